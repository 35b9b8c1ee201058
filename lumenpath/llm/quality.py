"""Quality classifier: a byte-level convolutional network in numpy.

A filter is a table of weights for each byte value at each of ``KERNEL`` neighbouring bytes; filters are applied every
``STRIDE`` bytes.  A document is covered from end to end by chunks of ``2 * HOP`` bytes, one every ``HOP`` bytes.  Within a
chunk each filter's answer is max-pooled; the mean and the maximum over the chunks of the document are combined by a
logistic layer into one probability.

Training runs on the driver over a bounded sample: at most ``SAMPLE`` labelled documents, those with the least hash of their
id, and of each at most ``SAMPLE_BYTES`` bytes, as evenly spaced pieces of the whole text.  Scoring reads whole texts.

Null and empty texts score as one chunk of padding.  Without labels the score is 0.5; with labels of one class only, it is
the smoothed share of that class.  Repeated documents get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenpath.llm.packing import tidied
from lumenpath.llm.words import slices, text_bytes

KERNEL, STRIDE, HOP, FILTERS = 8, 4, 256, 32
SAMPLE, SAMPLE_BYTES = 4000, 1 << 15
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-4
SLICE = 1 << 18


def _layout(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts padded apart; for each run of HOP bytes its first filter place, and the first run of each text, then their number."""
    length = np.diff(ends)
    places = np.maximum(1, -(-length // STRIDE))
    room = places + KERNEL // STRIDE  # zeros of a kernel's width follow each text
    opens = np.append(0, np.cumsum(room))
    padded = np.zeros(int(opens[-1]) * STRIDE + KERNEL, np.uint8)
    shift = np.repeat(opens[:-1] * STRIDE - ends[:-1], length)
    padded[np.arange(len(data)) + shift] = data
    runs = -(-places * STRIDE // HOP)
    first = np.append(0, np.cumsum(runs))
    within = np.arange(first[-1]) - np.repeat(first[:-1], runs)
    return padded, np.repeat(opens[:-1], runs) + within * (HOP // STRIDE), first


class Network:
    def __init__(self, table: np.ndarray, bias: np.ndarray, out: np.ndarray, prior: float):
        self.table, self.bias, self.out, self.prior = table, bias, out, prior

    def _answers(self, padded: np.ndarray) -> np.ndarray:
        n = (len(padded) - KERNEL) // STRIDE
        total = np.repeat(self.bias[None], n, axis=0)
        for k in range(KERNEL):
            total += self.table[k].take(padded[k : k + n * STRIDE : STRIDE], axis=0)
        return total

    def _chunks(self, padded: np.ndarray, opens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pooled answers of each chunk, and the first chunk of each text, then their number."""
        answers = self._answers(padded)
        stops = np.append(opens[1:], len(answers))
        last = np.zeros(len(opens), bool)
        last[first[1:] - 1] = True
        stops = np.where(last, stops - KERNEL // STRIDE, stops)
        pooled = np.maximum.reduceat(answers, np.stack([opens, np.minimum(stops, len(answers) - 1)], axis=1).ravel(), axis=0)[::2]
        pooled = np.maximum(pooled, 0)
        both = np.maximum(pooled, np.where(last[:, None], 0, np.append(pooled[1:], pooled[-1:], axis=0)))
        runs = np.diff(first)
        keep = ~last | np.repeat(runs == 1, runs)
        return both[keep], np.append(0, np.cumsum(np.maximum(1, runs - 1)))

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(ends) == 1:
            return np.zeros(0)
        if not len(self.out):
            return np.full(len(ends) - 1, self.prior)
        chunks, first = self._chunks(*_layout(data, ends))
        mean = np.add.reduceat(chunks, first[:-1], axis=0) / np.diff(first)[:, None]
        most = np.maximum.reduceat(chunks, first[:-1], axis=0)
        sums = (np.concatenate([mean, most], axis=1).astype(np.float64) * self.out[:-1]).sum(axis=1)  # by row: the same in any batch
        return 1 / (1 + np.exp(-(sums + self.out[-1])))


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Fits filters and logistic layer together, by Adam over mini-batches."""
    wanted = np.array(labels, np.float32)
    prior = float((wanted.sum() + 1) / (len(wanted) + 2))
    random = np.random.default_rng(seed)
    net = Network(
        random.normal(0, 0.15, (KERNEL, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        np.append(random.normal(0, 0.1, 2 * FILTERS), np.log(prior / (1 - prior))).astype(np.float32), prior,
    )
    if len(set(labels)) < 2:
        net.out = net.out[:0]
        return net
    weights = [net.table, net.bias, net.out]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            step += 1
            rate = RATE * (1 - 0.9 * step * BATCH / (EPOCHS * len(order)))
            grads = _gradients(net, [texts[i] for i in chosen], wanted[chosen])
            for k, (w, g) in enumerate(zip(weights, grads)):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                w -= rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8) + DECAY * w)
    return net


def _gradients(net: Network, texts: list[bytes], wanted: np.ndarray) -> list[np.ndarray]:
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    padded, opens, first = _layout(np.frombuffer(b"".join(texts), np.uint8), ends)
    answers = net._answers(padded)
    spans = [np.arange(a, min(a + 2 * HOP // STRIDE, len(answers) - 1)) for a in opens]
    g_table, g_bias, g_out = np.zeros_like(net.table), np.zeros_like(net.bias), np.zeros_like(net.out)
    everyone = np.arange(FILTERS)
    for k, target in enumerate(wanted):
        mine = spans[first[k] : first[k + 1]]
        end = mine[0][0] + max(1, -(-len(texts[k]) // STRIDE))
        mine = [s[s < end] for s in mine[: max(1, len(mine) - 1)]]
        at = np.stack([s[0] + answers[s].argmax(axis=0) for s in mine])  # chunk x filter
        pooled = np.maximum(answers[at, everyone], 0)
        top = pooled.argmax(axis=0)
        features = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)])
        error = (1 / (1 + np.exp(-(features @ net.out[:-1] + net.out[-1]))) - target) / len(wanted)
        g_out[:-1] += error * features
        g_out[-1] += error
        back = np.repeat((error * net.out[:FILTERS] / len(mine))[None], len(mine), axis=0)
        back[top, everyone] += error * net.out[FILTERS:-1]
        back *= pooled > 0
        g_bias += back.sum(axis=0)
        for j in range(KERNEL):
            np.add.at(g_table[j], (padded[at * STRIDE + j], np.broadcast_to(everyone, at.shape)), back)
    return [g_table, g_bias, g_out]


def _pieces(text: str | None) -> bytes:
    """The whole text, or evenly spaced pieces of a long one."""
    data = (text or "").encode()
    if len(data) <= SAMPLE_BYTES:
        return data
    piece = 2 * HOP
    starts = np.linspace(0, len(data) - piece, SAMPLE_BYTES // piece).astype(int)
    return b"".join(data[s : s + piece] for s in starts)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """``docs``: ``doc_id``, ``text``; ``labels``: ``doc_id``, ``label`` (0 or 1); equal ids take the larger label and the smaller text."""
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [_pieces(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(data, pa.binary())], names=["doc_id", "label", "data"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    pieces = chosen.select("doc_id", "label", "text").mapInArrow(tidied(cut), "doc_id bigint, label int, data binary")
    rows = pieces.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("data").alias("data")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return train([bytes(r["data"]) for r in rows], [r["label"] for r in rows])


def score(docs: DataFrame, network: Network, column: str = "score") -> DataFrame:
    """The documents with the probability of label 1; a column of that name is replaced."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(vars(network))
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(**shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = net.scores(*text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=schema.fieldNames())

    return docs.mapInArrow(tidied(scores), schema)
