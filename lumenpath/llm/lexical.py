"""Ranked lexical search with bit-sliced Bloom signatures.

``index`` cuts the documents into shards of a few hundred of similar size.  A document's signature is a Bloom filter of its terms, with
further entries for terms that it holds 2, 4, 8, ... times at least; a shard stores the signatures by slice, that is, for each bit
a bitmap over its documents.  Beside them it keeps the exact terms and counts of each document, in a cell of its own.

``rank`` intersects the slices of each term of the items.  The bitmaps overestimate which documents hold a term how often, so the
sum of the largest scores that each of them allows bounds a document's score from above.  Documents that this puts below the k-th
best so far are out; of all others the cell is opened and the score is computed exactly.  The best of all tasks are merged.

Items are ranked in blocks of about ``BLOCK_TERMS`` terms, each of which reads the index twice, once to count in how many documents
each term occurs; an item with more terms is a block of its own.  Statistics cover all documents.

Null and empty texts have no terms.  Repeated documents are ranked one by one; repeated items (same id and text) once, items that
share an id one by one.  Documents without an id are ranked with a null ``doc_id``, behind others of the same score.  Only the
columns named are read.  No documents, or no items, give no rows.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.llm.packing import cuts, pack, tidied, unpack
from lumenpath.llm.words import NOT_ALPHANUMERIC, Words, mix, slices
from lumenpath.sources.staging import Stage

SHARD = 256  # documents of a shard
GATHERED, GATHERED_TERMS = 2048, 1 << 20  # documents, and their distinct terms, that a task holds to form shards
PROBES, BITS_PER_ENTRY = 4, 10
AT_ONCE = 1 << 14  # terms of a shard whose slices are worked out together
PART = 1 << 11  # terms of a block whose bitmaps are unpacked together
DOCS = 64  # documents that are scored together
BLOCK_TERMS = 1 << 14
_LEVEL = np.uint64(0xD1342543DE82EF95)

INDEX = "n_docs int, n_terms bigint, least bigint, levels int, bits int, ids array<bigint>, lengths array<bigint>, sizes array<int>, slices binary, terms array<binary>, counts array<binary>"
INDEX_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
INDEX_NAMES = [field.split()[0] for field in INDEX.split(", ")]


def entries(terms: np.ndarray, level: int) -> np.ndarray:
    """The Bloom entry of each term for documents that hold it 2**level times at least."""
    return mix(terms + np.uint64(level) * _LEVEL)


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` slices of each entry, out of a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    probes = hashes[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)
    return ((probes ^ (probes >> np.uint64(17))) & np.uint64(bits - 1)).astype(np.int64)


def _shard(docs: list[tuple]) -> tuple:
    """A row of the index from documents (id, length, terms, counts)."""
    owners = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
    terms = np.concatenate([d[2] for d in docs])
    counts = np.concatenate([d[3] for d in docs])
    levels = int(counts.max()).bit_length()
    most = max(int(np.log2(d[3]).astype(np.int64).sum()) + len(d[2]) for d in docs)
    bits = 1 << max(6, (BITS_PER_ENTRY * most - 1).bit_length())
    table = np.zeros((bits, len(docs)), bool)
    for level in range(levels):
        held = np.flatnonzero(counts >= 1 << level)
        for at in range(0, len(held), AT_ONCE):
            some = held[at : at + AT_ONCE]
            table[places(entries(terms[some], level), bits), owners[some][:, None]] = True
    lengths = [d[1] for d in docs]
    return (
        len(docs), sum(lengths), min(lengths), levels, bits, [d[0] for d in docs], lengths, [len(d[2]) for d in docs],
        pa.compress(np.packbits(table, axis=1).tobytes(), codec="zstd", asbytes=True), [pack(d[2]) for d in docs], [pack(d[3].astype(np.uint64), 4) for d in docs],
    )


def _similar(docs: list[tuple]) -> Iterator[list[tuple]]:
    """Documents by number of terms, cut so that none of a shard has far more than another."""
    shard: list[tuple] = []
    for doc in sorted(docs, key=lambda d: len(d[2])):
        if shard and (len(shard) == SHARD or len(doc[2]) > 2 * len(shard[0][2]) + 32):
            yield shard
            shard = []
        shard.append(doc)
    if shard:
        yield shard


def index(docs: DataFrame) -> DataFrame:
    """Shards of the documents (``doc_id``, ``text``) that have a term."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def shards(docs):
            for some in _similar(docs):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(_shard(some), INDEX_TYPES)], names=INDEX_NAMES)

        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), NOT_ALPHANUMERIC)
                for k, own in enumerate(part.column("doc_id").to_pylist()):
                    a, b = int(words.starts[k]), int(words.starts[k + 1])
                    if a < b:
                        found = np.sort(words.hashes[a:b])
                        begin = cuts(found)
                        held.append((own, b - a, found[begin[:-1]], np.diff(begin)))
                        size += len(begin)
                if len(held) >= GATHERED or size >= GATHERED_TERMS:
                    yield from shards(held)
                    held, size = [], 0
        yield from shards(held)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(build), INDEX)


def _counted(shards: DataFrame, vocabulary) -> DataFrame:
    """``term`` (its place in the vocabulary) and ``df`` of the terms that occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                sizes, cells = batch.column("sizes")[k].as_py(), batch.column("terms")[k].as_py()
                terms = np.concatenate([unpack(cell, n) for cell, n in zip(cells, sizes)])
                at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
                total += np.bincount(at[wanted[at] == terms], minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["term", "df"])

    return shards.select("sizes", "terms").mapInArrow(tidied(count), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def _damping(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length adds to the divisor: 25 and up to 75 more for one of average length."""
    return 25 + 75 * lengths * n_docs // n_terms


def _gain(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth, out of a million."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * damping)


class Items:
    """A block of items: its terms, their weights, and for each item the places of its terms and how often it has them."""

    def __init__(self, vocabulary: np.ndarray, weights: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int):
        self.vocabulary, self.items, self.n_docs, self.n_terms, self.k = vocabulary, items, n_docs, n_terms, k
        self.weights = [times * weights[at] for _, at, times in items]
        self.heaps: list[list[tuple]] = [[] for _ in items]
        self.exact = 0  # pairs of item and document that were scored

    def least(self, item: int) -> int:
        """The score that a document must reach."""
        heap = self.heaps[item]
        return max(1, heap[0][0]) if len(heap) == self.k else 1

    def add(self, item: int, score: int, doc_id: int | None) -> None:
        entry, heap = (score, doc_id is not None, 0 if doc_id is None else -doc_id), self.heaps[item]
        if len(heap) < self.k:
            heappush(heap, entry)
        elif entry > heap[0]:
            heapreplace(heap, entry)

    def bounds(self, row: dict, lengths: np.ndarray) -> np.ndarray:
        """For each item and document of a shard, what the score cannot exceed."""
        n_docs, bits = row["n_docs"], row["bits"]
        table = np.frombuffer(pa.decompress(row["slices"], bits * -(-n_docs // 8), codec="zstd", asbytes=True), np.uint8).reshape(bits, -1)
        damping = _damping(np.array([lengths.min()]), self.n_docs, self.n_terms)
        worth = np.zeros((len(self.vocabulary), n_docs), np.float32)  # whole numbers up to a million, so nothing is rounded
        for begin in range(0, len(worth), PART):
            terms, part = self.vocabulary[begin : begin + PART], worth[begin : begin + PART]
            held, before = None, 0
            for level in range(row["levels"]):
                sets = np.bitwise_and.reduce(table[places(entries(terms, level), bits)], axis=1)
                held = sets if held is None else held & sets
                gain = int(_gain(np.array([(2 << level) - 1]), damping)[0])
                part += np.unpackbits(held, axis=1, count=n_docs) * float(gain - before)
                before = gain
        return np.array([weights @ worth[at].astype(float) for (_, at, _), weights in zip(self.items, self.weights)])

    def visit(self, row: dict) -> None:
        """Takes what a shard can add to the results."""
        lengths = np.array(row["lengths"], np.int64)
        bound = self.bounds(row, lengths)
        done = np.zeros(bound.shape, bool)
        first = np.zeros(bound.shape, bool)
        best = np.argpartition(-bound, min(self.k, bound.shape[1]) - 1, axis=1)[:, : self.k]
        np.put_along_axis(first, best, True, axis=1)
        for wanted in (first, ~first):  # the most promising ones raise what the others must reach
            least = np.array([self.least(item) for item in range(len(self.items))])
            wanted = wanted & ~done & (bound >= least[:, None])
            self.score(row, lengths, wanted)
            done |= wanted

    def score(self, row: dict, lengths: np.ndarray, wanted: np.ndarray) -> None:
        found = np.flatnonzero(wanted.any(axis=0))
        for begin in range(0, len(found), DOCS):
            self._score(row, lengths, wanted, found[begin : begin + DOCS])

    def _score(self, row: dict, lengths: np.ndarray, wanted: np.ndarray, docs: np.ndarray) -> None:
        gains = np.zeros((len(self.vocabulary), len(docs)), np.int64)
        for place, doc in enumerate(docs.tolist()):
            n = row["sizes"][doc]
            terms = unpack(row["terms"][doc], n)
            at = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == terms
            counts = unpack(row["counts"][doc], n, 4)[hit].astype(np.int64)
            gains[at[hit], place] = _gain(counts, _damping(lengths[doc], self.n_docs, self.n_terms))
        for item, ((_, at, _), weights) in enumerate(zip(self.items, self.weights)):
            some = np.flatnonzero(wanted[item, docs])
            if len(some):
                self.exact += len(some)
                scores = weights @ gains[np.ix_(at, some)]
                least = self.least(item)
                for k in np.flatnonzero(scores >= least).tolist():
                    self.add(item, int(scores[k]), row["ids"][int(docs[some[k]])])


def _ranked(shards: DataFrame, block) -> DataFrame:
    names, kinds = ["item", "score", "doc_id"], [pa.int64(), pa.int64(), pa.int64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*block.value)
        for batch in batches:
            for k in range(batch.num_rows):
                items.visit({name: batch.column(name)[k].as_py() for name in batch.schema.names})
        out = [(items.items[k][0], score, -own if named else None) for k, heap in enumerate(items.heaps) for score, named, own in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    return shards.mapInArrow(tidied(search), "item bigint, score bigint, doc_id bigint")


def _terms_of(texts: list[str]) -> list[np.ndarray]:
    words = Words(pa.array(texts, pa.string()), NOT_ALPHANUMERIC)
    return [words.hashes[a:b] for a, b in zip(words.starts[:-1], words.starts[1:])]


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the k best documents of each item (``item_id``, ``text``) with a score above 0."""
    spark = docs.sparkSession
    stage = Stage(spark, "lexical")
    shards = stage.keep("index", lambda: index(docs))
    size = shards.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    texts = items.select("item_id", "text").where("text is not null").distinct()
    # An item has at most half as many terms as characters, and one.
    room = F.floor(F.char_length("text") / 2).cast("bigint") + 1
    kept = stage.keep("items", lambda: texts.withColumn("item", F.monotonically_increasing_id()).withColumn("room", room))
    blocks = max(1, -(-(kept.agg(F.sum("room").alias("room")).first().room or 0) // block_terms))
    found = None
    for k_block in range(blocks if size.n_docs else 0):
        rows = kept.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k_block).select("item", "text").collect()
        terms = _terms_of([row.text for row in rows])
        vocabulary = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
        if not len(vocabulary):
            continue
        counted = _counted(shards, spark.sparkContext.broadcast(vocabulary)).collect()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in counted:
            weights[term] = math.floor(1000 * math.log((2 * size.n_docs + 2) / (2 * df + 1)))
        block = [(row.item, *np.unique(np.searchsorted(vocabulary, own), return_counts=True)) for row, own in zip(rows, terms) if len(own)]
        shared = spark.sparkContext.broadcast((vocabulary, weights, block, size.n_docs, size.n_terms, k))
        best = stage.keep(f"block{k_block}", lambda: _ranked(shards, shared))  # noqa: B023
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "item bigint, score bigint, doc_id bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    found = found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k)
    return found.join(kept.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
