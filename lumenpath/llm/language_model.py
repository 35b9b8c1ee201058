"""N-gram scoring from a log-frequency Bloom filter.

Counting: tasks hash the n-grams of whole texts, sort and add them up in numpy, and shuffle packed arrays by shard, that is
by the leading bits of the hash.  Each shard adds up its n-grams and becomes one part of the filter: an n-gram with count c is
inserted 1 + floor(log2 c) times, once for each level, so its quantised count is found by probing level after level until one
is missing.  Parts are sized for their own entries, so the filter grows with the corpus at a constant error rate.

Scoring: parts are broadcast to the workers, at most ``ROUND_BYTES`` of them at a time.  If the filter is larger, the documents
are visited once for each group of parts; the levels found so far travel with the document through a written table, which is
removed when the next one is written.
The last visit turns levels into probabilities: P(w | h) = (1 - a) P(w | h') + a c(hw) / c(h), from trigram to unigram, where
h' lacks the first word of h, and P(w | h) = P(w | h') where h is unknown.  A level stands for the middle of the counts it
covers, and unigrams are smoothed by adding one.

The base score needs exact unigram counts.  The ``FREQUENT`` most frequent words are broadcast; all other words of a document
are joined with the full table of counts.

Words are told apart by 64-bit hashes, n-grams of two and three words by the shard and 40 more bits.  All n-grams
are inserted, also those of count 1 (``LEAST``).  Null and empty texts are one token, the end.  Rows without an id are
scored and learned from.  Without training rows all scores rest on V = N = 0.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.packing import cuts, grouped, pack, unpack
from lumenpath.llm.words import Words, chain, mix, slices
from lumenpath.sources.staging import Stage

END, OPEN = np.uint64(0x656E64), np.uint64(0x6F70656E)  # tokens no word hashes to by design: the end, and what stands before a text
LEAST = (1, 1, 1)  # least count of an n-gram of 1, 2, 3 words in the filter
WEIGHT = (0.1, 0.1)  # a of bigrams and trigrams
BITS_PER_ENTRY, PROBES = 10, 4
ROUND_BYTES = 96 << 20
FREQUENT = 1 << 19
SHARD_ENTRIES = 1 << 20
FLUSH = 3_000_000  # n-grams that a task holds before it writes them out
ID_BYTES = 5


def token_stream(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts, two opening ones before and the end after each; where each text opens, and which tokens are real."""
    n = np.diff(words.starts)
    opens = np.append(0, np.cumsum(n + 3))
    tokens = np.full(opens[-1], OPEN, np.uint64)
    tokens[opens[1:] - 1] = END
    real = np.ones(len(tokens), bool)
    real[opens[:-1]] = real[opens[:-1] + 1] = False
    inner = real.copy()
    inner[opens[1:] - 1] = False
    tokens[inner] = words.hashes
    return tokens, opens, real


def ngram_hashes(tokens: np.ndarray, real: np.ndarray) -> list[np.ndarray]:
    """For orders 1, 2, 3 the hash of the n-gram that ends at each real token."""
    out = []
    for n in (1, 2, 3):
        made = mix(chain(tokens, n) + np.uint64(n))
        out.append(made[np.flatnonzero(real) - n + 1] if len(made) else made)
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edges = cuts(keys)[:-1]
    return keys[edges], np.add.reduceat(counts, edges) if len(edges) else counts


def _levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def middle(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level covers; 0 for level 0."""
    return np.where(levels > 0, (3 * 2.0 ** (levels - 1) - 1) / 2, 0.0)


class Filter:
    """Parts of the log-frequency Bloom filter: their bits one after the other, and where each shard's part lies in them."""

    def __init__(self, shards: int, bits: bytes | bytearray = b"", opens: np.ndarray | None = None, sizes: np.ndarray | None = None):
        self.shards, self.bits = shards, bits
        self.opens = np.zeros(shards, np.uint64) if opens is None else opens
        self.sizes = np.zeros(shards, np.uint64) if sizes is None else sizes

    @staticmethod
    def split(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each hash and what identifies it there."""
        bits = np.uint64(shards.bit_length() - 1)
        shard = (hashes >> (np.uint64(64) - bits)).astype(np.int64) if shards > 1 else np.zeros(len(hashes), np.int64)
        return shard, (hashes << bits) >> np.uint64(64 - 8 * ID_BYTES)

    @staticmethod
    def places(ids: np.ndarray, level: int, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """The bits of an entry, one probe after the other, in parts of so many bits."""
        first = mix(ids + np.uint64(level * 0xC2B2AE3D27D4EB4F % (1 << 64)))
        second = mix(first)
        for _ in range(PROBES):
            yield ((first >> np.uint64(32)) * sizes) >> np.uint64(32)
            first = first + second

    @classmethod
    def part(cls, ids: np.ndarray, levels: np.ndarray) -> bytes:
        """The bits of one shard."""
        size = 8 * max(8, -(-int(levels.sum()) * BITS_PER_ENTRY // 8))
        flags = np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for place in cls.places(ids[levels >= level], level, np.uint64(size)):
                flags[place.astype(np.int64)] = True
        return np.packbits(flags, bitorder="little").tobytes()

    def add(self, shard: int, part: bytes) -> None:
        self.opens[shard], self.sizes[shard] = len(self.bits) * 8, len(part) * 8
        self.bits += part

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The highest level up to which each n-gram is found; 0 if it is not, or its part is not here."""
        hashes, again = np.unique(hashes, return_inverse=True)  # each once, and part by part
        bits = np.frombuffer(self.bits, np.uint8)
        shard, ids = self.split(hashes, self.shards)
        found = np.zeros(len(hashes), np.uint8)
        still = np.flatnonzero(self.sizes[shard])
        level = 0
        while len(still):
            level += 1
            begin, sizes, probed = self.opens[shard[still]], self.sizes[shard[still]], np.arange(len(still))
            for place in self.places(ids[still], level, sizes):
                place = begin[probed] + place[probed]
                there = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                probed = probed[there > 0]
            still = still[probed]
            found[still] = level
        return found[again]


_CHUNK = "shard int, gram int, rows int, keys binary, counts binary"
_PART = "shard int, kind int, distinct bigint, total bigint, keys binary, counts binary"


def _count(texts: DataFrame, shards: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for n, grams in enumerate(held, 1):
                keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]), return_counts=True)
                shard, ids = Filter.split(keys, shards)
                stored, width = (keys, 8) if n == 1 else (ids, ID_BYTES)
                edges = cuts(shard)
                columns = [
                    (int(shard[a]), n, b - a, pack(stored[a:b], width), pack(counts[a:b].astype(np.uint64), 4)) for a, b in zip(edges[:-1], edges[1:])
                ]
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns), kinds)], names=names)

        for batch in batches:
            for part in slices(batch, "text"):
                tokens, _, real = token_stream(Words(part.column("text")))
                for grams, new in zip(held, ngram_hashes(tokens, real)):
                    grams.append(new)
                    size += len(new)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [[], [], []], 0
        yield from flush()

    names, kinds = ["shard", "gram", "rows", "keys", "counts"], [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return texts.mapInArrow(count, _CHUNK)


def _build(chunks: DataFrame, shards: int) -> DataFrame:
    """For each shard the exact counts of its words (kind 1) and its part of the filter (kind 2)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in grouped(batches, "shard"):
            held: dict[int, list] = defaultdict(list)
            for row in rows.to_pylist():
                width = 8 if row["gram"] == 1 else ID_BYTES
                held[row["gram"]].append((unpack(row["keys"], row["rows"], width), unpack(row["counts"], row["rows"], 4)))
            ids, levels, words = [], [], (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
            for n, chunks in held.items():
                keys, counts = _summed(*[np.concatenate(x) for x in zip(*chunks)])
                if n == 1:
                    words = keys, counts
                    keys = Filter.split(keys, shards)[1]
                often = counts >= LEAST[n - 1]
                ids.append(keys[often])
                levels.append(_levels(counts[often]))
            part = Filter.part(np.concatenate(ids), np.concatenate(levels))
            n = len(words[0])
            out = [(shard, 1, n, int(words[1].sum()), pack(words[0]), pack(words[1], 6)), (shard, 2, 0, len(part), part, b"")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names = ["shard", "kind", "distinct", "total", "keys", "counts"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return chunks.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, _PART)


class Model:
    """What training leaves: the written parts, the table of word counts, N, V, the number of texts and the frequent words."""

    def __init__(self, texts: DataFrame, stage: Stage, shard_entries: int = SHARD_ENTRIES, frequent: int = FREQUENT):
        texts = texts.select("text")
        row = texts.agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("size"), F.count("*").alias("n")).first()
        self.texts = row["n"]
        entries = ((row["size"] or 0) // 5 + self.texts) * 3
        self.shards = 1 << max(2, int(entries // shard_entries).bit_length())
        self.parts = stage.keep("parts", lambda: _build(_count(texts, self.shards), self.shards))
        sums = self.parts.where("kind = 1").agg(F.sum("total"), F.sum("distinct")).first()
        self.tokens, self.distinct = sums[0] or 0, sums[1] or 0

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    n = row["distinct"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(unpack(row["keys"], n).view(np.int64)), pa.array(unpack(row["counts"], n, 6).view(np.int64))], names=["word", "seen"]
                    )

        words = self.parts.where("kind = 1 and distinct > 0").select("distinct", "keys", "counts").mapInArrow(rows, "word bigint, seen bigint")
        size = F.floor(F.log2("seen") * 8)
        bins = words.groupBy(size.alias("size")).count().collect()  # at most 8 a doubling
        lowest, total = None, 0
        for bin_ in sorted(bins, key=lambda r: -r["size"]):
            total += bin_["count"]
            if total > frequent:
                break
            lowest = bin_["size"]
        often = words.where(size >= lowest).toArrow() if lowest is not None else None
        keys = often.column("word").to_numpy().view(np.uint64) if often is not None else np.zeros(0, np.uint64)
        order = np.argsort(keys)
        self.frequent = keys[order], (often.column("seen").to_numpy()[order] if often is not None else np.zeros(0, np.int64))
        self.rare = words.where(size < lowest) if lowest is not None else words

    def rounds(self, most: int = ROUND_BYTES) -> Iterator[tuple[Filter, bool]]:
        """The filter in pieces of at most ``most`` bytes (one part at least), and whether it is the last one."""
        sizes = {r["shard"]: r["total"] for r in self.parts.where("kind = 2").select("shard", "total").collect()}
        groups: list[list[int]] = [[]]
        held = 0
        for shard in sorted(sizes):
            if groups[-1] and held + sizes[shard] > most:
                groups.append([])
                held = 0
            groups[-1].append(shard)
            held += sizes[shard]
        for group in groups:
            piece = Filter(self.shards, bytearray())
            if group:
                rows = self.parts.where(f"kind = 2 and shard between {group[0]} and {group[-1]}").select("shard", "keys")
                for row in rows.toLocalIterator():
                    piece.add(row["shard"], row["keys"])
            yield piece, group is groups[-1]


def _log_probabilities(levels: np.ndarray, model: tuple[int, int, int]) -> float:
    """log10 of the probability of a text, from the levels of its tokens' n-grams."""
    texts, tokens, distinct = model
    one, two, three = middle(levels.astype(np.int64))
    before = np.append(texts, one[:-1])
    pair = np.append(texts, two[:-1])
    p = (one + 1) / (tokens + distinct + 1)
    for weight, context, whole in zip(WEIGHT, (before, pair), (two, three)):
        p = np.where(context > 0, (1 - weight) * p + weight * whole / np.maximum(np.maximum(context, whole), 1), p)
    return float(np.log10(p).sum())


_PROBED = "uid bigint, doc_id bigint, text string, levels binary"
_SCORED = "uid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, words array<bigint>, times array<int>"


def _visit(docs: DataFrame, piece: Filter, model: Model, first: bool, last: bool) -> DataFrame:
    """One visit of the documents, with the parts of one round.

    It gives the levels of the n-grams that end at each token, order by order, as far as they are known; the last visit
    gives scores, the base score of frequent words, and the other words with how often they occur.
    """
    shared = docs.sparkSession.sparkContext.broadcast((piece.shards, bytes(piece.bits), piece.opens, piece.sizes))
    counts = docs.sparkSession.sparkContext.broadcast((model.frequent, (model.texts, model.tokens, model.distinct))) if last else None

    def rare_words(words: np.ndarray, owner: np.ndarray, n: int) -> list[pa.Array]:
        order = np.lexsort((words, owner))
        words, owner = words[order], owner[order]
        edges = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1]))) if len(order) else order
        times = np.diff(np.append(edges, len(order))).astype(np.int32)
        lists = pa.array(np.searchsorted(owner[edges], np.arange(n + 1)).astype(np.int32))
        return [pa.ListArray.from_arrays(lists, pa.array(words[edges].view(np.int64))), pa.ListArray.from_arrays(lists, pa.array(times))]

    def scored(part: pa.RecordBatch, words: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> list[pa.Array]:
        (keys, seen), sizes = counts.value
        n, whole = part.num_rows, sizes[1] + sizes[2] + 1
        owner = np.repeat(np.arange(n), np.diff(ends))
        known, base = np.zeros(len(words), bool), np.zeros(n)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            known = keys[at] == words
            base = np.bincount(owner[known], np.log10((seen[at[known]] + 1) / whole), n)
        return [
            pa.array(np.diff(ends)), pa.array(np.bincount(owner[known], minlength=n)), pa.array(base),
            pa.array([_log_probabilities(x, sizes) for x in levels], pa.float64()), *rare_words(words[~known], owner[~known], n),
        ]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filter(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, opens, real = token_stream(Words(part.column("text")))
                grams = ngram_hashes(tokens, real)
                found = np.stack([held.levels(h) for h in grams])
                ends = opens - 2 * np.arange(len(opens))
                levels = [found[:, a:b] for a, b in zip(ends[:-1], ends[1:])]
                if not first:
                    levels = [np.maximum(x, np.frombuffer(old, np.uint8).reshape(3, -1)) for x, old in zip(levels, part.column("levels").to_pylist())]
                if last:
                    columns = [part.column("uid"), part.column("doc_id"), *scored(part, grams[0], ends, levels)]
                else:
                    columns = [part.column(c) for c in ("uid", "doc_id", "text")] + [pa.array([x.tobytes() for x in levels], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _SCORED if last else _PROBED
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.mapInArrow(visit, schema)


def score(docs: DataFrame, training: DataFrame, round_bytes: int = ROUND_BYTES, frequent: int = FREQUENT, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row ``doc_id``, ``text``.

    ``training`` has the texts to learn from.
    """
    stage = Stage(docs.sparkSession, "language_model")
    model = Model(training, stage, shard_entries, frequent)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for turn, (piece, last) in enumerate(model.rounds(round_bytes)):
        rows = stage.keep(f"round{turn}", lambda visited=_visit(rows, piece, model, turn == 0, last): visited)
        if turn:
            stage.drop(f"round{turn - 1}")  # texts and levels of one round are enough
    scored = rows
    rare = scored.select("uid", F.explode(F.arrays_zip("words", "times")).alias("x")).select("uid", "x.words", "x.times")
    seen = F.coalesce("seen", F.lit(0))
    rest = rare.join(model.rare, rare["words"] == model.rare["word"], "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10((seen + 1) / F.lit(float(model.tokens + model.distinct + 1)))).alias("more"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("also"),
    )
    return scored.join(rest, "uid", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )
