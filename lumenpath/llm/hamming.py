"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit for each of its numbers, set where the number is greater than 0.  Equal codes are one entry that
keeps its k + 1 least ids, which is all a result can need.  Entries are dealt by hash to data blocks of about ``BLOCK`` codes,
distinct query codes to query blocks, and each pair of blocks is one group of work.

In a group the data block is indexed by each of the code's segments.  A query looks up all keys that differ from its own
in r bits of a segment, for r = 0, 1, 2, ... and one segment after the other, and verifies the full distance of what it finds.
After radius r in the first a segments, every code nearer than segments * r + a has been seen, so the query ends as soon as
its kth verified distance lies below that.  The nearest k of all data blocks make the result.

Repeated rows (same id, same vector) count once; an id with several vectors takes part with each of them.  A row does not
find itself (same id, same code).  Ties go to the smaller id.  Rows without an id or whose vector is null or has not ``bits``
numbers are left out; NaN and null numbers give a 0 bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.llm.packing import grouped
from lumenpath.sources.staging import Stage

BITS, SEGMENT = 64, 16
BLOCK, QUERY_BLOCK = 1 << 16, 1 << 10


def codes(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """``id``, ``code`` (binary) of rows ``id``, ``vector``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("vector")
            fits = pc.and_(pc.equal(pc.list_value_length(vector), bits), pc.is_valid(batch.column("id")))
            batch = batch.filter(pc.fill_null(fits, False))
            if batch.num_rows:
                numbers = batch.column("vector").flatten().cast(pa.float64()).fill_null(0.0).to_numpy().reshape(-1, bits)
                packed = np.packbits(numbers > 0, axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([row.tobytes() for row in packed], pa.binary())], names=["id", "code"])

    return vectors.select(F.col("id").cast("bigint").alias("id"), "vector").mapInArrow(sign, "id bigint, code binary")


class SegmentIndex:
    """Codes of a block by the value of each segment."""

    def __init__(self, packed: np.ndarray, segment: int = SEGMENT):
        self.words = _words(packed)
        self.segment = segment
        self.keys = _segments(packed, segment)
        self.order = np.argsort(self.keys, axis=0, kind="stable")
        self.opens = [np.searchsorted(self.keys[self.order[:, j], j], np.arange((1 << segment) + 1)) for j in range(self.keys.shape[1])]
        self._flips: dict[int, np.ndarray] = {}

    def flips(self, radius: int) -> np.ndarray:
        """All masks of so many bits of a segment."""
        if radius not in self._flips:
            chosen = [sum(1 << b for b in some) for some in combinations(range(self.segment), radius)]
            self._flips[radius] = np.array(chosen, np.int64)
        return self._flips[radius]

    def nearest(self, packed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries at the k least distances, ties included, and their distances."""
        keys, words = _segments(packed[None], self.segment)[0], _words(packed[None])[0]
        seen = np.zeros(len(self.words), bool)
        entries, distances = [], np.zeros(0, np.int64)
        for radius in range(self.segment + 1):
            for j, key in enumerate(keys):
                probe = self.flips(radius) ^ key
                begin, size = self.opens[j][probe], self.opens[j][probe + 1] - self.opens[j][probe]
                hit = size > 0
                begin, size = begin[hit], size[hit]
                if len(size):
                    place = np.repeat(begin - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                    found = self.order[place, j]
                    found = found[~seen[found]]
                    seen[found] = True
                    entries.append(found)
                    distances = np.append(distances, np.bitwise_count(self.words[found] ^ words).sum(axis=1, dtype=np.int64))
                covered = len(keys) * radius + j  # every code at this distance or nearer has been seen
                if len(distances) == len(seen) or (len(distances) >= k and np.partition(distances, k - 1)[k - 1] <= covered):
                    break
            else:
                continue
            break
        entries = np.concatenate(entries) if entries else np.zeros(0, np.int64)
        if len(entries) > k:
            near = distances <= np.partition(distances, k - 1)[k - 1]
            entries, distances = entries[near], distances[near]
        return entries, distances


def _words(packed: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def _segments(packed: np.ndarray, segment: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1)
    count = -(-bits.shape[1] // segment)
    wide = np.zeros((len(packed), count * segment), np.int64)
    wide[:, : bits.shape[1]] = bits
    return wide.reshape(len(packed), count, segment) @ (1 << np.arange(segment, dtype=np.int64))


def _search(groups: DataFrame, k: int) -> DataFrame:
    """``query``, ``code``, ``distance``, ``ids`` from rows that are sorted by ``work``, the data before the queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "work"):
            asks = rows.column("asks").to_numpy()
            data = np.array([np.frombuffer(c, np.uint8) for c in rows.column("code").to_pylist()])
            ids = rows.column("ids").filter(pa.array(~asks)).to_pylist()
            if asks.all() or not asks.any():
                continue
            index, held = SegmentIndex(data[~asks]), data[~asks]
            best = []
            for query in data[asks]:
                entries, distances = index.nearest(query, k)
                named = sorted((d, i, e) for e, d in zip(entries.tolist(), distances.tolist()) for i in ids[e])[:k]
                best += [(query.tobytes(), held[e].tobytes(), d, i) for d, i, e in named]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*best), kinds)], names=["query", "code", "distance", "id"])

    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64()]
    return groups.mapInArrow(search, "query binary, code binary, distance int, id bigint")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, bits: int = BITS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``neighbor_id``, ``distance``: the k nearest of ``vectors`` for each of ``queries``.

    Both have ``id`` and ``vector``.
    """
    stage = Stage(vectors.sparkSession, "hamming")
    least = Window.partitionBy("code").orderBy("id")
    found = codes(vectors, bits).distinct().withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
    data = stage.keep("codes", lambda: found.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    asked = stage.keep("queries", lambda: codes(queries, bits).distinct())
    blocks = max(1, -(-data.count() // block))
    query_codes = asked.select("code").distinct()
    query_blocks = max(1, -(-query_codes.count() // query_block))
    dealt = data.select(
        F.pmod(F.xxhash64("code"), F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"),
        F.lit(False).alias("asks"), "code", "ids",
    ).union(query_codes.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("b"), F.pmod(F.xxhash64("code"), F.lit(query_blocks)).cast("int").alias("q"),
        F.lit(True).alias("asks"), "code", F.lit(None).cast("array<bigint>").alias("ids"),
    )).withColumn("work", F.col("b") * query_blocks + F.col("q"))
    dealt = dealt.repartition(blocks * query_blocks, "work").sortWithinPartitions("work", "asks")
    found = _search(dealt.select("work", "asks", "code", "ids"), k + 1)
    near = Window.partitionBy("query").orderBy("distance", "id")
    found = found.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    own = (F.col("id") == F.col("query_id")) & (F.col("code") == F.col("query"))
    answers = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(found, "query").where(~own)
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("distance", "id", "code"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("neighbor_id"), "distance")
