"""Nearest vectors by Euclidean distance: a block matrix join over int8 products with error bounds.

Vectors lie packed in blocks of ``BLOCK``; blocks are dealt to groups of at most ``GROUP_BYTES``, and packed blocks of the stated
queries are copied to every group.  A tile is a data block times a query block.  Each vector is rounded to a scale times whole
numbers from -127 to 127; the products of a tile are those of whole numbers, and so exact.  They give the distances of the rounded
vectors, and with the lengths of what rounding left out a lower and an upper bound of each true distance.  Pairs whose lower bound
lies above the k-th best so far, or above the k-th least upper bound of the tile, are out; all others are computed from the original
numbers in double precision, one component after the other, and enter a heap per query.  The heaps of all groups are merged.

Rows with the same id and the same vector count once; an id with several vectors takes part with each of them, and is a candidate
for itself by the others.  Of equal vectors the k + 1 least ids are enough for every result, and only these are compared.  Vectors
are compared with those of the same length.  Rows without an id, and vectors that are null, empty, all zero or hold null or
non-finite numbers, take no part.  Ties go to the smaller id.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.sources.staging import Stage

BLOCK, QUERY_BLOCK = 2048, 512
BLOCK_BYTES, GROUP_BYTES = 4 << 20, 64 << 20
EXACT = 1024  # components whose int8 products add up to less than 2**24, so that single precision holds them exactly


def packed(vectors: DataFrame) -> DataFrame:
    """``id``, ``cell`` (the numbers as little-endian doubles) of the rows ``id``, ``vector`` that take part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("vector")
            batch = batch.filter(pc.fill_null(pc.and_(pc.is_valid(batch.column("id")), pc.greater(pc.list_value_length(vector), 0)), False))
            ids, cells = [], []
            if batch.num_rows:
                vector = batch.column("vector")
                numbers = vector.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
                ends = np.cumsum(pc.list_value_length(vector).to_numpy(zero_copy_only=False))
                begins = np.append(0, ends[:-1])
                fits = np.logical_and.reduceat(np.isfinite(numbers), begins) & np.logical_or.reduceat(numbers != 0, begins)
                numbers = numbers + 0.0  # one zero only
                ids = batch.column("id").filter(pa.array(fits))
                cells = [numbers[a:b].tobytes() for a, b, fit in zip(begins.tolist(), ends.tolist(), fits.tolist()) if fit]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()) if not len(cells) else ids, pa.array(cells, pa.binary())], names=["id", "cell"])

    return vectors.select(F.col("id").cast("bigint").alias("id"), "vector").mapInArrow(pack, "id bigint, cell binary")


def _blocks(rows: DataFrame, size: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``width`` (bytes of a vector), ``ids`` and ``cells``: up to ``size`` vectors of one length, or ``BLOCK_BYTES``, in a row.

    ``part`` is the task that packed them; ``run`` counts runs of its blocks that hold about ``group_bytes``.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        waiting, passed, part = 0, 0, None

        def block(width):
            nonlocal waiting, passed
            ids, cells = held.pop(width)
            columns = [pa.array([x], t) for x, t in ((part, pa.int32()), (passed // group_bytes, pa.int64()), (width, pa.int32()))]
            waiting, passed = waiting - width * len(ids), passed + width * len(ids)
            columns += [pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([b"".join(cells)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "run", "width", "ids", "cells"])

        for batch in batches:
            for part, own, cell in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "cell"))):
                ids, cells = held.setdefault(len(cell), ([], []))
                ids.append(own)
                cells.append(cell)
                waiting += len(cell)
                if len(ids) == size or len(ids) * len(cell) >= BLOCK_BYTES:
                    yield block(len(cell))
                elif waiting >= 4 * BLOCK_BYTES:
                    for width in list(held):
                        yield block(width)
        for width in list(held):
            yield block(width)

    return rows.select(F.spark_partition_id().alias("part"), "id", "cell").mapInArrow(fill, "part int, run bigint, width int, ids binary, cells binary")


class Rounded:
    """Vectors as a scale times whole numbers of 8 bits, with the length of what is left out."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        with np.errstate(all="ignore"):
            self.scale = np.abs(vectors).max(axis=1) / 127
            self.codes = np.clip(np.rint(vectors / np.where(self.scale == 0, 1, self.scale)[:, None]), -127, 127).astype(np.int8)
            rounded = self.codes * self.scale[:, None]
            self.square = (self.codes.astype(np.int64) ** 2).sum(axis=1) * self.scale**2
            self.left = np.sqrt(((vectors - rounded) ** 2).sum(axis=1)) * (1 + 1e-9)

    def products(self, other: Rounded) -> np.ndarray:
        """Products of all codes with all codes of the other, exact."""
        total = np.zeros((len(self.codes), len(other.codes)))
        for at in range(0, self.codes.shape[1], EXACT):
            total += self.codes[:, at : at + EXACT].astype(np.float32) @ other.codes[:, at : at + EXACT].astype(np.float32).T
        return total

    def bounds(self, other: Rounded) -> tuple[np.ndarray, np.ndarray]:
        """What no distance to a vector of the other lies below, and what none lies above."""
        with np.errstate(all="ignore"):
            squares = self.square[:, None] + other.square[None]
            near = squares - 2 * self.scale[:, None] * other.scale[None] * self.products(other)
            slack, left = 1e-12 * squares, self.left[:, None] + other.left[None]
            # Tiny numbers, whose squares vanish, get a bound of their own from the length of the vectors.
            slack = slack + 1e-290
            low = np.sqrt(np.maximum(near - slack, 0)) * (1 - 1e-9) - left
            high = np.sqrt(near + slack) * (1 + 1e-9) + left
        return np.where(np.isfinite(low), low, 0.0), np.where(np.isfinite(high), high, np.inf)


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, added up from the first component to the last."""
    total = np.zeros(len(vectors))
    with np.errstate(all="ignore"):
        for component in range(vectors.shape[1]):
            apart = query[component] - vectors[:, component]
            total += apart * apart
    return np.sqrt(total)


class Nearest:
    """The k best candidates of one query: a heap with the worst on top."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def cut(self) -> float:
        return -self.heap[0][0] if len(self.heap) == self.k else np.inf

    def add(self, distance: float, own: int) -> None:
        entry = (-distance, -own)
        if len(self.heap) < self.k:
            heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapreplace(self.heap, entry)


def search_tile(queries: Rounded, query_ids: np.ndarray, data: Rounded, data_ids: np.ndarray, best: list[Nearest]) -> int:
    """Enters what a tile can add to the results; returns how many pairs were computed in full."""
    low, high = queries.bounds(data)
    computed = 0
    for at, held in enumerate(best):
        other = data_ids != query_ids[at]
        for own in np.flatnonzero(~other):  # the row itself; not another vector under its id
            other[own] = not np.array_equal(data.vectors[own], queries.vectors[at])
        upper = high[at][other]
        cut = min(held.cut(), np.partition(upper, held.k - 1)[held.k - 1]) if len(upper) >= held.k else held.cut()
        some = np.flatnonzero(other & (low[at] <= cut))
        computed += len(some)
        for distance, own in zip(distances(queries.vectors[at], data.vectors[some]).tolist(), data_ids[some].tolist()):
            held.add(distance, own)
    return computed


def _search(dealt: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``query``, ``distance``, ``vec_id`` from rows sorted by ``team``, the data before the queries."""
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    names = ["query_id", "query", "distance", "vec_id"]

    def numbers(row) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["cells"], "<f8").reshape(-1, row["width"] // 8)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        team, data = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["team"] != team:
                    team, data = row["team"], []
                ids, vectors = numbers(row)
                if not row["asks"]:
                    data.append((ids, Rounded(vectors)))
                    continue
                queries, best = Rounded(vectors), [Nearest(k) for _ in ids]
                for data_ids, block in data:
                    if block.vectors.shape[1] == vectors.shape[1]:
                        search_tile(queries, ids, block, data_ids, best)
                out = [(int(ids[at]), row["first"] + at, -d, -own) for at, held in enumerate(best) for d, own in held.heap]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    return dealt.mapInArrow(search, "query_id bigint, query bigint, distance double, vec_id bigint")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, query_block: int = QUERY_BLOCK, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest of ``vectors`` for each of ``queries``.

    Both have ``id`` and ``vector``.  A group is what one task has packed, or a run of about ``group_bytes`` of it.
    """
    stage = Stage(vectors.sparkSession, "neighbours")
    least = F.row_number().over(Window.partitionBy("cell").orderBy("id"))
    distinct = packed(vectors).distinct().withColumn("place", least).where(F.col("place") <= k + 1)
    data = stage.keep("data", lambda: _blocks(distinct, block, group_bytes))
    first = F.monotonically_increasing_id() * query_block
    asked = stage.keep("queries", lambda: _blocks(packed(queries).distinct(), query_block).select("width", "ids", "cells", first.alias("first")))
    last = data.agg(F.max("part").alias("part"), F.max("run").alias("run")).first()
    if last.part is None:
        last = last.asDict() | {"part": 0, "run": 0}
    runs = last["run"] + 1
    teams = (last["part"] + 1) * runs
    no_query = F.lit(None).cast("bigint").alias("first")
    dealt = data.select((F.col("part") * runs + F.col("run")).alias("team"), F.lit(False).alias("asks"), "width", "ids", "cells", no_query).unionByName(
        asked.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(teams - 1).cast("bigint"))).alias("team"), F.lit(True).alias("asks"), "width", "ids", "cells", "first")
    )
    dealt = dealt.repartitionByRange(teams, "team").sortWithinPartitions("team", "asks")
    best = Window.partitionBy("query").orderBy("distance", "vec_id")
    found = _search(dealt, k).withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
