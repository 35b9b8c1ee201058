"""Broadcast hints that rest on a measured size, and rows dealt ahead of the steps that need them together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def measured_bytes(side: DataFrame) -> int:
    """Size of a frame's values: text by length, numbers and the elements of an array of numbers at 16 bytes."""
    width = F.lit(0).cast("bigint")
    for name, kind in side.dtypes:
        value = F.col(f"`{name}`")
        if kind == "string":
            width = width + F.coalesce(F.length(value), F.lit(0)) * 2
        elif kind.startswith("array"):
            width = width + (F.greatest(F.size(value), F.lit(0)) + 1) * 16
        else:
            width = width + F.lit(16)
    return side.agg(F.sum(width).alias("bytes")).first().bytes or 0


def broadcast_if_small(side: DataFrame, limit: int | None = None) -> DataFrame:
    """``side`` with a broadcast hint when it is measured to be small; otherwise as it is, for a shuffle join.

    For catalogue-sized frames that come out of several joins: their estimated size is far above the
    real one, so Spark would shuffle the fact side by a handful of hot keys before finding out.
    """
    bound = BROADCAST_BYTES if limit is None else limit
    return F.broadcast(side) if measured_bytes(side) <= bound else side


def dealt(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by keys over all shuffle partitions, for groupings and joins that would collect and sort much in one task.

    A given count is not merged by adaptive execution, which goes by the bytes that travel and not by those the task then holds.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
