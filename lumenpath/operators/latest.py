"""Latest row per key, attempts, and the group under which a user appears."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.predicates import either_one_of, where_all
from lumenpath.operators.sizes import BROADCAST_BYTES
from lumenpath.sources import Platform


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark cuts the ranking to one row per key inside every map task before the shuffle
    (window group limit), so a key that owns a large share of the rows does not become a hot task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


ATTEMPT_KEYS = ("user_id", "tenant_id", "module_id")


def _with_results(attempts: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    total = sum((F.coalesce(F.col(c), zero) for c in ("challenge_bonus", "time_bonus")), F.coalesce(F.col("points"), zero))
    return (
        attempts.withColumn("total_score", total.cast("decimal(18,2)"))
        .withColumn("is_done", F.col("status_id").isin(*codes.CLOSED_STATES))
        .withColumn("is_approved", F.col("status_id").isin(*codes.PASSED_STATES))
    )


def valid_attempts(attempts: DataFrame) -> DataFrame:
    return attempts.where(F.col("status_id") != codes.CANCELLED)


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """The highest attempt that is not cancelled, per user and module, with score and flags."""
    return _with_results(first_per_key(valid_attempts(attempts), ATTEMPT_KEYS, [F.col("attempt_id").desc()]))


def attempt_history(attempts: DataFrame, most_recent: int | None = None) -> DataFrame:
    """Every attempt per user and module, or only the most recent ones, each with its number counted from the oldest.

    With a limit the number is taken as ``count - rank + 1`` from the newest, so only the kept rows travel: the
    count is combined on the map side and the ranking is cut to ``most_recent`` rows per key there.
    """
    valid = valid_attempts(attempts)
    if most_recent is None:
        oldest_first = F.row_number().over(Window.partitionBy(*ATTEMPT_KEYS).orderBy("attempt_id"))
        return _with_results(valid.withColumn("attempt_number", oldest_first.cast("bigint")))
    newest_first = F.row_number().over(Window.partitionBy(*ATTEMPT_KEYS).orderBy(F.col("attempt_id").desc()))
    recent = valid.withColumn("_rank", newest_first).where(F.col("_rank") <= most_recent)
    counts = valid.groupBy(*ATTEMPT_KEYS).agg(F.count("*").alias("_count"))
    numbered = recent.join(counts, list(ATTEMPT_KEYS)).withColumn("attempt_number", F.col("_count") - F.col("_rank") + 1)
    return _with_results(numbered.drop("_rank", "_count"))


def first_group(platform: Platform, per_environment: bool = True, group_ids: tuple[int, ...] = ()) -> DataFrame:
    """One active group per user (and environment) that is attached to an environment, with its parent.

    Groups with an active parent come first, then the lowest group id.  With ``group_ids`` only groups that are
    listed, or whose active parent is, can be chosen.

    Memberships travel once, as bare ids by user; what a group stands for in each environment is folded into one small row per
    group and unfolds only behind that exchange, where the least id with and without a parent is taken.  Names come last.
    """
    groups = platform.groups.where("is_active")
    parent = groups.select(F.col("group_id").alias("parent_group_id"), "tenant_id", F.col("name").alias("parent_group_name"))
    named = groups.select(
        "group_id", "tenant_id", F.col("name").alias("child_group_name"), "parent_group_id"
    ).join(parent.withColumn("_found", F.lit(True)), ["parent_group_id", "tenant_id"], "left")
    named = named.withColumn("parent_group_id", F.when(F.col("_found"), F.col("parent_group_id"))).drop("_found")
    named = where_all(named, either_one_of([F.col("group_id"), F.col("parent_group_id")], group_ids))

    attached = platform.environment_groups.groupBy("group_id", "tenant_id").agg(F.collect_set("environment_id").alias("environments"))
    if not per_environment:
        attached = attached.drop("environments")
    named = named.join(attached, ["group_id", "tenant_id"])
    # A bound of both sides from two plain scans, without the joins: every row has at most two names.
    size = groups.agg(F.count("*").alias("n"), F.coalesce(F.max(F.length("name")), F.lit(0)).alias("longest")).first()
    small = size.n * (64 + 4 * size.longest) + 16 * platform.environment_groups.count() <= BROADCAST_BYTES
    ids = named.withColumn("_top", F.col("parent_group_id").isNull()).drop("parent_group_id", "parent_group_name", "child_group_name")
    names = named.drop("environments")
    if small:
        ids, names = F.broadcast(ids), F.broadcast(names)
    keys = who = ["user_id", "tenant_id"]
    members = platform.group_members.select(*who, "group_id")
    if small:
        members = members.repartition(*who)  # by user alone, which is how every report joins them; the fan-out stays within its task
    members = members.join(ids, ["group_id", "tenant_id"])
    if per_environment:
        keys = [*who, "environment_id"]
        members = members.withColumn("environment_id", F.explode("environments"))
    group = F.col("group_id")
    chosen = members.groupBy(*keys).agg(F.min(F.when(~F.col("_top"), group)).alias("_under"), F.min(F.when(F.col("_top"), group)).alias("_alone"))
    chosen = chosen.select(*keys, F.coalesce("_under", "_alone").alias("group_id"))
    return chosen.join(names, ["group_id", "tenant_id"]).select(
        *keys, "parent_group_id", "parent_group_name", F.col("group_id").alias("child_group_id"), "child_group_name"
    )
