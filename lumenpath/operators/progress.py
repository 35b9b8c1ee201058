"""Environment progress: who is planned in which track, module summaries, and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import instant, money
from lumenpath.functions.predicates import Window, in_window, one_of, unless, where_all
from lumenpath.operators.content import module_roles
from lumenpath.operators.latest import first_per_key, latest_attempt
from lumenpath.params import ReportParams
from lumenpath.sources import Platform

PLAN = ["user_id", "tenant_id", "environment_id", "track_id"]
HOME = ["user_id", "tenant_id", "environment_id"]


def _live_tracks(platform: Platform) -> DataFrame:
    return platform.tracks.where("is_active and is_visible").select("track_id", "tenant_id")


def _shown_modules(platform: Platform) -> DataFrame:
    return platform.modules.where("is_active and is_visible")


def environment_track_plan(platform: Platform, params: ReportParams) -> DataFrame:
    """Distinct ``(user, tenant, environment, track)``: the user shares a group with the environment and holds a
    role on some active module of the track.

    It starts from the roles, folded to one row per user and track, so that group membership is only
    tested (semi-join) and never multiplies rows.
    """
    link: Window | None = params.window("link")
    modules = platform.modules.where("is_active").select("module_id", "tenant_id", "track_id")
    held = where_all(module_roles(platform, params.role_ids), in_window(F.col("created_at"), link), one_of(F.col("user_id"), params.user_ids))
    pairs = (
        held.select("user_id", "module_id", "tenant_id")
        .join(modules.join(_live_tracks(platform), ["track_id", "tenant_id"], "left_semi"), ["module_id", "tenant_id"])
        .select("user_id", "tenant_id", "track_id")
        .distinct()
    )
    environments = where_all(
        platform.environments,
        unless(params.show_inactive_environments, F.col("is_available")),
        one_of(F.col("environment_id"), params.environment_ids),
    ).select("environment_id", "tenant_id")
    placed = platform.environment_tracks.select("environment_id", "track_id", "tenant_id").join(
        environments, ["environment_id", "tenant_id"], "left_semi"
    )
    shared = platform.group_members.select("user_id", "group_id", "tenant_id").join(
        platform.environment_groups.select("environment_id", "group_id", "tenant_id"), ["group_id", "tenant_id"]
    )
    return pairs.join(placed, ["track_id", "tenant_id"]).join(shared, HOME, "left_semi").select(*PLAN)


def _module_results(platform: Platform, plan_modules: DataFrame) -> DataFrame:
    """Latest attempt of every planned module; ``plan_modules`` has the plan keys, the module and its facts."""
    keys = ["user_id", "tenant_id", "module_id"]
    latest = latest_attempt(platform.attempts).select(
        *keys, "attempt_id", "status_id", "points", "challenge_bonus", "time_bonus", "access_seconds",
        F.col("created_at").alias("attempted_at"), F.col("updated_at").alias("attempt_updated_at"),
    )
    zero = F.lit(0).cast("decimal(18,2)")
    state = F.col("status_id")
    closed = state.isin(*codes.CLOSED_STATES)
    bonus = F.when(F.col("allows_time_bonus"), F.coalesce("time_bonus", zero)).otherwise(zero)
    return (
        plan_modules.join(latest, keys, "left")
        .withColumn("is_done", state.isin(codes.AWAITING_REVIEW, *codes.CLOSED_STATES))
        .withColumn("is_approved", state.isin(*codes.PASSED_STATES))
        .withColumn("score", F.coalesce("points", zero) + F.coalesce("challenge_bonus", zero) + bonus)
        .withColumn(
            "spent_seconds",
            F.when(F.col("workload_minutes") > 0, F.when(closed, F.col("workload_minutes") * 60)).otherwise(F.col("access_seconds")),
        )
    )


def _summarise(results: DataFrame, params: ReportParams) -> DataFrame:
    """Counts, score, time and dates per track, own and linked modules apart.

    A linked module starts when the link was made.
    Modules with the same workload and the same last update form one summary row, whose workload
    counts once; this is the legacy definition of the workload of an environment.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    started = F.when(F.col("is_linked"), F.col("link_made_at")).otherwise(F.col("attempted_at"))
    return results.groupBy(*PLAN, "is_linked", "attempt_updated_at", "summed_workload").agg(
        F.min(started).alias("started_at"),
        F.max("attempt_updated_at").alias("completed_at"),
        F.count("module_id").alias("modules"),
        F.count("attempt_id").alias("modules_started"),
        F.count_if(F.col("is_done")).alias("modules_done"),
        F.count_if(F.col("is_approved")).alias("modules_approved"),
        money(F.coalesce(F.sum(F.when(F.col("is_done"), F.col("score"))), zero)).alias("score"),
        F.sum("spent_seconds").alias("spent_seconds"),
        F.count_if(F.col("starts_at") > instant(params.as_of)).alias("modules_not_released"),
    )


def track_summary(platform: Platform, plan: DataFrame, params: ReportParams) -> DataFrame:
    """Summaries of a plan's own modules and of modules linked into its tracks (UNION, duplicates removed).

    Tracks without a shown module have no row.
    """
    shown = _shown_modules(platform).select(
        "module_id", "track_id", "tenant_id", "workload_minutes", "allows_time_bonus", "starts_at",
        F.coalesce("workload_minutes", F.lit(0)).alias("summed_workload"),
    )
    made_at = platform.module_links.schema["created_at"].dataType
    own = shown.select("*", F.lit(None).cast(made_at).alias("link_made_at"), F.lit(False).alias("is_linked"))
    links = platform.module_links.where("is_active and kind = 'round'").select(
        "track_id", "tenant_id", F.col("target_module_id").alias("module_id"), F.col("created_at").alias("link_made_at")
    )
    far = links.join(shown.drop("track_id"), ["module_id", "tenant_id"]).withColumn("is_linked", F.lit(True))
    # Both kinds are put together in the catalogue, so plan and attempts meet them in one pass.
    modules = own.unionByName(far).join(_live_tracks(platform), ["track_id", "tenant_id"], "left_semi")
    results = _module_results(platform, plan.join(modules, ["track_id", "tenant_id"]))
    return _summarise(results, params).drop("is_linked").distinct()


def environment_rollup(summary: DataFrame) -> DataFrame:
    """Track summaries to one row per user and environment."""
    per_track = summary.groupBy(*PLAN).agg(
        F.sum("modules").alias("modules"), F.sum("modules_done").alias("modules_done"),
        F.sum("modules_approved").alias("modules_approved"), F.sum("modules_started").alias("modules_started"),
        F.sum("modules_not_released").alias("modules_not_released"), F.sum("score").alias("score"),
        F.min("started_at").alias("started_at"), F.max("completed_at").alias("completed_at"),
        F.sum("spent_seconds").alias("spent_seconds"), F.sum("summed_workload").alias("workload_minutes"),
    )
    c = F.col
    time_spent = F.when(c("workload_minutes") > 0, c("workload_minutes") * 60).otherwise(F.coalesce("spent_seconds", F.lit(0)))
    return (
        per_track.groupBy(*HOME)
        .agg(
            F.count("track_id").alias("total_tracks"),
            F.count_if(c("modules_started") > 0).alias("started_tracks"),
            F.count_if((c("modules") > 0) & (c("modules_done") >= c("modules"))).alias("finished_tracks"),
            F.count_if((c("modules") > 0) & (c("modules_approved") >= c("modules"))).alias("approved_tracks"),
            F.count_if((c("modules") > 0) & (c("modules_not_released") >= c("modules"))).alias("not_released_tracks"),
            money(F.sum("score")).alias("score"), F.min("started_at").alias("started_at"),
            F.max("completed_at").alias("completed_at"), F.sum(time_spent).alias("time_seconds"),
        )
        .withColumn("has_started", c("started_tracks") > 0)
        .withColumn("has_finished", c("finished_tracks") >= c("total_tracks"))
    )


def fully_exempt(platform: Platform) -> DataFrame:
    """``(user, tenant, environment)`` where the user is exempt, without a make-up date, from every active module.

    Exempt modules are counted per user and compared with the environment's module count, so users
    are never multiplied by modules.
    """
    tracks = platform.tracks.where("is_active").select("track_id", "tenant_id")
    content = (
        platform.modules.where("is_active").select("module_id", "track_id", "tenant_id")
        .join(tracks, ["track_id", "tenant_id"], "left_semi")
        .join(platform.environment_tracks.select("environment_id", "track_id", "tenant_id"), ["track_id", "tenant_id"])
        .select("environment_id", "module_id", "tenant_id")
    )
    size = content.groupBy("environment_id", "tenant_id").agg(F.count("*").alias("_modules"))
    excused = platform.exemptions.where("starts_at is null and ends_at is null").select("user_id", "module_id", "tenant_id").distinct()
    counted = excused.join(content, ["module_id", "tenant_id"]).groupBy(*HOME).agg(F.count("*").alias("_excused"))
    return counted.join(size, ["environment_id", "tenant_id"]).where("_excused >= _modules").select(*HOME)


COUNTERS = [
    "approved", "failed", "in_progress", "not_started", "not_released", "finished", "expired", "late", "exempt", "awaiting",
]


def progress_totals(platform: Platform, plan: DataFrame) -> DataFrame:
    """Summed progress counters per user and environment over planned, live tracks with a shown module."""
    shown = _shown_modules(platform).select("track_id", "tenant_id")
    rows = (
        platform.track_progress.join(_live_tracks(platform), ["track_id", "tenant_id"], "left_semi")
        .join(shown, ["track_id", "tenant_id"], "left_semi")
        .join(plan, PLAN, "left_semi")
    )
    return rows.groupBy(*HOME).agg(
        *[F.sum(f"{name}_modules").alias(f"{name}_modules") for name in COUNTERS],
        F.sum(F.col("total_modules") - F.col("exempt_modules")).alias("available_modules"),
        F.sum("total_modules").alias("total_modules"),
    )


def environment_link(platform: Platform, params: ReportParams) -> DataFrame:
    """The link that describes a user in an environment: lowest role number, then earliest date."""
    held = where_all(module_roles(platform, params.role_ids), in_window(F.col("created_at"), params.window("link")))
    # One row per user and track first: far fewer rows meet the environments of a track.
    own = first_per_key(
        held.join(platform.modules.select("module_id", "tenant_id", "track_id"), ["module_id", "tenant_id"]),
        ["user_id", "tenant_id", "track_id"], [F.col("role_id"), F.col("created_at"), F.col("module_id")],
    )
    placed = own.join(platform.environment_tracks.select("environment_id", "track_id", "tenant_id"), ["track_id", "tenant_id"])
    best = first_per_key(placed, HOME, [F.col("role_id"), F.col("created_at"), F.col("module_id")])
    return best.select(
        *HOME, "role_id", F.col("created_at").alias("linked_at"), "origin_created",
        *link_origin(),
    )


def link_origin() -> list[Column]:
    """``origin`` and ``creator`` of a stored link."""
    return [F.coalesce("origin_created", "origin_updated").alias("origin"), F.coalesce("created_by", "updated_by").alias("creator")]
