"""Track progress: one row per user and track."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import (
    blank_when, day_minute, day_second, grouped_number, instant, join_sorted, percent_text, plus_days, short_clock,
)
from lumenpath.functions.predicates import either_one_of, has_window, in_window, one_of, unless, where_all
from lumenpath.operators.access import all_groups
from lumenpath.operators.attributes import with_attribute_columns
from lumenpath.operators.content import module_roles, real_users
from lumenpath.operators.latest import first_group, first_per_key
from lumenpath.operators.sizes import dealt
from lumenpath.operators.status import track_status
from lumenpath.params import ReportParams
from lumenpath.plans.common import admins_for, visible_environments, visible_users
from lumenpath.sources import Platform

TRACK_KEYS = ["user_id", "tenant_id", "track_id"]


def track_link(platform: Platform) -> DataFrame:
    """Link of a user to a track through its active modules: strongest role number, earliest date, and the
    origin and creator of that earliest link."""
    modules = platform.modules.where("is_active").select("module_id", "tenant_id", "track_id")
    earliest = F.struct(
        "created_at", "module_id", F.coalesce("origin_created", "origin_updated").alias("origin"),
        F.coalesce("created_by", "updated_by").alias("creator"),
    )
    return (
        dealt(module_roles(platform).join(modules, ["module_id", "tenant_id"]), TRACK_KEYS)
        .groupBy(*TRACK_KEYS)
        .agg(F.max("role_id").alias("role_id"), F.min("created_at").alias("linked_at"), F.min(earliest).alias("_first"))
        .select(*TRACK_KEYS, "role_id", "linked_at", F.col("_first.origin").alias("origin"), F.col("_first.creator").alias("creator"))
    )


def finished_module_names(platform: Platform) -> DataFrame:
    """Names of the active modules of a track that a user closed and is not fully exempt from, in id order."""
    keys = ["user_id", "tenant_id", "module_id"]
    closed = platform.attempts.where(F.col("status_id").isin(*codes.CLOSED_STATES)).select(*keys).distinct()
    excused = platform.exemptions.where("starts_at is null and ends_at is null").select(*keys)
    modules = platform.modules.where("is_active").select("module_id", "tenant_id", "track_id", F.col("name").alias("text"))
    rows = closed.join(excused, keys, "left_anti").join(modules, ["module_id", "tenant_id"])
    return dealt(rows, TRACK_KEYS).groupBy(*TRACK_KEYS).agg(join_sorted(["module_id"], "text").alias("finished_modules_text"))


def track_facts(platform: Platform, params: ReportParams, admins: DataFrame | None = None) -> DataFrame:
    """Progress rows with link, recertification dates and status."""
    platform = platform.for_tenant(params.tenant_id)
    admins = admins_for(platform, params, admins)
    who = ["user_id", "tenant_id"]
    users = real_users(platform, params).join(visible_users(platform, admins), who, "left_semi").select(*who)
    live_tracks = platform.modules.where("is_active").select("track_id", "tenant_id")
    progress = where_all(
        platform.track_progress,
        one_of(F.col("environment_id"), params.environment_ids),
        one_of(F.col("track_id"), params.track_ids),
    )
    # The first progress row of a user and track is taken among the filtered rows.
    first = first_per_key(
        progress.join(live_tracks, ["track_id", "tenant_id"], "left_semi"), TRACK_KEYS, [F.col("progress_id")]
    )
    recertification = platform.recertifications.where("is_active").select(
        "track_id", "tenant_id", "recertification_id", "expiry_days", "available_days", "for_mandatory", "for_participant"
    )
    rows = (
        first.join(users, who)
        .join(track_link(platform), TRACK_KEYS)
        .join(visible_environments(platform, admins), ["environment_id", "tenant_id"], "left_semi")
        .join(recertification, ["track_id", "tenant_id"], "left")
        .withColumn("expires_at", plus_days(F.col("finished_at"), F.col("expiry_days")))
        .withColumn("renewable_at", plus_days(F.col("expires_at"), -F.col("available_days")))
        .withColumn("track_status", track_status(instant(params.as_of)))
        .withColumn("required_modules", F.when(F.col("exempt_modules") > 0, F.col("total_modules") - F.col("exempt_modules")).otherwise(F.col("total_modules")))
        .withColumn("is_exempt", F.col("exempt_modules") >= F.col("total_modules"))
        .withColumn("is_completed", F.col("finished_modules") >= F.col("required_modules"))
        .withColumn("attempt_type", F.when(F.coalesce("recertification_attempt_id", F.lit(0)) == 0, "default").otherwise("recertification"))
    )
    completion = None
    if has_window(params.window("completion")):
        done = F.col("is_completed") & in_window(F.col("finished_at"), params.window("completion"))
        completion = done | ~F.col("is_completed") if params.show_empty_dates else done
    return where_all(
        rows,
        one_of(F.col("role_id"), params.role_ids),
        in_window(F.col("linked_at"), params.window("link"), params.show_empty_dates),
        in_window(F.col("first_access_at"), params.window("start"), params.show_empty_dates),
        completion,
        in_window(F.col("expires_at"), params.window("expiration"), params.show_empty_dates),
        one_of(F.col("attempt_type"), params.attempt_types),
        one_of(F.col("track_status"), params.statuses),
    )


def track_report(platform: Platform, params: ReportParams, admins: DataFrame | None = None, sort: bool = True) -> DataFrame:
    facts = track_facts(platform, params, admins)
    platform = platform.for_tenant(params.tenant_id)
    who = ["user_id", "tenant_id"]
    environments = where_all(
        platform.environments, unless(params.show_inactive_environments, F.col("is_available"))
    ).select("environment_id", "tenant_id", F.col("name").alias("environment_name"))
    tracks = where_all(platform.tracks, unless(params.show_inactive_tracks, F.col("is_active"))).select(
        "track_id", "tenant_id", F.col("name").alias("track_name")
    )
    users = platform.users.select(*who, "full_name", "email", "login", "is_active")
    groups = where_all(
        first_group(platform, per_environment=False),
        either_one_of([F.col("child_group_id"), F.col("parent_group_id")], params.group_ids),
    )
    rows = (
        facts.join(environments, ["environment_id", "tenant_id"])
        .join(tracks, ["track_id", "tenant_id"])
        .join(finished_module_names(platform), TRACK_KEYS, "left")
        .join(groups, who)
        .join(users, who)
        .join(all_groups(platform, group_ids=params.group_ids), who, "left")
    )
    exempt, status = F.col("is_exempt"), F.col("track_status")
    idle = status.isin("not_started", "not_released")
    required, approved = F.col("required_modules"), F.col("approved_modules")
    yes_no = F.when(F.col("is_completed"), codes.YES).otherwise(codes.NO)
    report = rows.select(
        "tenant_id", "user_id", "full_name", "email", "login",
        codes.user_status_label(F.col("is_active")).alias("user_status"), "parent_group_id", "parent_group_name",
        "child_group_id", "child_group_name", "all_groups", "environment_id", "environment_name", "track_id",
        "track_name", codes.role_label(F.col("role_id"), None).alias("role_label"),
        F.when(exempt, "").when(F.coalesce("workload_seconds", F.lit(0)) > 0, short_clock(F.col("workload_seconds"))).alias("track_workload"),
        F.when(~exempt & (status != "not_started"), day_second(F.col("first_access_at"))).alias("started_at"),
        F.when(exempt, "").when(F.col("is_completed"), day_second(F.col("finished_at"))).alias("completed_at"),
        blank_when(exempt, F.col("score").cast("bigint").cast("string")).alias("track_score"),
        blank_when(exempt | idle, percent_text(F.col("finished_modules"), required)).alias("completion_percent"),
        blank_when(
            exempt | (required == 0),
            F.concat(grouped_number(F.lit(100).cast("decimal(18,1)") * approved / F.nullif(required, F.lit(0))), F.lit("%")),
        ).alias("approval_percent"),
        F.when(~exempt & (F.col("access_seconds") > 0), short_clock(F.col("access_seconds"))).otherwise("").alias("access_time"),
        codes.label_of(status, codes.DICTIONARIES["track_status"]).alias("track_status"),
        F.when(exempt | idle, codes.NO).otherwise(codes.YES).alias("has_started"),
        F.when(exempt, codes.NO).otherwise(yes_no).alias("has_completed"),
        F.when(exempt, codes.NO).when(approved >= required, codes.YES).otherwise("").alias("is_approved"),
        required.alias("modules_linked"), F.col("finished_modules").alias("modules_finished"),
        approved.alias("modules_approved"), day_minute(F.col("linked_at")).alias("linked_at"),
        codes.origin_label(F.col("origin")).alias("link_origin"),
        codes.label_of(F.col("attempt_type"), codes.DICTIONARIES["attempt_type"]).alias("attempt_type"),
        "finished_modules_text",
        blank_when(F.col("attempt_type") == "default", day_minute(F.col("expires_at"))).alias("expires_at"),
        F.nullif(F.col("recertification_attempt_id"), F.lit(0)).alias("recertification_attempt_id"),
    )
    report = with_attribute_columns(platform, report, admins_for(platform, params, admins))
    return report.orderBy("full_name", "environment_id", "track_id", "tenant_id", "user_id") if sort else report
