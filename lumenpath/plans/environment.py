"""Environment progress: one row per user and environment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import blank_when, day, day_second, percent_text, short_clock
from lumenpath.functions.predicates import either_one_of, has_window, in_window, one_of, where_all
from lumenpath.operators.access import all_groups
from lumenpath.operators.attributes import with_attribute_columns
from lumenpath.operators.content import module_roles, real_users
from lumenpath.operators.latest import first_group
from lumenpath.operators.progress import (
    HOME, environment_link, environment_rollup, environment_track_plan, fully_exempt, link_origin, progress_totals, track_summary,
)
from lumenpath.operators.provenance import with_provenance
from lumenpath.operators.status import environment_status
from lumenpath.params import ReportParams
from lumenpath.plans.common import admins_for, visible_environments, visible_users
from lumenpath.sources import Platform
from lumenpath.sources.staging import Stage


def environment_facts(
    platform: Platform, params: ReportParams, admins: DataFrame | None = None, audience: DataFrame | None = None
) -> DataFrame:
    """Roll-up, progress counters, exemption and status per user and environment."""
    platform = platform.for_tenant(params.tenant_id)
    admins = admins_for(platform, params, admins)
    who = ["user_id", "tenant_id"]
    users = real_users(platform, params).join(visible_users(platform, admins), who, "left_semi").select(*who)
    if audience is not None:
        users = users.join(audience.select(*who), who, "left_semi")
    planned = (
        environment_track_plan(platform, params)
        .join(visible_environments(platform, admins), ["environment_id", "tenant_id"], "left_semi")
        .join(users, who, "left_semi")
    )
    # Summaries and counters both start from the plan: it is worked out once and read twice.
    plan = Stage(platform.users.sparkSession, "environment").keep("plan", lambda: planned)
    access = platform.entity_access.where(F.trim("entity_type") == codes.ENVIRONMENT).select(
        "user_id", "tenant_id", F.col("entity_id").alias("environment_id"), "last_access_at"
    )
    exempt = fully_exempt(platform).withColumn("_exempt", F.lit(True))
    rows = (
        environment_rollup(track_summary(platform, plan, params))
        .join(access, HOME, "left")
        .join(exempt, HOME, "left")
        .join(progress_totals(platform, plan), HOME, "left")
        .withColumn("is_exempt", F.coalesce("_exempt", F.lit(False)))
        .withColumn("last_seen_at", F.coalesce("last_access_at", "completed_at"))
        .withColumn("shown_start", F.when(F.col("has_started"), F.col("started_at")))
        .withColumn("environment_status", environment_status())
        .drop("_exempt", "last_access_at")
    )
    completion = None
    if has_window(params.window("completion")):
        completion = F.col("has_finished") & in_window(F.col("completed_at"), params.window("completion"))
        completion = completion | ~F.col("has_finished") if params.show_empty_dates else completion
    return where_all(
        rows,
        completion,
        in_window(F.col("last_seen_at"), params.window("last_access"), params.show_empty_dates),
        in_window(F.col("shown_start"), params.window("start"), params.show_empty_dates),
        one_of(F.col("environment_status"), params.statuses),
    )


def environment_report(
    platform: Platform, params: ReportParams, admins: DataFrame | None = None, audience: DataFrame | None = None
) -> DataFrame:
    facts = environment_facts(platform, params, admins, audience)
    platform = platform.for_tenant(params.tenant_id)
    who = ["user_id", "tenant_id"]
    users = platform.users.select(*who, "full_name", "email", "login", "is_active")
    names = platform.environments.select("environment_id", "tenant_id", F.col("name").alias("environment_name"))
    rows = facts.join(first_group(platform, group_ids=params.group_ids), HOME, "left")
    rows = where_all(rows, either_one_of([F.col("child_group_id"), F.col("parent_group_id")], params.group_ids))
    held = module_roles(platform, params.role_ids).select("tenant_id", *link_origin())
    rows = with_provenance(platform, rows.join(environment_link(platform, params), HOME), "origin", "creator", held)
    rows = (
        rows.join(names, ["environment_id", "tenant_id"])
        .join(users, who)
        .join(all_groups(platform, group_ids=params.group_ids), who, "left")
    )
    exempt, status = F.col("is_exempt"), F.col("environment_status")
    idle = status.isin("not_released", "not_started")
    finished_at = F.when(F.col("has_finished"), day_second(F.col("completed_at")))
    approved = F.when(
        finished_at.isNotNull(), F.when(F.col("approved_modules") >= F.col("available_modules"), codes.YES).otherwise(codes.NO)
    ).when(F.col("shown_start").isNotNull(), "")
    started = F.when(~idle & F.col("has_started"), codes.YES).otherwise(codes.NO)

    def tracks(name):
        return F.when(exempt, F.lit(0).cast("bigint")).otherwise(F.col(name)).alias(name)

    report = rows.select(
        "tenant_id", "user_id", "full_name", F.coalesce("email", F.lit("")).alias("email"), "login",
        codes.user_status_label(F.col("is_active")).alias("user_status"), "parent_group_id", "parent_group_name",
        "child_group_id", "child_group_name", "all_groups", "environment_id", "environment_name",
        blank_when(exempt | idle, day_second(F.col("shown_start"))).alias("started_at"),
        blank_when(exempt, finished_at).alias("completed_at"),
        F.when(exempt, "").when(idle, "0.00").otherwise(F.col("score").cast("string")).alias("score"),
        blank_when(exempt, percent_text(F.col("finished_modules"), F.col("available_modules"))).alias("completion_percent"),
        blank_when(exempt, percent_text(F.col("approved_modules"), F.col("available_modules"))).alias("approval_percent"),
        F.when(exempt, "").when(idle, "0:00:00").otherwise(short_clock(F.col("time_seconds"))).alias("access_time"),
        tracks("total_tracks"), tracks("started_tracks"), tracks("finished_tracks"), tracks("approved_tracks"),
        day(F.col("last_seen_at")).alias("last_access_at"),
        blank_when(exempt, started).alias("has_started"), blank_when(exempt, approved).alias("is_approved"),
        codes.label_of(status, codes.DICTIONARIES["environment_status"]).alias("environment_status"),
        codes.role_label(F.col("role_id")).alias("role_label"), day_second(F.col("linked_at")).alias("linked_at"),
        codes.origin_label(F.col("origin_created")).alias("link_origin"), "linked_by",
    )
    return with_attribute_columns(platform, report, admins_for(platform, params, admins))
