"""Module status as rows: one row per user, environment and module (and attempt, when all are asked for)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import clock, day_minute, decimal_comma, first_chars, instant, money, to_id
from lumenpath.functions.predicates import any_of, either_one_of, has_window, in_window, one_of, where_all
from lumenpath.operators.access import all_groups
from lumenpath.operators.attributes import with_attribute_columns
from lumenpath.operators.content import module_hierarchy, module_roles, real_users
from lumenpath.operators.labels import environment_switch
from lumenpath.operators.latest import attempt_history, first_group
from lumenpath.operators.provenance import with_provenance
from lumenpath.operators.sizes import broadcast_if_small
from lumenpath.operators.status import module_status, module_window
from lumenpath.params import ReportParams
from lumenpath.plans.common import admins_for, visible_environments, visible_users
from lumenpath.sources import Platform

KEYS = ["user_id", "tenant_id", "module_id"]
GRADED = ("approved", "reproved", "out_of_date")


def module_workload(platform: Platform) -> DataFrame:
    """Minutes per module: the sum of its active activities when positive, else the module's own."""
    active = platform.activities.where("is_active").select("activity_id", "tenant_id", "workload_minutes")
    summed = (
        platform.module_activities.select("module_id", "activity_id", "tenant_id")
        .join(active, ["activity_id", "tenant_id"])
        .groupBy("module_id", "tenant_id")
        .agg(F.sum("workload_minutes").alias("_summed"))
    )
    modules = platform.modules.select("module_id", "tenant_id", F.col("workload_minutes").alias("_own"))
    minutes = F.when(F.coalesce("_summed", F.lit(0)) > 0, F.col("_summed")).when(F.col("_own") > 0, F.col("_own"))
    return modules.join(summed, ["module_id", "tenant_id"], "left").select("module_id", "tenant_id", minutes.alias("workload_minutes"))


def module_catalogue(platform: Platform, params: ReportParams) -> DataFrame:
    """Visible modules with workload, dates, editor and the environment's partial-score switch."""
    placed = module_hierarchy(platform, params, visible_only=True)
    facts = platform.modules.select(
        "module_id", "tenant_id", "type_id", "starts_at", "ends_at", F.col("created_at").alias("module_created_at"),
        F.col("updated_at").alias("module_updated_at"), to_id(F.col("updated_by")).alias("_editor"),
    )
    editors = platform.users.select(F.col("user_id").alias("_editor"), "tenant_id", F.col("full_name").alias("updated_by"))
    named = facts.join(editors, ["_editor", "tenant_id"], "left").drop("_editor")
    partial = environment_switch(platform, platform.environments, codes.PARTIAL_SCORE_SETTING)
    return (
        placed.join(named, ["module_id", "tenant_id"])
        .join(module_workload(platform), ["module_id", "tenant_id"])
        .join(partial.withColumnRenamed("is_on", "counts_partial"), ["environment_id", "tenant_id"])
        .withColumn("module_name", first_chars(F.col("module_name"), 128))
    )


def _attempts(platform: Platform, params: ReportParams) -> DataFrame:
    """Latest attempt with its number, or all of them (``attempts_per_module`` of them at most, where it is given)."""
    history = attempt_history(platform.attempts, params.attempts_per_module if params.all_attempts else 1)
    state = F.col("status_id")
    opened = state != codes.NOT_STARTED
    return history.select(
        *KEYS, "attempt_id", state.alias("attempt_status"), "grade", "points", "challenge_bonus", "time_bonus",
        "total_score", "is_done", "attempt_number", "access_seconds",
        F.when(opened, F.col("created_at")).alias("first_access_at"), F.col("updated_at").alias("_updated_at"),
    )


def _score(value: Column) -> Column:
    """Score of a closed attempt, or of any attempt where partial scores count."""
    return F.when(F.coalesce(F.col("is_done"), F.lit(False)) | F.col("counts_partial"), money(value, 10))


def module_status_facts(
    platform: Platform, params: ReportParams, admins: DataFrame | None = None, audience: DataFrame | None = None
) -> DataFrame:
    """Status rows before formatting, with module counts per user and track.

    ``audience(user_id, tenant_id)`` narrows the report to a target audience.
    """
    platform = platform.for_tenant(params.tenant_id)
    admins = admins_for(platform, params, admins)
    who = ["user_id", "tenant_id"]
    users = real_users(platform, params).join(visible_users(platform, admins), who, "left_semi")
    if audience is not None:
        users = users.join(audience.select(*who), who, "left_semi")
    roles = module_roles(platform)
    if params.role_ids:
        # Any of the listed roles on the module lets all of the user's links to it through.
        listed = module_roles(platform, params.role_ids).select(*KEYS)
        roles = roles.join(listed, KEYS, "left_semi")
    catalogue = broadcast_if_small(
        module_catalogue(platform, params).join(visible_environments(platform, admins), ["environment_id", "tenant_id"], "left_semi")
    )
    exempt = platform.exemptions.select(*KEYS, "exempted_at", F.col("starts_at").alias("exempt_starts_at"))
    links = roles.select(*KEYS, "role_id", "origin_created", "created_by", F.col("created_at").alias("linked_at"))
    now = instant(params.as_of)
    finished = F.col("attempt_status").isin(*codes.CLOSED_STATES) | (F.col("type_id") == codes.RECURRING_MODULE)
    rows = (
        where_all(links, in_window(F.col("linked_at"), params.window("link")))
        .join(_attempts(platform, params), KEYS, "left")
        .join(exempt, KEYS, "left")
        .join(users.select(*who, "is_active"), who)
        .join(first_group(platform), who)
        .join(catalogue, ["module_id", "tenant_id", "environment_id"])
        .withColumn("completed_at", F.when((F.col("attempt_status") != codes.NOT_STARTED) & finished, F.col("_updated_at")))
        .withColumn("window", module_window(now))
        .withColumn("module_status", module_status(now))
    )
    either = params.window("any")
    any_date = None
    if has_window(either):
        first, done = (in_window(F.col(name), either) for name in ("first_access_at", "completed_at"))
        any_date = any_of([first, done] + ([F.col("first_access_at").isNull()] if params.show_empty_dates else []))
    rows = where_all(
        rows,
        either_one_of([F.col("child_group_id"), F.col("parent_group_id")], params.group_ids),
        in_window(F.col("first_access_at"), params.window("start"), params.show_empty_dates),
        in_window(F.col("completed_at"), params.window("completion"), params.show_empty_dates),
        any_date,
    )
    per_track = Window.partitionBy("tenant_id", "user_id", "environment_id", "track_id")
    per_environment = Window.partitionBy("tenant_id", "user_id", "environment_id")
    # The coarser window first: its partitioning also serves the finer one, so there is one shuffle for both.
    rows = (
        rows.withColumn("last_completed_at", F.max("completed_at").over(per_environment))
        .withColumn("track_modules", F.count("module_id").over(per_track))
        .withColumn("track_modules_done", F.sum(F.when(F.col("is_done"), 1).otherwise(0)).over(per_track))
    )
    return where_all(rows, one_of(F.col("module_status"), params.statuses))


def module_status_rows(
    platform: Platform, params: ReportParams, admins: DataFrame | None = None, audience: DataFrame | None = None
) -> DataFrame:
    """The long module report."""
    facts = module_status_facts(platform, params, admins, audience)
    platform = platform.for_tenant(params.tenant_id)
    who = ["user_id", "tenant_id"]
    users = platform.users.select(*who, "full_name", "email", "login")
    groups = all_groups(platform, group_ids=params.group_ids)
    held = module_roles(platform).select("tenant_id", "origin_created", "created_by")
    rows = with_provenance(platform, facts, "origin_created", "created_by", held).join(users, who).join(groups, who, "left")
    status = F.col("module_status")
    graded = status.isin(*GRADED)
    zero = F.lit(0).cast("decimal(10,2)")

    def points(name: str) -> Column:
        return F.coalesce(_score(F.coalesce(F.col(name), zero)), zero)

    total = F.when(status != "exempted", _score(F.col("total_score")))
    report = rows.select(
        "tenant_id", "user_id", "full_name", "email", "login",
        codes.user_status_label(F.col("is_active")).alias("user_status"), "parent_group_id", "parent_group_name",
        "child_group_id", "child_group_name", "all_groups", "environment_id", "environment_name", "track_id",
        "track_name", "module_id", "module_name", "attempt_id", codes.role_label(F.col("role_id"), "").alias("role_label"),
        clock(F.col("workload_minutes") * 60).alias("module_workload"),
        day_minute(F.col("first_access_at")).alias("started_at"), day_minute(F.col("completed_at")).alias("completed_at"),
        F.when(graded, decimal_comma(points("points"))).otherwise(F.lit("")).alias("points"),
        F.when(graded, points("challenge_bonus").cast("string")).otherwise(F.lit("")).alias("challenge_bonus"),
        F.when(graded, decimal_comma(points("time_bonus"))).otherwise(F.lit("")).alias("time_bonus"),
        F.when(graded & total.isNotNull(), decimal_comma(total)).otherwise(F.lit("")).alias("total_score"),
        codes.label_of(status, codes.MODULE_STATUS_LABELS).alias("module_status"),
        clock(F.coalesce("access_seconds", F.lit(0))).alias("access_time"),
        F.when(status == "out_of_date", codes.LATE_LABEL).when(status.isin("approved", "reproved"), codes.IN_TIME_LABEL)
        .when(status.isin("not_started", "in_progress"), "").alias("done_on_time"),
        day_minute(F.col("module_created_at")).alias("module_created_at"),
        day_minute(F.col("module_updated_at")).alias("module_updated_at"), "updated_by", "attempt_number",
        day_minute(F.col("linked_at")).alias("linked_at"),
        codes.origin_label(F.col("origin_created")).alias("link_origin"), "linked_by",
        "track_modules", "track_modules_done", day_minute(F.col("last_completed_at")).alias("last_completed_at"),
    )
    return with_attribute_columns(platform, report, admins_for(platform, params, admins))
