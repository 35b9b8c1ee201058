"""Module status as columns: one row per user, role and environment, one column per module."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import day_second, decimal_comma, first_chars, instant, money
from lumenpath.functions.predicates import one_of, where_all
from lumenpath.operators.access import all_groups
from lumenpath.operators.attributes import unique_headers, with_attribute_columns
from lumenpath.operators.content import module_hierarchy, module_roles, real_users
from lumenpath.operators.latest import first_group, latest_attempt
from lumenpath.operators.sizes import broadcast_if_small
from lumenpath.operators.status import environment_status_from_modules, module_column_status, module_window
from lumenpath.params import ReportParams
from lumenpath.plans.common import admins_for, visible_environments, visible_users
from lumenpath.sources import Platform
from lumenpath.sources.staging import Stage

KEYS = ["user_id", "tenant_id", "module_id"]
HOME = ["user_id", "tenant_id", "environment_id"]
FIXED_COLUMNS = [
    "user_id", "full_name", "email", "login", "user_status", "parent_group_id", "parent_group_name", "child_group_id",
    "child_group_name", "all_groups", "role_label", "environment_name", "environment_id", "environment_score",
    "environment_status",
]


def module_column_facts(platform: Platform, params: ReportParams, admins: DataFrame | None = None) -> DataFrame:
    """One row per user, role and module with its place in the track, status and cell text."""
    platform = platform.for_tenant(params.tenant_id)
    admins = admins_for(platform, params, admins)
    who = ["user_id", "tenant_id"]
    users = real_users(platform, params).join(visible_users(platform, admins), who, "left_semi")
    # Only whole environments are reported: inactive tracks and modules never show.
    content = module_hierarchy(
        platform,
        ReportParams(
            as_of=params.as_of, environment_ids=params.environment_ids,
            show_inactive_environments=params.show_inactive_environments,
        ),
    ).join(visible_environments(platform, admins), ["environment_id", "tenant_id"], "left_semi")
    modules = platform.modules.select("module_id", "tenant_id", "type_id", "order_number", "starts_at", "ends_at")
    latest = latest_attempt(platform.attempts).select(
        *KEYS, "attempt_id", F.col("status_id").alias("attempt_status"), "total_score", "is_done", "is_approved",
        F.col("created_at").alias("first_access_at"), F.col("updated_at").alias("_updated_at"),
    )
    exempt = platform.exemptions.select(
        *KEYS, "exempted_at", F.col("starts_at").alias("exempt_starts_at"), F.col("ends_at").alias("exempt_ends_at"),
        F.lit(True).alias("_exempt"),
    )
    rows = (
        module_roles(platform, params.role_ids).select(*KEYS, "role_id")
        .join(latest, KEYS, "left")
        .join(exempt, KEYS, "left")
        .join(users.select(*who, "is_active"), who)
        .join(first_group(platform), who)
        .join(broadcast_if_small(content.join(modules, ["module_id", "tenant_id"])), ["module_id", "tenant_id", "environment_id"])
        .withColumn("is_exempt", F.coalesce("_exempt", F.lit(False)))
        .withColumn("is_done", F.coalesce("is_done", F.lit(False)))
        .withColumn("is_approved", F.coalesce("is_approved", F.lit(False)))
        .withColumn("is_started", F.coalesce(F.col("attempt_status") != codes.NOT_STARTED, F.lit(False)))
        .withColumn("window", module_window(instant(params.as_of)))
        .withColumn("module_status", module_column_status())
    )
    in_track = Window.partitionBy("user_id", "tenant_id", "environment_id", "track_id").orderBy(
        F.coalesce("exempt_starts_at", "starts_at"), "order_number", "module_id"
    )
    closed = F.col("is_done") | (F.col("attempt_id").isNotNull() & (F.col("type_id") == codes.RECURRING_MODULE))
    status_text = codes.label_of(F.col("module_status"), codes.COLUMN_STATUS_LABELS)
    cell = (
        F.when(~F.col("is_active") | (F.col("window") == "null"), status_text)
        .when(F.col("is_done"), decimal_comma(money(F.col("total_score"), 10)))
        .when(F.col("first_access_at").isNotNull(), "Em andamento")
        .otherwise("Nunca acessou")
    )
    return (
        rows.withColumn("module_index", F.row_number().over(in_track).cast("bigint"))
        .withColumn("module_label", module_label(F.col("module_index"), F.col("track_name"), F.col("module_name")))
        .withColumn("completed_at", day_second(F.when(closed, F.col("_updated_at"))))
        .withColumn("cell", cell)
        .drop("_exempt", "_updated_at")
    )


def module_label(index, track, module):
    """``<index>.<track> - <module>``, the names cut as the legacy report cuts them."""
    return F.concat(index.cast("string"), F.lit("."), first_chars(F.concat(track, F.lit(" - "), module), 125))


def environment_totals(facts: DataFrame, params: ReportParams) -> DataFrame:
    """Module counts and status per user and environment, counted once on the (track, module) grain."""
    exempt = F.col("is_exempt")
    per_track = facts.groupBy(*HOME, "track_id").agg(
        F.count("*").alias("modules"),
        F.count_if(F.col("is_done")).alias("done"),
        F.count_if(F.col("is_approved")).alias("approved"),
        F.count_if(F.col("is_started")).alias("started"),
        F.count_if(F.col("starts_at") <= instant(params.as_of)).alias("open"),
        F.count_if(exempt).alias("exempt"),
        F.max(F.when(exempt, F.col("exempt_starts_at")).otherwise(F.col("starts_at"))).alias("last_start"),
        F.max(F.when(exempt, F.col("exempt_ends_at")).otherwise(F.col("ends_at"))).alias("last_end"),
    )
    return (
        per_track.groupBy(*HOME)
        .agg(
            F.sum("modules").alias("module_rows"), F.sum("done").alias("modules_done"),
            F.sum("approved").alias("modules_approved"), F.sum("started").alias("modules_started"),
            F.sum("open").alias("modules_open"), F.sum("exempt").alias("exempt_rows"),
            F.count("*").alias("total_tracks"),
            F.count_if(F.col("started") > 0).alias("started_tracks"),
            F.count_if(F.col("done") >= F.col("modules")).alias("finished_tracks"),
            F.max("last_start").alias("last_start"), F.max("last_end").alias("last_end"),
        )
        .withColumn("environment_status", environment_status_from_modules(instant(params.as_of)))
    )


MOST_COLUMNS = 10_000


def module_labels(platform: Platform, params: ReportParams, environments: DataFrame) -> DataFrame:
    """``(module_id, tenant_id, header, order_number)`` of the modules of the given environments.

    The index in a header is the module's place in its track by start date, order and id.
    """
    placed = module_hierarchy(
        platform,
        ReportParams(as_of=params.as_of, environment_ids=params.environment_ids, show_inactive_environments=params.show_inactive_environments),
    ).join(environments, ["environment_id", "tenant_id"], "left_semi").select("module_id", "tenant_id", "track_id", "track_name", "module_name").distinct()
    order = platform.modules.select("module_id", "tenant_id", "order_number", "starts_at")
    in_track = Window.partitionBy("tenant_id", "track_id").orderBy("starts_at", "order_number", "module_id")
    header = module_label(F.row_number().over(in_track), F.col("track_name"), F.col("module_name"))
    return (
        placed.join(order, ["module_id", "tenant_id"]).withColumn("header", header)
        .groupBy("module_id", "tenant_id").agg(F.min("header").alias("header"), F.min("order_number").alias("order_number"))
    )


def module_headers(labels: DataFrame) -> list[tuple[int, str, str]]:
    """``(module_id, label, header)`` of the modules that become columns, in column order.

    Tenants share a column only where both the module's id and its label agree.  Headers are metadata of the
    plan (one short row per column, at most ``MOST_COLUMNS``) and are read on the driver; equal ones get `` (n)``.
    """
    columns = labels.groupBy("module_id", "header").agg(F.min("order_number").alias("order_number"))
    rows = columns.orderBy("order_number", F.col("module_id").cast("string"), "header").limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} module columns; narrow the report by tenant or environment")
    repeats, seen, headers = Counter(row.header for row in rows), Counter(), []
    for row in rows:
        seen[row.header] += 1
        headers.append(f"{row.header} ({seen[row.header]})" if repeats[row.header] > 1 else row.header)
    fresh = unique_headers(headers, FIXED_COLUMNS + ["tenant_id"])
    return [(row.module_id, row.header, header) for row, header in zip(rows, fresh)]


def _by_environment(rows: DataFrame, value: str) -> DataFrame:
    """A map from environment to value for each user: joined by user it needs no other dealing than the facts have."""
    pairs = F.map_from_entries(F.collect_list(F.struct("environment_id", value)))
    return rows.where(F.col(value).isNotNull()).groupBy("user_id", "tenant_id").agg(pairs.alias(f"_{value}"))


def reported_facts(platform: Platform, params: ReportParams, admins: DataFrame | None = None) -> DataFrame:
    """The facts of the environments that the status filter leaves, with ``environment_status``.

    They are worked out once, dealt by user, and read three times: for the status, the columns and the cells.
    """
    who = ("user_id", "tenant_id")
    facts = Stage(platform.users.sparkSession, "module_columns").keep("facts", lambda: module_column_facts(platform, params, admins), bucket_by=who)
    totals = where_all(environment_totals(facts, params), one_of(F.col("environment_status"), params.statuses))
    status = F.element_at("_environment_status", F.col("environment_id"))
    found = facts.join(_by_environment(totals, "environment_status"), [*who]).withColumn("environment_status", status).drop("_environment_status")
    return found.where(F.col("environment_status").isNotNull())


def reported_labels(platform: Platform, params: ReportParams, facts: DataFrame) -> DataFrame:
    """``module_labels`` of the modules that some reported row has."""
    labels = module_labels(platform.for_tenant(params.tenant_id), params, facts.select("environment_id", "tenant_id").distinct())
    return labels.join(facts.select("module_id", "tenant_id").distinct(), ["module_id", "tenant_id"], "left_semi")


def module_status_columns(platform: Platform, params: ReportParams, admins: DataFrame | None = None) -> DataFrame:
    """The wide module report.

    The pivot groups ids only; names, groups, scores and attributes are joined to the pivoted rows by user.
    """
    facts = reported_facts(platform, params, admins)
    platform = platform.for_tenant(params.tenant_id)
    labels = Stage(platform.users.sparkSession, "module_columns").keep("labels", lambda: reported_labels(platform, params, facts))
    who = ["user_id", "tenant_id"]
    headers = module_headers(labels)
    groups = ["parent_group_id", "parent_group_name", "child_group_id", "child_group_name"]
    keys = [*HOME, "environment_name", "environment_status", "role_id", "is_active", *groups]
    column = F.concat(F.col("module_id").cast("string"), F.lit(":"), F.col("header")).alias("column")
    cells = facts.join(broadcast_if_small(labels.select("module_id", "tenant_id", "header")), ["module_id", "tenant_id"]).select(*keys, column, "cell")
    wide = cells.groupBy(*keys).pivot("column", [f"{module}:{label}" for module, label, _ in headers]).agg(F.max("cell"))
    wide = wide.toDF(*keys, *[header for *_, header in headers])
    scores = _by_environment(platform.environment_scores.where("ranking_id = 0").groupBy(*HOME).agg(F.max("score").alias("score")), "score")
    users = platform.users.select(*who, "full_name", "email", "login")
    rows = (
        wide.join(users, who)
        .join(scores, who, "left").withColumn("score", F.element_at("_score", F.col("environment_id"))).drop("_score")
        .join(all_groups(platform, group_ids=params.group_ids), who, "inner" if params.group_ids else "left")
    )
    finished = F.col("environment_status") == "finished"
    score = F.when(finished, F.coalesce(decimal_comma(money(F.col("score"))), F.lit(""))).otherwise(F.lit(""))
    report = rows.withColumns({
        "user_status": codes.user_status_label(F.col("is_active")),
        "role_label": codes.role_label(F.col("role_id")),
        "environment_score": score,
        "environment_status": codes.label_of(F.col("environment_status"), codes.DICTIONARIES["environment_status"]),
    })
    columns = [F.col(f"`{c}`") for c in ["tenant_id", *FIXED_COLUMNS, *[header for *_, header in headers]]]
    return with_attribute_columns(platform, report.select(*columns), admins_for(platform, params, admins))
