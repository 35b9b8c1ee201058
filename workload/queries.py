"""Registered queries: every operator and report run over the whole stand-in tables of a data directory.

Each query covers all tenants at once.  ``ORACLES`` holds the checking SQL of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.functions import codes, exprs, predicates
from lumenpath.operators import access, answers, attributes, audience, content, labels, latest, progress, provenance, status, table_functions
from lumenpath.operators.audience import Criterion
from lumenpath.params import ReportParams
from lumenpath.plans import activity, environment, gold, module_columns, module_rows, track
from lumenpath.sources import Platform
from workload.oracle import ORACLES  # noqa: F401  (re-exported next to QUERIES)
from workload.tables import AS_OF, TENANTS, standin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Platform], DataFrame]) -> Callable[[Platform], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(standin(spark, sf_dir, build.__name__))
    return build


def params(**filters) -> ReportParams:
    return ReportParams(as_of=AS_OF, **filters)


def now():
    return exprs.instant(AS_OF)


# ---- attempts, groups ------------------------------------------------------------------------------


@query
def status_by_track(p: Platform) -> DataFrame:
    """Users per tenant, track and state of their latest valid attempt."""
    modules = p.modules.select("module_id", "tenant_id", "track_id")
    return (
        latest.latest_attempt(p.attempts).join(modules, ["module_id", "tenant_id"])
        .groupBy("tenant_id", "track_id", "status_id")
        .agg(
            F.count("*").alias("attempts"), F.count_if(F.col("is_done")).alias("done"),
            F.count_if(F.col("is_approved")).alias("approved"), exprs.money(F.sum("total_score")).alias("score"),
        )
    )


@query
def latest_attempt(p: Platform) -> DataFrame:
    return latest.latest_attempt(p.attempts).select(
        "user_id", "tenant_id", "module_id", "attempt_id", "status_id", "total_score", "is_done", "is_approved"
    )


@query
def attempt_history_numbered(p: Platform) -> DataFrame:
    return latest.attempt_history(p.attempts).select("user_id", "tenant_id", "module_id", "attempt_id", "attempt_number", "total_score")


@query
def attempt_history_of_busy_users(p: Platform) -> DataFrame:
    """Three users who have all attempts between them: far more than a hundred in one module."""
    busy = p.attempts.withColumn("user_id", F.col("user_id") % 3)
    return latest.attempt_history(busy).select("user_id", "tenant_id", "module_id", "attempt_id", "attempt_number")


@query
def first_group(p: Platform) -> DataFrame:
    return latest.first_group(p)


@query
def first_group_any_environment(p: Platform) -> DataFrame:
    return latest.first_group(p, per_environment=False)


@query
def all_groups(p: Platform) -> DataFrame:
    return access.all_groups(p)


@query
def all_groups_filtered(p: Platform) -> DataFrame:
    return access.all_groups(p, group_ids=(1, 2, 105, 106, 107))


# ---- labels, settings, attributes --------------------------------------------------------------------


@query
def label_override(p: Platform) -> DataFrame:
    wanted = p.labels.join(p.label_texts.select("label_id"), "label_id", "left_semi").select("label_id").withColumn(
        "tenant_id", F.explode(F.array(*[F.lit(t) for t in TENANTS]))
    )
    return labels.label_text(p, wanted, "pt")


@query
def settings_overlay(p: Platform) -> DataFrame:
    return labels.settings(p, p.users.select("tenant_id"))


@query
def environment_settings_overlay(p: Platform) -> DataFrame:
    return labels.environment_settings(p, p.environments)


@query
def partial_score_switch(p: Platform) -> DataFrame:
    return labels.environment_switch(p, p.environments, codes.PARTIAL_SCORE_SETTING)


@query
def attributes_latest(p: Platform) -> DataFrame:
    return attributes.user_attributes(p)


@query
def attributes_pivot(p: Platform) -> DataFrame:
    return attributes.pivot_attributes(attributes.user_attributes(p), attributes.attribute_names(p))


@query
def attribute_names_by_tenant(p: Platform) -> DataFrame:
    return attributes.tenant_attribute_names(p)


@query
def attributes_of_two_tenants(p: Platform) -> DataFrame:
    """Users of two tenants with the attribute columns that a report on these tenants has."""
    tenants = p.users.where(F.col("tenant_id").isin(TENANTS[0], TENANTS[1])).select("tenant_id").distinct()
    users = p.users.join(tenants, "tenant_id", "left_semi").select("user_id", "tenant_id")
    return attributes.with_attribute_columns(p, users, tenants)


@query
def module_pivot(p: Platform) -> DataFrame:
    """Latest total score per user with one column per module, in module order."""
    ids = [row.module_id for row in p.modules.select("module_id").distinct().orderBy("module_id").collect()]
    rows = latest.latest_attempt(p.attempts).select("user_id", "tenant_id", "module_id", "total_score")
    wide = rows.groupBy("user_id", "tenant_id").pivot("module_id", ids).agg(F.max("total_score"))
    return wide.toDF("user_id", "tenant_id", *[f"module_{m}" for m in ids])


# ---- table functions, called from SQL ------------------------------------------------------------------


def _through_sql(p: Platform, sql: str, **tables: DataFrame) -> DataFrame:
    table_functions.register(p)
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return p.users.sparkSession.sql(sql)


@query
def sql_user_attributes(p: Platform) -> DataFrame:
    return _through_sql(p, "SELECT a.* FROM called_tenants t, LATERAL user_attributes_of(t.tenant_id) a", called_tenants=p.users.select("tenant_id").distinct())


@query
def sql_settings(p: Platform) -> DataFrame:
    return _through_sql(p, "SELECT s.* FROM called_tenants t, LATERAL settings_of(t.tenant_id) s", called_tenants=p.users.select("tenant_id").distinct())


@query
def sql_environment_settings(p: Platform) -> DataFrame:
    sql = "SELECT s.* FROM called_environments e, LATERAL environment_settings_of(e.tenant_id, e.environment_id) s"
    return _through_sql(p, sql, called_environments=p.environments)


@query
def sql_editable_entities(p: Platform) -> DataFrame:
    admins = p.any_admins.unionByName(p.tree_admins).unionByName(p.specific_admins).distinct()
    return _through_sql(p, "SELECT e.* FROM called_admins a, LATERAL editable_entities_of(a.admin_id, a.tenant_id, 'CP') e", called_admins=admins)


@query
def sql_label_text(p: Platform) -> DataFrame:
    wanted = p.labels.select("label_id").withColumn("tenant_id", F.explode(F.array(*[F.lit(t) for t in TENANTS])))
    return _through_sql(p, "SELECT l.* FROM called_labels w, LATERAL label_text_of(w.label_id, w.tenant_id, 'pt') l", called_labels=wanted)


@query
def sql_all_groups(p: Platform) -> DataFrame:
    sql = "SELECT g.* FROM called_users u, LATERAL all_groups_of(u.user_id, u.tenant_id, array(1L, 2L, 105L, 106L, 107L)) g"
    return _through_sql(p, sql, called_users=p.group_members.select("user_id", "tenant_id").distinct())


# ---- access --------------------------------------------------------------------------------------------


@query
def editable_any(p: Platform) -> DataFrame:
    return access.editable_entities(p, p.any_admins, codes.USER)


@query
def editable_tree(p: Platform) -> DataFrame:
    return access.editable_entities(p, p.tree_admins, codes.USER)


@query
def editable_specific(p: Platform) -> DataFrame:
    return access.editable_entities(p, p.specific_admins, codes.USER)


def _editable_by_everyone(p: Platform, entity_type: str) -> DataFrame:
    admins = p.any_admins.unionByName(p.tree_admins).unionByName(p.specific_admins).distinct()
    return access.editable_entities(p, admins, entity_type)


@query
def editable_environments(p: Platform) -> DataFrame:
    return _editable_by_everyone(p, codes.ENVIRONMENT)


@query
def editable_activities(p: Platform) -> DataFrame:
    return _editable_by_everyone(p, codes.ACTIVITY)


@query
def editable_achievements(p: Platform) -> DataFrame:
    return _editable_by_everyone(p, codes.ACHIEVEMENT)


@query
def editable_ungrouped(p: Platform) -> DataFrame:
    return _editable_by_everyone(p, codes.USER).where(~F.col("is_linked"))


# ---- content, answers, gold ------------------------------------------------------------------------------


@query
def hierarchy_distinct(p: Platform) -> DataFrame:
    return content.hierarchy(p)


@query
def hierarchy_active(p: Platform) -> DataFrame:
    return content.hierarchy(p, params(activity_types=("formulario", "minigame", "padrao_sou"), track_ids=(1996, 1997, 1998, 1999, 2000)))


@query
def user_plan(p: Platform) -> DataFrame:
    modules = p.modules.select("module_id", "tenant_id", "track_id", F.col("name").alias("module_name"))
    return content.user_plan(p, modules)


@query
def answers_concat(p: Platform) -> DataFrame:
    keys = ["attempt_id", "activity_id", "tenant_id"]
    return answers.choice_answers(p).join(answers.form_answers(p), keys, "full")


@query
def answers_minigame(p: Platform) -> DataFrame:
    return answers.minigame_answers(p)


@query
def answer_choice(p: Platform) -> DataFrame:
    rows = gold.activity_facts(p, AS_OF)
    return rows.select("user_id", "tenant_id", "environment_id", "activity_id", "activity_type_id", "answer_text")


@query
def activity_status(p: Platform) -> DataFrame:
    rows = gold.activity_facts(p, AS_OF)
    return rows.groupBy("tenant_id", "track_id", "environment_id", "activity_type_id", "activity_status").agg(
        F.count("*").alias("rows"), F.count_if(F.col("attempt_id").isNotNull()).alias("with_attempt")
    )


@query
def weight_override(p: Platform) -> DataFrame:
    rows = gold.activity_facts(p, AS_OF)
    return rows.select("user_id", "tenant_id", "environment_id", "activity_id", "activity_weight", "activity_workload")


@query
def activity_gold(p: Platform) -> DataFrame:
    return gold.activity_time_gold(p, AS_OF)


@query
def activity_report(p: Platform) -> DataFrame:
    chosen = params(user_flags=(1,), role_ids=(1, 2))
    return activity.activity_report(p, p.gold, chosen, p.any_admins)


@query
def activity_role_filters(p: Platform) -> DataFrame:
    """Gold rows of no role, of a role nobody knows, and of that one beside a known one."""
    frames = [
        activity.filter_gold(p.gold, params(role_ids=roles)).agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("roles"), "n")
        for name, roles in (("none", ()), ("unknown", (9,)), ("one known", (9, 1)))
    ]
    return frames[0].union(frames[1]).union(frames[2])


@query
def activity_status_filters(p: Platform) -> DataFrame:
    """Gold rows of no user status, of one nobody knows, of that one beside inactive users, and of both known ones."""
    frames = [
        activity.filter_gold(p.gold, params(user_flags=flags)).agg(F.count("*").alias("n")).select(F.lit(name).alias("statuses"), "n")
        for name, flags in (("none", ()), ("unknown", (7,)), ("one known", (7, 0)), ("both", (1, 0)))
    ]
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


@query
def activity_of_listed_modules(p: Platform) -> DataFrame:
    """Gold rows of 2,000 listed modules, of which the tables have some, and of 1,100 listed groups."""
    chosen = params(module_ids=tuple(range(17984, 19984)), group_ids=tuple(range(104, 1204)), show_inactive_modules=True)
    return activity.filter_gold(p.gold, chosen).groupBy("tenant_id", "module_id", "child_group_id", "parent_group_id").agg(F.count("*").alias("n"))


@query
def activity_report_filtered(p: Platform) -> DataFrame:
    chosen = params(
        role_ids=(1, 2, 3), statuses=("in_progress", "expired", "not_started"), group_ids=(1, 2, 3, 104, 105),
        windows={"first_access": ("1997-01-01 00:00:00", "2000-12-31 00:00:00")}, show_empty_dates=True,
        show_inactive_tracks=True, show_inactive_modules=True,
    )
    return activity.activity_report(p, p.gold, chosen, p.tree_admins, sort=False)


# ---- module reports ------------------------------------------------------------------------------------------


@query
def module_window_status(p: Platform) -> DataFrame:
    keys = ["user_id", "tenant_id", "module_id"]
    exempt = p.exemptions.select(*keys, "exempted_at", F.col("starts_at").alias("exempt_starts_at"))
    rows = content.module_roles(p).select(*keys).join(exempt, keys, "left").join(
        p.modules.select("module_id", "tenant_id", "starts_at", "ends_at"), ["module_id", "tenant_id"]
    )
    return rows.select(*keys, status.module_window(now()).alias("window"))


@query
def module_status_rows(p: Platform) -> DataFrame:
    return module_rows.module_status_rows(p, params(user_flags=(1,), role_ids=(1, 2, 3)), p.any_admins)


@query
def module_status_rows_all_attempts(p: Platform) -> DataFrame:
    chosen = params(
        all_attempts=True, role_ids=(1, 2), show_inactive_modules=True, show_empty_dates=True,
        windows={"any": ("1996-06-01 00:00:00", "1999-06-30 00:00:00"), "link": ("1995-01-01 00:00:00", "2000-12-31 00:00:00")},
    )
    rows = module_rows.module_status_facts(p, chosen, p.any_admins)
    return rows.select(
        "user_id", "tenant_id", "environment_id", "module_id", "attempt_id", "attempt_number", "role_id", "window",
        "module_status", "first_access_at", "completed_at", "track_modules", "track_modules_done", "last_completed_at",
    )


@query
def module_workload(p: Platform) -> DataFrame:
    return module_rows.module_workload(p)


@query
def module_status_columns(p: Platform) -> DataFrame:
    return module_columns.module_status_columns(p, params(user_flags=(1, 0), role_ids=(1, 2)), p.any_admins)


@query
def module_columns_of_few_users(p: Platform) -> DataFrame:
    """Columns of the wide report of some users: modules that none of them has do not show."""
    chosen = params(user_ids=tuple(range(1, 1500, 150)), role_ids=(1, 2), statuses=("in_progress", "expired", "finished"))
    facts = module_columns.reported_facts(p, chosen, p.any_admins)
    return module_columns.reported_labels(p, chosen, facts).select("tenant_id", "module_id", "header")


@query
def module_column_cells(p: Platform) -> DataFrame:
    rows = module_columns.module_column_facts(p, params(role_ids=(1, 2)), p.any_admins)
    return rows.select("user_id", "tenant_id", "environment_id", "module_id", "module_index", "module_label", "module_status", "cell", "completed_at")


@query
def environment_status_from_modules(p: Platform) -> DataFrame:
    chosen = params(role_ids=(1, 2))
    rows = module_columns.environment_totals(module_columns.module_column_facts(p, chosen, p.any_admins), chosen)
    return rows.select(
        "user_id", "tenant_id", "environment_id", "module_rows", "modules_done", "modules_approved", "modules_started",
        "modules_open", "total_tracks", "finished_tracks", "started_tracks", "environment_status",
    )


# ---- track and environment reports -----------------------------------------------------------------------------


@query
def track_link(p: Platform) -> DataFrame:
    return track.track_link(p)


@query
def track_status(p: Platform) -> DataFrame:
    rows = track.track_facts(p, params(), p.any_admins)
    return rows.select("user_id", "tenant_id", "track_id", "role_id", "expires_at", "track_status", "attempt_type")


@query
def track_report(p: Platform) -> DataFrame:
    chosen = params(
        user_flags=(1,), role_ids=(1, 2), show_empty_dates=True, group_ids=(1, 2, 3, 101, 104, 106, 108),
        windows={"completion": ("1995-06-01 00:00:00", "2001-06-30 00:00:00")},
    )
    return track.track_report(p, chosen, p.any_admins)


@query
def recert_expiry(p: Platform) -> DataFrame:
    dates = p.recertifications.select("track_id", "tenant_id", "expiry_days", "available_days")
    rows = p.track_progress.select("user_id", "tenant_id", "track_id", "finished_at").join(dates, ["track_id", "tenant_id"])
    expires = exprs.plus_days(F.col("finished_at"), F.col("expiry_days"))
    return rows.select("user_id", "tenant_id", "track_id", expires.alias("expires_at")).join(dates, ["track_id", "tenant_id"]).select(
        "user_id", "tenant_id", "track_id", "expires_at",
        exprs.plus_days(F.col("expires_at"), -F.col("available_days")).alias("renewable_at"),
    )


@query
def environment_plan(p: Platform) -> DataFrame:
    return progress.environment_track_plan(p, params())


@query
def track_summary_union(p: Platform) -> DataFrame:
    return progress.track_summary(p, progress.environment_track_plan(p, params()), params()).drop("attempt_updated_at")


@query
def environment_rollup(p: Platform) -> DataFrame:
    return progress.environment_rollup(progress.track_summary(p, progress.environment_track_plan(p, params()), params()))


@query
def environment_exempt(p: Platform) -> DataFrame:
    return progress.fully_exempt(p)


@query
def environment_status(p: Platform) -> DataFrame:
    rows = environment.environment_facts(p, params(), p.any_admins)
    return rows.select(
        "user_id", "tenant_id", "environment_id", "total_tracks", "not_released_tracks", "approved_modules",
        "available_modules", "is_exempt", "last_seen_at", "environment_status",
    )


@query
def environment_report(p: Platform) -> DataFrame:
    return environment.environment_report(p, params(user_flags=(1,), role_ids=(1, 2)), p.any_admins)


@query
def environment_report_by_group(p: Platform) -> DataFrame:
    """Groups are chosen among those asked for, also for users whose first group is another one."""
    rows = environment.environment_report(p, params(user_flags=(1,), role_ids=(1, 2), group_ids=(2, 3, 101, 104, 106, 108)), p.any_admins)
    return rows.select("tenant_id", "user_id", "environment_id", "child_group_id", "child_group_name", "parent_group_id", "environment_status")


@query
def environment_report_for_audience(p: Platform) -> DataFrame:
    members = audience.audience(p, _all("AV", "contains", value="CODE-", attribute_id=2, entity_id=0))
    chosen = params(windows={"last_access": ("1998-01-01 00:00:00", "2001-12-31 00:00:00")}, show_empty_dates=True)
    rows = environment.environment_report(p, chosen, p.tree_admins, members)
    return rows.select("user_id", "tenant_id", "environment_id", "environment_status", "score", "completion_percent", "linked_by")


@query
def provenance_names(p: Platform) -> DataFrame:
    links = content.module_roles(p).select("user_id", "tenant_id", "module_id", "origin_created", "created_by")
    named = provenance.with_provenance(p, links, "origin_created", "created_by")
    return named.withColumn("link_origin", codes.origin_label(F.col("origin_created")))


# ---- audiences -------------------------------------------------------------------------------------------------


def _all(entity_type: str, kind: str, **rest) -> list[Criterion]:
    """The same criterion for every tenant."""
    return [Criterion(t, entity_type, kind, **rest) for t in TENANTS]


AUDIENCES: dict[str, list[Criterion]] = {
    "competition": _all("CP", "competition", entity_id=2) + _all("CP", "competition", entity_id=4),
    "competition_not_participate": _all("CP", "competition_not_participate", entity_id=1),
    "competition_not_participate_any": _all("CP", "competition_not_participate_any"),
    "competition_finished": _all("CP", "competition_finished", entity_id=2),
    "competition_not_finished": _all("CP", "competition_not_finished", entity_id=3),
    "track": _all("TR", "track", entity_id=1998) + _all("TR", "track", entity_id=1999),
    "track_not_participate": _all("TR", "track_not_participate", entity_id=1996),
    "track_finished": _all("TR", "track_finished", entity_id=1997),
    "track_not_finished": _all("TR", "track_not_finished", entity_id=1997),
    "group": _all("GR", "group", entity_id=103) + _all("GR", "group", entity_id=3),
    "user_profile": _all("UP", "userProfile", entity_id=3),
    "admin_profile": _all("AP", "adminProfile", entity_id=1),
    "user_status": _all("SU", "userStatus", entity_id=0),
    "select": _all("AV", "equal_to", entity_id=2, attribute_id=4),
    "multiple": _all("AV", "equal_to", entity_id=2, attribute_id=7) + _all("AV", "equal_to", entity_id=5, attribute_id=7),
    "integer": _all("AV", "greater_than_or_equal_to", value="100", attribute_id=1, entity_id=0),
    "date": _all("AV", "in_between", value="2024-01-10", value_2="2024-01-12", attribute_id=5, entity_id=0),
    "text": _all("AV", "contains", value="CODE-1", attribute_id=2, entity_id=0),
    "text_empty": _all("AV", "is_empty", attribute_id=2, entity_id=0),
}

for _name, _criteria in AUDIENCES.items():
    QUERIES[f"audience_{_name}"] = lambda spark, sf_dir, rows=_criteria: audience.audience(standin(spark, sf_dir), rows)


@query
def audience_all_criteria(p: Platform) -> DataFrame:
    include = (
        AUDIENCES["competition"] + AUDIENCES["track"] + AUDIENCES["integer"]
        + _all("AV", "less_than", value="20", attribute_id=1, entity_id=0) + AUDIENCES["select"]
        + _all("AV", "equal_to", entity_id=3, attribute_id=4) + AUDIENCES["track_not_finished"]
    )
    exclude = _all("US", "user", entity_id=7) + AUDIENCES["admin_profile"] + _all("GR", "group", entity_id=102)
    return audience.audience(p, include, exclude)


@query
def audience_page(p: Platform) -> DataFrame:
    return audience.audience_users(p, AUDIENCES["competition"], AUDIENCES["track_finished"], search="CUSTOMER#0000", skip=5, take=40)


@query
def deep_audience_page(p: Platform) -> DataFrame:
    """A page that begins behind several hundred users."""
    return audience.audience_users(p, AUDIENCES["competition"], AUDIENCES["track_finished"], skip=300, take=45)


@query
def text_criteria(p: Platform) -> DataFrame:
    value = F.col("text_value")
    rows = p.entity_attributes

    def test(operation: str, wanted: str):
        return predicates.text_matches(F.lit(operation), F.trim(value), F.lit(wanted)).alias(operation)

    return rows.select(
        "entity_attribute_id", "attribute_id", test("equal_to", "CODE-1"), test("starts_with", "Code-1"), test("ends_with", "-2"),
        test("contains", "DE-3"), test("is_empty", ""),
    )


@query
def typed_criteria(p: Platform) -> DataFrame:
    value = F.col("text_value")

    def test(operation: str, low: str, high: str | None, kind: str, name: str):
        return F.coalesce(predicates.typed_matches(F.lit(operation), value, F.lit(low), F.lit(high), kind), F.lit(False)).alias(name)

    return p.entity_attributes.select(
        "entity_attribute_id", test("equal_to", "12", None, "int", "int_equal"), test("in_between", "5", "50", "int", "int_between"),
        test("greater_than", "12", None, "int", "int_above"), test("less_than_or_equal_to", "12", None, "int", "int_up_to"),
        test("less_than", "2024-01-15", None, "date", "date_before"), test("greater_than_or_equal_to", "2024-01-15", None, "date", "date_from"),
    )


@query
def search_box(p: Platform) -> DataFrame:
    columns = [F.col(c) for c in ("full_name", "login", "email", "user_id")]
    return predicates.where_all(p.users, predicates.mentions(columns, "R#00000001")).select("user_id", "tenant_id", "full_name")


# ---- scalar functions, filters -----------------------------------------------------------------------------------


@query
def filter_conversion(p: Platform) -> DataFrame:
    """Every state of an attempt and two more codes through each dictionary."""
    codes_there = p.attempts.select(F.col("status_id").alias("original")).distinct()
    frames = []
    for kind in sorted(codes.DICTIONARIES):
        converted = labels.convert_filter(p.attempts.sparkSession, ",".join([*sorted(codes.DICTIONARIES[kind]), "no such code"]), kind)
        seen = codes_there.join(converted.select("original", "converted"), "original", "left")
        frames.append(converted.select("kind", "original", "converted", F.lit("sent").alias("origin")).union(
            seen.select(F.lit(kind), "original", F.coalesce("converted", F.lit("not sent")), F.lit("held"))))
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


@query
def code_translate(p: Platform) -> DataFrame:
    return p.attempts.groupBy("status_id").agg(F.count("*").alias("n")).select(
        "status_id", "n",
        codes.label_of(F.col("status_id"), codes.DICTIONARIES["activity_status"], codes.UNKNOWN).alias("not_a_code"),
        codes.label_of(
            F.when(F.col("status_id") == codes.IN_PROGRESS, " in_progress ").otherwise("finished"), codes.DICTIONARIES["track_status"],
            codes.UNKNOWN,
        ).alias("label"),
    )


@query
def format_duration(p: Platform) -> DataFrame:
    seconds = F.col("seconds") * 37
    return p.activity_access.select("attempt_id", "activity_id", exprs.clock(seconds).alias("clock"), exprs.short_clock(seconds).alias("short"))


@query
def format_percent(p: Platform) -> DataFrame:
    part, whole = F.col("finished_modules"), F.col("total_modules")
    return p.track_progress.select(
        "progress_id", exprs.percent_text(part, whole).alias("share"), exprs.percent(F.col("exempt_modules"), F.nullif(part, F.lit(0))).alias("of_done"),
        exprs.decimal_comma(F.col("score")).alias("comma"), exprs.grouped_number(F.col("score")).alias("grouped"),
    )


@query
def date_formats(p: Platform) -> DataFrame:
    moment = F.col("updated_at")
    return p.users.select(
        "user_id", exprs.day(moment).alias("day"), exprs.day_minute(moment).alias("minute"), exprs.day_second(moment).alias("second"),
        exprs.first_chars(F.col("full_name"), 12).alias("clipped"),
    )


@query
def optional_filters(p: Platform) -> DataFrame:
    users = content.real_users(p, params(user_flags=(1,)))
    open_modules = content.module_hierarchy(p, params(environment_ids=(1, 2, 5), show_inactive_tracks=True), visible_only=True)
    roles = content.module_roles(p, (1, 3))
    linked = predicates.where_all(
        roles, predicates.in_window(F.col("created_at"), ("1996-03-01", "1999-03-01")), predicates.in_window(F.col("created_at"), (None, "1997-01-01"))
    )
    return (
        linked.join(users.select("user_id", "tenant_id"), ["user_id", "tenant_id"], "left_semi")
        .join(open_modules, ["module_id", "tenant_id"])
        .groupBy("tenant_id", "environment_id", "track_id", "role_id").agg(F.count("*").alias("links"))
    )
