"""The consolidated activity table: one row per user, environment, module, activity and role."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import clock, instant, spread_key
from lumenpath.operators.answers import answer_text, choice_answers, form_answers, minigame_answers
from lumenpath.operators.content import hierarchy, module_roles, real_users
from lumenpath.operators.labels import label_text
from lumenpath.operators.latest import first_group, latest_attempt
from lumenpath.operators.sizes import broadcast_if_small, dealt
from lumenpath.operators.status import activity_status
from lumenpath.sources import Platform

ACTIVITY_LANGUAGE = "pt-BR"

GOLD_COLUMNS = [
    "user_id", "full_name", "email", "login", "user_status", "parent_group_id", "parent_group_name", "child_group_id",
    "child_group_name", "environment_id", "environment_name", "track_id", "track_name", "module_id", "module_name",
    "activity_id", "activity_name", "attempt_id", "activity_workload", "activity_type", "access_time", "first_access_at",
    "last_access_at", "answered_at", "hit_percent", "statement", "answer_text", "activity_weight", "feedback",
    "activity_status", "role_label", "tenant_id", "activity_type_id", "environment_active", "track_active",
    "module_active", "activity_active",
]

# What an activity takes from the lists of its attempt and its user.
_FACTS = {
    "_access": ("access_seconds", "first_access_at", "last_access_at"),
    "_answers": ("answered_at", "answer_registered_at", "hit_ratio", "essay_text", "feedback", "is_reviewed"),
    "_weights": ("_own_weight",),
}


def participation(platform: Platform, people: DataFrame | None = None) -> DataFrame:
    """User and module, with latest attempt, exemption, own weights and the environments the user belongs to.

    Everything known per user and module is joined here, before modules fan out into activities,
    and only environments shared through a group survive.  ``people`` adds columns of the users.
    """
    keys = ["user_id", "tenant_id", "module_id"]
    roles = module_roles(platform).select(*keys, "role_id")
    users = real_users(platform).select("user_id", "tenant_id")
    if people is not None:
        users = users.join(people, ["user_id", "tenant_id"])
    latest = latest_attempt(platform.attempts).select(*keys, "attempt_id", F.col("status_id").alias("attempt_status"))
    exempt = platform.exemptions.select(*keys, "exempted_at")
    weights = _listed(dealt(platform.user_weights, keys), keys, "_weights", F.col("weight").alias("_own_weight"))
    groups = first_group(platform)
    return (
        roles.join(latest, keys, "left")
        .join(exempt, keys, "left")
        .join(weights, keys, "left")
        .join(users, ["user_id", "tenant_id"])
        .join(groups.drop("parent_group_name", "child_group_name"), ["user_id", "tenant_id"])
    )


def _listed(facts: DataFrame, keys: list[str], name: str, *values: Column) -> DataFrame:
    """One row per key with its facts of all activities as a list.

    ``facts`` are dealt by these keys already: collected before the exchange they would have to be sorted there, too.
    """
    return facts.groupBy(*keys).agg(F.collect_list(F.struct("activity_id", *values)).alias(name))


def catalogue(platform: Platform) -> DataFrame:
    """Everything about an activity in its place that does not depend on the user, type name included."""
    modules = platform.modules.select("module_id", "tenant_id", "starts_at", "ends_at")
    types = platform.activity_types.select(F.col("type_id").alias("activity_type_id"), "requires_review", "label_id")
    content = hierarchy(platform).join(modules, ["module_id", "tenant_id"]).join(types, "activity_type_id", "left")
    names = label_text(platform, content.select("label_id", "tenant_id"), ACTIVITY_LANGUAGE).select(
        "label_id", "tenant_id", F.col("text").alias("activity_type")
    )
    return content.join(names, ["label_id", "tenant_id"], "left").drop("label_id")


def activity_facts(platform: Platform, as_of: datetime | str, people: DataFrame | None = None) -> DataFrame:
    """Participation by activity with access, answers, weight, status and the catalogue's columns.

    Modules fan out into activities last: what is known of an attempt meets its users as one list per attempt, and each
    activity takes its own from the lists.  So the many rows of the result pass through no exchange and no sort.
    """
    place = ["tenant_id", "environment_id", "module_id", "activity_id"]
    content = catalogue(platform)
    # The ids are measured apart from the wide columns: long texts do not cost them their broadcast.
    ids, content = broadcast_if_small(content.select(*place)), broadcast_if_small(content)
    attempt = ["attempt_id", "tenant_id"]
    access = _listed(
        dealt(platform.activity_access, attempt), attempt, "_access", F.col("seconds").alias("access_seconds"),
        F.col("created_at").alias("first_access_at"), F.col("updated_at").alias("last_access_at"),
    )
    answers = _listed(
        dealt(platform.answers, attempt), attempt, "_answers", F.col("user_id"), F.col("environment_id"), F.col("answered_at"),
        F.col("created_at").alias("answer_registered_at"), F.col("hit_ratio"), F.col("essay_text"), F.col("feedback"), F.col("is_reviewed"),
    )
    choices = _listed(choice_answers(platform, attempt), attempt, "_choices", F.col("choice_text"))
    forms = _listed(form_answers(platform, attempt), attempt, "_forms", F.col("form_text"))
    plan = participation(platform, people)
    plan = plan.withColumn("_attempt", spread_key(F.col("attempt_id"), F.col("user_id"), F.col("module_id"), F.col("tenant_id")))
    for facts in (access, answers, choices, forms, minigame_answers(platform)):
        plan = plan.join(facts.withColumnRenamed("attempt_id", "_attempt"), ["_attempt", "tenant_id"], "left")

    def own(facts: str) -> Column:
        return F.filter(facts, lambda fact: fact["activity_id"] == F.col("activity_id"))

    def by_user(answer: Column) -> Column:
        return (answer["user_id"] == F.col("user_id")) & (answer["environment_id"] == F.col("environment_id"))

    rows = plan.join(ids, ["module_id", "tenant_id", "environment_id"]).withColumns({
        "_access": own("_access"), "_weights": own("_weights"), "_answers": F.filter(own("_answers"), by_user),
        # An attempt has at most one text of each kind for an activity.
        "choice_text": F.get(own("_choices"), F.lit(0))["choice_text"], "form_text": F.get(own("_forms"), F.lit(0))["form_text"],
    }).drop("_choices", "_forms")
    for facts, values in _FACTS.items():
        rows = rows.withColumn(facts, F.explode_outer(facts)).withColumns({value: F.col(facts)[value] for value in values}).drop(facts)
    return (
        rows.join(content, place)
        .withColumn("answer_text", answer_text())
        .withColumn("activity_status", activity_status(instant(as_of)))
        .withColumn("activity_weight", F.coalesce("_own_weight", "default_weight"))
        .drop("_attempt", "_own_weight", "choice_text", "form_text", "minigame_text", "essay_text")
    )


def activity_time_gold(platform: Platform, as_of: datetime | str) -> DataFrame:
    """The gold table.  ``activity_status`` holds the canonical code; fields of exempt rows are blank."""
    users = platform.users.select("user_id", "tenant_id", "full_name", "email", "login", "is_active")
    facts = activity_facts(platform, as_of, users)
    group = platform.groups.select("group_id", "tenant_id", "name")
    child = group.select(F.col("group_id").alias("child_group_id"), "tenant_id", F.col("name").alias("child_group_name"))
    parent = group.select(F.col("group_id").alias("parent_group_id"), "tenant_id", F.col("name").alias("parent_group_name"))
    rows = (
        facts.join(child, ["child_group_id", "tenant_id"])
        .join(parent, ["parent_group_id", "tenant_id"], "left")
    )
    counted = F.col("activity_status") != "exempted"

    def shown(value, blank=""):
        return F.when(counted, value).otherwise(F.lit(blank))

    workload = F.when(F.col("activity_workload") > 0, F.col("activity_workload").cast("string")).otherwise(F.lit(""))
    return rows.select(
        "user_id", "full_name", "email", "login", codes.user_status_label(F.col("is_active")).alias("user_status"),
        "parent_group_id", "parent_group_name", "child_group_id", "child_group_name", "environment_id",
        "environment_name", "track_id", "track_name", "module_id", "module_name", "activity_id", "activity_name",
        shown(F.col("attempt_id").cast("string")).alias("attempt_id"),
        shown(workload).alias("activity_workload"), "activity_type",
        shown(F.coalesce(clock(F.col("access_seconds")), F.lit(""))).alias("access_time"),
        shown(F.col("first_access_at"), None).alias("first_access_at"),
        shown(F.col("last_access_at"), None).alias("last_access_at"),
        shown(F.col("answered_at"), None).alias("answered_at"),
        shown(F.coalesce((F.col("hit_ratio") * 100).cast("decimal(18,2)").cast("string"), F.lit(""))).alias("hit_percent"),
        "statement", shown(F.col("answer_text")).alias("answer_text"),
        shown(F.col("activity_weight").cast("string")).alias("activity_weight"),
        shown(F.coalesce("feedback", F.lit(""))).alias("feedback"), "activity_status",
        codes.role_label(F.col("role_id")).alias("role_label"), "tenant_id", "activity_type_id", "environment_active",
        "track_active", "module_active", "activity_active",
    )
