"""Localised labels, settings with overrides, and translation of filter codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.operators.latest import first_per_key
from lumenpath.operators.sizes import BROADCAST_BYTES, measured_bytes
from lumenpath.sources import Platform


def for_each(scope: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every row of ``scope`` with every row of a catalogue: a broadcast, whose size is measured, beside which the scope stays in place."""
    if measured_bytes(catalogue) > BROADCAST_BYTES:
        raise ValueError("the catalogue is too large to be repeated for every row; narrow it first")
    return scope.join(F.broadcast(catalogue))


def _texts(platform: Platform, wanted: DataFrame) -> DataFrame:
    """The text of every wanted ``(label_id, tenant_id)`` in each language: the tenant's own, or else the shared one."""
    own = platform.label_overrides.select("label_id", "language_id", "tenant_id", F.col("text").alias("_own"))
    return (
        wanted.select("label_id", "tenant_id").distinct()
        .join(platform.label_texts.select("label_id", "language_id", "text"), "label_id")
        .join(own, ["label_id", "language_id", "tenant_id"], "left")
        .withColumn("text", F.coalesce("_own", "text"))
    )


def label_languages(platform: Platform, tenants: DataFrame) -> DataFrame:
    """``(label_id, tenant_id, key, is_default, texts)``: all texts of each label for each of ``tenants``, by language."""
    wanted = for_each(platform.labels.select("label_id"), tenants.select("tenant_id").distinct())
    texts = _texts(platform, wanted).groupBy("label_id", "tenant_id").agg(F.array_sort(F.collect_list(F.struct("language_id", "text"))).alias("texts"))
    return texts.join(platform.labels.select("label_id", "key", "is_default"), "label_id")


def label_text(platform: Platform, wanted: DataFrame, language: str) -> DataFrame:
    """Best text of every wanted ``(label_id, tenant_id)``.

    The exact language wins, then a language that starts with it, then any other in alphabetical
    order; a tenant's own text replaces the shared one in the same language.
    """
    found = _texts(platform, wanted)
    folded = F.lower("language_id")
    fit = F.when(folded == language.lower(), 1).when(folded.startswith(language.lower()), 2).otherwise(4)
    best = first_per_key(found, ["label_id", "tenant_id"], [fit, F.col("language_id")])
    facts = platform.labels.select("label_id", "key", "is_default")
    return best.join(facts, "label_id").select("label_id", "tenant_id", "key", "language_id", "text", "is_default")


_SETTING_FACTS = (
    "group_label", "order_number", "help_label", "group_order", "config_order", "config_group_order",
    "config_tab", "config_group",
)


def _overlay(defaults: DataFrame, overrides: DataFrame, scope: DataFrame, scope_keys: list[str]) -> DataFrame:
    """Every default setting for every scope row, replaced field by field by the scope's own row."""
    own = overrides.select(
        "setting_id", *scope_keys, F.col("file").alias("_file"), F.col("is_active").alias("_active"),
        F.col("is_visible").alias("_visible"), F.lit(True).alias("_found"),
    )
    each = for_each(scope.select(*scope_keys).distinct(), defaults)
    return each.join(own, ["setting_id", *scope_keys], "left").select(
        "setting_id", *scope_keys, "description",
        F.coalesce("_file", "file").alias("file"),
        F.coalesce("_active", "is_active").alias("is_active"),
        F.coalesce("_visible", "is_visible").alias("is_visible"),
        F.col("_found").isNull().alias("is_default"),
        F.lit("").alias("tenant_theme"), *_SETTING_FACTS,
    )


def settings(platform: Platform, tenants: DataFrame) -> DataFrame:
    """Settings in force for every ``tenant_id`` of ``tenants``."""
    return _overlay(platform.settings, platform.tenant_settings, tenants, ["tenant_id"])


def environment_settings(platform: Platform, environments: DataFrame) -> DataFrame:
    """Settings in force for every ``(tenant_id, environment_id)`` of ``environments``."""
    scope = ["tenant_id", "environment_id"]
    return _overlay(platform.environment_settings, platform.tenant_environment_settings, environments, scope).drop("tenant_theme")


def environment_switch(platform: Platform, environments: DataFrame, setting_id: str) -> DataFrame:
    """One setting as a flag per environment; an environment without the setting is off."""
    default = platform.environment_settings.where(F.col("setting_id") == setting_id).select(F.col("is_active").alias("_default"))
    own = platform.tenant_environment_settings.where(F.col("setting_id") == setting_id).select(
        "tenant_id", "environment_id", F.col("is_active").alias("_own")
    )
    shared = default.agg(F.max("_default")).scalar()
    return environments.select("tenant_id", "environment_id").distinct().join(own, ["tenant_id", "environment_id"], "left").select(
        "tenant_id", "environment_id",
        (shared.isNotNull() & F.coalesce("_own", shared)).alias("is_on"),
    )


def convert_filter(spark: SparkSession, csv: str | None, kind: str) -> DataFrame:
    """Rows ``(original, converted, kind)`` of a comma-separated filter.

    Kinds with a dictionary are translated (unknown codes become "Desconhecido"); others pass through.
    """
    values = [] if not csv else csv.split(",")
    rows = spark.createDataFrame([(v, kind) for v in values], "original string, kind string")
    if kind in codes.DICTIONARIES:
        converted = codes.label_of(F.col("original"), codes.DICTIONARIES[kind], codes.UNKNOWN)
    else:
        converted = F.col("original")
    return rows.select("original", converted.alias("converted"), "kind")
