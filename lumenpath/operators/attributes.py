"""Custom user attributes: latest value per attribute, and attributes as columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import day, without_prefix
from lumenpath.operators.labels import label_text
from lumenpath.operators.latest import first_per_key
from lumenpath.operators.sizes import dealt
from lumenpath.sources import Platform

# Attribute types by how the value is stored, and the language of select options.
TEXT_TYPES = ("TEXT", "PHONE", "INTEGER", "DECIMAL")
OPTION_TYPES = ("SELECT", "MULTIPLE")
OPTION_LANGUAGE = "pt-BR"


def user_attributes(platform: Platform, users: DataFrame | None = None) -> DataFrame:
    """``(user_id, tenant_id, attribute_id, attribute, value, value_id)``: the newest row per user and active attribute.

    The newest row is picked on the narrow fact before any lookup is joined.
    """
    keys = ["attribute_id", "tenant_id", "entity_id"]
    facts = platform.entity_attributes.where(F.trim("entity_type") == codes.USER).select(
        *keys, "entity_attribute_id", "value_id", "text_value", "date_value", "time_value"
    )
    if users is not None:
        facts = facts.join(users.select(F.col("user_id").alias("entity_id"), "tenant_id"), ["entity_id", "tenant_id"], "left_semi")
    newest = first_per_key(facts, keys, [F.col("entity_attribute_id").desc()])

    types = platform.attribute_types.select("type_id", F.col("name").alias("_type"))
    names = (
        platform.attributes.where("is_active").select("attribute_id", "tenant_id", "name", "type_id")
        .join(platform.attribute_items.select("attribute_id", "tenant_id"), ["attribute_id", "tenant_id"], "left_semi")
        .join(types, "type_id")
    )
    values = platform.attribute_values.select("value_id", "tenant_id", "label_id")
    options = values.join(
        label_text(platform, values, OPTION_LANGUAGE).select("label_id", "tenant_id", F.col("text").alias("_option")),
        ["label_id", "tenant_id"],
    ).drop("label_id")
    kind = F.col("_type")
    value = (
        F.when(kind.isin(*TEXT_TYPES), F.trim("text_value"))
        .when(kind.isin(*OPTION_TYPES), F.trim("_option"))
        .when(kind == "DATE", day(F.col("date_value")))
        .when(kind == "TIME", F.col("time_value"))
    )
    known = platform.users.select(F.col("user_id").alias("entity_id"), "tenant_id")
    return (
        newest.join(names, ["attribute_id", "tenant_id"])
        .join(known, ["entity_id", "tenant_id"], "left_semi")
        .join(options, ["value_id", "tenant_id"], "left")
        .select(
            F.col("entity_id").alias("user_id"), "tenant_id", "attribute_id",
            without_prefix(F.col("name"), F.col("tenant_id")).alias("attribute"), value.alias("value"), "value_id",
        )
    )


#: Attribute columns of one report.  Spark plans one expression for each; a wider report has to be narrowed by tenant.
MOST_COLUMNS = 2_000


class TooManyColumns(ValueError):
    """The tenants of a report have more attributes than it can have columns."""


def tenant_attribute_names(platform: Platform) -> DataFrame:
    """``(tenant_id, attribute, first_id)``: each tenant's active attributes without tenant prefix, with the least id of that name."""
    return (
        platform.attributes.where("is_active")
        .select("attribute_id", "tenant_id", without_prefix(F.col("name"), F.col("tenant_id")).alias("attribute"))
        .groupBy("tenant_id", "attribute").agg(F.min("attribute_id").alias("first_id"))
    )


def attribute_names(platform: Platform, tenants: DataFrame | None = None) -> list[str]:
    """Names of the attributes of ``tenants`` (``tenant_id``; all of the platform unless given), by attribute id.

    Column headers have to be known while the plan is built, so the names are read on the driver: one short row for each column,
    and an error beyond ``MOST_COLUMNS``, whatever number of tenants there are.
    """
    names = tenant_attribute_names(platform)
    if tenants is not None:
        names = names.join(tenants.select("tenant_id").distinct(), "tenant_id", "left_semi")
    rows = names.groupBy("attribute").agg(F.min("first_id").alias("first_id")).orderBy("first_id", "attribute").limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise TooManyColumns(f"the report's tenants have more than {MOST_COLUMNS} attributes; narrow it by tenant")
    return [row.attribute for row in rows]


def unique_headers(names: Sequence[str], taken: Iterable[str] = ()) -> list[str]:
    """Headers that differ from each other and from ``taken`` even when case is ignored."""
    used = {name.casefold() for name in taken}
    headers = []
    for name in names:
        header, n = name, 1
        while header.casefold() in used:
            n += 1
            header = f"{name} ({n})"
        used.add(header.casefold())
        headers.append(header)
    return headers


def pivot_attributes(attributes: DataFrame, names: Sequence[str], headers: Sequence[str] | None = None) -> DataFrame:
    """One row per user with a column per attribute name.

    The pivot runs on ``(user, tenant, attribute, value)`` alone, before the report is joined, so
    wide report rows are never grouped.  Given names spare Spark the job that would look for them.
    """
    # Dealt by user at once: both steps of the pivot and the join to the report find the rows there.
    narrow = dealt(attributes.select("user_id", "tenant_id", "attribute", "value"), ["user_id", "tenant_id"])
    wide = narrow.groupBy("user_id", "tenant_id").pivot("attribute", list(names)).agg(F.max("value"))
    return wide.toDF("user_id", "tenant_id", *(headers or names))


def with_attribute_columns(platform: Platform, report: DataFrame, tenants: DataFrame | None = None) -> DataFrame:
    """Report rows (keyed by user and tenant) with the attributes of the report's tenants appended as columns.

    ``tenants`` are those the report is made for, such as its administrators'; other tenants' attributes get no column.
    """
    names = attribute_names(platform, tenants)
    if not names:
        return report
    headers = unique_headers(names, report.columns)
    values = user_attributes(platform)
    if tenants is not None:
        values = values.join(F.broadcast(tenants.select("tenant_id").distinct()), "tenant_id", "left_semi")
    wide = pivot_attributes(values, names, headers)
    return report.join(wide, ["user_id", "tenant_id"], "left")
