"""The platform's table functions, callable from SQL.

``register`` defines temporary functions over the operators' frames; each takes ids as arguments and returns rows, so they can stand
in a ``FROM`` clause or beside another table with ``LATERAL``:

    SELECT u.user_id, g.all_groups FROM users u, LATERAL all_groups_of(u.user_id, u.tenant_id, NULL) g

Nothing is worked out until a function is used.  With literal arguments their predicates reach the scans; beside a table Spark turns
the call into a join on the arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.operators import access, attributes, labels
from lumenpath.sources import Platform

ENTITY_TYPES = (codes.USER, codes.ENVIRONMENT, codes.ACTIVITY, codes.ACHIEVEMENT)


def _define(spark: SparkSession, name: str, arguments: str, frame: DataFrame, body: str, columns: str | None = None) -> None:
    """A function over the rows of ``frame``; ``body`` names them ``{rows}``.  Columns are those of the frame unless given."""
    view = f"rows_of_{name}"
    frame.createOrReplaceTempView(view)
    columns = columns or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body.format(rows=view)}")


def _all_editable(platform: Platform) -> DataFrame:
    admins = platform.profile_users.select(F.col("user_id").alias("admin_id"), "tenant_id").distinct()
    frames = [access.editable_entities(platform, admins, kind) for kind in ENTITY_TYPES]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def register(platform: Platform) -> list[str]:
    """Defines the functions in the platform's session and returns their names.

    * ``user_attributes_of(tenant)``: latest attribute values of all users
    * ``settings_of(tenant)`` and ``environment_settings_of(tenant, environment)``: settings in force
    * ``editable_entities_of(admin, tenant, entity_type)``: what an administrator may work with
    * ``label_text_of(label, tenant, language)``: best text of a label
    * ``all_groups_of(member, tenant, groups)``: a user's groups in one text; only those in the array ``groups``, if it is not null
    """
    spark = platform.users.sparkSession
    _define(spark, "user_attributes_of", "tenant STRING", attributes.user_attributes(platform), "SELECT * FROM {rows} WHERE tenant_id = tenant")
    tenants = platform.users.select("tenant_id")
    _define(spark, "settings_of", "tenant STRING", labels.settings(platform, tenants), "SELECT * FROM {rows} WHERE tenant_id = tenant")
    _define(
        spark, "environment_settings_of", "tenant STRING, environment BIGINT", labels.environment_settings(platform, platform.environments),
        "SELECT * FROM {rows} WHERE tenant_id = tenant AND environment_id = environment",
    )
    _define(
        spark, "editable_entities_of", "admin BIGINT, tenant STRING, kind STRING", _all_editable(platform),
        "SELECT * FROM {rows} WHERE admin_id = admin AND tenant_id = tenant AND entity_type = kind",
    )
    fit = "CASE WHEN lower(t.language_id) = lower(language) THEN 1 WHEN startswith(lower(t.language_id), lower(language)) THEN 2 ELSE 4 END"
    best = f"array_min(transform(texts, t -> struct({fit} AS fit, t.language_id AS language_id, t.text AS text)))"
    _define(
        spark, "label_text_of", "label BIGINT, tenant STRING, language STRING", labels.label_languages(platform, tenants),
        "SELECT label_id, tenant_id, key, best.language_id, best.text, is_default FROM "
        f"(SELECT *, {best} AS best FROM {{rows}} WHERE label_id = label AND tenant_id = tenant)",
        "label_id BIGINT, tenant_id STRING, key STRING, language_id STRING, text STRING, is_default BOOLEAN",
    )
    kept = "filter(places, p -> groups IS NULL OR array_contains(groups, p.group_id))"
    _define(
        spark, "all_groups_of", "member BIGINT, tenant STRING, groups ARRAY<BIGINT>", access.group_places(platform),
        f"SELECT user_id, tenant_id, array_join(transform(kept, p -> p.name), ', ') AS all_groups FROM "
        f"(SELECT *, {kept} AS kept FROM {{rows}} WHERE user_id = member AND tenant_id = tenant) WHERE size(kept) > 0",
        "user_id BIGINT, tenant_id STRING, all_groups STRING",
    )
    return ["user_attributes_of", "settings_of", "environment_settings_of", "editable_entities_of", "label_text_of", "all_groups_of"]
