"""How a link between a user and an entity came about, and by whom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions.exprs import spread_key, to_id
from lumenpath.operators.sizes import BROADCAST_BYTES, measured_bytes
from lumenpath.sources import Platform
from lumenpath.sources.staging import Stage

# Origin of a link.
MANUAL, AUDIENCE, API, IMPORT = 1, 2, 3, 4

#: Parts into which the links of one creator are dealt when the names are too many for a broadcast.
SPREAD = 16
LOOKED_UP = ["_origin", "_key", "tenant_id"]


def _keys(links: DataFrame, origin: str, creator: str) -> DataFrame:
    named = F.col(origin).cast("bigint")
    return links.withColumn("_origin", named).withColumn("_key", F.when(named.isin(MANUAL, AUDIENCE, IMPORT), to_id(F.col(creator))))


def creator_names(platform: Platform, links: DataFrame, origin: str, creator: str) -> DataFrame:
    """``_name`` for each distinct (``_origin``, ``_key``, ``tenant_id``) among the links that has one.

    The distinct keys come first: a map-side aggregation of narrow rows.  Only they meet the users, audiences and imports.
    """
    stage = Stage(platform.users.sparkSession, "provenance")
    admins = platform.imports.select("import_id", "admin_id", "tenant_id").withColumnsRenamed({"import_id": "_key", "admin_id": "_importer"})
    asked = _keys(links, origin, creator).where("_key is not null").select(*LOOKED_UP).distinct()
    asked = asked.join(admins.withColumn("_origin", F.lit(IMPORT).cast("bigint")), LOOKED_UP, "left")
    person = F.when(F.col("_origin") == MANUAL, F.col("_key")).when(F.col("_origin") == IMPORT, F.col("_importer"))
    asked = stage.keep("creators", lambda: asked.select(*LOOKED_UP, person.alias("_person")))
    users = platform.users.select(F.col("user_id").alias("_person"), "tenant_id", F.col("full_name").alias("_name"))
    audiences = platform.audiences.select(F.col("audience_id").alias("_key"), "tenant_id", F.col("name").alias("_name"))
    people = asked.where("_person is not null").join(users, ["_person", "tenant_id"]).select(*LOOKED_UP, "_name")
    chosen = asked.where(F.col("_origin") == AUDIENCE).join(audiences, ["_key", "tenant_id"]).select(*LOOKED_UP, "_name")
    return stage.keep("names", lambda: people.unionByName(chosen))


def with_provenance(platform: Platform, links: DataFrame, origin: str, creator: str, source: DataFrame | None = None) -> DataFrame:
    """``links`` plus ``linked_by``: the name behind ``creator``, looked up according to ``origin``.

    The creator is a key held as text.  Only rows of the matching origin take part in a lookup, and rows without a match fall back
    to the raw creator.  ``links`` carries ``user_id`` and ``tenant_id``.  ``source`` is a cheaper frame that has all
    their origins and creators, and maybe more (the stored links behind a report's rows).

    The links stay where they are when the names fit a broadcast.  Otherwise a creator's links, which may be a third of all, are
    dealt to ``SPREAD`` tasks, each of which gets a copy of the name; rows that are not looked up get keys that match nothing.
    """
    names = creator_names(platform, links if source is None else source, origin, creator)
    keyed = _keys(links, origin, creator)
    if measured_bytes(names) <= BROADCAST_BYTES:
        named = keyed.join(F.broadcast(names), LOOKED_UP, "left")
    else:
        parts = F.array(*[F.lit(k) for k in range(SPREAD)])
        keyed = keyed.withColumn("_key", spread_key(F.col("_key"), F.col("user_id"), F.col("tenant_id")))
        keyed = keyed.withColumn("_part", F.pmod(F.xxhash64("user_id"), F.lit(SPREAD)).cast("int"))
        named = keyed.join(names.withColumn("_part", F.explode(parts)), [*LOOKED_UP, "_part"], "left").drop("_part")
    linked_by = F.when(F.col("_origin").isin(MANUAL, AUDIENCE, IMPORT), F.coalesce("_name", creator)).when(
        F.col("_origin") == API, F.col(creator)
    )
    return named.withColumn("linked_by", linked_by).drop("_origin", "_key", "_name")
