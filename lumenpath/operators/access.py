"""Which entities an administrator may see, and the groups a user belongs to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.exprs import join_sorted
from lumenpath.functions.predicates import keep_listed
from lumenpath.operators.latest import first_per_key
from lumenpath.operators.sizes import BROADCAST_BYTES, measured_bytes
from lumenpath.sources import Platform

# How far an admin profile reaches, strongest first.
ANY_GROUP, TOP_DOWN, SPECIFIC = "any_group", "group_structure_top_down", "specific_groups"


def admin_frame(spark: SparkSession, admin_id: int, tenant_id: str) -> DataFrame:
    return spark.createDataFrame([(admin_id, tenant_id)], "admin_id bigint, tenant_id string")


def admin_profile(platform: Platform, admins: DataFrame) -> DataFrame:
    """Strongest active profile of every admin, and whether any of the admin's profiles shows ungrouped entities."""
    held = admins.select("admin_id", "tenant_id").distinct().join(
        platform.profile_users.select("profile_id", F.col("user_id").alias("admin_id"), "tenant_id"),
        ["admin_id", "tenant_id"],
    ).join(platform.admin_profiles.select("profile_id", "tenant_id", "access_kind", "sees_ungrouped", "is_active"), ["profile_id", "tenant_id"])
    ungrouped = held.groupBy("admin_id", "tenant_id").agg(F.max("sees_ungrouped").alias("sees_ungrouped"))
    kind = F.col("access_kind")
    strength = F.when(kind == ANY_GROUP, 1).when(kind == TOP_DOWN, 2).when(kind == SPECIFIC, 3).otherwise(4)
    strongest = first_per_key(held.where("is_active").drop("sees_ungrouped"), ["admin_id", "tenant_id"], [strength, F.col("profile_id")])
    profile = strongest.join(ungrouped, ["admin_id", "tenant_id"]).select(
        "admin_id", "tenant_id", "profile_id", "access_kind", "sees_ungrouped"
    )
    # One row per admin at most, so the size of the request bounds it.  The branches join it on the tenant
    # alone; a shuffle there would send each tenant to a single task.
    return F.broadcast(profile) if measured_bytes(admins) <= BROADCAST_BYTES // 16 else profile


def _reachable_groups(platform: Platform, profiles: DataFrame) -> DataFrame:
    """``(admin_id, tenant_id, group_id)`` for the two profile kinds that name groups."""
    who = ["admin_id", "tenant_id"]
    own = platform.entity_groups.where(F.trim("entity_type") == codes.USER).select(
        F.col("entity_id").alias("admin_id"), "tenant_id", F.col("group_id").alias("root_id")
    )
    below = (
        profiles.where(F.col("access_kind") == TOP_DOWN).select(*who)
        .join(own, who)
        .join(platform.group_tree.select("root_id", "group_id", "tenant_id"), ["root_id", "tenant_id"])
    )
    # Every active profile counts here, not just the strongest one.
    named = (
        profiles.where(F.col("access_kind") == SPECIFIC).select(*who)
        .join(platform.profile_users.select(F.col("user_id").alias("admin_id"), "tenant_id", "profile_id"), who)
        .join(platform.admin_profiles.where("is_active").select("profile_id", "tenant_id"), ["profile_id", "tenant_id"])
        .join(platform.profile_groups.select("profile_id", "group_id", "tenant_id"), ["profile_id", "tenant_id"])
    )
    return below.select(*who, "group_id").unionByName(named.select(*who, "group_id", F.lit(True).alias("is_named")), allowMissingColumns=True).distinct()


def _played_environments(platform: Platform, admins: DataFrame) -> DataFrame:
    """Environments in which an admin holds a role on an active module of some track."""
    modules = platform.modules.where("is_active").select(F.col("module_id").alias("entity_id"), "track_id", "tenant_id")
    held = _module_roles(platform).select(F.col("user_id").alias("admin_id"), "entity_id", "tenant_id")
    return (
        admins.select("admin_id", "tenant_id")
        .join(held, ["admin_id", "tenant_id"])
        .join(modules, ["entity_id", "tenant_id"])
        .join(platform.environment_tracks.select("environment_id", "track_id", "tenant_id"), ["track_id", "tenant_id"])
        .select("admin_id", "tenant_id", F.col("environment_id").alias("entity_id"))
        .distinct()
    )


def _module_roles(platform: Platform) -> DataFrame:
    return platform.roles.where(
        (F.trim("entity_type") == codes.MODULE) & F.col("role_id").isin(*codes.PLAYING_ROLES)
    )


def _ungrouped(platform: Platform, entity_type: str) -> DataFrame | None:
    """``(entity_id, tenant_id)`` of entities outside every group; None when the type has no such rule."""
    active = platform.groups.where("is_active").select("group_id", "tenant_id")
    if entity_type == codes.USER:
        users = platform.users.where(~F.col("is_default")).select(F.col("user_id").alias("entity_id"), "tenant_id")
        return users.join(platform.group_members.select(F.col("user_id").alias("entity_id"), "tenant_id"), ["entity_id", "tenant_id"], "left_anti")
    if entity_type == codes.ENVIRONMENT:
        grouped = platform.environment_groups.join(active, ["group_id", "tenant_id"], "left_semi")
        everything = platform.environments.select(F.col("environment_id").alias("entity_id"), "tenant_id")
        return everything.join(grouped.select(F.col("environment_id").alias("entity_id"), "tenant_id"), ["entity_id", "tenant_id"], "left_anti")
    sources = {codes.ACTIVITY: ("activities", "activity_id"), codes.ACHIEVEMENT: ("achievements", "achievement_id")}
    if entity_type not in sources:
        return None
    table, key = sources[entity_type]
    grouped = platform.entity_groups.where(F.trim("entity_type") == entity_type).join(active, ["group_id", "tenant_id"], "left_semi")
    return platform[table].select(F.col(key).alias("entity_id"), "tenant_id").join(
        grouped.select("entity_id", "tenant_id"), ["entity_id", "tenant_id"], "left_anti"
    )


def editable_entities(platform: Platform, admins: DataFrame, entity_type: str) -> DataFrame:
    """Entities of one type that each admin of ``admins(admin_id, tenant_id)`` may work with.

    Returns ``(admin_id, tenant_id, entity_id, entity_type, is_linked)``, one row per admin and entity;
    an entity reached through a group is linked, one shown for lack of groups is not.
    """
    profiles = admin_profile(platform, admins)
    active = platform.groups.where("is_active").select("group_id", "tenant_id")
    links = (
        platform.entity_groups.where(F.trim("entity_type") == entity_type)
        .select("entity_id", "group_id", "tenant_id")
        .join(active, ["group_id", "tenant_id"], "left_semi")
    )
    who = ["admin_id", "tenant_id"]
    everywhere = links.select("entity_id", "tenant_id").join(
        profiles.where(F.col("access_kind") == ANY_GROUP).select(*who), "tenant_id"
    ).select(*who, "entity_id")
    reach = links.join(_reachable_groups(platform, profiles), ["group_id", "tenant_id"])
    if entity_type == codes.ENVIRONMENT:
        below = reach.where(F.col("is_named").isNull()).select(*who, "entity_id")
        named = reach.where("is_named").select(*who, "entity_id").join(
            _played_environments(platform, profiles), [*who, "entity_id"], "left_semi"
        )
        reach = below.unionByName(named)
    linked = everywhere.unionByName(reach.select(*who, "entity_id")).withColumn("is_linked", F.lit(True))

    outside = _ungrouped(platform, entity_type)
    if outside is not None:
        shown = outside.join(profiles.where("sees_ungrouped").select(*who), "tenant_id")
        linked = linked.unionByName(shown.select(*who, "entity_id", F.lit(False).alias("is_linked")))
    # Aggregated, not ranked: partial aggregation folds duplicates before the shuffle.
    return linked.groupBy(*who, "entity_id").agg(F.max("is_linked").alias("is_linked")).select(
        *who, "entity_id", F.lit(entity_type).alias("entity_type"), "is_linked"
    )


def visible_to(platform: Platform, admins: DataFrame, entity_type: str, key: str) -> DataFrame:
    """``(key, tenant_id)`` of the editable entities, for semi-joins."""
    return editable_entities(platform, admins, entity_type).select(F.col("entity_id").alias(key), "tenant_id")


def _placed_members(platform: Platform, users: DataFrame | None = None, group_ids: Iterable[int] = ()) -> DataFrame:
    """Memberships in active groups with what the groups are listed by: hops, depth, parent and id."""
    place = platform.group_tree.groupBy("group_id", "tenant_id").agg(
        F.min("hops").alias("hops"), F.count("*").alias("depth")
    )
    groups = platform.groups.where("is_active").select("group_id", "tenant_id", "name", "parent_group_id")
    placed = groups.join(place, ["group_id", "tenant_id"], "left").withColumn("depth", F.coalesce("depth", F.lit(0).cast("bigint")))
    members = keep_listed(platform.group_members.select("user_id", "group_id", "tenant_id"), "group_id", group_ids).distinct()
    if users is not None:
        members = members.join(users.select("user_id", "tenant_id"), ["user_id", "tenant_id"], "left_semi")
    return members.join(placed, ["group_id", "tenant_id"])


def group_places(platform: Platform) -> DataFrame:
    """``(user_id, tenant_id, places)``: a user's active groups as an array in the order of ``all_groups``."""
    places = F.array_sort(F.collect_list(F.struct("hops", "depth", "parent_group_id", "group_id", "name")))
    return _placed_members(platform).groupBy("user_id", "tenant_id").agg(places.alias("places"))


def all_groups(platform: Platform, users: DataFrame | None = None, group_ids: Iterable[int] = ()) -> DataFrame:
    """Names of a user's active groups in one text, nearest to the root first.

    The order is hops, then depth, then parent, then group id.  ``group_ids`` keeps only memberships
    in those groups, so users in none of them have no row.  Hops and depth belong to the group, so
    they are worked out once per group and not once per member.
    """
    names = join_sorted(["hops", "depth", "parent_group_id", "group_id"], "name").alias("all_groups")
    return _placed_members(platform, users, group_ids).groupBy("user_id", "tenant_id").agg(names)
