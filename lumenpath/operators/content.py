"""The content catalogue and who takes part in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.functions import codes
from lumenpath.functions.predicates import is_real_user, keep_all_listed, keep_listed, unless, where_all, with_flag
from lumenpath.params import ReportParams
from lumenpath.sources import Platform


def module_hierarchy(platform: Platform, params: ReportParams | None = None, visible_only: bool = False) -> DataFrame:
    """Module within track within environment, one row per (tenant, environment, module)."""
    p = params
    modules = where_all(
        keep_listed(platform.modules, "module_id", p and p.module_ids),
        unless(p is None or p.show_inactive_modules, F.col("is_active")),
        F.col("is_visible") if visible_only else None,
    ).select("module_id", "track_id", "tenant_id", F.col("name").alias("module_name"), F.col("is_active").alias("module_active"))
    tracks = where_all(
        keep_listed(platform.tracks, "track_id", p and p.track_ids),
        unless(p is None or p.show_inactive_tracks, F.col("is_active")),
    ).select("track_id", "tenant_id", F.col("name").alias("track_name"), F.col("is_active").alias("track_active"))
    environments = where_all(
        keep_listed(platform.environments, "environment_id", p and p.environment_ids),
        unless(p is None or p.show_inactive_environments, F.col("is_available")),
    ).select(
        "environment_id", "tenant_id", F.col("name").alias("environment_name"),
        F.col("is_available").alias("environment_active"),
    )
    placed = platform.environment_tracks.select("environment_id", "track_id", "tenant_id")
    return (
        modules.join(tracks, ["track_id", "tenant_id"])
        .join(placed, ["track_id", "tenant_id"])
        .join(environments, ["environment_id", "tenant_id"])
    )


def hierarchy(platform: Platform, params: ReportParams | None = None) -> DataFrame:
    """Activity within module within track within environment; without params nothing is filtered.

    Every join carries the tenant, and the grain is one row per (tenant, environment, module, activity).
    """
    p = params
    activities = where_all(
        keep_all_listed(platform.activities, {"activity_id": p and p.activity_ids, "type_id": p and p.activity_types}),
        unless(p is None or p.show_inactive_activities, F.col("is_active")),
    ).select(
        "activity_id", "tenant_id", F.col("type_id").alias("activity_type_id"), F.col("title").alias("activity_name"),
        "statement", F.col("workload_minutes").alias("activity_workload"), F.col("is_active").alias("activity_active"),
    )
    placed = platform.module_activities.select("module_id", "activity_id", "tenant_id", F.col("weight").alias("default_weight"))
    return (
        activities.join(placed, ["activity_id", "tenant_id"])
        .join(module_hierarchy(platform, p), ["module_id", "tenant_id"])
    )


def module_roles(platform: Platform, role_ids: tuple[int, ...] = codes.PLAYING_ROLES) -> DataFrame:
    """Roles of users on modules: ``(user_id, tenant_id, module_id, role_id, ...)``."""
    held = platform.roles.where(
        (F.trim("entity_type") == codes.MODULE) & F.col("role_id").isin(*(role_ids or codes.PLAYING_ROLES))
    )
    return held.withColumnRenamed("entity_id", "module_id").drop("entity_type")


def real_users(platform: Platform, params: ReportParams | None = None) -> DataFrame:
    """Users who are neither built-in nor deleted, narrowed by the id and status filters."""
    p = params
    users = keep_listed(platform.users, "user_id", p and p.user_ids)
    return where_all(users, is_real_user(), with_flag(F.col("is_active"), p and p.user_flags))


def user_plan(platform: Platform, content: DataFrame, role_ids: tuple[int, ...] = codes.PLAYING_ROLES) -> DataFrame:
    """Every activity of ``content`` for every real user with a role on its module."""
    users = real_users(platform).select("user_id", "tenant_id", "full_name", "is_active")
    roles = module_roles(platform, role_ids).select("user_id", "tenant_id", "module_id", "role_id")
    return (
        roles.join(users, ["user_id", "tenant_id"])
        .join(content, ["module_id", "tenant_id"])
        .withColumn("role_label", codes.role_label(F.col("role_id")))
    )
