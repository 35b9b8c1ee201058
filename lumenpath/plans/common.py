"""Pieces shared by the report plans."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumenpath.functions import codes
from lumenpath.operators.access import admin_frame, visible_to
from lumenpath.operators.sizes import broadcast_if_small
from lumenpath.params import ReportParams
from lumenpath.sources import Platform


def admins_for(platform: Platform, params: ReportParams, admins: DataFrame | None) -> DataFrame:
    """The administrators a report is made for, one per tenant."""
    if admins is not None:
        return admins
    if params.admin_id is None or params.tenant_id is None:
        raise ValueError("a report needs admin_id and tenant_id, or a frame of admins")
    return admin_frame(platform.users.sparkSession, params.admin_id, params.tenant_id)


def visible_users(platform: Platform, admins: DataFrame) -> DataFrame:
    return visible_to(platform, admins, codes.USER, "user_id")


def visible_environments(platform: Platform, admins: DataFrame) -> DataFrame:
    """Environments are few: with a measured size the rows of a report are tested against them without a shuffle."""
    return broadcast_if_small(visible_to(platform, admins, codes.ENVIRONMENT, "environment_id"))
