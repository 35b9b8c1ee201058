"""Status ladders.  Each is an ordered CASE: the first rung that holds wins, and NULL falls through.

All ladders return canonical codes; labels are put on in the last projection of a report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenpath.functions import codes


def activity_status(now: Column) -> Column:
    """From ``exempted_at, answer_registered_at, answered_at, is_reviewed, requires_review, first_access_at,
    starts_at, ends_at, attempt_id, attempt_status``."""
    c = F.col
    return (
        F.when(c("exempted_at").isNotNull(), "exempted")
        .when(c("answer_registered_at").isNull() & (c("ends_at") < now), "expired")
        .when(~c("is_reviewed") & c("requires_review"), "awaiting_approval")
        .when(c("first_access_at").isNotNull() & c("answer_registered_at").isNull(), "in_progress")
        .when((c("starts_at") < now) & c("attempt_id").isNull(), "not_started")
        .when(c("starts_at") > now, "not_released")
        .when(
            c("answered_at").isNotNull() | c("attempt_status").isin(codes.APPROVED, codes.DONE, codes.FAILED), "finished"
        )
        .otherwise("not_started")
    )


def module_window(now: Column) -> Column:
    """``null`` (exempt), ``current``, ``not_current`` or ``not_done``, from ``exempted_at, exempt_starts_at,
    starts_at, ends_at``."""
    c = F.col
    exempt, start = c("exempted_at").isNotNull(), c("exempt_starts_at")
    return (
        F.when(exempt & start.isNotNull() & (now < start), "not_current")
        .when(exempt & (start.isNull() | (start > now)), "null")
        .when(now.between(c("starts_at"), c("ends_at")), "current")
        .when(now < F.coalesce(start, c("starts_at")), "not_current")
        .otherwise("not_done")
    )


def module_status(now: Column) -> Column:
    """Row dialect, from ``window, attempt_id, attempt_status`` and the dates of ``module_window``."""
    c = F.col
    window, state = c("window"), c("attempt_status")
    no_attempt = F.coalesce(state, F.lit("")) == ""
    closed = (
        F.when(state == codes.APPROVED, "approved").when(state == codes.FAILED, "reproved")
        .when(state == codes.LATE, "out_of_date").otherwise("finished")
    )
    ahead = (
        F.when(no_attempt & (now < F.coalesce(c("exempt_starts_at"), c("starts_at"))), "not_released")
        .when(state == codes.IN_PROGRESS, "in_progress").otherwise("not_started")
    )
    return (
        F.when(window == "null", "exempted")
        .when(state == codes.AWAITING_REVIEW, "awaiting_approval")
        .when(state.isin(*codes.CLOSED_STATES), closed)
        .when(window == "current", F.when(no_attempt, "not_started").otherwise("in_progress"))
        .when(window == "not_current", ahead)
        .when(window == "not_done", "expired")
    )


def module_column_status() -> Column:
    """Column dialect: no late rung, no release rung, an unopened attempt counts as not started."""
    window, state = F.col("window"), F.col("attempt_status")
    idle = (F.coalesce(state, F.lit("")) == "") | (state == codes.NOT_STARTED)
    return (
        F.when(window == "null", "exempted")
        .when(state == codes.AWAITING_REVIEW, "awaiting_approval")
        .when(
            state.isin(*codes.CLOSED_STATES),
            F.when(state == codes.APPROVED, "approved").when(state == codes.FAILED, "reproved").otherwise("finished"),
        )
        .when(window == "current", F.when(idle, "not_started").otherwise("in_progress"))
        .when(window == "not_current", F.when(state == codes.IN_PROGRESS, "in_progress").otherwise("not_started"))
        .when(window == "not_done", "not_done")
    )


def environment_status_from_modules(now: Column) -> Column:
    """From ``module_rows, exempt_rows, finished_tracks, started_tracks, total_tracks, last_start, last_end``."""
    c = F.col
    return (
        F.when(c("exempt_rows") == c("module_rows"), "exempted")
        .when((c("finished_tracks") == c("total_tracks")) & (c("total_tracks") > 0), "finished")
        .when((c("last_end") < now) & (c("finished_tracks") < c("total_tracks")), "expired")
        .when(c("started_tracks") > 0, "in_progress")
        .when(c("last_start") > now, "not_released")
        .otherwise("not_started")
    )


def _busy() -> Column:
    return F.col("in_progress_modules") + F.col("not_started_modules") + F.col("awaiting_modules")


def _touched() -> Column:
    names = ("approved", "failed", "awaiting", "in_progress", "expired", "late")
    return sum((F.col(f"{name}_modules") for name in names[1:]), F.col(f"{names[0]}_modules"))


def track_status(now: Column) -> Column:
    """From the counters of a track progress row plus ``role_id`` and the recertification columns
    ``recertification_id, for_mandatory, for_participant, expires_at``."""
    c = F.col
    open_modules = c("total_modules") - c("exempt_modules")
    applies = (c("for_mandatory") & (c("role_id") == codes.MANDATORY)) | (
        c("for_participant") & (c("role_id") == codes.PARTICIPANT)
    )
    certified = c("recertification_id").isNotNull()
    finished = (
        F.when(certified & applies & (now <= c("expires_at")), "valid_certification")
        .when(certified & (now > c("expires_at")), "invalid_certification")
        .otherwise("finished")
    )
    return (
        F.when(c("exempt_modules") >= c("total_modules"), "exempted")
        .when(c("approved_modules") + c("failed_modules") >= open_modules, finished)
        .when((c("expired_modules") + c("late_modules") > 0) & (_busy() == 0), "expired")
        .when((c("not_released_modules") > 0) & (c("not_released_modules") >= open_modules), "not_released")
        .when((c("not_started_modules") > 0) & (_touched() == 0), "not_started")
        .when(_busy() > 0, "in_progress")
        .otherwise("not_started")
    )


def environment_status() -> Column:
    """From summed counters plus ``is_exempt, available_modules, not_released_tracks, total_tracks``."""
    c = F.col
    return (
        F.when((c("exempt_modules") >= c("total_modules")) | c("is_exempt"), "exempted")
        .when(c("approved_modules") + c("failed_modules") >= c("available_modules"), "finished")
        .when((c("expired_modules") + c("late_modules") > 0) & (_busy() == 0), "expired")
        .when(
            ((c("not_released_modules") >= 0) & (c("not_released_modules") >= c("available_modules")))
            | (c("not_released_tracks") >= c("total_tracks")),
            "not_released",
        )
        .when((c("not_started_modules") > 0) & (_touched() == 0), "not_started")
        .when(_busy() > 0, "in_progress")
        .otherwise("not_started")
    )
