"""Every rung of every ladder, and the order of neighbouring rungs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lumenpath.functions.exprs import instant
from lumenpath.operators import status

NOW = "2020-06-01 00:00:00"
PAST, FUTURE = "2020-01-01 00:00:00", "2020-12-01 00:00:00"


def evaluate(spark, ladder, cases, columns):
    ddl = "id int, " + ", ".join(f"{n} {t if t != 'ts' else 'string'}" for n, t in columns.items())
    frame = spark.createDataFrame([(i, *[case.get(n) for n in columns]) for i, (case, _) in enumerate(cases)], ddl)
    for name, kind in columns.items():
        if kind == "ts":
            frame = frame.withColumn(name, F.col(name).cast("timestamp_ntz"))
    got = {r.id: r.s for r in frame.select("id", ladder.alias("s")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_activity_status(spark):
    columns = dict(
        exempted_at="ts", answer_registered_at="ts", answered_at="ts", is_reviewed="boolean", requires_review="boolean", first_access_at="ts",
        starts_at="ts", ends_at="ts", attempt_id="bigint", attempt_status="string",
    )
    live = dict(starts_at=PAST, ends_at=FUTURE)
    cases = [
        (dict(exempted_at=PAST, ends_at=PAST), "exempted"),
        (dict(ends_at=PAST, first_access_at=PAST), "expired"),
        (dict(ends_at=PAST, answer_registered_at=PAST, is_reviewed=False, requires_review=True), "awaiting_approval"),
        (dict(**live, answer_registered_at=PAST, answered_at=PAST, is_reviewed=False, requires_review=False), "not_started"),
        (dict(**live, answer_registered_at=PAST, answered_at=PAST, is_reviewed=False, attempt_id=1), "finished"),
        (dict(**live, first_access_at=PAST, attempt_id=1), "in_progress"),
        (dict(**live), "not_started"),
        (dict(starts_at=FUTURE, ends_at=FUTURE), "not_released"),
        (dict(**live, attempt_id=1, attempt_status="reprovado"), "finished"),
        (dict(**live, attempt_id=1, attempt_status="realizado_fora_prazo"), "not_started"),
        (dict(), "not_started"),
    ]
    evaluate(spark, status.activity_status(instant(NOW)), cases, columns)


WINDOW_COLUMNS = dict(exempted_at="ts", exempt_starts_at="ts", starts_at="ts", ends_at="ts")


def test_module_window(spark):
    cases = [
        (dict(exempted_at=PAST, exempt_starts_at=FUTURE, starts_at=PAST, ends_at=FUTURE), "not_current"),
        (dict(exempted_at=PAST, starts_at=PAST, ends_at=FUTURE), "null"),
        (dict(exempted_at=PAST, exempt_starts_at=PAST, starts_at=PAST, ends_at=FUTURE), "current"),
        (dict(exempted_at=PAST, exempt_starts_at=PAST, starts_at=PAST, ends_at=PAST), "not_done"),
        (dict(starts_at=NOW, ends_at=NOW), "current"),
        (dict(starts_at=FUTURE, ends_at=FUTURE), "not_current"),
        (dict(starts_at=PAST, ends_at=PAST), "not_done"),
    ]
    evaluate(spark, status.module_window(instant(NOW)), cases, WINDOW_COLUMNS)


MODULE_COLUMNS = {"window": "string", "attempt_id": "bigint", "attempt_status": "string", **WINDOW_COLUMNS}


def test_module_status_rows(spark):
    cases = [
        (dict(window="null", attempt_status="aprovado"), "exempted"),
        (dict(window="not_done", attempt_status="aguardando_correcao"), "awaiting_approval"),
        (dict(window="not_done", attempt_status="aprovado"), "approved"),
        (dict(window="current", attempt_status="reprovado"), "reproved"),
        (dict(window="current", attempt_status="realizado_fora_prazo"), "out_of_date"),
        (dict(window="current", attempt_status="concluido"), "finished"),
        (dict(window="current"), "not_started"),
        (dict(window="current", attempt_id=1, attempt_status="nao_iniciado"), "in_progress"),
        (dict(window="not_current", starts_at=FUTURE), "not_released"),
        (dict(window="not_current", exempt_starts_at=PAST, starts_at=FUTURE), "not_started"),
        (dict(window="not_current", attempt_id=1, attempt_status="em_andamento", starts_at=FUTURE), "in_progress"),
        (dict(window="not_current", attempt_id=1, attempt_status="nao_iniciado", starts_at=FUTURE), "not_started"),
        (dict(window="not_done", attempt_status="em_andamento"), "expired"),
    ]
    evaluate(spark, status.module_status(instant(NOW)), cases, MODULE_COLUMNS)


def test_module_status_columns(spark):
    cases = [
        (dict(window="null", attempt_status="aprovado"), "exempted"),
        (dict(window="not_done", attempt_status="aguardando_correcao"), "awaiting_approval"),
        (dict(window="not_done", attempt_status="realizado_fora_prazo"), "finished"),
        (dict(window="current", attempt_status="nao_iniciado"), "not_started"),
        (dict(window="current", attempt_status="em_andamento"), "in_progress"),
        (dict(window="not_current", starts_at=FUTURE), "not_started"),
        (dict(window="not_current", attempt_status="em_andamento"), "in_progress"),
        (dict(window="not_done"), "not_done"),
    ]
    evaluate(spark, status.module_column_status(), cases, MODULE_COLUMNS)


def test_environment_status_from_modules(spark):
    columns = dict(module_rows="int", exempt_rows="int", finished_tracks="int", started_tracks="int", total_tracks="int", last_start="ts", last_end="ts")
    base = dict(module_rows=4, exempt_rows=0, finished_tracks=0, started_tracks=0, total_tracks=2, last_start=PAST, last_end=FUTURE)
    cases = [
        ({**base, "exempt_rows": 4, "finished_tracks": 2}, "exempted"), ({**base, "finished_tracks": 2, "last_end": PAST}, "finished"),
        ({**base, "last_end": PAST, "started_tracks": 1}, "expired"), ({**base, "started_tracks": 1, "last_start": FUTURE}, "in_progress"),
        ({**base, "last_start": FUTURE}, "not_released"), (base, "not_started"),
    ]
    evaluate(spark, status.environment_status_from_modules(instant(NOW)), cases, columns)


COUNTERS = ("total", "exempt", "approved", "failed", "awaiting", "in_progress", "expired", "late", "not_released", "not_started")


def counters(**values):
    return {f"{name}_modules": values.pop(name, 0) for name in COUNTERS} | values


def test_track_status(spark):
    columns = {f"{n}_modules": "int" for n in COUNTERS} | dict(
        role_id="int", recertification_id="int", for_mandatory="boolean", for_participant="boolean", expires_at="ts"
    )
    done = counters(total=3, approved=2, failed=1)
    cert = dict(recertification_id=1, for_mandatory=True, for_participant=False)
    cases = [
        (counters(total=2, exempt=2, approved=2), "exempted"), (done, "finished"),
        ({**done, **cert, "role_id": 1, "expires_at": NOW}, "valid_certification"), ({**done, **cert, "role_id": 2, "expires_at": FUTURE}, "finished"),
        ({**done, **cert, "role_id": 1, "expires_at": PAST}, "invalid_certification"), (counters(total=3, exempt=1, approved=2), "finished"),
        (counters(total=3, expired=1, late=1), "expired"), (counters(total=3, expired=1, in_progress=1), "in_progress"),
        (counters(total=3, exempt=1, not_released=2), "not_released"), (counters(total=3, not_released=1, not_started=2), "not_started"),
        (counters(total=3, awaiting=1, approved=1), "in_progress"), (counters(total=3, not_released=1, approved=1), "not_started"),
    ]
    evaluate(spark, status.track_status(instant(NOW)), cases, columns)


def test_environment_status(spark):
    columns = {f"{n}_modules": "int" for n in COUNTERS} | dict(available_modules="int", is_exempt="boolean", not_released_tracks="int", total_tracks="int")

    def env(**values):
        base = counters(**{k: values.pop(k) for k in list(values) if k in COUNTERS})
        return {**base, "available_modules": base["total_modules"] - base["exempt_modules"], "is_exempt": False, "not_released_tracks": 0, "total_tracks": 2, **values}

    nothing = dict(is_exempt=False, not_released_tracks=0, total_tracks=2)
    cases = [
        (env(total=2, exempt=2), "exempted"), (env(total=3, approved=3, is_exempt=True), "exempted"), (env(total=3, approved=2, failed=1), "finished"),
        (env(total=3, late=1, approved=1), "expired"), (env(total=3, not_released=3), "not_released"),
        (env(total=3, not_started=1, approved=1, not_released_tracks=2), "not_released"), (env(total=3, not_started=2), "not_started"),
        (env(total=3, not_started=1, approved=1), "in_progress"), (nothing, "not_started"), ({**nothing, "not_released_tracks": 2}, "not_released"),
        ({**nothing, "is_exempt": True}, "exempted"),
    ]
    evaluate(spark, status.environment_status(), cases, columns)


@pytest.mark.parametrize("moment", [NOW, datetime(2020, 6, 1)])
def test_as_of_is_explicit(spark, moment):
    assert spark.range(1).select(instant(moment).alias("t")).first().t == datetime(2020, 6, 1)
