from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenpath.functions import codes, exprs, predicates
from lumenpath.operators.attributes import unique_headers
from lumenpath.operators.labels import convert_filter
from lumenpath.params import from_request, parse_flag, parse_ids, parse_instant


def test_offset_dates_are_moved_to_utc():
    assert parse_instant("2026-01-29T09:45:24.694-03:00") == datetime(2026, 1, 29, 12, 45, 24, 694000)
    assert parse_instant("2025-01-01T13:40:42.000Z") == datetime(2025, 1, 1, 13, 40, 42)
    assert parse_instant("2025-01-01") == datetime(2025, 1, 1)
    assert parse_instant("") is None
    with pytest.raises(ValueError):
        parse_instant("yesterday")


def test_request_with_padded_key_and_codes():
    params = from_request(
        {
            " profileTrackIds": "1, 2", "adminId": 7, "customerId": "t1", "activityCompletionStatus": "in_progress", "userStatus": "1",
            "firstAccessToActivityDateStartDate": "2026-01-29", "firstAccessToActivityDateEndDate": "2026-02-04", "showEmptyDates": "false",
        },
        as_of=datetime(2026, 2, 1),
    )
    assert params.role_ids == (1, 2) and params.admin_id == 7 and params.statuses == ("in_progress",)
    assert params.window("first_access") == (datetime(2026, 1, 29), datetime(2026, 2, 4))
    assert params.window("completion") is None and not params.show_empty_dates
    with pytest.raises(KeyError):
        from_request({"nope": "1"}, as_of=datetime(2026, 2, 1))


@given(st.lists(st.integers(min_value=0, max_value=10**9)))
def test_ids_survive_a_round_trip(ids):
    assert parse_ids(",".join(f" {i} " for i in ids) + ", ,") == tuple(ids)


def test_what_is_no_id_raises():
    for text in ("abc", "--5", "²", "1,x", "1;2", "1.0"):
        with pytest.raises(ValueError):
            parse_ids(text)
    assert parse_ids("-5, +6") == (-5, 6) and parse_ids(" ") == parse_ids(None) == ()


def test_requests_of_the_other_reports():
    now = datetime(2026, 2, 1)
    rows_ = from_request(
        {"adminId": "7", "clienteID": "t1", "startDate": "2026-01-01", "endDate": "2026-01-31", "roundLinkDateStartDate": "2026-01-02",
         "roundLinkDateEndDate": "2026-01-03", "exibirTodasTentativas": "1", "showInactiveRound": "true"}, now, "module_rows")
    assert rows_.window("any") == (datetime(2026, 1, 1), datetime(2026, 1, 31)) and rows_.window("link") == (datetime(2026, 1, 2), datetime(2026, 1, 3))
    assert rows_.all_attempts and rows_.attempts_per_module is None and rows_.show_inactive_modules and rows_.role_ids == (1, 2, 3)
    wide = from_request({"competicaoID": "3", "statusConclusaoCompeticao": "finished", "userStatus": "0,1"}, now, "module_columns")
    assert (wide.environment_ids, wide.statuses, wide.user_flags, wide.role_ids) == ((3,), ("finished",), (0, 1), (1, 2))
    track = from_request({"trackExpirationDateStartDate": "2026-01-01", "trackExpirationDateEndDate": "2026-01-02", "tipoDeTentativa": "first"}, now, "track")
    assert track.window("expiration") == (datetime(2026, 1, 1), datetime(2026, 1, 2)) and track.attempt_types == ("first",)
    environment = from_request({"lastCompetitionAccessDateStartDate": "2026-01-01", "lastCompetitionAccessDateEndDate": "2026-01-02"}, now, "environment")
    assert environment.window("last_access") == (datetime(2026, 1, 1), datetime(2026, 1, 2))
    for report in ("module_rows", "module_columns", "track", "environment"):
        with pytest.raises(KeyError):
            from_request({"profileTrackIds": "1"}, now, report)


def test_flags():
    assert [parse_flag(v) for v in ("True", "1", True, "false", "", None)] == [True, True, True, False, False, False]


def test_scalar_formats(spark, rows):
    row = rows([(366125, 0, 7, 8, 0)], "long bigint, zero bigint, a bigint, b bigint, none bigint").select(
        exprs.clock(F.col("long")).alias("clock"), exprs.short_clock(F.col("zero")).alias("zero"), exprs.clock(F.lit(None)).alias("missing"),
        exprs.percent_text(F.col("a"), F.col("b")).alias("share"), exprs.percent_text(F.col("a"), F.col("none")).alias("no_share"),
        exprs.grouped_number(F.lit("1234567.125").cast("decimal(18,3)")).alias("grouped"),
        exprs.first_chars(F.lit("abcdef"), 4).alias("clipped"), exprs.to_id(F.lit("x1")).alias("bad_id"),
        exprs.without_prefix(F.lit("t.1_a_t.1_b "), F.lit("t.1")).alias("name"),
        exprs.day_second(exprs.instant("2020-02-03 04:05:06")).alias("second"),
        exprs.plus_days(exprs.instant("2020-02-28 10:00:00"), F.lit(2)).alias("later"),
        codes.label_of(F.lit(" finished "), codes.DICTIONARIES["track_status"]).alias("label"),
        codes.label_of(F.lit("?"), codes.DICTIONARIES["track_status"], codes.UNKNOWN).alias("unknown"),
    ).first()
    assert (row.clock, row.zero, row.missing) == ("101:42:05", "0:00:00", None)
    assert (row.share, row.no_share, row.grouped) == ("87,50%", None, "1.234.567,13")
    assert (row.clipped, row.bad_id, row.name) == ("abc", None, "a_b")
    assert (row.second, row.later) == ("03/02/2020 04:05:06", datetime(2020, 3, 1, 10))
    assert (row.label, row.unknown) == ("Concluído", "Desconhecido")


def test_text_matching_folds_case_and_accents(spark, rows):
    frame = rows([("Gerência",), ("",), (None,)], "v string")
    tests = {
        "equal_to": "gerencia", "starts_with": "GER", "ends_with": "CIA", "contains": "rên", "is_empty": "",
    }
    got = frame.select(*[F.coalesce(predicates.text_matches(F.lit(op), F.col("v"), F.lit(w)), F.lit(False)).alias(op) for op, w in tests.items()]).collect()
    assert [tuple(r) for r in got] == [(True, True, True, True, False), (False, False, False, False, True), (False, False, False, False, True)]


def test_window_needs_both_ends(spark, rows):
    assert predicates.in_window(F.col("x"), (None, "2020-01-01")) is None
    frame = rows([("2020-01-01 00:00:00",), ("2020-01-02 00:00:00",), ("2020-01-03 00:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    window = ("2020-01-01", "2020-01-02")
    assert frame.where(predicates.in_window(F.col("t"), window)).count() == 2
    assert frame.where(predicates.in_window(F.col("t"), window, show_empty=True)).count() == 3


def test_convert_filter(spark):
    got = [tuple(r) for r in convert_filter(spark, "1, 3,8", "role").collect()]
    assert got == [("1", "Obrigatório", "role"), (" 3", "Gestor", "role"), ("8", "Desconhecido", "role")]
    assert [r.converted for r in convert_filter(spark, "5,6", "trackId").collect()] == ["5", "6"]
    assert convert_filter(spark, "", "role").columns == ["original", "converted", "kind"]


def test_headers_stay_apart():
    assert unique_headers(["a b", "A B", "a-b", "email"], ["email"]) == ["a b", "A B (2)", "a-b", "email (2)"]
