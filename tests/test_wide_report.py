"""The wide module report on tenants that share ids."""

from datetime import datetime

import pytest

import platform_fixture
from lumenpath.operators import access
from lumenpath.params import ReportParams
from lumenpath.plans import module_columns
from lumenpath.plans.module_columns import module_headers


def report(spark, *tenants, **overrides):
    platform = platform_fixture.build(
        spark, profile_users=("profile_id bigint, user_id bigint, tenant_id string", [(1, 9, "t1"), (1, 9, "t2")]),
        environment_scores=("user_id bigint, tenant_id string, environment_id bigint, ranking_id bigint, score decimal(18,2)", [(1, "t1", 100, 0, None)]),
        exemptions=("user_id bigint, tenant_id string, module_id bigint, exempted_at timestamp_ntz, starts_at timestamp_ntz, ends_at timestamp_ntz", []), **overrides,
    )
    admins = spark.createDataFrame([(9, t) for t in tenants], "admin_id bigint, tenant_id string")
    return module_columns.module_status_columns(platform, ReportParams(as_of=datetime(2020, 6, 1)), admins)


def test_labels_belong_to_a_tenant(spark):
    environments = spark.createDataFrame([(100, "t1"), (100, "t2")], "environment_id bigint, tenant_id string")
    labels = module_columns.module_labels(platform_fixture.build(spark), ReportParams(as_of=datetime(2020, 6, 1)), environments)
    found = {(r["module_id"], r["tenant_id"]): r["header"] for r in labels.collect()}
    assert found[300, "t1"] == "1.Track - Past" and found[300, "t2"] == "1.Track two - Past two"
    headers = [(module, header) for module, _, header in module_headers(labels)]
    assert (300, "1.Track - Past") in headers and (300, "1.Track two - Past two") in headers


def test_only_modules_of_visible_environments_become_columns(spark):
    columns = report(spark, "t1").columns
    assert "1.Track - Past" in columns and not any("two" in c for c in columns)


def test_repeated_labels_are_numbered_and_columns_are_bounded(rows, monkeypatch):
    labels = rows([(1, "a", "x", 1), (2, "a", "x", 2), (1, "b", "x", 1), (1, "c", "y", 1)], "module_id bigint, tenant_id string, header string, order_number bigint")
    assert module_headers(labels) == [(1, "x", "x (1)"), (1, "y", "y"), (2, "x", "x (2)")]
    monkeypatch.setattr(module_columns, "MOST_COLUMNS", 2)
    with pytest.raises(ValueError):
        module_headers(labels)


def test_access_is_one_row_an_entity(spark):
    platform = platform_fixture.build(spark, profile_users=("profile_id bigint, user_id bigint, tenant_id string", [(1, 9, "t1")]))
    seen = access.visible_to(platform, access.admin_frame(spark, 9, "t1"), "CP", "environment_id")
    assert seen.count() == seen.distinct().count()


def test_modules_without_a_reported_row_get_no_column(spark):
    from lumenpath.operators import content

    platform = platform_fixture.build(spark)
    held = {r.module_id for r in content.module_roles(platform).where("tenant_id = 't1'").select("module_id").distinct().collect()}
    everybody = report(spark, "t1")
    nobody = report(spark, "t1", roles=(platform_fixture.TABLES["roles"][0], [row for row in platform_fixture.TABLES["roles"][1] if row[1] != 301]))
    assert 301 in held and any("Now" in c for c in everybody.columns) and not any("Now" in c for c in nobody.columns)


def test_facts_are_dealt_by_user_once(spark):
    import re

    text = report(spark, "t1")._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert "Bucketed: true" in text and not [d for d in dealt if "user_id" in d and "environment_id" in d and "module" not in d and "score" in d]
