"""Registered queries against their checking SQL, and the shape of their plans, on the smallest data."""

import os
import re

import pytest

from workload.compare import compare, open_duck
from workload.queries import ORACLES, QUERIES
from workload.tables import standin

SF_DIR = os.environ.get("LUMENPATH_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")

# A cross-section; ``python -m workload.compare <dir>`` runs all of them.
CHECKED = [
    "status_by_track", "attempt_history_numbered", "first_group", "all_groups", "label_override", "settings_overlay",
    "attributes_pivot", "editable_environments", "activity_gold", "module_workload", "track_summary_union", "audience_track",
    "provenance_names", "activity_status_filters", "sql_settings", "sql_label_text", "sql_all_groups", "attribute_names_by_tenant", "audience_multiple",
]


@pytest.fixture(scope="module")
def duck():
    return open_duck(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_checking_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["activity_gold", "module_status_rows", "audience_all_criteria"])
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_latest_attempt_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["latest_attempt"](spark, SF_DIR))
    assert "WindowGroupLimit" in text and "Partial" in text.split("WindowGroupLimit", 2)[2].split("\n")[0]
    assert "PushedFilters: [IsNotNull(status_id), Not(EqualTo(status_id,cancelado))]" in text


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("audience_") and n not in ("audience_page", "audience_all_criteria")])
def test_criteria_reach_the_scans_as_literals(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "ExistingRDD" not in text and "LocalTableScan" not in text
    assert not re.search(r"hashpartitioning\((tenant_id|is_active)#\w+, (tenant_id#\w+, )?\d+\)", text)


def test_environment_report_evaluates_its_plan_once(spark):
    text = plan(QUERIES["environment_report"](spark, SF_DIR))
    assert text.count("/attempts") <= 1


def test_attribute_pivot_groups_narrow_rows(spark):
    text = plan(QUERIES["attributes_pivot"](spark, SF_DIR))
    assert "full_name" not in text and "statement" not in text


def test_gold_grain_and_isolation(spark):
    gold = standin(spark, SF_DIR).gold
    keys = ["tenant_id", "user_id", "environment_id", "module_id", "activity_id", "role_label"]
    assert gold.count() == gold.select(*keys).distinct().count()
    users = standin(spark, SF_DIR).users
    assert gold.join(users, ["user_id", "tenant_id"], "left_anti").count() == 0
    assert gold.where("activity_status = 'exempted' and (attempt_id <> '' or answered_at is not null or access_time <> '')").count() == 0


def test_memberships_travel_once_and_without_environments(spark):
    text = plan(QUERIES["first_group"](spark, SF_DIR))
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert not [d for d in dealt if "environment_id" in d] and len({d for d in dealt if "user_id" in d}) == 1
    assert "Window" not in text


def test_only_creators_of_links_are_looked_up(spark):
    text = plan(QUERIES["provenance_names"](spark, SF_DIR))
    assert "/users" not in text and "Union" not in text and "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_long_lists_become_semi_joins(spark):
    text = plan(QUERIES["activity_of_listed_modules"](spark, SF_DIR))
    assert "LeftSemi" in text and not re.search(r"module_id#\w+ IN|module_id#\w+ INSET", text)


def test_exceptions_need_no_join_of_their_own(spark):
    text = plan(QUERIES["audience_all_criteria"](spark, SF_DIR))
    assert "bit_or" in text
    top = text.split("Final Plan")[0].split("HashAggregate", 1)[0]
    assert "LeftAnti" not in top


def test_a_deep_page_reads_its_ranges_only(spark, rows):
    from lumenpath.operators.audience import page_of

    people = spark.range(5000).selectExpr("concat('n', id % 700) as name", "id as user_id")
    names = sorted((f"n{k % 700}", k) for k in range(5000))
    for skip, take in ((0, 10), (4321, 25), (4990, 50), (6000, 5), (2500, 0)):
        page = page_of(people.repartition(3), ["name", "user_id"], skip, take, "total")
        assert [tuple(r) for r in page.collect()] == [(*row, 5000) for row in names[skip : skip + take]]
    deep = plan(page_of(people, ["name", "user_id"], 4321, 25, "total"))
    assert re.search(r"PartitionFilters: \[(isnotnull\(_range#\w+\), )?\(?_range#\w+ (= \d+|IN \(\d+\))", deep) and "CollectLimit" not in deep
    assert page_of(people.where("false"), ["name", "user_id"], 0, 10, "total").collect() == []
