"""Rows that are dealt ahead of the groupings that need them together."""

import platform_fixture
from lumenpath.operators.attributes import pivot_attributes
from lumenpath.plans.track import track_link


def test_pivot_and_track_link_deal_their_rows_once(spark, rows):
    values = rows([(1, "t1", "a", "x"), (1, "t1", "a", "y"), (1, "t1", "b", None), (2, "t1", "b", "z"), (1, "t2", "b", "w")],
                  "user_id bigint, tenant_id string, attribute string, value string")
    wide = pivot_attributes(values, ["a", "b"])
    assert sorted(map(tuple, wide.collect()), key=str) == [(1, "t1", "y", None), (1, "t2", None, "w"), (2, "t1", None, "z")]
    for frame in (pivot_attributes(values, ["a", "b"]), track_link(platform_fixture.build(spark))):
        plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        first = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(user_id" in line)
        assert len([line for line in plan if "Exchange hashpartitioning(user_id" in line]) == 1
        assert not [line for line in plan[first:] if "Aggregate" in line]  # no step of a grouping before the rows are dealt
