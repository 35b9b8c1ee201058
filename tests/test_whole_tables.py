"""Users whom the shared stand-ins leave out take part in the queries whose job is all users."""

from datetime import datetime

import pytest

from workload.oracle import ORACLES
from workload.queries import QUERIES
from workload.tables import INSTEAD

LEFT_OUT, SEEN, ADMIN = 21, 22, 1
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (1, "AMERICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(2, "BRAZIL", 1)]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(ADMIN, "Customer#1", 2, 2000.0, "BUILDING"), (LEFT_OUT, "Customer#21", 2, 700.0, "BUILDING"), (SEEN, "Customer#22", 2, 900.0, "BUILDING")],
    ),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "Supplier#1", 2)]),
    "part": ("p_partkey long, p_brand string", [(1, "Brand#21")]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(k, user, "F", 200000.0, datetime(1997, 3, 1 + k), "1-URGENT") for k, user in enumerate((ADMIN, LEFT_OUT, SEEN))],
    ),
    "lineitem": (
        "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [(k, 1, 5.0, 0.05, 0.02, "N", "F", datetime(1997, 4, 1)) for k in range(3)],
    ),
    "events": ("event_id long, user_id long, event_type string, value double, ts timestamp_ntz", [(1, SEEN, "click", 3.0, datetime(2024, 1, 1))]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("whole")
    for name, (ddl, rows) in TABLES.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", INSTEAD)
def test_users_of_every_balance_are_reported(spark, folder, name):
    assert {LEFT_OUT, SEEN} <= {row.user_id for row in QUERIES[name](spark, folder).select("user_id").collect()}


@pytest.mark.parametrize("name", INSTEAD)
def test_checking_sql_leaves_no_balance_out(name):
    assert "balance > 600" not in ORACLES[name]
