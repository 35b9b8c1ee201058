"""Runs registered queries next to their checking SQL and reports differences.

    python -m workload.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Spark type name -> DuckDB type names that hold the same values.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"}, "double": {"DOUBLE"},
}


def open_duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return value.normalize() if value else Decimal(0)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, order):
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> list[str]:
    """Differences between a Spark result and a DuckDB result; empty when they agree."""
    result = con.execute(sql)
    duck_cols = [(c[0], str(c[1]).upper()) for c in result.description]
    duck_rows = result.fetchall()
    rows = frame.collect()
    names, duck_names = frame.columns, [c for c, _ in duck_cols]
    if sorted(names) != sorted(duck_names):
        return [f"columns differ: spark only {set(names) - set(duck_names)}, sql only {set(duck_names) - set(names)}"]
    problems = []
    types = dict(con.execute(f"describe {sql}").fetchall()[i][:2] for i in range(len(duck_cols)))
    for field in frame.schema.fields:
        kind = field.dataType.simpleString()
        want = SAME_TYPE.get(kind, {kind.upper()})
        if types[field.name] not in want:
            problems.append(f"type of {field.name}: spark {kind}, sql {types[field.name]}")
    order = sorted(names)
    left = _bag(rows, [names.index(c) for c in order])
    right = _bag(duck_rows, [duck_names.index(c) for c in order])
    if len(rows) != len(duck_rows):
        problems.append(f"rows: spark {len(rows)}, sql {len(duck_rows)}")
    if left != right:
        extra, missing = list((left - right))[:2], list((right - left))[:2]
        problems.append(f"values differ ({sum((left - right).values())} rows): columns {order}\n   spark {extra}\n   sql   {missing}")
    if not rows:
        problems.append("empty result")
    return problems


def main() -> int:
    from lumenpath.session import build_session
    from workload.queries import ORACLES, QUERIES

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = open_duck(sf_dir)
    bad = 0
    for name, build in QUERIES.items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            frame = build(spark, sf_dir)
            if name in ORACLES:
                problems = compare(frame, con, ORACLES[name])
                note = "ok"
            else:
                problems, note = [], f"no sql, {frame.count()} rows"
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{name:34s} {time.time() - start:6.1f}s  {note if not problems else 'FAIL'}", flush=True)
        for problem in problems:
            print("   ", problem)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
