"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   data directory (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     timed runs per query after one warm-up (default 3); the median is reported
    BENCH_QUERIES  comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import time

from lumenpath.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "status_by_track", "latest_attempt", "attempt_history_numbered", "first_group", "all_groups", "attributes_pivot",
    "editable_environments", "activity_status", "activity_gold", "activity_report", "module_status_rows",
    "module_status_columns", "track_report", "environment_report", "audience_all_criteria",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session("bench", cpus=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total seconds, headline queries (median per query)", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
