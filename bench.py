"""Times the headline queries and prints one JSON line.

Each query is built and run to a sink that discards the rows, once to warm up and then
``BENCH_RUNS`` times; the median counts. ``value`` is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "snapshot_delta",
    "snapshot_delta_lineitem",
    "snapshot_deletes_lineitem",
    "change_feed",
    "change_feed_lineitem",
    "upsert_merge",
    "cdc_apply",
    "cdc_stream",
    "daily_snapshot",
    "clean_ascii",
    "clean_date",
    "clean_full_name",
    "clean_rules",
    "lookup_marital",
    "apply_schema",
    "strip_nul",
    "rejected_rows",
    "export_by_key",
    "unload_csv",
    "unload_parquet",
    "compact_table",
    "normalize_file_names",
    "report_metadata",
    "run_latest_status",
    "run_ready",
    "run_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries.load_all()
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries.BUILDERS[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    print(
        json.dumps(
            {
                "metric": f"total seconds of {len(seconds)} queries, median of {runs} after a warm-up",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
