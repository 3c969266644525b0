"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)
    BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from premia.catalog import QUERIES  # noqa: E402
from premia.session import build_session  # noqa: E402

HEADLINE = [
    "feature_table",
    "feature_table_events",
    "rolling_avg_time",
    "size_premium",
    "agg_join_back",
    "pre_drop_avg",
    "failure_summary",
    "sku_match_join",
    "snapshot_reshape",
    "standardize_fit",
    "score_batch",
    "stream_score",
    "drift_report",
    "ranked_board",
    "top1_per_key",
    "write_parquet_partitioned",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "premia-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    result = {
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if "feature_table" in seconds:
        result["feature_rows_per_sec"] = round(rows / seconds["feature_table"])
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
