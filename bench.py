"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected), once to warm up and then ``BENCH_RUNS``
times; the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helioframe import registry  # noqa: E402
from helioframe.session import build_session  # noqa: E402

HEADLINE = [
    "window_avg_local",      # flagship: local -> UTC -> 1-minute mean -> local
    "window_avg_1h",
    "keyed_read",
    "aggregate_job",         # raw table write + keyed read + windows + upsert
    "csv_round_trip",        # CSV files -> per-file outcome -> dedup -> upsert
    "dedup_first",
    "upsert_latest",
    "chrono_split",
    "kfold",
    "metrics_rmse_r2",
    "tag_overlap",
    "null_counts",
    "files_to_load",
    "tree_stump",            # model fits: one tree, a weighted round, a converged solver
    "ada_two_stumps",
    "svr",
    "ingest_list",           # a list of files out of a folder
    "forest_search_stump",   # a search in shared passes
    "min_norm_ols",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session(f"local[{cpus}]", app="helioframe-bench",
                          shuffle_partitions=max(8, 2 * int(cpus)),
                          extra={"spark.driver.memory": "16g"})
    times = {}
    for name in names:
        fn = registry.QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
