
from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "flatten_logs",
    "flatten_traces",
    "assign_file_batches",
    "log_file_column_stats",
    "span_file_column_stats",
    "write_logs_roundtrip",
    "write_traces_roundtrip",
    "slow_spans",
    "recent_error_logs",
    "spans_by_service",
    "logs_with_span",
    "span_parent_join",
    "prune_files_minmax",
    "bloom_point_lookup",
    "catalog_data_files",
    "table_column_stats",
    "catalog_commit",
    "stream_ingest_logs",
    "stream_ingest_traces",
]
REPEATS = 2  # the first run also pays for code generation


def main() -> None:
    from spanloom.plans.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spanloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {', '.join(f'{r:.2f}' for r in runs)}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {name: round(n_events / s) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "events": n_events,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
