"""Time the headline queries and whole runs; prints one JSON line.

BENCH_SF_DIR   tables to run on (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_ROUNDS   timed repetitions per query, the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from accesslens.operators.batching import batch_by_record_count, number_lines  # noqa: E402
from accesslens.session import build_session, delete_path, scratch_path, stage  # noqa: E402
from checks import inputs  # noqa: E402
from checks.queries import REGISTERED  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))

QUERIES = (
    "parse_log_lines",
    "malformed_count",
    "daily_traffic",
    "top_resources",
    "hourly_errors",
    "daily_traffic_by_batch",
    "top_resources_by_batch",
    "hourly_errors_by_batch",
    "batch_metadata",
    "malformed_summary",
    "scan_log_text",
    "batch_by_file",
    "log_table_view",
    "latest_run_per_pipeline",
    "result_page",
    "compare_runs",
    "result_consistency",
    "result_diff",
    "host_sessions",
    "asof_previous_error",
    "errors_in_incidents",
    "traffic_rollup",
    "traffic_trend",
    "stream_windowed_errors",
)
# Strategy and pipeline of complete runs: listing, parsing, three queries, all tables.
RUNS = {
    "run_etl_file_based": ("file_based", "dataframe"),
    "run_etl_record_count": ("record_count", "dataframe"),
    "run_etl_sql": ("record_count", "sql"),
}


def best_of(work) -> float:
    """Seconds of the fastest round, after one round to warm up."""
    work()
    seconds = []
    for _ in range(ROUNDS):
        started = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - started)
    return round(min(seconds), 4)


def scan_and_batch(spark) -> None:
    """Files scanned and staged, lines numbered and put into batches: all of it, every time."""
    path = scratch_path(spark, "bench-scan")
    numbered = number_lines(stage(inputs.scanned(spark, SF_DIR), path), f"{path}-offsets")
    batched = batch_by_record_count(numbered, inputs.BATCH_LINES)
    batched.write.format("noop").mode("overwrite").save()
    delete_path(spark, path)
    delete_path(spark, f"{path}-offsets")


def main() -> None:
    spark = build_session(
        "accesslens-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs.log_folder(spark, SF_DIR)
    seconds: dict[str, float] = {}
    for name in QUERIES:
        query = REGISTERED[name]
        seconds[name] = best_of(
            lambda query=query: query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    seconds["scan_and_batch_by_record_count"] = best_of(lambda: scan_and_batch(spark))
    tables = inputs.new_tables(spark)
    for name, (strategy, pipeline) in RUNS.items():
        seconds[name] = best_of(
            lambda s=strategy, p=pipeline: inputs.run(spark, SF_DIR, tables, s, p)
        )
    # A streaming run takes its time per micro-batch: timed once, in few of them.
    started = time.perf_counter()
    inputs.run(spark, SF_DIR, tables, "file_based", "stream", files_per_trigger=10)
    seconds["run_etl_stream"] = round(time.perf_counter() - started, 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
