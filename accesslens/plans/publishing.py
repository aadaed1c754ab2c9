"""The steps batch and streaming runs share: check, parse and stage, publish, record."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.operators.aggregates import BATCH, QUERIES, top_resources
from accesslens.operators.batch_totals import (
    batch_metadata,
    malformed_samples,
    malformed_summary,
    run_totals,
)
from accesslens.operators.parsing import parse_log_lines
from accesslens.plans.sql_variant import run_sql
from accesslens.schema import (
    ALL_QUERIES,
    BATCH_METADATA,
    BATCH_STRATEGIES,
    FILE_BASED,
    MALFORMED_SUMMARY,
    PIPELINES,
    QUERY_NAMES,
    RECORD_COUNT,
    SAMPLE_LINES,
)
from accesslens.session import stage
from accesslens.tables.run_tables import GENERATION, RunTables

POSITION = ("file_no", "block_start", "scan_pos")

# What a query reads besides `host`, which every one needs: NULL marks malformed.
QUERY_FIELDS = {
    "query1": ("log_date", "status_code", "bytes_transferred"),
    "query2": ("resource_path", "bytes_transferred"),
    "query3": ("log_date", "log_hour", "status_code"),
}


@dataclass(frozen=True)
class RunRequest:
    """Checked arguments of a run."""

    pipeline: str
    query: str = ALL_QUERIES
    batch_strategy: str = FILE_BASED
    batch_size: int | None = None

    def __post_init__(self):
        _one_of("pipeline", self.pipeline, PIPELINES)
        _one_of("query", self.query, (*QUERY_NAMES, ALL_QUERIES))
        _one_of("batch_strategy", self.batch_strategy, BATCH_STRATEGIES)
        if self.batch_strategy == RECORD_COUNT:
            size = self.batch_size
            if isinstance(size, bool) or not isinstance(size, int) or size <= 0:
                raise ValueError(f"record_count needs a positive integer batch_size, got {size!r}")
            if self.pipeline == "stream":
                raise ValueError("the stream pipeline takes files as they come: use file_based")
        else:
            if self.batch_size is not None:
                warnings.warn(f"batch_size is ignored by {self.batch_strategy} batches", stacklevel=3)
            object.__setattr__(self, "batch_size", None)

    @property
    def queries(self) -> tuple[str, ...]:
        return QUERY_NAMES if self.query == ALL_QUERIES else (self.query,)


def _one_of(what: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"invalid {what}: {value!r}; allowed: {', '.join(allowed)}")


def stage_parsed(located: DataFrame, request: RunRequest, spark: SparkSession, path: str) -> DataFrame:
    """Parse the text once into columns the queries can share, each reading only its own.

    Of the lines themselves only the malformed ones are kept.
    """
    used = dict.fromkeys(f for name in request.queries for f in QUERY_FIELDS[name])
    position = [c for c in POSITION if c in located.columns]
    malformed_line = F.when(F.col("host").isNull(), F.col("line")).alias("line")
    parsed = parse_log_lines(located).select(*position, "host", *used, malformed_line)
    return stage(parsed, path, spark)


def publish(
    tables: RunTables,
    batched: DataFrame,
    request: RunRequest,
    run_id: int,
    work: str,
    load_id: int = 0,
    every_batch: DataFrame | None = None,
    runtime: Callable[[], float] | None = None,
    sample_lines: int = SAMPLE_LINES,
) -> None:
    """Aggregate one load of batched, staged lines and publish it to the run tables.

    Everything is loaded as it is worked out; readers see it once the run's row says so. What is
    read twice is kept below the folder `work`. `every_batch` names batches that may be empty, and
    `runtime` tells the seconds that the load took, stored with each of its batches.
    """
    spark = tables.spark
    metadata: list[DataFrame] = []

    def load_query(name: str) -> None:
        if request.pipeline == "sql":
            result = run_sql(name, batched, f"{work}/top")
        elif name == "query2":
            result = top_resources(batched, by=BATCH, path=f"{work}/top")
        else:
            result = QUERIES[name](batched, by=BATCH)
        tables.load_query_results(name, result, run_id, load_id)

    def load_malformed() -> None:
        metadata.append(stage(batch_metadata(batched, every_batch), f"{work}/batches", spark))
        position = [c for c in POSITION if c in batched.columns]
        samples = malformed_samples(batched, position, sample_lines)
        tables.load_malformed(malformed_summary(metadata[0], samples), run_id, load_id)

    _at_once(spark, *[partial(load_query, name) for name in request.queries], load_malformed)
    batches = metadata[0]
    if runtime is not None:
        # It covers the queries, so it can only be stored after them.
        batches = batches.withColumn("batch_runtime_seconds", F.lit(runtime()))
    tables.load_batches(batches, run_id, load_id)


def _at_once(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Submit independent jobs together: one fills the cores that another's last tasks leave idle."""
    same_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        for submitted in [pool.submit(same_session(step)) for step in steps]:
            submitted.result()


def record_run(tables: RunTables, request: RunRequest, run_id: int, seconds: float, generation: int = 0) -> None:
    """Total the stored batches, write the run's row, and only then let an earlier generation go."""
    totals = run_totals(tables.read_generation(BATCH_METADATA, run_id, generation))
    tables.write_run_record(
        totals.select(
            F.lit(request.pipeline).alias("pipeline_name"),
            F.lit(request.query).alias("query_name"),
            F.lit(request.batch_strategy).alias("batch_strategy"),
            F.lit(request.batch_size).cast("int").alias("configured_batch_size"),
            *totals.columns,
            F.lit(round(seconds, 3)).alias("runtime_seconds"),
            F.current_timestamp().alias("execution_timestamp"),
        ),
        run_id,
        generation * GENERATION,
    )
    tables.end_generation(run_id, generation)
