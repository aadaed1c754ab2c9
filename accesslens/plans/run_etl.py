"""One run: scan, number, parse once, aggregate per batch, publish, record."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accesslens.operators.batching import batch_by_file, batch_by_record_count, number_lines
from accesslens.plans.publishing import RunRequest, publish, record_run, stage_parsed
from accesslens.schema import ALL_QUERIES, FILE_BASED, RECORD_COUNT, SAMPLE_LINES
from accesslens.session import delete_path, scratch_path
from accesslens.sources.log_files import list_log_files, open_logs, scan_log_text, with_file_no
from accesslens.streaming.file_batches import stream_file_batches
from accesslens.tables.run_tables import GENERATION, RunTables


def run_etl(
    spark: SparkSession,
    tables: RunTables,
    folder: str,
    *,
    pipeline: str = "dataframe",
    query: str = ALL_QUERIES,
    batch_strategy: str = FILE_BASED,
    batch_size: int | None = None,
    prefix: str = "",
    run_id: int | None = None,
    checkpoint: str | None = None,
    files_per_trigger: int | None = None,
    sample_lines: int = SAMPLE_LINES,
) -> int:
    """Run the queries over the log files of a folder and store everything; returns the run id.

    The files are listed once: one that arrives later belongs to the next run. Running an
    id again loads the new results beside those stored before and switches over when all are
    there: readers see the one or the other, and a run that fails leaves the old one as it was.
    `sample_lines` malformed lines of a batch are kept to look at. `checkpoint` and
    `files_per_trigger` are for the stream pipeline, see `stream_file_batches`.
    """
    request = RunRequest(pipeline, query, batch_strategy, batch_size)
    if request.pipeline == "stream":
        return stream_file_batches(
            spark,
            tables,
            folder,
            prefix=prefix,
            query=query,
            run_id=run_id,
            checkpoint=checkpoint,
            files_per_trigger=files_per_trigger,
            sample_lines=sample_lines,
        )
    text = open_logs(spark, folder, prefix)
    files = list_log_files(spark, folder, prefix, text)
    tables.init_tables()
    run_id = tables.reserve_run_id(run_id)
    generation = tables.begin_generation(run_id)

    started = time.monotonic()
    work = scratch_path(spark, f"run-{run_id}")
    try:
        located = with_file_no(scan_log_text(spark, folder, prefix, text), files)
        parsed = stage_parsed(located, request, spark, f"{work}/parsed")
        every_batch = None
        if request.batch_strategy == RECORD_COUNT:
            numbered = number_lines(parsed, f"{work}/offsets")
            batched = batch_by_record_count(numbered, request.batch_size)
        else:
            batched = batch_by_file(parsed)
            every_batch = files.select(F.col("file_no").alias("batch_id"))
        publish(
            tables,
            batched,
            request,
            run_id,
            f"{work}/results",
            load_id=generation * GENERATION,
            every_batch=every_batch,
            sample_lines=sample_lines,
        )
        record_run(tables, request, run_id, time.monotonic() - started, generation)
    finally:
        delete_path(spark, work)
    return run_id
