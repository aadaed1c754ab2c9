"""The batch loop as a streaming query: take files, aggregate, publish, go on."""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.operators.batch_totals import batch_metadata, malformed_summary
from accesslens.operators.batching import batch_by_file
from accesslens.plans.publishing import RunRequest, publish, record_run, stage_parsed
from accesslens.schema import ALL_QUERIES, BATCH_METADATA, SAMPLE_LINES
from accesslens.session import (
    broadcast_if_small,
    create_file,
    delete_path,
    file_names,
    path_exists,
    scratch_path,
    stage,
)
from accesslens.sources.log_files import (
    list_log_files,
    listing_by_scan_path,
    located_lines,
    open_text,
    with_file_no_of,
)
from accesslens.tables.run_tables import GENERATION, RunTables

# Each load takes its time however few lines it has, so a run has no more of them if nothing is said.
MOST_LOADS = 32


def stream_file_batches(
    spark: SparkSession,
    tables: RunTables,
    folder: str,
    *,
    prefix: str = "",
    query: str = ALL_QUERIES,
    run_id: int | None = None,
    files_per_trigger: int | None = None,
    checkpoint: str | None = None,
    sample_lines: int = SAMPLE_LINES,
) -> int:
    """Process the files of a folder a few at a time, one batch per file; returns the run id.

    `files_per_trigger` files form a load, a partition of the run tables; if it is not said,
    one file does up to `MOST_LOADS` files, and beyond that as many as make so many loads. The
    time a load took is stored with each of its batches. Files arrive by age, but batch ids follow
    the sorted listing taken when the run began. Files that arrive later are left to the next run.
    A micro-batch publishes under its own load id, so one that is repeated after a failure
    overwrites itself.

    To resume a run, call again with its run_id and checkpoint, and with the same
    `files_per_trigger`. A checkpoint that is not named is removed when the call ends. Running a
    finished id again with a new checkpoint loads beside what it stored before, as `run_etl` does,
    and readers are switched over when the last load is there.
    """
    request = RunRequest("stream", query)
    tables.init_tables()
    run_id = tables.reserve_run_id(run_id)
    keep = checkpoint is not None
    checkpoint = checkpoint or scratch_path(spark, f"run-{run_id}-stream")
    work = scratch_path(spark, f"run-{run_id}")
    listing, progress = f"{checkpoint}/listing", f"{checkpoint}/progress"
    if path_exists(spark, progress):
        files = spark.read.parquet(listing)
        generation = max(map(int, file_names(spark, f"{checkpoint}/generation")))
    else:
        generation = tables.begin_generation(run_id)
        delete_path(spark, f"{checkpoint}/generation")
        create_file(spark, f"{checkpoint}/generation/{generation}")
        files = stage(list_log_files(spark, folder, prefix), listing)
    if files_per_trigger is None:
        # By the listing that the checkpoint keeps: the same when a run is resumed.
        files_per_trigger = max(1, math.ceil(files.count() / MOST_LOADS))
    first_load = generation * GENERATION
    # Keyed and measured once for all micro-batches.
    named = broadcast_if_small(stage(listing_by_scan_path(files), f"{work}/listing"))

    def load(lines: DataFrame, epoch: int) -> None:
        started = time.monotonic()
        # A micro-batch frame keeps the partitions of its scan, so ids are in line order.
        placed = lines.withColumn("scan_pos", F.monotonically_increasing_id())
        path = f"{work}/epoch-{epoch}"
        numbered = with_file_no_of(placed, named, listed_only=True)
        publish(
            tables,
            batch_by_file(stage_parsed(numbered, request, spark, f"{path}/parsed")),
            request,
            run_id,
            f"{path}/results",
            load_id=first_load + epoch + 1,
            runtime=lambda: round(time.monotonic() - started, 3),
            sample_lines=sample_lines,
        )
        delete_path(spark, path)

    started = time.monotonic()
    try:
        reader = spark.readStream.option("maxFilesPerTrigger", int(files_per_trigger))
        stream = (
            located_lines(open_text(reader, folder, prefix))
            .writeStream.foreachBatch(load)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
        _load_empty_files(tables, files, run_id, generation, f"{work}/empty-files")
        record_run(tables, request, run_id, time.monotonic() - started, generation)
    finally:
        delete_path(spark, work)
        if not keep:
            delete_path(spark, checkpoint)
    return run_id


def _load_empty_files(tables: RunTables, files: DataFrame, run_id: int, generation: int, path: str) -> None:
    """Files without lines form no group in any micro-batch, yet they are batches of size 0."""
    spark = tables.spark
    # Micro-batches load from 1 up; load 0 of the generation is ours and may hold an earlier try.
    own = generation * GENERATION
    seen = tables.read_generation(BATCH_METADATA, run_id, generation).where(F.col("load_id") > own)
    batches = files.select(F.col("file_no").alias("batch_id"))
    absent = stage(batches.join(seen.select("batch_id"), "batch_id", "left_anti"), path)
    # An empty file takes no time.
    metadata = batch_metadata(spark.createDataFrame([], "batch_id int, host string"), absent)
    metadata = metadata.withColumn("batch_runtime_seconds", F.lit(0.0))
    tables.load_batches(metadata, run_id, own)
    no_samples = spark.createDataFrame([], "batch_id int, sample_lines array<string>")
    tables.load_malformed(malformed_summary(metadata, no_samples), run_id, own)
