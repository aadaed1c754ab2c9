"""Line numbers and batch ids as columns; a batch is never a driver-side list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.session import broadcast_if_small, stage

SPLIT = ("file_no", "block_start")


def split_offsets(located: DataFrame) -> DataFrame:
    """What to add to `scan_pos` in each split to get the line number from 0.

    The lines are counted per split on all executors. Splits are summed up within
    their file, side by side for all files; only the sums of files, a row per file of
    the listing, go through one task.
    """
    sizes = located.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("lines"), F.min("scan_pos").alias("first_pos")
    )
    files = sizes.groupBy("file_no").agg(F.sum("lines").alias("_file_lines"))
    files = files.select("file_no", _sum_before("_file_lines", Window.orderBy("file_no")).alias("_file_start"))
    within = _sum_before("lines", Window.partitionBy("file_no").orderBy("block_start"))
    starts = sizes.withColumn("_start", within).join(files, "file_no")
    return starts.select(*SPLIT, (F.col("_file_start") + F.col("_start") - F.col("first_pos")).alias("shift"))


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_lines(located: DataFrame, path: str | None = None) -> DataFrame:
    """Add `line_no`, from 0 over all files in listing order, without shuffling lines.

    `located` has file_no, block_start and scan_pos, and must be staged: the
    positions of two separate scans need not agree. Only the offsets, one row per
    split, are shuffled. With a `path` they are kept there, and the lines take them in
    by a size-checked broadcast; without one the join is planned as it runs.
    """
    shifts = split_offsets(located)
    if path:
        shifts = broadcast_if_small(stage(shifts, path))
    numbered = located.join(shifts, list(SPLIT))
    return numbered.withColumn("line_no", F.col("scan_pos") + F.col("shift")).drop("shift")


def batch_by_record_count(numbered: DataFrame, batch_size: int, line_no: str = "line_no") -> DataFrame:
    """Consecutive `batch_size` lines share a batch id from 1; batches cross files."""
    if batch_size <= 0:
        raise ValueError(f"batch_size must be a positive integer, got {batch_size}")
    nth = F.expr(f"`{line_no}` div {int(batch_size)}")
    return numbered.withColumn("batch_id", (nth + 1).cast("int"))


def batch_by_file(lines: DataFrame) -> DataFrame:
    """One batch per listed file, in listing order."""
    return lines.withColumn("batch_id", F.col("file_no"))
