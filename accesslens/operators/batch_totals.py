"""Sizes, malformed counts and samples per batch, and totals per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.schema import SAMPLE_LINES


def batch_metadata(batched: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Size, malformed and valid lines of each batch of parsed lines.

    `batches` (batch_id) names batches that must appear even if they are empty.
    """
    valid = F.count("host")
    sizes = batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"),
        (F.count(F.lit(1)) - valid).alias("malformed_count"),
        valid.alias("valid_records"),
    )
    if batches is None:
        return sizes
    counts = [c for c in sizes.columns if c != "batch_id"]
    return (
        batches.select("batch_id")
        .join(sizes, "batch_id", "left")
        .select("batch_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts])
    )


def malformed_samples(
    batched: DataFrame, position: Sequence[str], limit: int = SAMPLE_LINES, line: str = "line"
) -> DataFrame:
    """The first few malformed lines of each batch by `position`, as an array.

    Tasks drop all but `limit` rows per batch before the shuffle, so the list
    that is collected stays short however many lines a batch got wrong.
    """
    where = F.struct(*position)
    nth = F.row_number().over(Window.partitionBy("batch_id").orderBy(where))
    first = (
        batched.where(F.col("host").isNull())
        .select("batch_id", where.alias("_at"), F.col(line).alias("_line"), nth.alias("_nth"))
        .where(F.col("_nth") <= limit)
    )
    found = F.sort_array(F.collect_list(F.struct("_nth", "_line")))
    return first.groupBy("batch_id").agg(F.transform(found, lambda s: s["_line"]).alias("sample_lines"))


def malformed_summary(metadata: DataFrame, samples: DataFrame) -> DataFrame:
    """Malformed count of every batch, with its sample (empty where nothing was wrong)."""
    empty = F.array().cast("array<string>")
    return metadata.join(samples, "batch_id", "left").select(
        "batch_id", "malformed_count", F.coalesce("sample_lines", empty).alias("sample_lines")
    )


def run_totals(metadata: DataFrame) -> DataFrame:
    """Records, malformed records, batches and the mean batch size; zeros without batches."""
    zero = F.lit(0).cast("bigint")
    records, batches = F.col("total_records_processed"), F.col("total_batches")
    exact = records.cast("decimal(20,0)") / batches.cast("decimal(10,0)")
    return metadata.agg(
        F.coalesce(F.sum("batch_size"), zero).alias("total_records_processed"),
        F.coalesce(F.sum("malformed_count"), zero).alias("total_malformed_records"),
        F.count(F.lit(1)).cast("int").alias("total_batches"),
    ).withColumn(
        "average_batch_size",
        F.when(batches > 0, exact).otherwise(F.lit(0)).cast("decimal(20,2)"),
    )
