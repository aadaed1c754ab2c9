"""Range join: rows inside intervals, by an equality of time buckets that grow with the interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.session import broadcast_if_small, stage


def _bucket(seconds, level):
    """The bucket of 2^level seconds that a second is in."""
    return F.call_function("shiftright", seconds, level)


def in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Every pair of a row of `points` and one of `intervals` whose [start, end] its time `at` is in.

    Columns of both sides, those of `by`, which have to be equal, once; other names that both sides
    have are refused. Ends belong to the interval. NULL times and keys match nothing, and neither
    does an interval that ends before it starts. Repeated rows make repeated pairs.

    An interval lies in one or two of the smallest time buckets that are as long as it is, and a
    row in one bucket of each length that intervals have, of which there are some 40 at most. So
    the join is one of equal buckets, rechecked exactly: no pair comes out twice, and no interval is
    spread over many rows however long it is. Intervals are broadcast if they fit, measured first
    (kept below `path` for it, if given); beyond that the join shuffles with adaptive skew splitting.
    """
    shared = {name.lower() for name in points.columns} & {name.lower() for name in intervals.columns} - {name.lower() for name in by}
    if shared:
        raise ValueError(f"columns of both sides: {sorted(shared)}")
    spans = intervals.select(F.struct("*").alias("_span"))
    first, last = (F.unix_seconds(F.col("_span")[name]) for name in (start, end))
    # 2^level is at least the number of seconds that the interval touches.
    level = F.ceil(F.log2((last - first + 1).cast("double"))).cast("int")
    spans = spans.where(F.col("_span")[start] <= F.col("_span")[end]).withColumn("_level", level)
    bucket = F.explode(F.array_distinct(F.array(_bucket(first, F.col("_level")), _bucket(last, F.col("_level")))))
    spans = spans.select("_span", "_level", bucket.alias("_bucket"), *(F.col("_span")[name].alias(f"_k{i}") for i, name in enumerate(by)))
    if path:
        spans = stage(spans, path, points.sparkSession)
    # One number per length of buckets; their count is bounded by the 64 bits of a second.
    levels = sorted(row["_level"] for row in spans.select("_level").distinct().collect())
    rows = points.select(F.struct("*").alias("_point"))
    second = F.unix_seconds(F.col("_point")[at])
    buckets = [F.struct(F.lit(one).alias("level"), _bucket(second, F.lit(one)).alias("bucket")) for one in levels]
    kind = "array<struct<level:int,bucket:bigint>>"
    rows = rows.where(F.col("_point")[at].isNotNull()).withColumn("_in", F.explode(F.array(*buckets).cast(kind)))
    rows = rows.select(
        "_point",
        F.col("_in.level").alias("_level"),
        F.col("_in.bucket").alias("_bucket"),
        *(F.col("_point")[name].alias(f"_k{i}") for i, name in enumerate(by)),
    )
    spans = broadcast_if_small(spans) if path else spans
    pairs = rows.join(spans, ["_level", "_bucket", *(f"_k{i}" for i in range(len(by)))])
    inside = F.col("_point")[at].between(F.col("_span")[start], F.col("_span")[end])
    own = {name.lower() for name in by}
    return pairs.where(inside).select(
        *(F.col("_point")[name].alias(name) for name in points.columns),
        *(F.col("_span")[name].alias(name) for name in intervals.columns if name.lower() not in own),
    )
