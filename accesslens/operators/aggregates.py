"""The three log aggregates and the malformed count, whole-input or per batch.

Each takes parsed lines in which a malformed line has NULL fields. Such lines
fall into one all-NULL group that the partial aggregation shrinks to a row per
task; `count(host)` is 0 there, and the filter on that count drops it: no filter has
to run for every line.

`by` adds group columns (`batch_id`). Distinct hosts are counted exactly: Spark
first shuffles on the keys *and* the host, so a hot path or hour is spread over
its hosts, and only one partial row per task remains for the second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.functions import chronological, error_rate, is_error
from accesslens.schema import RESULT_ORDER, TOP_RESOURCES
from accesslens.session import broadcast_if_small, scratch_path, stage

BATCH = ("batch_id",)


def _requests():
    return F.count("host")


def _bytes():
    return F.coalesce(F.sum("bytes_transferred"), F.lit(0).cast("bigint"))


def daily_traffic(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests and bytes per date and status code."""
    return (
        parsed.groupBy(*by, "log_date", "status_code")
        .agg(_requests().alias("request_count"), _bytes().alias("total_bytes"))
        .where("request_count > 0")
    )


def _resource_counts(parsed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Requests and bytes per path, a row per path from every task."""
    return (
        parsed.groupBy(*by, "resource_path")
        .agg(_requests().alias("request_count"), _bytes().alias("total_bytes"))
        .where("request_count > 0")
    )


def _most_requested(totals: DataFrame, limit: int, by: Sequence[str]) -> DataFrame:
    """The first `limit` rows, of each `by` group if given.

    Either way each task keeps only its own best rows before anything is gathered.
    """
    order = ordered_by("query2")
    if not by:
        return totals.orderBy(*order).limit(limit)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return totals.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def top_resources(
    parsed: DataFrame, limit: int = TOP_RESOURCES, by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """The most requested resources, by path where counts tie; per `by` group if given.

    Counts alone decide who is in, and they shrink to a row per path in every task.
    Only then are hosts counted, of those few paths, so that the large shuffle carries
    their hosts instead of every pair of path and host. The top counts are kept and joined
    by a size-checked broadcast. The lines are read twice: with a `path`, which the top
    counts are kept at, they should be staged already, as runs have them. Without, the four
    columns are staged in the shared folder first, so that no line is parsed twice.
    """
    keys = [*by, "resource_path"]
    if path is None:
        spark = parsed.sparkSession
        path = scratch_path(spark, "top-resources")
        parsed = stage(parsed.select(*keys, "host", "bytes_transferred"), f"{path}-lines", spark)
    counts = _resource_counts(parsed, by)
    top = broadcast_if_small(stage(_most_requested(counts, limit, by), path))
    # The counts go along as grouping columns, so that `top` is worked out once.
    requests_to_top = parsed.select(*keys, "host").join(top, keys)
    return requests_to_top.groupBy(*keys, "request_count", "total_bytes").agg(
        F.count_distinct("host").alias("distinct_host_count")
    )


def hourly_errors(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors, requests, error rate and distinct failing hosts per date and hour."""
    failed = is_error(F.col("status_code"))
    errors, total = F.col("error_request_count"), F.col("total_request_count")
    return (
        parsed.groupBy(*by, "log_date", "log_hour")
        .agg(
            F.count_if(failed).alias("error_request_count"),
            _requests().alias("total_request_count"),
            F.count_distinct(F.when(failed, F.col("host"))).alias("distinct_error_hosts"),
        )
        .where("total_request_count > 0")
        .select(
            *by,
            "log_date",
            "log_hour",
            "error_request_count",
            "total_request_count",
            error_rate(errors, total).alias("error_rate"),
            "distinct_error_hosts",
        )
    )


QUERIES = {"query1": daily_traffic, "query2": top_resources, "query3": hourly_errors}


def malformed_count(parsed: DataFrame) -> DataFrame:
    """One row: how many lines do not match. 0 if none do."""
    return parsed.agg(F.count_if(~F.col("is_valid")).alias("malformed_count"))


def ordered_by(query: str) -> list:
    """Sort columns of a query's rows."""
    return [F.col(name).asc() if way == "asc" else F.col(name).desc() for name, way in RESULT_ORDER[query]]


def sorted_results(rows: DataFrame, query: str, by: Sequence[str] = (), by_calendar: bool = False) -> DataFrame:
    """Rows of a query in its own order: dates as text, or by calendar if asked."""
    order = ordered_by(query)
    if by_calendar and "log_date" in rows.columns:
        order.insert(0, chronological(F.col("log_date")).asc_nulls_last())
    return rows.orderBy(*by, *order)
