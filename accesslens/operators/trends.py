"""Totals at several levels, status classes side by side, trends over calendar days, and hours without holes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.functions import chronological, is_error
from accesslens.operators.aggregates import _bytes, _requests

STATUS_CLASSES = (1, 2, 3, 4, 5)
DAYS = 7


def traffic_rollup(parsed: DataFrame) -> DataFrame:
    """Requests and bytes per date and status, per date, per status, and in all, in one pass.

    `level` says which columns a row is a total over: 0 none, 1 status codes, 2 dates, 3 both; the
    columns it is a total over are NULL. Lines that are malformed count nowhere. Without a valid line
    there is no row.
    """
    valid = parsed.where("is_valid").select("host", "log_date", "status_code", "bytes_transferred")
    return valid.cube("log_date", "status_code").agg(
        F.grouping_id().cast("int").alias("level"), _requests().alias("request_count"), _bytes().alias("total_bytes")
    )


def status_by_day(parsed: DataFrame) -> DataFrame:
    """(log_date, status_1xx ... status_5xx, other, request_count): requests per date by class of status.

    The classes are named beforehand, so one aggregation does and no job looks for them. `other` are
    codes of no class; a date without requests of a class has 0.
    """
    known = F.floor(F.col("status_code") / 100).cast("int")
    label = F.when(known.isin(*STATUS_CLASSES), F.concat(F.lit("status_"), known.cast("string"), F.lit("xx"))).otherwise("other")
    labels = [f"status_{n}xx" for n in STATUS_CLASSES] + ["other"]
    valid = parsed.where("is_valid").select("log_date", label.alias("label"))
    wide = valid.groupBy("log_date").pivot("label", labels).agg(F.count(F.lit(1)))
    counts = [F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in labels]
    total = counts[0]
    for one in counts[1:]:
        total = total + one
    return wide.select("log_date", *(one.alias(name) for one, name in zip(counts, labels)), total.alias("request_count"))


def traffic_trend(parsed: DataFrame, days: int = DAYS) -> DataFrame:
    """Requests per path and calendar day, the day before, and sums over the last `days` calendar days.

    (resource_path, day, request_count, previous_day, previous_count, change, week_count, week_errors).
    `previous_*` is the path's last day with requests, NULL on its first; the moving sums are over
    calendar days, whether or not each has requests. Dates that no calendar has are left out.

    Lines are added up per path and day before the windows, which see a row per path and day and are
    dealt out by path: a path with a third of all lines has no more of them than any other.
    """
    failed = F.count_if(is_error(F.col("status_code"))).alias("errors")
    daily = parsed.where("is_valid").groupBy("resource_path", "log_date").agg(_requests().alias("request_count"), failed)
    daily = daily.withColumn("day", chronological(F.col("log_date"))).where("day IS NOT NULL")
    place = F.datediff("day", F.lit("1970-01-01").cast("date"))
    daily = daily.select("resource_path", "day", "request_count", "errors", place.alias("_place"))
    by_day = Window.partitionBy("resource_path").orderBy("_place")
    lately = by_day.rangeBetween(-(days - 1), 0)
    previous = F.lag("request_count").over(by_day)
    return daily.select(
        "resource_path",
        "day",
        "request_count",
        F.lag("day").over(by_day).alias("previous_day"),
        previous.alias("previous_count"),
        (F.col("request_count") - previous).alias("change"),
        F.sum("request_count").over(lately).alias("week_count"),
        F.sum("errors").over(lately).alias("week_errors"),
    )


def requests_by_hour(requests: DataFrame, at: str = "requested_at") -> DataFrame:
    """(hour, request_count) for every hour from the first to the last request; hours without any have 0.

    `at` is an instant (see `with_instants`), so hours are those of the session's time zone. Requests
    without one count nowhere. What is filled in are hours, not lines: one row per hour of the span.
    """
    hours = requests.where(F.col(at).isNotNull()).groupBy(F.date_trunc("hour", at).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    span = hours.agg(F.min("hour").alias("first"), F.max("hour").alias("last")).where("first IS NOT NULL")
    every = span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return every.join(hours, "hour", "left").select("hour", F.coalesce("n", F.lit(0).cast("bigint")).alias("request_count"))
