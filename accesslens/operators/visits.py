"""Visits: requests of one key without a longer pause, summed up in time slices and merged at their edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Half an hour without a request ends a visit.
PAUSE = 30 * 60
# Seconds that are put in order in one task, of one key.
TIME_SLICE = 6 * 3600


def _merged(parts: DataFrame, keys: list[str], within: list[str], pause: int, sums: Sequence[str], number: str) -> DataFrame:
    """Parts that follow each other within the pause as one row, numbered from 1 in each `keys` + `within`."""
    order = Window.partitionBy(*keys, *within).orderBy("_first")
    begins = F.coalesce(F.col("_first") - F.lag("_last").over(order) > pause, F.lit(True))
    numbered = parts.withColumn("_begins", begins.cast("int"))
    numbered = numbered.withColumn(number, F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, *within, number).agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), *(F.sum(name).alias(name) for name in sums)
    )


def visits(
    requests: DataFrame,
    keys: Sequence[str] = ("host",),
    at: str = "requested_at",
    pause: int = PAUSE,
    sums: Mapping[str, Column] | None = None,
    time_slice: int = TIME_SLICE,
) -> DataFrame:
    """(keys, visit, started_at, ended_at, requests, sums): a row per visit, numbered per key by time.

    A pause of more than `pause` seconds begins a new visit. `sums` are columns that are added up
    over a visit's requests. Requests without an instant or with a NULL key belong to no visit.

    Requests of the same second are added up first, in every task before anything is shuffled. Then
    each key is put in order in time slices, so a key with a third of all requests is spread over
    time and no task orders more than `time_slice` seconds of it. A slice leaves a row per visit or
    part of one, at most one per pause, and the parts of a key are merged where they meet.
    """
    keys, sums = list(keys), dict(sums or {})
    whole = F.col(at).isNotNull()
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    names = ["requests", *sums]
    seconds = (
        requests.where(whole)
        .groupBy(*keys, F.unix_seconds(at).alias("_first"))
        .agg(F.count(F.lit(1)).alias("requests"), *(F.sum(column).alias(name) for name, column in sums.items()))
        .withColumns({"_last": F.col("_first"), "_slice": F.floor(F.col("_first") / time_slice)})
    )
    parts = _merged(seconds, keys, ["_slice"], pause, names, "_part")
    whole_visits = _merged(parts, keys, [], pause, names, "visit")
    return whole_visits.select(
        *keys,
        F.col("visit").cast("bigint").alias("visit"),
        F.timestamp_seconds("_first").alias("started_at"),
        F.timestamp_seconds("_last").alias("ended_at"),
        *names,
    )
