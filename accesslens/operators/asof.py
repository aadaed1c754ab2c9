"""As-of join: every row with the latest earlier row of its key, by sorting both together in time slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seconds that are put in order in one task, of one key.
TIME_SLICE = 15 * 60

_CARRIED, _FIRST, _SECOND = -1, 0, 1


def _keyed(rows: DataFrame, by: Sequence[str], at: str, time_slice: int) -> DataFrame:
    """(_row, _key, _micros, _slice): rows apart from what they are joined by, so that no name can clash."""
    keyed = rows.select(F.struct("*").alias("_row"))
    key = F.struct(*(F.col("_row")[name].alias(f"k{i}") for i, name in enumerate(by)))
    micros = F.unix_micros(F.col("_row")[at])
    return keyed.select("_row", key.alias("_key"), micros.alias("_micros"), F.floor(micros / (time_slice * 1_000_000)).alias("_slice"))


def _has_key(by: Sequence[str]) -> Column:
    known = F.col("_micros").isNotNull()
    for i in range(len(by)):
        known = known & F.col(f"_key.k{i}").isNotNull()
    return known


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    at: str,
    take: Sequence[str],
    prefix: str = "previous_",
    exact: bool = False,
    tolerance: float | None = None,
    time_slice: int = TIME_SLICE,
) -> DataFrame:
    """Every row of `left`, with the columns `take` and the time `at` of the latest row of `right` before it.

    Rows match on equal columns `by`; the added columns are named with the prefix. A row of the same
    instant counts with `exact` only, and one more than `tolerance` seconds ago does not. Of several
    rows of `right` at one instant the largest (by `take`, in its order) is taken. Rows of `left`
    whose key or time is NULL, or that have no earlier row, get NULLs; none is lost or repeated.

    No inequality join: both sides are put in order together and the last row of `right` is looked
    back to. A key is ordered in time slices; what a slice begins with is carried over from the
    slices before, of which only their last row of `right` is looked at. Both sides are read twice:
    stage them if they are costly to make.
    """
    added = [f"{prefix}{name}" for name in (at, *take)]
    clash = {name.lower() for name in added} & {name.lower() for name in left.columns}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    lefts = _keyed(left, by, at, time_slice)
    rights = _keyed(right, by, at, time_slice).where(_has_key(by))
    # One row of each instant, added up in every task first.
    taken = F.max(F.struct(*(F.col("_row")[name].alias(f"t{i}") for i, name in enumerate(take)))) if take else F.max(F.lit(True))
    rights = rights.groupBy("_key", "_slice", "_micros").agg(taken.alias("_taken"))
    rights = rights.withColumn("_match", F.struct("_micros", "_taken"))

    # What every slice with rows of `left` begins with: the last match of the slices before it.
    known = lefts.where(_has_key(by))
    lasts = rights.groupBy("_key", "_slice").agg(F.max_by("_match", "_micros").alias("_last"))
    asking = known.select("_key", "_slice").distinct()
    slices = lasts.withColumn("_asking", F.lit(False)).unionByName(
        asking.withColumns({"_last": F.lit(None).cast(lasts.schema["_last"].dataType), "_asking": F.lit(True)})
    )
    slices = slices.groupBy("_key", "_slice").agg(F.max_by("_last", F.col("_last").isNotNull()).alias("_last"), F.max("_asking").alias("_asking"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("_match", F.last("_last", ignorenulls=True).over(before)).where("_asking AND _match IS NOT NULL")

    no_row = F.lit(None).cast(lefts.schema["_row"].dataType)
    no_match = F.lit(None).cast(rights.schema["_match"].dataType)
    start = (F.col("_slice") * time_slice * 1_000_000).cast("bigint")
    events = known.select("_key", "_slice", "_micros", F.lit(_SECOND if exact else _FIRST).alias("_turn"), "_row", no_match.alias("_match"))
    events = events.unionByName(
        rights.select("_key", "_slice", "_micros", F.lit(_FIRST if exact else _SECOND).alias("_turn"), no_row.alias("_row"), "_match")
    ).unionByName(
        carried.select("_key", "_slice", start.alias("_micros"), F.lit(_CARRIED).alias("_turn"), no_row.alias("_row"), "_match")
    )
    so_far = Window.partitionBy("_key", "_slice").orderBy("_micros", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    matched = events.withColumn("_match", F.last("_match", ignorenulls=True).over(so_far)).where("_row IS NOT NULL")
    if tolerance is not None:
        near = F.col("_micros") - F.col("_match._micros") <= int(tolerance * 1_000_000)
        matched = matched.withColumn("_match", F.when(near, F.col("_match")))
    # Rows without a key would all meet in one group.
    matched = matched.select("_row", "_match").unionByName(lefts.where(~_has_key(by)).select("_row", no_match.alias("_match")))
    return matched.select(
        *(F.col("_row")[name].alias(name) for name in left.columns),
        F.timestamp_micros("_match._micros").alias(added[0]),
        *(F.col(f"_match._taken.t{i}").alias(name) for i, name in enumerate(added[1:])),
    )
