"""Choosing, listing, ranking and comparing runs, and paging through their rows.

All take a frame of runs (one row per run, columns of `run_metadata`) and frames
of stored result rows with a run_id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a side-by-side comparison, in order, and the run column behind each.
COMPARED = {
    "run_id": "run_id",
    "runtime_seconds": "runtime_seconds",
    "total_records": "total_records_processed",
    "malformed_records": "total_malformed_records",
    "total_batches": "total_batches",
    "average_batch_size": "average_batch_size",
}


def list_runs(
    runs: DataFrame, pipeline: str | None = None, limit: int | None = None, newest_first: bool = False
) -> DataFrame:
    """Runs by id, of one pipeline if named; a limit of 0 or less is no limit."""
    chosen = runs.where(F.col("pipeline_name") == pipeline) if pipeline else runs
    ordered = chosen.orderBy(F.col("run_id").desc() if newest_first else F.col("run_id").asc())
    return ordered.limit(limit) if limit is not None and limit > 0 else ordered


def latest_run(runs: DataFrame, pipeline: str | None = None) -> DataFrame:
    """The newest run (of one pipeline if named); no rows if there is none."""
    return list_runs(runs, pipeline, limit=1, newest_first=True)


def latest_run_per_pipeline(runs: DataFrame, batch_strategy: str | None = None) -> DataFrame:
    """Each pipeline's newest run of a strategy; of every strategy if none is named.

    One scan: tasks send a single row per pipeline, instead of joining the runs
    back to their highest ids.
    """
    if batch_strategy is not None:
        runs = runs.where(F.col("batch_strategy") == batch_strategy)
    newest = F.max_by(F.struct(*runs.columns), F.col("run_id")).alias("run")
    picked = runs.groupBy("batch_strategy", "pipeline_name").agg(newest).select("run.*")
    return picked.orderBy("batch_strategy", "pipeline_name")


def runs_by_ids(runs: DataFrame, run_ids: Sequence[int]) -> DataFrame:
    """Runs in the order asked for, an id as often as it is asked for.

    An id without a run gives a row with found = false; drop those to skip them.
    """
    if not run_ids:
        raise ValueError("name at least one run id")
    asked = runs.sparkSession.createDataFrame(
        list(enumerate(map(int, run_ids), start=1)), "position int, run_id bigint"
    )
    # The filter reaches the scan (and prunes run partitions); the join restores order.
    among = runs.where(F.col("run_id").isin(*{int(i) for i in run_ids}))
    rest = [c for c in runs.columns if c != "run_id"]
    marked = among.select(F.col("run_id").cast("bigint").alias("run_id"), *rest, F.lit(True).alias("found"))
    return (
        asked.join(marked, "run_id", "left")
        .select("position", "run_id", F.coalesce("found", F.lit(False)).alias("found"), *rest)
        .orderBy("position")
    )


def collected(chosen: DataFrame) -> DataFrame:
    """The chosen runs, evaluated once: they are those a person asked to compare, and few."""
    rows = chosen.collect()
    return chosen.sparkSession.createDataFrame(rows, chosen.schema)


def runtime_ranking(chosen: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Chosen runs from fastest to slowest, by run id where runtimes tie.

    `within` ranks separately per value. The input is the handful of runs being
    compared, not the history.
    """
    place = F.row_number().over(Window.partitionBy(*within).orderBy("runtime_seconds", "run_id"))
    return chosen.select(place.alias("rank"), *within, "pipeline_name", "run_id", "runtime_seconds")


def compare_runs(chosen: DataFrame) -> DataFrame:
    """One row per (run, measure); needs at least two runs.

    The chosen runs are evaluated once, here, and come to the driver. They are numbered by
    `position` if the frame has it, else by pipeline name.
    """
    runs = chosen.collect()
    if len(runs) < 2:
        raise ValueError(f"need at least 2 runs to compare, found {len(runs)}")
    if "position" in chosen.columns:
        placed = [(run["position"], run) for run in runs]
    else:
        placed = enumerate(sorted(runs, key=lambda run: (run["pipeline_name"], run["run_id"])), start=1)
    rows = [
        (position, run["pipeline_name"], label, None if run[column] is None else float(run[column]))
        for position, run in placed
        for label, column in COMPARED.items()
    ]
    return chosen.sparkSession.createDataFrame(
        rows, "position int, pipeline_name string, measure string, value double"
    )


def side_by_side(compared: DataFrame) -> DataFrame:
    """`compare_runs` with one column per run, named by pipeline; repeats get their position."""
    rows = compared.collect()
    names = {row["position"]: row["pipeline_name"] for row in sorted(rows, key=lambda row: row["position"])}
    named = list(names.values())
    labels = [name if named.count(name) == 1 else f"{name}_{place}" for place, name in names.items()]
    values = {(row["measure"], row["position"]): row["value"] for row in rows}
    wide = [(measure, *(values[measure, place] for place in names)) for measure in COMPARED]
    kinds = T.StructType(
        [T.StructField("measure", T.StringType()), *(T.StructField(label, T.DoubleType()) for label in labels)]
    )
    return compared.sparkSession.createDataFrame(wide, kinds)


def result_counts(results: Mapping[str, DataFrame]) -> DataFrame:
    """Stored rows per query and run."""
    counted = [
        rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count")).withColumn("query_name", F.lit(query))
        for query, rows in results.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def result_consistency(chosen: DataFrame, results: Mapping[str, DataFrame]) -> DataFrame:
    """Per query, how many rows each chosen run stored and whether all stored the same number.

    Only rows of the chosen runs are counted; their ids come to the driver to select
    them. A run without rows counts 0. `same_query` is false where the runs did not run
    the same queries, so that counts may differ for that reason alone.
    """
    runs = collected(chosen.select("run_id", "pipeline_name", F.col("query_name").alias("_ran")))
    ids = [run["run_id"] for run in runs.collect()]
    results = {query: rows.where(F.col("run_id").isin(ids)) for query, rows in results.items()}
    # A row per query and chosen run: the query names are the fixed three.
    wanted = runs.select("*", F.explode(F.array(*map(F.lit, results))).alias("query_name"))
    rows = wanted.join(result_counts(results), ["query_name", "run_id"], "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )
    per_query = Window.partitionBy("query_name")
    return rows.select(
        "query_name",
        "run_id",
        "pipeline_name",
        "row_count",
        _all_equal("row_count", per_query).alias("all_equal"),
        _all_equal("_ran", per_query).alias("same_query"),
    )


def _all_equal(column: str, window) -> Column:
    return F.min(column).over(window) == F.max(column).over(window)


def result_page(rows: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    """The first rows each run stored, by batch and then `order`, with the run's row count.

    Tasks drop all but `limit` rows per run before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("batch_id", *order))
    totals = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("total_rows"))
    shown = rows.withColumn("place", place).where(F.col("place") <= limit)
    return shown.join(totals, "run_id")


def result_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows two results do not share, with how many more each side has.

    One aggregation over both, which counts repeated rows as well; rows are
    compared on the columns of `left`, less run_id.
    """
    columns = [c for c in left.columns if c != "run_id"]
    both = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    surplus = F.sum("_side")
    return (
        both.groupBy(*columns)
        .agg(surplus.alias("_surplus"))
        .where("_surplus <> 0")
        .select(
            *columns,
            F.when(F.col("_surplus") > 0, "left").otherwise("right").alias("only_in"),
            F.abs("_surplus").alias("extra_rows"),
        )
    )
