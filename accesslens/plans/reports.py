"""What a run stored, and several runs side by side, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.operators.aggregates import ordered_by
from accesslens.operators.run_history import (
    collected,
    compare_runs,
    latest_run,
    latest_run_per_pipeline,
    result_consistency,
    result_page,
    runs_by_ids,
    runtime_ranking,
    side_by_side,
)
from accesslens.schema import (
    ALL_QUERIES,
    BATCH_METADATA,
    PAGE_ROWS,
    QUERY_NAMES,
    QUERY_TABLES,
)
from accesslens.tables.run_tables import RunTables


@dataclass(frozen=True)
class RunReport:
    """The run's row, its batches, and the first rows of each query that ran."""

    run: DataFrame
    batches: DataFrame
    pages: dict[str, DataFrame]


@dataclass(frozen=True)
class Comparison:
    """Chosen runs, their measures side by side, their ranking and their row counts.

    `missing` lists the ids that were asked for but name no run.
    """

    runs: DataFrame
    measures: DataFrame
    ranking: DataFrame
    consistency: DataFrame
    missing: list[int]


def run_report(
    tables: RunTables, run_id: int | None = None, pipeline: str | None = None
) -> RunReport:
    """Report one run, or the latest (of a pipeline if named) when no id is given."""
    if run_id is None:
        newest = latest_run(tables.runs(), pipeline).first()
        if newest is None:
            raise LookupError(f"no runs found for pipeline {pipeline!r}" if pipeline else "no runs found")
    else:
        newest = tables.run(run_id)
        if newest is None:
            raise LookupError(f"no run with id {run_id}")
    chosen = newest["run_id"]
    ran = QUERY_NAMES if newest["query_name"] == ALL_QUERIES else (newest["query_name"],)
    pages = {
        query: result_page(tables.read(QUERY_TABLES[query], chosen), ordered_by(query), PAGE_ROWS[query])
        for query in ran
    }
    return RunReport(
        tables.runs().where(F.col("run_id") == chosen),
        tables.read_ordered(BATCH_METADATA, chosen),
        {query: page.orderBy("place") for query, page in pages.items()},
    )


def comparison(
    tables: RunTables, batch_strategy: str | None = None, run_ids: Sequence[int] = ()
) -> Comparison:
    """Compare the latest run per pipeline of a strategy, or the runs listed."""
    missing: list[int] = []
    if batch_strategy:
        runs = latest_run_per_pipeline(tables.runs(), batch_strategy)
    elif run_ids:
        asked = collected(runs_by_ids(tables.runs(), run_ids))
        missing = [r["run_id"] for r in asked.where("NOT found").collect()]
        runs = asked.where("found").drop("found")
    else:
        raise ValueError("name a batch strategy or run ids to compare")
    # A person reads the comparison, so the runs are few; all that follows is made from this one evaluation.
    runs = collected(runs)
    measures = side_by_side(compare_runs(runs))
    compared = sorted({run["run_id"] for run in runs.collect()})
    return Comparison(
        runs,
        measures,
        runtime_ranking(runs).orderBy("rank"),
        result_consistency(runs, tables.results(compared)),
        missing,
    )
