"""Choosing, ranking and comparing runs, where ids, ties and gaps make it hard."""

import pytest

from accesslens.operators import run_history as history

COLUMNS = (
    "run_id int, pipeline_name string, query_name string, batch_strategy string, "
    "total_records_processed bigint, total_malformed_records bigint, total_batches int, "
    "average_batch_size double, runtime_seconds double"
)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [
            (1, "sql", "all", "file_based", 10, 1, 2, 5.0, 3.5),
            (2, "dataframe", "all", "file_based", 10, 1, 2, 5.0, 2.5),
            (3, "sql", "query1", "file_based", 10, 1, 2, 5.0, 2.5),
            (4, "stream", "all", "record_count", 10, 1, 5, 2.0, 0.5),
            (5, "sql", "all", "record_count", 10, 1, 5, 2.0, 9.5),
        ],
        COLUMNS,
    )


def ids(frame):
    return [r["run_id"] for r in frame.collect()]


def test_list_runs(runs):
    assert ids(history.list_runs(runs)) == [1, 2, 3, 4, 5]
    assert ids(history.list_runs(runs, "sql")) == [1, 3, 5]
    assert ids(history.list_runs(runs, limit=2)) == [1, 2]
    assert ids(history.list_runs(runs, limit=2, newest_first=True)) == [5, 4]
    assert ids(history.list_runs(runs, limit=0)) == ids(history.list_runs(runs, limit=-3)) == [1, 2, 3, 4, 5]
    assert ids(history.list_runs(runs, "none")) == []


def test_latest(runs):
    assert ids(history.latest_run(runs)) == [5]
    assert ids(history.latest_run(runs, "dataframe")) == [2]
    assert ids(history.latest_run(runs, "none")) == []
    newest = history.latest_run_per_pipeline(runs, "file_based")
    assert newest.columns == runs.columns
    assert ids(newest) == [2, 3]
    assert ids(history.latest_run_per_pipeline(runs)) == [2, 3, 5, 4]


def test_runs_by_ids_keeps_order_repeats_and_gaps(runs):
    found = history.runs_by_ids(runs, [4, 77, 1, 4]).collect()
    assert [(r["position"], r["run_id"], r["found"], r["pipeline_name"]) for r in found] == [
        (1, 4, True, "stream"),
        (2, 77, False, None),
        (3, 1, True, "sql"),
        (4, 4, True, "stream"),
    ]
    with pytest.raises(ValueError):
        history.runs_by_ids(runs, [])


def test_ranking_breaks_ties_by_id(runs):
    ranked = history.runtime_ranking(runs).orderBy("rank").collect()
    assert [(r["rank"], r["run_id"]) for r in ranked] == [(1, 4), (2, 2), (3, 3), (4, 1), (5, 5)]


def test_comparison_needs_two(runs):
    with pytest.raises(ValueError, match="found 1"):
        history.compare_runs(runs.where("run_id = 1"))


def test_side_by_side(runs):
    wide = history.side_by_side(history.compare_runs(runs.where("batch_strategy = 'record_count'")))
    rows = {r["measure"]: (r["sql"], r["stream"]) for r in wide.collect()}
    assert rows == {
        "run_id": (5.0, 4.0),
        "runtime_seconds": (9.5, 0.5),
        "total_records": (10.0, 10.0),
        "malformed_records": (1.0, 1.0),
        "total_batches": (5.0, 5.0),
        "average_batch_size": (2.0, 2.0),
    }


def test_consistency_counts_missing_runs_as_zero(spark, runs):
    rows = spark.createDataFrame([(2, 1), (2, 1), (3, 1), (3, 2), (9, 1)], "run_id int, batch_id int")
    results = {"query1": rows, "query2": rows.where("run_id <> 3")}
    chosen = history.latest_run_per_pipeline(runs, "file_based")
    got = {
        (r["query_name"], r["run_id"]): (r["row_count"], r["all_equal"], r["same_query"])
        for r in history.result_consistency(chosen, results).collect()
    }
    assert got == {
        ("query1", 2): (2, True, False),
        ("query1", 3): (2, True, False),
        ("query2", 2): (2, False, False),
        ("query2", 3): (0, False, False),
    }


def test_page_shows_the_first_rows_and_counts_all(spark):
    stored = [(1, b, v) for b in (2, 1) for v in (3, 1, 2)] + [(2, 1, 1)]
    rows = spark.createDataFrame(stored, "run_id int, batch_id int, v int")
    page = history.result_page(rows, ["v"], 4).orderBy("run_id", "place").collect()
    assert [(r["run_id"], r["place"], r["batch_id"], r["v"], r["total_rows"]) for r in page] == [
        (1, 1, 1, 1, 6),
        (1, 2, 1, 2, 6),
        (1, 3, 1, 3, 6),
        (1, 4, 2, 1, 6),
        (2, 1, 1, 1, 1),
    ]


def test_diff_counts_repeats_and_nulls(spark):
    kind = "a int, b string"
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], kind)
    right = spark.createDataFrame([(1, "x"), (2, None), (4, "z")], kind)
    got = sorted(map(tuple, history.result_diff(left, right).collect()))
    assert got == [(1, "x", "left", 1), (3, "z", "left", 1), (4, "z", "right", 1)]
    assert history.result_diff(left, left).count() == 0
