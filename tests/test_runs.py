"""Whole runs: publishing, repeating, resuming, reporting and comparing."""

import datetime

import pytest
from pyspark.sql import functions as F

from accesslens.operators.run_history import result_diff
from accesslens.plans import publishing
from accesslens.plans.reports import comparison, run_report
from accesslens.plans.publishing import RunRequest
from accesslens.plans.run_etl import run_etl
from accesslens.schema import BATCH_METADATA, MALFORMED_SUMMARY, QUERY_TABLES, TABLE_COLUMNS
from accesslens.streaming import stream_file_batches
from accesslens.tables import RunTables, export_run, export_tsv, jdbc_options

LINE = 'h{host} - - [0{day}/Jul/1995:0{hour}:00:00 -0400] "GET /p{path}" {status} {size}'


def write_logs(folder):
    """Three files and an empty one: 2,000 lines, 20 of them malformed."""
    n = 0
    for name, count in (("access_a", 700), ("access_b", 0), ("access_c", 1000), ("access_d", 300)):
        rows = []
        for _ in range(count):
            rows.append(
                f"bad {n}"
                if n % 100 == 7
                else LINE.format(
                    host=n % 13,
                    day=1 + n % 3,
                    hour=n % 5,
                    path=n % 41,
                    status=(200, 304, 404, 500)[n % 4],
                    size="-" if n % 6 == 0 else n,
                )
            )
            n += 1
        (folder / name).write_text("".join(r + "\n" for r in rows))


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    write_logs(folder)
    return folder


@pytest.fixture
def tables(spark, tmp_path):
    return RunTables(spark, str(tmp_path / "it's tables"), f"t_{abs(hash(str(tmp_path)))}")


def stored(tables, table, run_id):
    return sorted(map(str, tables.read(table, run_id).drop("run_id", "batch_runtime_seconds").collect()))


def test_variants_agree(spark, tables, logs):
    runs = {
        pipeline: run_etl(spark, tables, str(logs), pipeline=pipeline, prefix="access_")
        for pipeline in ("dataframe", "sql", "stream")
    }
    assert list(runs.values()) == [1, 2, 3]
    for table in (*QUERY_TABLES.values(), BATCH_METADATA, MALFORMED_SUMMARY):
        rows = [tables.read(table, run_id).drop("batch_runtime_seconds") for run_id in runs.values()]
        assert rows[0].count() > 0
        assert result_diff(rows[0], rows[1]).count() == 0
        assert result_diff(rows[0], rows[2]).count() == 0

    batches = tables.read_ordered(BATCH_METADATA, 1).collect()
    assert [tuple(b)[1:5] for b in batches] == [
        (1, 700, 7, 693),
        (2, 0, 0, 0),
        (3, 1000, 10, 990),
        (4, 300, 3, 297),
    ]
    streamed = {b["batch_id"]: b["batch_runtime_seconds"] for b in tables.read(BATCH_METADATA, 3).collect()}
    assert streamed[2] == 0 and all(streamed[b] > 0 for b in (1, 3, 4))
    samples = {r["batch_id"]: r["sample_lines"] for r in tables.read(MALFORMED_SUMMARY, 1).collect()}
    assert samples[1] == ["bad 7", "bad 107", "bad 207", "bad 307", "bad 407"] and samples[2] == []
    for run in tables.runs().collect():
        assert run["total_records_processed"] == 2000 and run["total_malformed_records"] == 20
        assert (run["total_batches"], float(run["average_batch_size"])) == (4, 500.0)
        assert run["configured_batch_size"] is None and run["runtime_seconds"] > 0
        assert isinstance(run["execution_timestamp"], datetime.datetime)

    report = run_report(tables, pipeline="sql")
    assert report.run.first()["run_id"] == 2 and report.batches.count() == 4
    assert {q: p.count() for q, p in report.pages.items()} == {"query1": 36, "query2": 20, "query3": 45}
    assert report.pages["query2"].first()["total_rows"] == 60
    side = comparison(tables, "file_based")
    assert side.measures.columns == ["measure", "dataframe", "sql", "stream"]
    assert {r["all_equal"] for r in side.consistency.collect()} == {True}
    assert [r["rank"] for r in side.ranking.collect()] == [1, 2, 3] and side.missing == []
    listed = comparison(tables, run_ids=[3, 9, 1, 3])
    assert listed.measures.columns == ["measure", "stream_1", "dataframe", "stream_4"]
    assert listed.missing == [9]
    with pytest.raises(ValueError, match="at least 2"):
        comparison(tables, run_ids=[1, 9])
    with pytest.raises(ValueError, match="name a batch strategy"):
        comparison(tables)


def test_repeating_a_run_replaces_it(spark, tables, logs):
    first = run_etl(
        spark, tables, str(logs), batch_strategy="record_count", batch_size=300, prefix="access_", run_id=5
    )
    before = {t: stored(tables, t, first) for t in TABLE_COLUMNS if t != "run_metadata"}
    run_etl(spark, tables, str(logs), batch_strategy="record_count", batch_size=300, prefix="access_", run_id=5)
    assert {t: stored(tables, t, 5) for t in before} == before
    sizes = [b["batch_size"] for b in tables.read_ordered(BATCH_METADATA, 5).collect()]
    assert sizes == [300] * 6 + [200]
    assert tables.next_run_id() == 6
    # A smaller run under the same id leaves nothing of the larger one.
    run_etl(spark, tables, str(logs), query="query1", prefix="access_", run_id=5)
    assert tables.read(QUERY_TABLES["query2"], 5).count() == 0
    assert tables.read(BATCH_METADATA, 5).count() == 4
    assert run_report(tables, 5).pages.keys() == {"query1"}


def test_a_failed_run_leaves_no_record(spark, tables, logs, monkeypatch):
    monkeypatch.setitem(publishing.QUERIES, "query3", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_etl(spark, tables, str(logs), prefix="access_")
    assert tables.runs().count() == 0
    monkeypatch.undo()
    run_id = run_etl(spark, tables, str(logs), prefix="access_", run_id=1)
    assert tables.read(QUERY_TABLES["query2"], run_id).count() == 60


def test_a_broken_stream_resumes(spark, tables, logs, tmp_path, monkeypatch):
    from accesslens.streaming import file_batches

    publish, done = file_batches.publish, []

    def fail_after_publishing_twice(*args, **kwargs):
        publish(*args, **kwargs)
        done.append(kwargs["load_id"])
        if len(done) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(file_batches, "publish", fail_after_publishing_twice)
    again = {"prefix": "access_", "run_id": 4, "checkpoint": str(tmp_path / "progress")}
    with pytest.raises(Exception, match="lost"):
        stream_file_batches(spark, tables, str(logs), **again)
    assert tables.runs().count() == 0
    assert stream_file_batches(spark, tables, str(logs), **again) == 4
    # The second load was published twice and counts once.
    assert done[:3] == [1, 2, 2]
    whole = run_etl(spark, tables, str(logs), prefix="access_")
    for table in (*QUERY_TABLES.values(), BATCH_METADATA, MALFORMED_SUMMARY):
        left, right = (tables.read(table, r).drop("batch_runtime_seconds") for r in (4, whole))
        assert result_diff(left, right).count() == 0


def test_stream_takes_several_files_at_once(spark, tables, logs):
    run_id = stream_file_batches(spark, tables, str(logs), prefix="access_", files_per_trigger=3)
    batches = tables.read_ordered(BATCH_METADATA, run_id).collect()
    assert [b["batch_size"] for b in batches] == [700, 0, 1000, 300]
    assert all((b["batch_runtime_seconds"] > 0) == (b["batch_size"] > 0) for b in batches)


def test_a_stream_of_many_files_keeps_every_runtime(spark, tables, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for n in range(7):
        (folder / f"log_{n}").write_text(LINE.format(host=n, day=1, hour=1, path=1, status=200, size=1) + "\n")
    run_id = run_etl(spark, tables, str(folder), prefix="log_", pipeline="stream", query="query1", files_per_trigger=4)
    batches = tables.read(BATCH_METADATA, run_id).collect()
    assert len(batches) == 7 and all(b["batch_runtime_seconds"] > 0 for b in batches)
    assert tables.stored(BATCH_METADATA).where("load_id > 0").select("load_id").distinct().count() == 2


def test_loads_do_not_grow_with_the_number_of_files(spark, tables, tmp_path, monkeypatch):
    from accesslens.streaming import file_batches

    monkeypatch.setattr(file_batches, "MOST_LOADS", 3, raising=False)
    folder = tmp_path / "logs"
    folder.mkdir()
    for n in range(8):
        (folder / f"log_{n}").write_text(LINE.format(host=n, day=1, hour=1, path=1, status=200, size=1) + "\n")
    run_id = run_etl(spark, tables, str(folder), prefix="log_", pipeline="stream", query="query1")
    assert tables.stored(BATCH_METADATA).where("load_id > 0").select("load_id").distinct().count() == 3
    assert [(b.batch_id, b.batch_size) for b in tables.read_ordered(BATCH_METADATA, run_id).collect()] == [(n, 1) for n in range(1, 9)]


def test_a_stream_resumes_although_a_file_was_added(spark, tables, tmp_path, monkeypatch):
    from accesslens.streaming import file_batches

    folder = tmp_path / "logs"
    folder.mkdir()
    write_logs(folder)
    publish, done = file_batches.publish, []

    def fail_at_first(*args, **kwargs):
        done.append(kwargs["load_id"])
        if len(done) == 1:
            raise RuntimeError("lost")
        publish(*args, **kwargs)

    monkeypatch.setattr(file_batches, "publish", fail_at_first)
    again = {"pipeline": "stream", "prefix": "access_", "run_id": 4, "checkpoint": str(tmp_path / "progress")}
    with pytest.raises(Exception, match="lost"):
        run_etl(spark, tables, str(folder), **again)
    (folder / "access_aa").write_text(LINE.format(host=1, day=1, hour=1, path=1, status=200, size=1) + "\n")
    run_etl(spark, tables, str(folder), **again)
    assert [b["batch_size"] for b in tables.read_ordered(BATCH_METADATA, 4).collect()] == [700, 0, 1000, 300]
    assert (tmp_path / "progress").exists()


def test_an_unnamed_checkpoint_is_removed(spark, tables, logs):
    from accesslens.session import file_names, shared_folder

    run_id = stream_file_batches(spark, tables, str(logs), prefix="access_", query="query1", run_id=77)
    assert not [name for name in file_names(spark, shared_folder(spark)) if name.startswith(f"run-{run_id}")]


def test_a_file_that_arrives_after_the_listing_is_left_to_the_next_run(spark, tables, tmp_path, monkeypatch):
    from accesslens.plans import run_etl as module

    folder = tmp_path / "logs"
    folder.mkdir()
    write_logs(folder)
    list_files = module.list_log_files

    def list_and_add(*args):
        files = list_files(*args)
        (folder / "access_b2").write_text("late\n")
        return files

    monkeypatch.setattr(module, "list_log_files", list_and_add)
    first = run_etl(spark, tables, str(folder), prefix="access_", query="query1")
    monkeypatch.undo()
    second = run_etl(spark, tables, str(folder), prefix="access_", query="query1")
    sizes = [[b["batch_size"] for b in tables.read_ordered(BATCH_METADATA, r).collect()] for r in (first, second)]
    assert sizes == [[700, 0, 1000, 300], [700, 0, 1, 1000, 300]]


def test_two_runs_at_once_get_two_ids(spark, tables, logs):
    from concurrent.futures import ThreadPoolExecutor

    tables.init_tables()
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(run_etl, spark, tables, str(logs), prefix="access_", query="query1") for _ in range(2)]
        ids = sorted(run.result() for run in runs)
    assert ids == [1, 2]
    assert all(tables.read(QUERY_TABLES["query1"], run_id).count() == 36 for run_id in ids)
    tables.delete_run(2)
    assert tables.reserve_run_id() == 3 and tables.next_run_id() == 4


def test_old_results_stay_until_the_queries_are_done(spark, tables, logs, monkeypatch):
    run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    monkeypatch.setitem(publishing.QUERIES, "query3", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    assert tables.run(3)["total_records_processed"] == 2000
    assert tables.read(QUERY_TABLES["query3"], 3).count() > 0


def test_a_run_keeps_as_many_samples_as_asked(spark, tables, logs):
    run_id = run_etl(spark, tables, str(logs), prefix="access_", query="query1", sample_lines=2)
    samples = {r["batch_id"]: r["sample_lines"] for r in tables.read(MALFORMED_SUMMARY, run_id).collect()}
    assert samples[1] == ["bad 7", "bad 107"]


def test_totals_of_very_large_batches(spark):
    from accesslens.operators.batch_totals import run_totals

    metadata = spark.createDataFrame([(1, 2 * 10**10, 0)], "batch_id int, batch_size bigint, malformed_count bigint")
    assert int(run_totals(metadata).first()["average_batch_size"]) == 2 * 10**10


def test_tables_are_created_once_kept_reset_and_deleted(spark, tables, logs):
    assert {r["status"] for r in tables.init_tables().collect()} == {"created"}
    assert {r["status"] for r in tables.init_tables().collect()} == {"already exists"}
    for _ in range(2):
        run_etl(spark, tables, str(logs), query="query3", prefix="access_")
    # Another session, with a catalog that does not know the tables yet.
    other = RunTables(spark, tables.root, tables.database + "_again")
    assert {r["status"] for r in other.init_tables().collect()} == {"already exists"}
    assert other.runs().count() == 2 and other.read(BATCH_METADATA, 2).count() == 4
    tables.delete_run(1)
    assert [r["run_id"] for r in tables.runs().collect()] == [2]
    assert tables.read(BATCH_METADATA).select("run_id").distinct().count() == 1
    with pytest.raises(PermissionError):
        tables.reset_tables()
    assert tables.runs().count() == 1
    tables.reset_tables(confirm=True)
    assert all(tables.read(t).count() == 0 for t in TABLE_COLUMNS)
    assert tables.next_run_id() == 1


def test_stored_types(spark, tables, logs):
    run_etl(spark, tables, str(logs), prefix="access_")
    for table, columns in TABLE_COLUMNS.items():
        types = {f.name: f.dataType for f in tables.read(table).schema}
        assert types == {"run_id": types["run_id"], **{f.name: f.dataType for f in columns}}
        assert types["run_id"].simpleString() == "int"


def test_reports_of_unknown_runs(tables):
    tables.init_tables()
    with pytest.raises(LookupError, match="no runs found"):
        run_report(tables)
    with pytest.raises(LookupError, match="pipeline 'sql'"):
        run_report(tables, pipeline="sql")
    with pytest.raises(LookupError, match="no run with id 3"):
        run_report(tables, 3)


@pytest.mark.parametrize(
    "wrong",
    [
        {"pipeline": "other"},
        {"query": "query4"},
        {"batch_strategy": "by_hour"},
        {"batch_strategy": "record_count"},
        {"batch_strategy": "record_count", "batch_size": 0},
        {"batch_strategy": "record_count", "batch_size": "9"},
        {"batch_strategy": "record_count", "batch_size": 9, "pipeline": "stream"},
    ],
)
def test_arguments_are_checked(wrong):
    with pytest.raises(ValueError):
        RunRequest(**{"pipeline": "dataframe", **wrong})


def test_file_batches_ignore_a_size():
    with pytest.warns(UserWarning, match="ignored"):
        assert RunRequest("sql", batch_size=10).batch_size is None


def test_export_of_a_run(spark, tables, logs, tmp_path):
    run_id = run_etl(spark, tables, str(logs), batch_strategy="record_count", batch_size=900, prefix="access_")
    export_run(tables, run_id, str(tmp_path / "out"))

    def rows(name):
        return {tuple(r["value"].split("\t")) for r in spark.read.text(str(tmp_path / "out" / name)).collect()}

    assert rows("malformed") == {("1", "9"), ("2", "9"), ("3", "2")}
    errors = tables.read(QUERY_TABLES["query3"], run_id).drop("run_id").collect()
    assert rows("query3") == {tuple(map(str, r)) for r in errors}
    assert len(rows("query2")) == 60


def test_tsv_is_not_quoted(spark, tmp_path):
    rows = spark.createDataFrame(
        [('/a"b', 2, 0.5), ('"', 1, 1 / 3)], "resource_path string, request_count int, rate double"
    )
    export_tsv(rows.coalesce(1), str(tmp_path / "out"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == ['/a"b\t2\t0.500000', '"\t1\t0.333333']


def test_jdbc_options_take_the_callers():
    options = jdbc_options("jdbc:some:db", "t", user="u", batchsize="5")
    assert options["dbtable"] == "t" and options["user"] == "u" and options["batchsize"] == "5"


def test_old_results_stay_until_the_text_is_parsed(spark, tables, logs, monkeypatch):
    run_id = run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    monkeypatch.setattr("accesslens.plans.run_etl.stage_parsed", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    assert tables.run(run_id)["total_records_processed"] == 2000
    assert tables.read(QUERY_TABLES["query2"], run_id).count() == 60


def test_rows_lie_in_query_order(spark, tables, logs):
    run_id = run_etl(spark, tables, str(logs), batch_strategy="record_count", batch_size=250, prefix="access_")
    for query, key in {
        "query1": lambda r: (r["batch_id"], r["log_date"], r["status_code"]),
        "query2": lambda r: (r["batch_id"], -r["request_count"], r["resource_path"]),
        "query3": lambda r: (r["batch_id"], r["log_date"], r["log_hour"]),
    }.items():
        stored = tables.stored(QUERY_TABLES[query]).where(F.col("run_id") == run_id)
        placed = stored.select("*", "_metadata.file_path", "_metadata.row_index")
        keys = [key(r) for r in placed.orderBy("file_path", "row_index").collect()]
        assert keys and keys == sorted(keys)


def test_readers_see_one_run_or_the_other_while_it_is_run_again(spark, tables, logs, monkeypatch):
    run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    old = {table: stored(tables, table, 3) for table in (*QUERY_TABLES.values(), BATCH_METADATA)}
    seen = []
    for name in ("load_batches", "write_run_record", "end_generation"):
        step = getattr(tables, name)

        def looked_at(*args, step=step, name=name):
            step(*args)
            seen.append((name, {table: stored(tables, table, 3) for table in old}, tables.runs().count()))

        monkeypatch.setattr(tables, name, looked_at)
    run_etl(spark, tables, str(logs), prefix="access_", run_id=3, batch_strategy="record_count", batch_size=500)
    new = {table: stored(tables, table, 3) for table in old}
    assert len(new[BATCH_METADATA]) == len(old[BATCH_METADATA]) and new != old
    assert seen == [("load_batches", old, 1), ("write_run_record", new, 1), ("end_generation", new, 1)]
    # Nothing of the old run is left in the folders either.
    assert tables.stored(BATCH_METADATA).count() == 4
    other = RunTables(spark, tables.root, tables.database + "_again")
    other.init_tables()
    assert {table: stored(other, table, 3) for table in old} == new


@pytest.mark.parametrize("pipeline", ["dataframe", "stream"])
def test_a_load_that_fails_leaves_the_old_run(spark, tables, logs, monkeypatch, pipeline):
    run_etl(spark, tables, str(logs), prefix="access_", run_id=3)
    everything = lambda: {table: stored(tables, table, 3) for table in TABLE_COLUMNS}
    old, load = everything(), tables.load_malformed
    for failing in ("load_malformed", "write_run_record"):
        with monkeypatch.context() as broken:
            broken.setattr(tables, failing, lambda *args: 1 / 0)
            with pytest.raises(Exception, match="division|ZeroDivision"):
                run_etl(spark, tables, str(logs), prefix="access_", run_id=3, pipeline=pipeline, query="query1")
        assert everything() == old and len(tables.results([3])["query2"].collect()) == 60
    assert load is not None
    run_etl(spark, tables, str(logs), prefix="access_", run_id=3, pipeline=pipeline, query="query1")
    assert tables.read(QUERY_TABLES["query2"], 3).count() == 0 and tables.read(QUERY_TABLES["query1"], 3).count() == 36
    assert tables.stored(BATCH_METADATA).count() == 4


def test_runs_side_by_side_are_read_each_by_their_generation(spark, tables, logs):
    for run_id in (1, 2, 1):
        run_etl(spark, tables, str(logs), prefix="access_", query="query3", run_id=run_id)
    assert tables.runs().count() == 2
    assert tables.read(BATCH_METADATA).count() == 8
    assert tables.results()["query3"].count() == 2 * tables.read(QUERY_TABLES["query3"], 1).count()
