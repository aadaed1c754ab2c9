"""Listing, scanning, numbering and batching real files, against plain Python."""

import os

import pytest
from pyspark.sql import functions as F

from accesslens.operators.aggregates import daily_traffic
from accesslens.operators.batching import batch_by_file, batch_by_record_count, number_lines
from accesslens.session import stage
from accesslens.sources import list_log_files, log_table_view, scan_log_text, with_file_no
from accesslens.sources.log_files import open_logs

LINE = '%s - - [01/Jul/1995:00:00:01 -0400] "GET /%s HTTP/1.0" 200 %d'


def expected_lines(paths):
    """What reading the files one after the other gives."""
    for path in sorted(paths):
        with open(path, encoding="ISO-8859-1", newline=None) as text:
            for line in text:
                line = line.strip("".join(map(chr, range(33))))
                if line:
                    yield path, line


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    home = tmp_path_factory.mktemp("logs with blank + 100%")
    ends = ["\n", "\r\n", "\n\n", "\n \t\n", "\r"]
    for n, name in enumerate(["access_log_a", "access_log_b c", "access_log_d+e%20", "access_log_z"]):
        rows = [LINE % (f"h{i % 17}é", f"café/{n}/{i}", i) + ends[i % 5 if n else 0] for i in range(1000 + 331 * n)]
        (home / name).write_bytes("".join(rows).encode("ISO-8859-1"))
    (home / "access_log_m").write_bytes(b"")
    (home / "access_log_y").write_bytes(b" \n\t\n")
    (home / "other_log").write_bytes(b"not mine\n")
    (home / "access_log_sub").mkdir()
    (home / "access_log_sub" / "access_log_x").write_bytes(b"too deep\n")
    return home


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def log_paths(folder):
    return [str(p) for p in folder.iterdir() if p.is_file() and p.name.startswith("access_log_")]


def test_listing_is_sorted_and_keeps_empty_files(spark, folder):
    listed = list_log_files(spark, str(folder), "access_log_").orderBy("file_no").collect()
    assert [r["file_no"] for r in listed] == [1, 2, 3, 4, 5, 6]
    names = [os.path.basename(p) for p in sorted(log_paths(folder))]
    wanted = [n.replace("%", "%25").replace(" ", "%20") for n in names]
    assert [os.path.basename(r["path"]) for r in listed] == wanted


def test_listing_sorts_names_as_they_are(spark, tmp_path):
    for name in ("x a", "x!a", "x%a", "xa"):
        (tmp_path / name).write_text(f"{name}\n")
    lines = with_file_no(scan_log_text(spark, str(tmp_path)), list_log_files(spark, str(tmp_path)))
    got = [row["line"] for row in lines.orderBy("file_no").collect()]
    assert got == sorted(got) == ["x a", "x!a", "x%a", "xa"]


def test_listing_says_what_is_missing(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such log folder"):
        list_log_files(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError, match="is empty"):
        list_log_files(spark, str(tmp_path), "access_log_")
    with pytest.raises(FileNotFoundError, match="no file named nothing"):
        list_log_files(spark, str(folder), "nothing")
    with pytest.raises(FileNotFoundError, match="no file named"):
        list_log_files(spark, str(folder), "access_lo[g]")


def test_lines_are_decoded_trimmed_and_numbered_over_all_files(spark, folder, small_splits):
    files = list_log_files(spark, str(folder), "access_log_")
    scan = scan_log_text(spark, str(folder), "access_log_")
    staged = stage(with_file_no(scan, files), str(folder / "_staged"))
    assert staged.select("file_no", "block_start").distinct().count() > 12
    numbered = number_lines(staged, str(folder / "_offsets"))
    got = [(r["line_no"], r["file_no"], r["line"]) for r in numbered.orderBy("line_no").collect()]
    number = {path: n for n, path in enumerate(sorted(log_paths(folder)), start=1)}
    want = [(n, number[p], line) for n, (p, line) in enumerate(expected_lines(log_paths(folder)))]
    assert got == want

    sizes = batch_by_record_count(numbered, 1500).groupBy("batch_id").count().orderBy("batch_id")
    counts = [r["count"] for r in sizes.collect()]
    assert counts[:-1] == [1500] * (len(counts) - 1) and sum(counts) == len(want) and 0 < counts[-1] <= 1500
    crossing = batch_by_record_count(numbered, 1500).where("batch_id = 1").select("file_no").distinct().count()
    assert crossing == 2
    by_file = {r["batch_id"]: r["count"] for r in batch_by_file(staged).groupBy("batch_id").count().collect()}
    assert set(by_file) == {1, 2, 3, 6}


def test_offsets_do_not_shuffle_lines(spark, folder):
    files = list_log_files(spark, str(folder), "access_log_")
    staged = stage(
        with_file_no(scan_log_text(spark, str(folder), "access_log_"), files), str(folder / "_staged2")
    )
    numbered = number_lines(staged, str(folder / "_offsets2"))
    plan = batch_by_record_count(numbered, 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("size", [0, -1])
def test_batch_size_must_be_positive(spark, size):
    with pytest.raises(ValueError, match="positive"):
        batch_by_record_count(spark.range(1).withColumnRenamed("id", "line_no"), size)


def test_an_unlisted_file_fails_the_job(spark, folder):
    files = list_log_files(spark, str(folder), "access_log_").where("file_no <> 3")
    scan = with_file_no(scan_log_text(spark, str(folder), "access_log_"), files)
    with pytest.raises(Exception, match="not in the listing"):
        scan.collect()


def test_compressed_files_are_read(spark, folder, tmp_path):
    import gzip

    with gzip.open(tmp_path / "access_log_1.gz", "wb") as out:
        out.write((LINE % ("h", "a", 7) + "\n").encode())
    assert scan_log_text(spark, str(tmp_path), "access_log_").count() == 1


def test_view_over_a_folder(spark, folder):
    log_table_view(spark, str(folder), "access_log_", "logs_here")
    by_sql = spark.sql(
        """
        SELECT log_date, status_code, count(*) AS request_count, sum(bytes_transferred) AS total_bytes
        FROM logs_here WHERE host IS NOT NULL GROUP BY log_date, status_code
        """
    )
    assert by_sql.collect() == daily_traffic(spark.table("logs_here")).collect()
    assert spark.table("logs_here").where(F.col("host").contains("é")).count() > 0


def test_scan_reads_only_what_is_asked(spark, folder):
    plan = scan_log_text(spark, str(folder), "access_log_").select("source_file").where("source_file IS NULL")
    assert "decode" not in plan._jdf.queryExecution().executedPlan().toString().lower()


def test_numbers_are_the_same_without_any_broadcast(spark, folder, small_splits, monkeypatch):
    from accesslens.operators import batching
    from accesslens.sources import log_files

    monkeypatch.setattr(log_files, "broadcast_if_small", lambda frame: frame)
    monkeypatch.setattr(batching, "broadcast_if_small", lambda frame: frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = list_log_files(spark, str(folder), "access_log_")
        located = with_file_no(scan_log_text(spark, str(folder), "access_log_"), files)
        staged = stage(located, str(folder / "_staged3"))
        numbered = number_lines(staged, str(folder / "_offsets3"))
        assert "BroadcastHashJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
        got = [r["line"] for r in numbered.orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [line for _, line in expected_lines(log_paths(folder))]


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    """Spark alone takes a task per folder."""
    for n in range(70):
        (tmp_path / f"chunk={n}").mkdir()
        (tmp_path / f"chunk={n}" / "log_1").write_text("x\n")
    context, setting = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(setting)
    context.setJobGroup("listing", "")
    try:
        assert open_logs(spark, f"{tmp_path}/chunk=*", "log_").count() == 70
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert max(stage.numTasks for stage in stages) <= 4 * context.defaultParallelism < 70
    assert spark.conf.get(setting) == usual
