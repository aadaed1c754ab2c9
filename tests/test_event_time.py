"""Streams over event time: closed and open windows, late lines, restarts; and instants of lines."""

import os

import pytest
from pyspark.sql import functions as F

from accesslens.functions.log_time import with_instants
from accesslens.operators.parsing import parse_log_lines
from accesslens.operators.trends import requests_by_hour
from accesslens.sources.log_files import scan_log_text
from accesslens.streaming.event_time import (
    late_requests,
    stream_first_seen_hosts,
    stream_windowed_errors,
    windowed_errors,
)

LINE = '{host} - - [{day:02d}/Jul/1995:{hour:02d}:{minute:02d}:00 -0400] "GET /p HTTP/1.0" {status} 10\n'


def write(folder, name, rows, age):
    """A file of (host, day, hour, minute, status), older than those of a smaller age."""
    text = "".join(LINE.format(host=h, day=d, hour=hr, minute=m, status=s) for h, d, hr, m, s in rows)
    path = folder / name
    path.write_text(text + "garbage\n")
    os.utime(path, (10**9 - age, 10**9 - age))


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    write(folder, "log_1", [("a", 1, 0, 5, 200), ("b", 1, 0, 50, 404), ("a", 1, 3, 10, 500)], 30)
    write(folder, "log_2", [("c", 1, 6, 0, 200), ("a", 1, 2, 59, 500), ("a", 1, 7, 20, 503)], 20)
    # Its first line comes after its window was closed, its second just before.
    write(folder, "log_3", [("late", 1, 0, 30, 404), ("b", 1, 3, 30, 200), ("d", 1, 9, 0, 200)], 10)
    return folder


def batch(spark, folder, **options):
    lines = with_instants(parse_log_lines(scan_log_text(spark, str(folder), "log_"))).where("is_valid")
    return windowed_errors(lines, **options)


def shown(frame, *columns):
    start = F.date_format("window_start", "dd HH:mm").alias("start")
    return sorted(map(tuple, frame.select(start, *columns).collect()))


def test_windows_close_once_the_watermark_has_passed(spark, logs, tmp_path):
    found = stream_windowed_errors(spark, str(logs), str(tmp_path / "work"), "log_")
    assert shown(found, "request_count", "error_count", "closed") == [
        ("01 04:00", 2, 1, True),
        ("01 06:00", 1, 1, True),
        ("01 07:00", 2, 1, True),
        ("01 10:00", 1, 0, True),
        ("01 11:00", 1, 1, False),
        ("01 13:00", 1, 0, False),
    ]
    late = late_requests(found, batch(spark, logs))
    assert shown(late, "late_requests", "late_errors") == [("01 04:00", 1, 1)]


def test_enough_delay_gives_what_a_batch_gives(spark, logs, tmp_path):
    for window, slide in (("1 hour", None), ("3 hours", "1 hour")):
        found = stream_windowed_errors(spark, str(logs), str(tmp_path / f"work-{slide is None}"), "log_", window, slide, delay="1 day")
        whole = batch(spark, logs, window=window, slide=slide)
        assert shown(found, "request_count", "error_count") == shown(whole, "request_count", "error_count")
        assert late_requests(found, whole).count() == 0


def test_a_stream_goes_on_where_it_was(spark, logs, tmp_path):
    """Files that come later, and a second call without any, count once."""
    work = str(tmp_path / "work")
    run = lambda: stream_windowed_errors(spark, str(logs), work, "log_", delay="1 day", files_per_trigger=2)
    run()
    write(logs, "log_4", [("a", 1, 9, 30, 500), ("e", 3, 0, 0, 200)], 0)
    run()
    found = run()
    assert shown(found, "request_count", "error_count") == shown(batch(spark, logs), "request_count", "error_count")
    assert {row.closed for row in found.where("window_start < '1995-07-02'").collect()} == {True}


def test_first_seen_hosts(spark, logs, tmp_path, monkeypatch):
    work = str(tmp_path / "work")
    first = lambda frame: {r.host: r.first_seen.strftime("%d %H:%M") for r in frame.collect()}
    found = stream_first_seen_hosts(spark, str(logs), work, "log_")
    wanted = {"a": "01 04:05", "b": "01 04:50", "c": "01 10:00", "d": "01 13:00", "late": "01 04:30"}
    assert first(found) == wanted
    said = spark.read.parquet(f"{work}/hosts").count()
    assert said == 5
    # An earlier request of a known host and a new one: state survived, and only these are said.
    write(logs, "log_4", [("b", 1, 0, 10, 200), ("a", 2, 0, 0, 200), ("new", 2, 0, 0, 200)], 0)
    assert first(stream_first_seen_hosts(spark, str(logs), work, "log_")) == wanted | {"b": "01 04:10", "new": "02 04:00"}
    assert spark.read.parquet(f"{work}/hosts").count() == said + 2


def test_first_seen_hosts_keep_a_part_of_the_state_per_core(spark, logs, tmp_path):
    """Not one per shuffle partition: each costs every micro-batch time. An equal request is not said again."""
    work, usual = str(tmp_path / "work"), spark.conf.get("spark.sql.shuffle.partitions")
    write(logs, "log_4", [("a", 1, 0, 5, 200), ("b", 1, 0, 50, 200)], 0)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        found = stream_first_seen_hosts(spark, str(logs), work, "log_")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert found.count() == spark.read.parquet(f"{work}/hosts").count() == 5
    parts = spark.read.format("state-metadata").load(f"{work}/progress").select("numPartitions").collect()
    assert [row.numPartitions for row in parts] == [spark.sparkContext.defaultParallelism]


STAMPS = [
    ("01/Jul/1995:00:00:01 -0400", "1995-07-01 04:00:01"),
    ("31/Dec/1999:23:59:59 -0730", "2000-01-01 07:29:59"),
    ("29/Feb/1996:12:00:00  -0000", "1996-02-29 12:00:00"),
    ("29/Feb/1995:12:00:00 -0400", None),
    ("00/Jul/1995:00:00:00 -0400", None),
    ("01/Foo/1995:00:00:00 -0400", None),
    ("01/Jul/1995:24:00:00 -0400", None),
    ("01/Jul/1995:00:61:00 -0400", None),
    ("01/Jul/1995:00:00:00 -9999", None),
]


def test_instants(spark):
    lines = [(i, f'h[0] - -  [{stamp}] "GET /[x] HTTP/1.0" 200 1') for i, (stamp, _) in enumerate(STAMPS)] + [(99, "garbage"), (100, None)]
    parsed = parse_log_lines(spark.createDataFrame(lines, "n int, line string"))
    found = with_instants(parsed).select("n", F.date_format("requested_at", "yyyy-MM-dd HH:mm:ss")).collect()
    assert dict(map(tuple, found)) == {i: wanted for i, (_, wanted) in enumerate(STAMPS)} | {99: None, 100: None}


def test_hours_without_requests(spark):
    times = spark.createDataFrame([("1995-07-01 23:59:59",), ("1995-07-02 02:00:00",), (None,)], "t string")
    rows = requests_by_hour(times.select(F.try_to_timestamp("t").alias("requested_at"))).orderBy("hour").collect()
    assert [(r.hour.hour, r.request_count) for r in rows] == [(23, 1), (0, 0), (1, 0), (2, 1)]
    assert requests_by_hour(times.where("false").select(F.try_to_timestamp("t").alias("requested_at"))).collect() == []
