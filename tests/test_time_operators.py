"""Visits, as-of joins and interval joins against plain Python, and the plans they get."""

import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from accesslens.operators import intervals
from accesslens.operators.asof import asof_join
from accesslens.operators.intervals import in_intervals
from accesslens.operators.visits import visits
from accesslens.session import scratch_path

DAY = dt.datetime(1995, 7, 1)


def at(seconds):
    return None if seconds is None else DAY + dt.timedelta(seconds=seconds)


def seconds(instant):
    return None if instant is None else (instant - DAY).total_seconds()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def no_pairwise_join(text):
    return not re.search("NestedLoop|Cartesian", text)


# -- visits -----------------------------------------------------------------


def random_requests(seed=1, count=900):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(0, 90_000, 7)] if n % 50 == 0 else range(0, 90_000, 7)), n) for n in range(count)]
    return rows + [("edge", 0, 1), ("edge", 1800, 1), ("edge", 3601, 1), ("edge", 21_599, 1), ("edge", 21_600, 1)]


def brute_visits(rows, pause):
    keyed = defaultdict(list)
    for host, when, size in rows:
        if host is not None and when is not None:
            keyed[host].append((when, size))
    found = []
    for host, requests in keyed.items():
        last, number = None, 0
        for when, size in sorted(requests):
            if last is None or when - last > pause:
                number += 1
                found.append([host, number, when, when, 0, 0])
            found[-1][3:] = [when, found[-1][4] + 1, found[-1][5] + size]
            last = when
    return sorted(map(tuple, found))


@pytest.mark.parametrize("pause, time_slice", [(1800, 21_600), (600, 1000), (60, 30), (5000, 100)])
def test_visits(spark, pause, time_slice):
    rows = random_requests()
    frame = spark.createDataFrame([(h, at(s), n) for h, s, n in rows], "host string, requested_at timestamp, n int").repartition(6)
    found = visits(frame, pause=pause, time_slice=time_slice, sums={"size": F.col("n")}).collect()
    got = sorted((r.host, r.visit, seconds(r.started_at), seconds(r.ended_at), r.requests, r["size"]) for r in found)
    assert got == brute_visits(rows, pause)


def test_visits_of_nothing(spark):
    frame = spark.createDataFrame([("a", None), (None, DAY)], "host string, requested_at timestamp")
    assert visits(frame).collect() == []


def test_a_frequent_host_is_ordered_by_time_slices(spark):
    """Requests are added up per second before the first shuffle, and only then put in order."""
    text = plan(visits(spark.createDataFrame([("a", DAY)], "host string, requested_at timestamp")))
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", text)
    assert len(dealt) == 3
    assert "_slice" in dealt[1] and "_slice" not in dealt[0]
    assert text.rindex("HashAggregate") > text.rindex("Exchange hashpartitioning")


# -- as-of join ---------------------------------------------------------------


def brute_asof(left, right, exact, tolerance):
    found = []
    for n, key, when in left:
        best = None
        for key2, when2, number in right:
            if None in (key, when, when2) or key != key2:
                continue
            if (when2 < when or exact and when2 == when) and (tolerance is None or when - when2 <= tolerance):
                best = max(best or (when2, number), (when2, number))
        found.append((n, key, when, *(best or (None, None))))
    return sorted(found, key=repr)


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("tolerance, time_slice", [(None, 900), (300, 60), (None, 7)])
def test_asof_join(spark, exact, tolerance, time_slice):
    rng = random.Random(3)
    when = lambda: rng.choice([None, *range(0, 6000, 5)]) if rng.random() < 0.05 else rng.randrange(0, 6000, 5)
    key = lambda: rng.choice(["hot", "hot", "a", "b", None, "left only"])
    left = [(n, key(), when()) for n in range(400)]
    right = [(rng.choice(["hot", "hot", "a", "b", None, "right only"]), when(), n) for n in range(120)]
    lefts = spark.createDataFrame([(n, k, at(w)) for n, k, w in left], "_row int, path string, t timestamp").repartition(5)
    rights = spark.createDataFrame([(k, at(w), n) for k, w, n in right], "path string, t timestamp, number int").repartition(3)
    found = asof_join(lefts, rights, ["path"], "t", ["number"], exact=exact, tolerance=tolerance, time_slice=time_slice)
    assert found.columns == ["_row", "path", "t", "previous_t", "previous_number"]
    got = [(r[0], r[1], seconds(r[2]), seconds(r[3]), r[4]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(((n, k, w and float(w) if w else (None if w is None else 0.0), p if p is None else float(p), m) for n, k, w, p, m in brute_asof(left, right, exact, tolerance)), key=repr)


def test_asof_join_of_nothing(spark):
    left = spark.createDataFrame([("a", DAY), (None, None)], "k string, t timestamp")
    none = left.where("false").withColumn("x", F.lit(1))
    assert sorted(map(tuple, asof_join(left, none, ["k"], "t", ["x"]).collect()), key=repr) == [("a", DAY, None, None), (None, None, None, None)]
    assert asof_join(none, left.withColumn("y", F.lit(1)), ["k"], "t", ["y"]).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left.withColumn("previous_x", F.lit(1)), none, ["k"], "t", ["x"])


def test_asof_join_compares_no_pairs(spark):
    left = spark.createDataFrame([("a", DAY)], "k string, t timestamp")
    text = plan(asof_join(left, left.withColumn("x", F.lit(1)), ["k"], "t", ["x"]))
    assert no_pairwise_join(text) and "Join" not in text
    assert all("_slice" in keys for keys in re.findall(r"Window \[last\(_match.*?\], \[(.*?)\], \[_micros", text))


# -- interval join ------------------------------------------------------------


def brute_inside(points, spans):
    return sorted(
        (n, name)
        for n, key, when in points
        for name, key2, first, last in spans
        if None not in (key, when, first, last) and key == key2 and first <= when <= last
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_intervals(spark, broadcast, monkeypatch):
    """From a single second to a year, nested, touching, reversed, repeated and unknown ones."""
    if not broadcast:
        monkeypatch.setattr(intervals, "broadcast_if_small", lambda frame: frame)
    rng = random.Random(9)
    points = [(n, rng.choice(["a", "b", None]), rng.choice([None, *range(-2000, 4000)])) for n in range(500)]
    spans = [("year", "a", -10**7, 2 * 10**7), ("same", "a", 5, 5), ("same", "a", 5, 5), ("reversed", "a", 9, 3), ("none", "b", None, 5)]
    spans += [(f"s{n}", rng.choice(["a", "b", None]), first := rng.randrange(-2000, 4000), first + rng.choice([0, 1, 2, 63, 64, 65, 900])) for n in range(60)]
    points += [(1000 + n, "a", n) for n in range(8)]
    left = spark.createDataFrame([(n, k, at(w)) for n, k, w in points], "_point int, path string, t timestamp").repartition(4)
    right = spark.createDataFrame([(n, k, at(a), at(b)) for n, k, a, b in spans], "name string, path string, a timestamp, b timestamp")
    path = scratch_path(spark, "spans")
    found = in_intervals(left, right, "t", "a", "b", ["path"], path)
    assert found.columns == ["_point", "path", "t", "name", "a", "b"]
    assert sorted((r._1 if False else r["_point"], r.name) for r in found.collect()) == brute_inside(points, spans)
    assert no_pairwise_join(plan(found))
    without = in_intervals(left.drop("path"), right.drop("path"), "t", "a", "b")
    every = brute_inside([(n, 1, w) for n, _, w in points], [(s, 1, a, b) for s, _, a, b in spans])
    assert sorted((r["_point"], r.name) for r in without.collect()) == every
    assert no_pairwise_join(plan(without))


def test_intervals_make_few_rows(spark):
    """A long interval is two rows at most, and a point a row per length of intervals."""
    points = spark.range(100).select(F.timestamp_seconds("id").alias("t"))
    spans = spark.createDataFrame([(at(0), at(10**9)), (at(3), at(10**9 + 3)), (at(1), at(2))], "a timestamp, b timestamp")
    path = scratch_path(spark, "spans")
    in_intervals(points, spans, "t", "a", "b", path=path).count()
    kept = spark.read.parquet(path)
    assert kept.count() <= 6 and kept.select("_level").distinct().count() == 2


def test_no_intervals(spark):
    points = spark.createDataFrame([(DAY,)], "t timestamp")
    spans = spark.createDataFrame([], "a timestamp, b timestamp")
    assert in_intervals(points, spans, "t", "a", "b").collect() == []
    with pytest.raises(ValueError, match="both sides"):
        in_intervals(points, spans.withColumnRenamed("a", "T"), "t", "T", "b")
