"""Totals, pivots, trends, sketches and parameters against plain Python, and the plans they get."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from accesslens.functions.parameters import query_parameters
from accesslens.operators.sketches import approx_bytes_quantiles, approx_hosts, merged_sketches, traffic_sketches
from accesslens.operators.trends import status_by_day, traffic_rollup, traffic_trend

COLUMNS = "host string, log_date string, resource_path string, status_code int, bytes_transferred bigint, batch_id int, is_valid boolean"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    days = ["30/Jun/1995", "01/Jul/1995", "02/Jul/1995", "09/Jul/1995", "10/Jul/1995", "45/Jul/1995"]
    made = []
    for n in range(4_000):
        if n % 40 == 0:
            made.append((None, None, None, None, None, n // 1_000, False))
            continue
        path = "/hot" if rng.random() < 0.3 else f"/p{rng.randrange(12)}"
        size = None if n % 31 == 0 else int(rng.paretovariate(1.1) * 100)
        made.append((f"h{rng.randrange(1_500)}", rng.choice(days), path, rng.choice([100, 200, 304, 404, 500, 799]), size, n // 1_000, True))
    return made


@pytest.fixture(scope="module")
def parsed(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(5).cache()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rollup(parsed, rows):
    wanted = defaultdict(lambda: [0, 0])
    for _, date, _, status, size, _, valid in rows:
        for key in ((date, status, 0), (date, None, 1), (None, status, 2), (None, None, 3)) if valid else ():
            wanted[key][0] += 1
            wanted[key][1] += size or 0
    found = traffic_rollup(parsed)
    assert {tuple(r)[:3]: list(r)[3:] for r in found.collect()} == wanted
    text = plan(traffic_rollup(parsed))
    assert text.count("Expand") == 1 and len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_status_classes(parsed, rows):
    wanted = defaultdict(Counter)
    for _, date, _, status, _, _, valid in rows:
        if valid:
            wanted[date][f"status_{status // 100}xx" if status < 600 else "other"] += 1
    found = status_by_day(parsed)
    for row in found.collect():
        counts = row.asDict()
        date, total = counts.pop("log_date"), counts.pop("request_count")
        assert {k: v for k, v in counts.items() if v} == wanted[date] and total == sum(wanted[date].values())
    assert found.count() == len(wanted)
    assert status_by_day(parsed.where("false")).collect() == []


def test_trend(parsed, rows):
    day = {"30/Jun/1995": 0, "01/Jul/1995": 1, "02/Jul/1995": 2, "09/Jul/1995": 9, "10/Jul/1995": 10}
    counts, errors = defaultdict(Counter), defaultdict(Counter)
    for _, date, path, status, _, _, valid in rows:
        if valid and date in day:
            counts[path][day[date]] += 1
            errors[path][day[date]] += 400 <= status <= 599
    found = traffic_trend(parsed)
    first = min(row.day for row in found.collect())
    assert str(first) == "1995-06-30"
    for row in found.collect():
        at, own = (row.day - first).days, counts[row.resource_path]
        before = [d for d in own if d < at]
        last = max(before) if before else None
        assert (row.request_count, row.previous_count) == (own[at], own[last] if before else None)
        assert (row.previous_day and (row.previous_day - first).days) == last
        assert row.change == (own[at] - own[last] if before else None)
        week = range(at - 6, at + 1)
        assert row.week_count == sum(own[d] for d in week)
        assert row.week_errors == sum(errors[row.resource_path][d] for d in week)
    assert found.count() == sum(map(len, counts.values()))
    # A row per path and day reaches the windows, dealt out by path.
    text = plan(traffic_trend(parsed))
    assert "SinglePartition" not in text and text.index("Window") < text.index("HashAggregate")


def test_sketches_merge_like_one(parsed, rows):
    """Per batch, stored and merged over batches: within their bounds of the exact answers."""
    sketches = traffic_sketches(parsed)
    assert {kind for name, kind in sketches.dtypes if name in ("hosts", "sizes")} == {"binary"}
    merged = merged_sketches(sketches).withColumn("batch_id", F.lit(-1))
    both = sketches.unionByName(merged)
    valid = [row for row in rows if row[6]]
    for row in approx_hosts(both).collect():
        own = [r for r in valid if row.batch_id in (-1, r[5])]
        exact = len({r[0] for r in own})
        assert row.requests == len(own) and abs(row.distinct_hosts - exact) <= 0.05 * exact
    for row in approx_bytes_quantiles(both).collect():
        sizes = np.array(sorted(r[4] for r in valid if row.batch_id in (-1, r[5]) and r[4] is not None))
        below, up_to = (sizes < row["size"]).mean(), (sizes <= row["size"]).mean()
        assert below - 0.02 <= row["quantile"] <= up_to + 0.02
    assert approx_bytes_quantiles(both).count() == 3 * 5


def test_sketches_of_nothing(parsed):
    assert traffic_sketches(parsed.where("NOT is_valid")).collect() == []
    sizeless = traffic_sketches(parsed.withColumn("bytes_transferred", F.lit(None).cast("bigint")))
    assert approx_bytes_quantiles(sizeless).collect() == [] and approx_hosts(sizeless).count() == 4


@pytest.mark.parametrize(
    "path, wanted",
    [
        ("/a", {}),
        ("/a?", {}),
        (None, None),
        ("/a?k=1&k=2&K=3", {"k": "2", "K": "3"}),
        ("/a?x=1&flag&=lost&&y=a=b#z=9", {"x": "1", "flag": "", "y": "a=b"}),
        ("/a?q=two+words%21&b%20c=%C3%A9", {"q": "two words!", "b c": "é"}),
        ("/a?bad=%zz&half=%4", {"bad": "%zz", "half": "%4"}),
        ("/a?x=1?y=2", {"x": "1?y=2"}),
    ],
)
def test_parameters(spark, path, wanted):
    row = spark.createDataFrame([(path,)], "path string").select(query_parameters(F.col("path"))).first()
    assert row[0] == wanted
