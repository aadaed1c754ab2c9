"""Aggregates against plain Python on random lines, and the plans they get."""

import random
import re
from collections import Counter, defaultdict

import pytest

from accesslens.operators import aggregates
from accesslens.operators.aggregates import (
    BATCH,
    daily_traffic,
    hourly_errors,
    sorted_results,
    top_resources,
)
from accesslens.operators.batch_totals import (
    batch_metadata,
    malformed_samples,
    malformed_summary,
    run_totals,
)
from accesslens.operators.batching import batch_by_record_count
from accesslens.operators.parsing import parse_log_lines
from accesslens.plans.sql_variant import run_sql
from accesslens.session import scratch_path

SIZE = 400


def random_lines(count=3000, seed=5):
    """Rows (line_no, line, fields or None); one path holds a third of the lines."""
    rng = random.Random(seed)
    for n in range(count):
        if rng.random() < 0.05:
            yield n, f"broken {n}", None
            continue
        path = "/hot" if rng.random() < 0.33 else f"/p{rng.randrange(60)}"
        host = f"h{rng.randrange(40)}"
        day, hour = f"{rng.randrange(1, 4):02d}/{rng.choice(['Jul', 'Aug'])}/1995", f"{rng.randrange(24):02d}"
        status = rng.choice([200, 200, 200, 304, 399, 400, 404, 500, 599, 600])
        size = rng.choice(["-", "0", "17", "4096", "x9", "99999999999999999999"])
        line = f'{host} - - [{day}:{hour}:00:00 -0400] "GET {path} HTTP/1.0" {status} {size}'
        number = int(size) if size.isdigit() and len(size) < 19 else 0
        yield n, line, (host, day, hour, path, status, number)


@pytest.fixture(scope="module")
def rows():
    return list(random_lines())


@pytest.fixture(scope="module")
def batched(spark, rows):
    lines = spark.createDataFrame([(n, line) for n, line, _ in rows], "line_no bigint, line string")
    return batch_by_record_count(parse_log_lines(lines.repartition(5)), SIZE).cache()


def grouped(rows, key, per_batch):
    groups = defaultdict(list)
    for n, _, fields in rows:
        if fields:
            batch = (n // SIZE + 1,) if per_batch else ()
            groups[batch + key(*fields)].append(fields)
    return groups


def by(per_batch):
    return BATCH if per_batch else ()


@pytest.mark.parametrize("per_batch", [False, True])
def test_daily_traffic(batched, rows, per_batch):
    want = {
        key + (len(g), sum(f[5] for f in g))
        for key, g in grouped(rows, lambda h, d, hr, p, s, b: (d, s), per_batch).items()
    }
    got = daily_traffic(batched, by(per_batch)).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("per_batch", [False, True])
def test_hourly_errors(batched, rows, per_batch):
    want = set()
    for key, g in grouped(rows, lambda h, d, hr, p, s, b: (d, hr), per_batch).items():
        bad = [f for f in g if 400 <= f[4] <= 599]
        want.add(key + (len(bad), len(g), round(len(bad) / len(g), 6), len({f[0] for f in bad})))
    got = {tuple(r) for r in hourly_errors(batched, by(per_batch)).collect()}
    assert got == want and any(row[-4] == 0 for row in want) == per_batch


@pytest.mark.parametrize("per_batch", [False, True])
@pytest.mark.parametrize("limit", [1, 20, 100])
def test_top_resources(batched, rows, per_batch, limit):
    ranked = defaultdict(list)
    for key, g in grouped(rows, lambda h, d, hr, p, s, b: (p,), per_batch).items():
        ranked[key[:-1]].append((-len(g), key[-1], sum(f[5] for f in g), len({f[0] for f in g})))
    want = {
        batch + (path, -count, size, hosts)
        for batch, places in ranked.items()
        for count, path, size, hosts in sorted(places)[:limit]
    }
    # Equal counts straddle the limit, so the path decides who is in.
    assert {tuple(r) for r in top_resources(batched, limit, by(per_batch)).collect()} == want


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("per_batch", [False, True])
@pytest.mark.parametrize("limit", [1, 20, 100])
def test_top_resources_of_kept_counts(spark, batched, per_batch, limit, fits, monkeypatch):
    if not fits:
        monkeypatch.setattr(aggregates, "broadcast_if_small", lambda frame: frame)
    kept = top_resources(batched, limit, by(per_batch), path=scratch_path(spark, "top"))
    lazy = top_resources(batched, limit, by(per_batch))
    assert kept.columns == lazy.columns
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, lazy.collect()))


def host_shuffles_after_the_top(text):
    """Whether hosts are dealt out only above the join that leaves the top paths."""
    by_host = [m.start() for m in re.finditer(r"Exchange hashpartitioning\([^)]*host#", text)]
    return len(by_host) == 1 and by_host[0] < text.index("Join [")


def test_only_hosts_of_top_paths_are_shuffled(spark, batched):
    assert host_shuffles_after_the_top(plan(top_resources(batched, by=BATCH, path=scratch_path(spark, "top"))))
    assert host_shuffles_after_the_top(plan(top_resources(batched, by=BATCH)))
    assert host_shuffles_after_the_top(plan(top_resources(batched)))
    assert host_shuffles_after_the_top(plan(run_sql("query2", batched, scratch_path(spark, "top"))))


def test_batch_totals(batched, rows):
    wrong = Counter(n // SIZE + 1 for n, _, fields in rows if fields is None)
    sizes = Counter(n // SIZE + 1 for n, _, _ in rows)
    metadata = batch_metadata(batched)
    got = {tuple(r) for r in metadata.collect()}
    assert got == {(b, sizes[b], wrong[b], sizes[b] - wrong[b]) for b in sizes}
    for row in malformed_summary(metadata, malformed_samples(batched, ["line_no"])).collect():
        lines = [line for n, line, f in rows if f is None and n // SIZE + 1 == row["batch_id"]]
        assert (row["malformed_count"], row["sample_lines"]) == (len(lines), lines[:5])
    totals = run_totals(metadata).first()
    assert totals["total_records_processed"] == len(rows)
    assert totals["total_malformed_records"] == sum(wrong.values())
    assert (totals["total_batches"], float(totals["average_batch_size"])) == (8, 375.0)


def test_results_of_one_batch_add_up(batched, rows):
    valid = sum(f is not None for _, _, f in rows)
    count = daily_traffic(batched, BATCH).agg({"request_count": "sum"}).first()[0]
    total = hourly_errors(batched, BATCH).agg({"total_request_count": "sum"}).first()[0]
    assert count == total == valid


def test_sql_gives_the_same(batched):
    for name, frame in {
        "query1": daily_traffic(batched, BATCH),
        "query2": top_resources(batched, by=BATCH),
        "query3": hourly_errors(batched, BATCH),
    }.items():
        assert sorted(map(tuple, run_sql(name, batched).collect())) == sorted(map(tuple, frame.collect()))


def test_sorted_results(batched):
    rows = daily_traffic(batched)
    as_text = [(r["log_date"], r["status_code"]) for r in sorted_results(rows, "query1").collect()]
    assert as_text == sorted(as_text) and as_text[0][0] == "01/Aug/1995"
    calendar = [r["log_date"] for r in sorted_results(rows, "query1", by_calendar=True).collect()]
    order = ["01/Jul/1995", "02/Jul/1995", "03/Jul/1995", "01/Aug/1995", "02/Aug/1995", "03/Aug/1995"]
    assert list(dict.fromkeys(calendar)) == order


def test_calendar_order_survives_impossible_dates(spark):
    rows = spark.createDataFrame([("99/Foo/0000", 200), ("02/Jan/1995", 200)], "log_date string, status_code int")
    assert [r["log_date"] for r in sorted_results(rows, "query1", by_calendar=True).collect()] == [
        "02/Jan/1995",
        "99/Foo/0000",
    ]


def test_nothing_valid_and_nothing_at_all(spark):
    for lines in ([("broken",)], []):
        parsed = parse_log_lines(spark.createDataFrame(lines, "line string"))
        for query in (daily_traffic, top_resources, hourly_errors):
            assert query(parsed).count() == 0
    empty = spark.createDataFrame([], "batch_id int, host string")
    totals = run_totals(batch_metadata(empty)).first()
    assert tuple(totals) == (0, 0, 0, 0)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def lines_of(spark):
    return parse_log_lines(spark.createDataFrame([("x",)], "line string").repartition(3))


def test_tasks_send_only_their_best(spark):
    parsed = lines_of(spark)
    best = lambda lines, by: aggregates._most_requested(aggregates._resource_counts(lines, by), 20, by)
    assert "TakeOrderedAndProject" in plan(best(parsed, ()))
    batched = batch_by_record_count(parsed.selectExpr("*", "length(line) AS line_no"), 10)
    for frame in (best(batched, BATCH), malformed_samples(batched, ["line_no"])):
        steps = re.findall(r", (Final)|(hashpartitioning\(batch_id#\d+, \d+\))|, (Partial)", plan(frame))
        signs = [bool(s[0]) - bool(s[2]) for s in steps]
        assert signs and signs == [1, 0, -1] * (len(signs) // 3)


def test_aggregates_match_the_pattern_once(spark):
    # The top resources stage four columns in one job first, and read those twice: for counts and for hosts.
    for query, times in ((daily_traffic, 1), (top_resources, 0), (hourly_errors, 1)):
        text = plan(query(lines_of(spark)))
        assert text.count("regexp_replace(") == times and "RLIKE" not in text
