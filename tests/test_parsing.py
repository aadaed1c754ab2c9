"""Hand-written lines at the edges of the grammar, with the fields they must give."""

import random
import re

import pytest
from pyspark.sql import functions as F

from accesslens.operators.aggregates import malformed_count
from accesslens.functions import is_error
from accesslens.operators.parsing import filter_valid, malformed_lines, parse_log_lines
from accesslens.schema import LOG_GROUPS, LOG_PATTERN
from accesslens.sources import trim_nonblank

T = "[01/Jul/1995:00:00:01 -0400]"
GOOD = f'h1 - - {T} "GET /a.html HTTP/1.0" 200 6245'


def fields(**changed):
    base = {
        "host": "h1",
        "log_date": "01/Jul/1995",
        "log_hour": "00",
        "http_method": "GET",
        "resource_path": "/a",
        "protocol_version": "HTTP/1.0",
        "status_code": 200,
        "bytes_raw": "1",
        "bytes_transferred": 1,
    }
    return {**base, **changed}


VALID = {
    GOOD: fields(resource_path="/a.html", bytes_raw="6245", bytes_transferred=6245),
    f'h1 - - {T} "GET /a.html" 304 -': fields(
        resource_path="/a.html", protocol_version=None, status_code=304, bytes_raw="-", bytes_transferred=0
    ),
    f'h1 - - {T} "GET /a"b HTTP/1.0" 404 12': fields(
        resource_path='/a"b', status_code=404, bytes_raw="12", bytes_transferred=12
    ),
    'h1 - - [99/Foo/0000:77:00:01 -0400] "GET /a HTTP/1.0" 200 1': fields(log_date="99/Foo/0000", log_hour="77"),
    f'h1 - - {T} "GET /a HTTP/1.0" 600 1': fields(status_code=600),
    f'h1 - - {T} "GET /a HTTP/1.0" 200 1x': fields(bytes_raw="1x", bytes_transferred=None),
    f'h1 - - {T} "GET /a HTTP/1.0" 200 99999999999999999999': fields(
        bytes_raw="99999999999999999999", bytes_transferred=None
    ),
    f'a|b - - {T} "GET /a HTTP/1.0" 500 5': fields(
        host="a|b", status_code=500, bytes_raw="5", bytes_transferred=5
    ),
    f'h1 - - {T} "GET /café HTTP/1.0" 200 1': fields(resource_path="/café"),
    f'h1 \t-  -\x0b{T}\f "GET\t/a  HTTP/1.0"   200\t1': fields(),
    f'h1 - - {T} "GET /a HTTP/1.0" 000 1': fields(status_code=0),
    f'h1 - - {T} "GET /$1\\n HTTP/1.0" 200 1': fields(resource_path="/$1\\n"),
}

MALFORMED = [
    f'h1 - - {T} "GET /a b HTTP/1.0" 404 12',
    f'h1 - - {T} "GET" 400 -',
    f'h1 - - {T} "" 400 -',
    f'h1 u - {T} "GET /a HTTP/1.0" 200 1',
    f'h1 - u {T} "GET /a HTTP/1.0" 200 1',
    GOOD.replace("-0400", "+0400"),
    f'h1 - - {T} "GET /a HTTP/1.0" 99 1',
    f'h1 - - {T} "GET /a HTTP/1.0" 2000 1',
    f'h1 - - {T} "GET /a HTTP/1.0" 200',
    f"{GOOD} extra",
    f'h1 - - [1/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1',
    "garbage",
    # As many newlines as a matched line has groups, though no text scan gives such a line.
    "x" + "\n".join("abcdefgh"),
    "a\n1\n2\n3\n4\n5\n6\n7\n8",
    "\n1\n2\n3\n4\n5\n6\n7\n8",
    f"\n{GOOD}",
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(line,) for line in [*VALID, *MALFORMED]]
    return parse_log_lines(spark.createDataFrame(rows, "line string")).cache()


@pytest.mark.parametrize("line", VALID, ids=range(len(VALID)))
def test_valid_line(parsed, line):
    row = parsed.where(F.col("line") == F.lit(line)).first().asDict()
    assert row.pop("line") == line and row.pop("is_valid")
    assert row == VALID[line]


def test_malformed_lines_have_no_fields(parsed):
    bad = parsed.where("host IS NULL").collect()
    assert sorted(r["line"] for r in bad) == sorted(MALFORMED)
    for row in bad:
        assert not row["is_valid"]
        assert all(row[c] is None for c in parsed.columns if c not in ("line", "is_valid"))


def test_filters_and_count_agree(parsed):
    assert filter_valid(parsed).count() == len(VALID)
    assert sorted(r["line"] for r in malformed_lines(parsed).collect()) == sorted(MALFORMED)
    assert malformed_lines(parsed).columns == ["line"]
    assert malformed_count(parsed).first()["malformed_count"] == len(MALFORMED)
    assert malformed_count(parsed.where("is_valid")).first()["malformed_count"] == 0


def test_trim_takes_control_characters_and_drops_blank_lines(spark):
    rows = [(f"\t \x00{GOOD}\x1f \r",), ("",), (" \t\x01 ",), (" ",), ("  a b  ",)]
    kept = trim_nonblank(spark.createDataFrame(rows, "line string"))
    # A no-break space lies above 0x20: it is neither trimmed nor blank.
    assert sorted(r["line"] for r in kept.collect()) == sorted([GOOD, " ", "a b"])


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_the_pattern_runs_once(spark):
    lines = spark.createDataFrame([(GOOD,)], "line string").repartition(2)
    parsed = parse_log_lines(lines)
    parsed.createOrReplaceTempView("parsed_once")
    view = spark.sql("SELECT host, status_code FROM parsed_once WHERE host IS NOT NULL AND status_code > 200")
    failed = filter_valid(parsed).where(is_error(F.col("status_code"))).select("status_code")
    frames = [parsed, parsed.drop("is_valid"), malformed_count(parsed), filter_valid(parsed), malformed_lines(parsed), failed, view]
    for frame in frames:
        text = plan_of(frame)
        assert text.count("regexp_replace(") == 1 and "RLIKE" not in text


def mutated_lines(count=6000, seed=11):
    """Lines put together from good and bad pieces, some with a character changed."""
    rng = random.Random(seed)
    spaces = [" "] * 150 + ["  ", "\t", "\x0b", "\f", "", "\xa0", "\x1c"]
    pieces = [
        ["h1", "a|b", "é.example", "\x01", "", "x y"],
        ["-"] * 9 + ["u", "--"],
        ["-"] * 9 + ["frank"],
        ["[01/Jul/1995:00:00:01"] * 9 + ["[1/Jul/1995:00:00:01", "[01/J_l/1995:99:99:99", "[01/Jül/1995:00:00:01"],
        ["-0400]"] * 9 + ["+0400]", "-040]"],
        ['"GET'] * 9 + ['GET', '""', '"'],
        ["/a", '/a"b', "/$1", "/\\d", '"', ""],
        ['HTTP/1.0"'] * 6 + ['"', 'HTTP/1.0', '" "', '"x"'],
        ["200"] * 9 + ["20", "2000", "20x", "٢٠٠"],
        ["-", "0", "17", "1x", "99999999999999999999", "+5", "-7", "1.5", "", "x\x85", "\x85", "5\x7f", "\x015"],
    ]
    for _ in range(count):
        line = "".join(rng.choice(p) + rng.choice(spaces) for p in pieces)
        if rng.random() < 0.3:
            at = rng.randrange(len(line))
            line = line[:at] + rng.choice(' "[]-:/\t\x00\x7fé9') + line[at + rng.randrange(2) :]
        yield line


def python_fields(line):
    match = re.fullmatch(LOG_PATTERN.removeprefix("^").removesuffix("$"), line, re.ASCII)
    if not match:
        return dict.fromkeys(LOG_GROUPS)
    fields = dict(zip(LOG_GROUPS, match.groups()))
    return {**fields, "status_code": int(fields["status_code"])}


def test_random_lines_parse_as_in_python(spark):
    control = "".join(map(chr, range(33)))
    raw = list(dict.fromkeys(mutated_lines()))
    lines = trim_nonblank(spark.createDataFrame(list(enumerate(raw)), "n int, line string"))
    parsed = parse_log_lines(lines).select("n", "line", "is_valid", *LOG_GROUPS, "bytes_transferred").collect()
    assert {r["n"] for r in parsed} == {n for n, line in enumerate(raw) if line.strip(control)}
    valid = 0
    for row in parsed:
        line = raw[row["n"]].strip(control)
        want = python_fields(line)
        assert row["line"] == line
        assert {g: row[g] for g in LOG_GROUPS} == want, line
        assert row["is_valid"] == (want["host"] is not None)
        size = want["bytes_raw"]
        if size is not None:
            number = 0 if size == "-" else int(size) if re.fullmatch(r"[+-]?[0-9]{1,18}", size) else None
            assert row["bytes_transferred"] == number, line
            valid += 1
    assert 300 < valid < len(parsed)
