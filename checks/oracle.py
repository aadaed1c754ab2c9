"""The same answers in DuckDB SQL, worked out from the given tables alone."""

from __future__ import annotations

from accesslens.schema import LOG_GROUPS, LOG_PATTERN
from checks.inputs import BATCH_LINES, FILE_LINES

_SIZE = "CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)"

_LINES = f"""
lines AS (
    SELECT event_id AS line_no,
           CASE WHEN event_id % 97 = 0 THEN 'garbage ' || event_id
           ELSE 'u' || user_id || '.example.net - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S')
                || ' -0400] "GET /' || event_type || '/' || (event_id % 40)
                || CASE WHEN event_id % 13 = 0 THEN '' ELSE ' HTTP/1.0' END || '" '
                || CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN '404' ELSE '500' END
                        WHEN event_id % 10 = 0 THEN '304' ELSE '200' END
                || ' ' || CASE WHEN event_id % 10 = 0 THEN '-' ELSE {_SIZE} END
           END AS line
    FROM events
)"""

_GROUP_LIST = ", ".join(f"'{g}'" for g in LOG_GROUPS)

_PARSED = f"""{_LINES},
cut AS (
    SELECT line_no, line, regexp_matches(line, '{LOG_PATTERN}') AS is_valid,
           regexp_extract(line, '{LOG_PATTERN}', [{_GROUP_LIST}]) AS f
    FROM lines
),
parsed AS (
    SELECT line_no, line, is_valid,
           CASE WHEN is_valid THEN f.host END AS host,
           CASE WHEN is_valid THEN f.log_date END AS log_date,
           CASE WHEN is_valid THEN f.log_hour END AS log_hour,
           CASE WHEN is_valid THEN f.http_method END AS http_method,
           CASE WHEN is_valid THEN f.resource_path END AS resource_path,
           CASE WHEN is_valid THEN nullif(f.protocol_version, '') END AS protocol_version,
           CASE WHEN is_valid THEN TRY_CAST(f.status_code AS INTEGER) END AS status_code,
           CASE WHEN is_valid THEN f.bytes_raw END AS bytes_raw,
           CASE WHEN is_valid THEN
               CASE WHEN f.bytes_raw = '-' THEN 0 ELSE TRY_CAST(f.bytes_raw AS BIGINT) END
           END AS bytes_transferred,
           CAST(line_no // {BATCH_LINES} + 1 AS INTEGER) AS by_count,
           CAST(line_no // {2 * BATCH_LINES} + 1 AS INTEGER) AS by_double,
           CAST(line_no // {FILE_LINES} + 1 AS INTEGER) AS by_file
    FROM cut
)"""


def _lines(select: str) -> str:
    return f"WITH {_LINES}\n{select}"


def _parsed(select: str) -> str:
    return f"WITH {_PARSED}\n{select}"


_BYTES = "CAST(coalesce(sum(bytes_transferred), 0) AS BIGINT)"
_FAILED = "status_code BETWEEN 400 AND 599"


def _daily(batch: str = "", source: str = "parsed") -> str:
    shown = f"{batch} AS batch_id, " if batch else ""
    key = f"{batch}, " if batch else ""
    return f"""
        SELECT {shown}log_date, status_code, count(*) AS request_count, {_BYTES} AS total_bytes
        FROM {source} WHERE is_valid GROUP BY {key}log_date, status_code"""


def _hourly(batch: str = "") -> str:
    shown = f"{batch} AS batch_id, " if batch else ""
    key = f"{batch}, " if batch else ""
    return f"""
        SELECT {shown}log_date, log_hour,
               count(*) FILTER (WHERE {_FAILED}) AS error_request_count,
               count(*) AS total_request_count,
               round(count(*) FILTER (WHERE {_FAILED}) / count(*), 6) AS error_rate,
               count(DISTINCT host) FILTER (WHERE {_FAILED}) AS distinct_error_hosts
        FROM parsed WHERE is_valid GROUP BY {key}log_date, log_hour"""


_RESOURCES = f"""
        SELECT resource_path, count(*) AS request_count, {_BYTES} AS total_bytes,
               count(DISTINCT host) AS distinct_host_count
        FROM parsed WHERE is_valid GROUP BY resource_path
        ORDER BY request_count DESC, resource_path LIMIT 20"""


def _resources(batch: str) -> str:
    return f"""
        SELECT batch_id, resource_path, request_count, total_bytes, distinct_host_count
        FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY batch_id ORDER BY request_count DESC, resource_path) AS place
            FROM (
                SELECT {batch} AS batch_id, resource_path, count(*) AS request_count,
                       {_BYTES} AS total_bytes, count(DISTINCT host) AS distinct_host_count
                FROM parsed WHERE is_valid GROUP BY {batch}, resource_path
            )
        )
        WHERE place <= 20"""


def _batches(batch: str) -> str:
    return f"""
        SELECT {batch} AS batch_id, count(*) AS batch_size,
               count(*) FILTER (WHERE NOT is_valid) AS malformed_count,
               count(*) FILTER (WHERE is_valid) AS valid_records
        FROM parsed GROUP BY {batch}"""


_SUMMARY = """
        SELECT by_count AS batch_id, count(*) FILTER (WHERE NOT is_valid) AS malformed_count,
               coalesce(string_agg(line, '; ' ORDER BY line_no) FILTER (WHERE NOT is_valid AND nth <= 5), '')
                   AS sample
        FROM (
            SELECT *, row_number() OVER (PARTITION BY by_count, is_valid ORDER BY line_no) AS nth
            FROM parsed
        )
        GROUP BY by_count"""


# Half-up to two decimals in whole numbers, so that no binary fraction decides a tie.
def _mean(total: str, count: str) -> str:
    return f"(({total} * 200 + {count}) // (2 * {count})) / 100"


_TOTALS = f"""
        SELECT CAST(count(*) AS BIGINT) AS total_records_processed,
               count(*) FILTER (WHERE NOT is_valid) AS total_malformed_records,
               CAST(count(DISTINCT by_count) AS INTEGER) AS total_batches,
               {_mean("count(*)", "count(DISTINCT by_count)")} AS average_batch_size
        FROM parsed"""

# -- run history -------------------------------------------------------------

_RUNS = f"""
measured AS (
    SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS records,
           count(*) FILTER (WHERE l_returnflag = 'R') AS malformed,
           CAST(count(*) AS INTEGER) AS batches
    FROM lineitem GROUP BY l_orderkey
),
runs AS (
    SELECT o_orderkey AS run_id, o_orderpriority AS pipeline_name, 'all' AS query_name,
           o_orderstatus AS batch_strategy,
           coalesce(records, 0) AS total_records_processed,
           coalesce(malformed, 0) AS total_malformed_records,
           coalesce(batches, 0) AS total_batches,
           coalesce({_mean("records", "batches")}, 0.0) AS average_batch_size,
           o_totalprice AS runtime_seconds,
           strftime(o_orderdate, '%Y-%m-%d') AS executed_on
    FROM orders LEFT JOIN measured ON o_orderkey = l_orderkey
),
newest AS (
    SELECT r.* FROM runs r
    JOIN (SELECT batch_strategy, pipeline_name, max(run_id) AS run_id FROM runs
          GROUP BY batch_strategy, pipeline_name) m
    ON r.run_id = m.run_id
)"""


def _runs(select: str) -> str:
    return f"WITH {_RUNS}\n{select}"


_MEASURES = {
    "run_id": "run_id",
    "runtime_seconds": "runtime_seconds",
    "total_records": "total_records_processed",
    "malformed_records": "total_malformed_records",
    "total_batches": "total_batches",
    "average_batch_size": "average_batch_size",
}


def _compared(strategy: str) -> str:
    parts = [
        f"SELECT position, pipeline_name, '{label}' AS measure, CAST({column} AS DOUBLE) AS value FROM placed"
        for label, column in _MEASURES.items()
    ]
    union = "\n        UNION ALL ".join(parts)
    return f"""
        , placed AS (
            SELECT *, CAST(row_number() OVER (ORDER BY pipeline_name) AS INTEGER) AS position
            FROM newest WHERE batch_strategy = '{strategy}'
        ), compared AS (
        {union}
        )"""


_PIPELINES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SIDES = ", ".join(f"max(value) FILTER (WHERE pipeline_name = '{p}') AS \"{p}\"" for p in _PIPELINES)

_COUNTED = """
        , flags(query_name, flag) AS (VALUES ('query1', 'A'), ('query2', 'N'), ('query3', 'R')),
        stored AS (
            SELECT query_name, l_orderkey, count(*) AS n
            FROM lineitem JOIN flags ON l_returnflag = flag GROUP BY query_name, l_orderkey
        ),
        counted AS (
            SELECT f.query_name, r.run_id, r.pipeline_name, coalesce(s.n, 0) AS row_count
            FROM newest r CROSS JOIN flags f
            LEFT JOIN stored s ON s.query_name = f.query_name AND s.l_orderkey = r.run_id
            WHERE r.batch_strategy = 'O'
        )"""

_RUN_ROWS = {
    # table name -> rows a run over the lines stores, batches by the given column
    "run_metadata": "SELECT 1",
    "batch_metadata": "SELECT DISTINCT {batch} FROM parsed",
    "malformed_summary": "SELECT DISTINCT {batch} FROM parsed",
    "query1_daily_traffic": "SELECT DISTINCT {batch}, log_date, status_code FROM parsed WHERE is_valid",
    "query2_top_resources": (
        "SELECT * FROM (SELECT {batch}, row_number() OVER (PARTITION BY {batch}) AS nth "
        "FROM (SELECT DISTINCT {batch}, resource_path FROM parsed WHERE is_valid)) WHERE nth <= 20"
    ),
    "query3_hourly_errors": "SELECT DISTINCT {batch}, log_date, log_hour FROM parsed WHERE is_valid",
}


def _row_counts(batch: str, shown: str) -> str:
    return "\n        UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {shown}, (SELECT count(*) FROM ({rows.format(batch=batch)})) AS row_count"
        for name, rows in _RUN_ROWS.items()
    )


_REQUESTS = f"""{_PARSED},
requests AS (
    SELECT *, strptime(regexp_extract(line, '\\[(\\S+) ', 1), '%d/%b/%Y:%H:%M:%S') + INTERVAL 4 HOUR AS requested_at
    FROM parsed WHERE is_valid
)"""


def _requests(select: str) -> str:
    return f"WITH {_REQUESTS}\n{select}"


def _shown(instant: str) -> str:
    return f"strftime({instant}, '%Y-%m-%d %H:%M:%S')"


# Zones -0730, -0000 and -0400 by turns, and days that no month has.
_ZONED = f"""{_PARSED},
zoned AS (
    SELECT line_no, is_valid,
           CASE WHEN is_valid AND line_no % 41 <> 0 THEN
               strptime(regexp_extract(line, '\\[(\\S+) ', 1), '%d/%b/%Y:%H:%M:%S')
               + to_minutes(CASE line_no % 3 WHEN 0 THEN 450 WHEN 1 THEN 0 ELSE 240 END)
           END AS requested_at
    FROM parsed
)"""


def _visits(source: str, key: str, pause: int) -> str:
    return f"""
        marked AS (
            SELECT *, coalesce(epoch(requested_at) - epoch(lag(requested_at) OVER w) > {pause}, true) AS begins
            FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY requested_at)
        ), visited AS (
            SELECT *, sum(begins::INT) OVER (PARTITION BY {key} ORDER BY requested_at, begins DESC
                                             ROWS UNBOUNDED PRECEDING)::BIGINT AS visit
            FROM marked
        )"""


def _asof(by: str, later: str, most: str = "") -> str:
    return f"""
        , errors AS (
            SELECT {by}, requested_at, max(line_no) AS error_line, arg_max(status_code, line_no) AS error_status
            FROM requests WHERE {_FAILED} GROUP BY {by}, requested_at
        ), found AS (
            SELECT r.line_no, r.{by}, e.error_line, e.error_status,
                   (epoch(r.requested_at) - epoch(e.requested_at))::BIGINT AS seconds_since
            FROM requests r ASOF LEFT JOIN errors e ON r.{by} = e.{by} AND r.requested_at {later} e.requested_at
        )
        SELECT line_no, {by}, {", ".join(f"CASE WHEN true {most} THEN {c} END AS {c}" for c in ("error_line", "error_status", "seconds_since"))}
        FROM found"""


def _windows(hours: int, every: int, delay: str) -> str:
    return f"""
        SELECT {_shown("s")} AS window_start, count(*) AS request_count,
               count(*) FILTER (WHERE {_FAILED}) AS error_count, s + INTERVAL {hours} HOUR <= passed AS closed
        FROM (
            SELECT *, time_bucket(INTERVAL {every} HOUR, requested_at) - to_hours(back) AS s
            FROM requests, (SELECT unnest(range(0, {hours}, {every})) AS back)
        ), (SELECT max(requested_at) - INTERVAL {delay} AS passed FROM requests)
        GROUP BY s, passed"""


_BATCHED = """
        , batched AS (
            SELECT by_count AS batch_id, host, bytes_transferred FROM parsed WHERE is_valid
            UNION ALL SELECT 0, host, bytes_transferred FROM parsed WHERE is_valid
        )"""

ORACLE: dict[str, str] = {
    "request_instants": f"""WITH {_ZONED}
        SELECT line_no, {_shown("requested_at")} AS requested_at FROM zoned""",
    "requests_by_hour": f"""WITH {_ZONED},
        hours AS (SELECT date_trunc('hour', requested_at) AS h, count(*) AS n FROM zoned WHERE requested_at IS NOT NULL GROUP BY h),
        every AS (SELECT unnest(generate_series((SELECT min(h) FROM hours), (SELECT max(h) FROM hours), INTERVAL 1 HOUR)) AS h)
        SELECT {_shown("h")} AS hour, coalesce(n, 0) AS request_count FROM every LEFT JOIN hours USING (h)""",
    "host_sessions": _requests(f"""
        , {_visits("requests", "host", 1800)}
        SELECT host, visit, {_shown("min(requested_at)")} AS started_at, {_shown("max(requested_at)")} AS ended_at,
               count(*) AS requests, {_BYTES} AS total_bytes, count(*) FILTER (WHERE {_FAILED}) AS errors
        FROM visited GROUP BY host, visit"""),
    "asof_previous_error": _requests(_asof("resource_path", ">")),
    "asof_recent_error_of_host": _requests(_asof("host", ">=", "AND seconds_since <= 172800")),
    "errors_in_incidents": _requests(f"""
        , broken AS (SELECT * FROM requests WHERE status_code >= 500), {_visits("broken", "resource_path", 21600)},
        incidents AS (
            SELECT resource_path AS path, visit, min(requested_at) AS started_at, max(requested_at) AS ended_at
            FROM visited GROUP BY path, visit HAVING count(*) >= 3
        )
        SELECT path, visit, {_shown("i.started_at")} AS started_at, {_shown("i.ended_at")} AS ended_at,
               count(*) AS request_count, count(*) FILTER (WHERE {_FAILED}) AS error_count,
               count(DISTINCT host) AS distinct_hosts
        FROM requests r JOIN incidents i ON r.requested_at BETWEEN i.started_at AND i.ended_at
        GROUP BY path, visit, i.started_at, i.ended_at"""),
    "stream_windowed_errors": _requests(_windows(1, 1, "2 HOUR")),
    "stream_sliding_errors": _requests(_windows(6, 2, "1 DAY")),
    "stream_first_seen_hosts": _requests(f"SELECT host, {_shown('min(requested_at)')} AS first_seen FROM requests GROUP BY host"),
    "traffic_rollup": _parsed(f"""
        SELECT log_date, status_code, CAST(grouping(log_date, status_code) AS INTEGER) AS level,
               count(*) AS request_count, {_BYTES} AS total_bytes
        FROM parsed WHERE is_valid GROUP BY CUBE (log_date, status_code)"""),
    "status_by_day": _parsed(
        "SELECT log_date, "
        + ", ".join(f"count(*) FILTER (WHERE status_code // 100 = {n}) AS status_{n}xx" for n in range(1, 6))
        + ", count(*) FILTER (WHERE status_code // 100 NOT BETWEEN 1 AND 5) AS other, count(*) AS request_count "
        "FROM parsed WHERE is_valid GROUP BY log_date"
    ),
    "traffic_trend": _parsed(f"""
        , daily AS (
            SELECT resource_path, strptime(log_date, '%d/%b/%Y')::DATE AS d, count(*) AS request_count,
                   count(*) FILTER (WHERE {_FAILED}) AS errors
            FROM parsed WHERE is_valid GROUP BY ALL
        )
        SELECT resource_path, strftime(d, '%Y-%m-%d') AS day, request_count,
               strftime(lag(d) OVER p, '%Y-%m-%d') AS previous_day, lag(request_count) OVER p AS previous_count,
               request_count - lag(request_count) OVER p AS change,
               (sum(request_count) OVER r)::BIGINT AS week_count, (sum(errors) OVER r)::BIGINT AS week_errors
        FROM daily
        WINDOW p AS (PARTITION BY resource_path ORDER BY d),
               r AS (PARTITION BY resource_path ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"""),
    "approx_hosts": _parsed(_BATCHED + """
        SELECT batch_id, count(*) AS requests, count(DISTINCT host) AS exact_hosts, true AS within
        FROM batched GROUP BY batch_id"""),
    "approx_bytes_quantiles": _parsed(_BATCHED + """
        SELECT batch_id, quantile, count(bytes_transferred) AS sizes, true AS within
        FROM batched, (SELECT unnest([0.5, 0.9, 0.99])::DOUBLE AS quantile)
        WHERE bytes_transferred IS NOT NULL GROUP BY batch_id, quantile"""),
    "query_parameters": _parsed("""
        SELECT parameter, value, count(*) AS request_count, count(DISTINCT host) AS distinct_hosts
        FROM (
            SELECT host, unnest(['k', 'tag', 'flag']) AS parameter, unnest([
                CASE WHEN line_no % 3 = 0 THEN 'last' ELSE json_extract_string(props, '$.k') END,
                event_type || ' ' || (line_no % 5), '']) AS value
            FROM parsed JOIN events ON event_id = line_no WHERE is_valid
        )
        GROUP BY parameter, value"""),
    "list_log_files": f"""
        SELECT DISTINCT CAST(event_id // {FILE_LINES} + 1 AS INTEGER) AS file_no,
               lpad(CAST(event_id // {FILE_LINES} AS VARCHAR), 9, '0') AS chunk
        FROM events""",
    "scan_log_text": _lines(f"SELECT CAST(line_no // {FILE_LINES} + 1 AS INTEGER) AS file_no, line FROM lines"),
    "log_table_view": _parsed("""
        SELECT host, log_date, log_hour, http_method, resource_path, protocol_version, status_code, bytes_raw
        FROM parsed WHERE is_valid"""),
    "read_run_tables": _parsed(_SUMMARY),
    "batch_by_record_count": _parsed("SELECT line_no, by_count AS batch_id, line FROM parsed"),
    "batch_by_file": _parsed("SELECT by_file AS batch_id, line FROM parsed"),
    "stream_file_batches": _parsed(_daily("by_file")),
    "stream_top_resources": _parsed(_resources("by_file")),
    "stream_hourly_errors": _parsed(_hourly("by_file")),
    "stream_batches": _parsed(f"SELECT *, true AS timed FROM ({_batches('by_file')})"),
    "stream_malformed": _parsed(f"SELECT batch_id, malformed_count FROM ({_batches('by_file')})"),
    "scan_latin_text": _lines("SELECT line_no || ' \u00e9\u00fc\u00df ' || line AS line FROM lines"),
    "parse_log_lines": _parsed("""
        SELECT line_no, host, log_date, log_hour, http_method, resource_path, protocol_version,
               status_code, bytes_raw, bytes_transferred
        FROM parsed"""),
    "filter_valid": _parsed("SELECT line_no, host, resource_path FROM parsed WHERE is_valid"),
    "malformed_lines": _parsed("SELECT line_no, line FROM parsed WHERE NOT is_valid"),
    "clean_bytes": f"""
        SELECT line_no, bytes_raw,
               CASE WHEN bytes_raw = '-' THEN 0
                    WHEN regexp_full_match(bytes_raw, '[0-9]{{1,18}}') THEN CAST(bytes_raw AS BIGINT)
               END AS bytes_transferred
        FROM (
            SELECT event_id AS line_no,
                   CASE WHEN event_id % 10 = 0 THEN '-'
                        WHEN event_id % 11 = 0 THEN {_SIZE} || 'x'
                        WHEN event_id % 17 = 0 THEN '99999999999999999999'
                        ELSE {_SIZE} END AS bytes_raw
            FROM events
        )""",
    "cast_status": _parsed("SELECT line_no, status_code FROM parsed WHERE is_valid"),
    "error_predicate": _parsed(f"SELECT line_no, status_code FROM parsed WHERE is_valid AND {_FAILED}"),
    "error_rate": _parsed(f"""
        SELECT host, coalesce(round(count(*) FILTER (WHERE {_FAILED}) / nullif(count(host), 0), 6), 0) AS error_rate
        FROM parsed GROUP BY host"""),
    "trim_nonblank": _lines("""
        SELECT line_no, regexp_replace(padded, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line
        FROM (
            SELECT line_no,
                   CASE WHEN line_no % 7 = 0 THEN chr(9) || ' ' || chr(1)
                        ELSE chr(9) || ' ' || line || ' ' || chr(11) END AS padded
            FROM lines
        )
        WHERE regexp_matches(padded, '[^\\x00-\\x20]')"""),
    "daily_traffic": _parsed(_daily()),
    "top_resources": _parsed(_RESOURCES),
    "hourly_errors": _parsed(_hourly()),
    "malformed_count": _parsed("SELECT count(*) FILTER (WHERE NOT is_valid) AS malformed_count FROM parsed"),
    "daily_traffic_by_batch": _parsed(_daily("by_count")),
    "top_resources_by_batch": _parsed(_resources("by_count")),
    "hourly_errors_by_batch": _parsed(_hourly("by_count")),
    "batch_metadata": _parsed(_batches("by_count")),
    "malformed_summary": _parsed(_SUMMARY),
    "run_totals": _parsed(_TOTALS),
    "sorted_results": _parsed(_hourly() + " ORDER BY log_date, log_hour"),
    "latest_run_per_pipeline": _runs("SELECT * FROM newest WHERE batch_strategy = 'O' ORDER BY pipeline_name"),
    "runs_by_ids": _runs("""
        SELECT CAST(position AS INTEGER) AS position, asked.run_id, runs.run_id IS NOT NULL AS found,
               pipeline_name, runtime_seconds
        FROM (VALUES (1, 70::BIGINT), (2, 3), (3, 999999999999), (4, 70), (5, 41)) AS asked(position, run_id)
        LEFT JOIN runs ON runs.run_id = asked.run_id"""),
    "list_runs": _runs("SELECT * FROM runs ORDER BY run_id"),
    "list_runs_filtered": _runs("SELECT * FROM runs WHERE pipeline_name = '2-HIGH' ORDER BY run_id LIMIT 25"),
    "latest_run": _runs("SELECT * FROM runs WHERE pipeline_name = '5-LOW' ORDER BY run_id DESC LIMIT 1"),
    "runtime_ranking": _runs("""
        SELECT CAST(row_number() OVER (PARTITION BY batch_strategy ORDER BY runtime_seconds, run_id) AS INTEGER)
                   AS rank,
               batch_strategy, pipeline_name, run_id, runtime_seconds
        FROM newest"""),
    "result_page": """
        SELECT run_id, CAST(place AS INTEGER) AS place, batch_id, l_partkey, l_extendedprice, total_rows
        FROM (
            SELECT l_orderkey AS run_id, l_linenumber AS batch_id, l_partkey, l_extendedprice,
                   row_number() OVER (PARTITION BY l_orderkey
                                      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place,
                   count(*) OVER (PARTITION BY l_orderkey) AS total_rows
            FROM lineitem
        )
        WHERE place <= 3""",
    "run_report": _parsed(f"""
        SELECT CAST(row_number() OVER (ORDER BY batch_id, log_date, log_hour) AS INTEGER) AS place, *,
               count(*) OVER () AS total_rows
        FROM ({_hourly("by_count")})
        ORDER BY place LIMIT 50"""),
    "run_report_daily_traffic": _parsed(f"""
        SELECT CAST(row_number() OVER (ORDER BY batch_id, log_date, status_code) AS INTEGER) AS place, *,
               count(*) OVER () AS total_rows
        FROM ({_daily("by_count")})
        ORDER BY place LIMIT 50"""),
    "run_report_top_resources": _parsed(f"""
        SELECT CAST(row_number() OVER (ORDER BY batch_id, request_count DESC, resource_path) AS INTEGER) AS place, *,
               count(*) OVER () AS total_rows
        FROM ({_resources("by_count")})
        ORDER BY place LIMIT 20"""),
    "run_report_run": _parsed(f"""
        SELECT 'dataframe' AS pipeline_name, 'all' AS query_name, 'record_count' AS batch_strategy,
               CAST({BATCH_LINES} AS INTEGER) AS configured_batch_size, *
        FROM ({_TOTALS})"""),
    "run_report_batches": _parsed(_batches("by_count")),
    "compare_runs": _runs(_compared("O") + " SELECT * FROM compared"),
    "compare_runs_side_by_side": _runs(_compared("F") + f" SELECT measure, {_SIDES} FROM compared GROUP BY measure"),
    "result_consistency": _runs(_COUNTED + """
        SELECT *, min(row_count) OVER q = max(row_count) OVER q AS all_equal, true AS same_query
        FROM counted WINDOW q AS (PARTITION BY query_name)"""),
    "result_diff": _parsed(f"""
        , l AS ({_daily("by_count")}), r AS ({_daily("by_double")})
        SELECT *, 'left' AS only_in, CAST(1 AS BIGINT) AS extra_rows FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
        UNION ALL
        SELECT *, 'right' AS only_in, CAST(1 AS BIGINT) AS extra_rows FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)
        """),
    "load_query_results": _parsed(_daily("by_count")),
    "write_run_record": _parsed(f"""
        SELECT 'dataframe' AS pipeline_name, 'all' AS query_name, 'record_count' AS batch_strategy,
               CAST({BATCH_LINES} AS INTEGER) AS configured_batch_size, *
        FROM ({_TOTALS})"""),
    "init_tables": _parsed(_row_counts("by_count", "'already exists' AS status")),
    "reset_tables": _parsed(_row_counts("by_count", "CAST(1 AS INTEGER) AS run_id")),
    "delete_run": _parsed(_row_counts("by_count", "CAST(2 AS INTEGER) AS run_id")),
    "export_tsv": _parsed(_hourly()),
    "export_run": _parsed(_resources("by_count")),
    "export_run_daily_traffic": _parsed(_daily("by_count")),
    "export_run_hourly_errors": _parsed(_hourly("by_count")),
    "export_run_malformed": _parsed(f"SELECT batch_id, malformed_count FROM ({_batches('by_count')})"),
    "run_etl_sql_daily_traffic": _parsed(_daily("by_count")),
    "run_etl_sql_top_resources": _parsed(_resources("by_count")),
    "run_etl": _parsed(_hourly("by_file")),
    "run_etl_record_count": _parsed(_resources("by_count")),
    "run_etl_sql": _parsed(_hourly("by_count")),
    "run_etl_batches": _parsed(_batches("by_file")),
}
