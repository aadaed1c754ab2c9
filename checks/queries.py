"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import clean_bytes, error_rate, is_error
from accesslens.functions.log_time import with_instants
from accesslens.functions.parameters import query_parameters
from accesslens.operators import run_history as history
from accesslens.operators.aggregates import (
    BATCH,
    daily_traffic,
    hourly_errors,
    malformed_count,
    sorted_results,
    top_resources,
)
from accesslens.operators.asof import asof_join
from accesslens.operators.batch_totals import (
    batch_metadata,
    malformed_samples,
    malformed_summary,
    run_totals,
)
from accesslens.operators.batching import batch_by_file, batch_by_record_count, number_lines
from accesslens.operators.intervals import in_intervals
from accesslens.operators.parsing import filter_valid, malformed_lines, parse_log_lines
from accesslens.operators.sketches import (
    approx_bytes_quantiles,
    approx_hosts,
    merged_sketches,
    traffic_sketches,
)
from accesslens.operators.trends import requests_by_hour, status_by_day, traffic_rollup, traffic_trend
from accesslens.operators.visits import visits
from accesslens.plans.reports import run_report
from accesslens.schema import (
    BATCH_METADATA,
    MALFORMED_SUMMARY,
    QUERY_TABLES,
    RUN_METADATA,
    TABLE_COLUMNS,
)
from accesslens.session import scratch_path, stage
from accesslens.sources import list_log_files, log_table_view, scan_log_text, trim_nonblank
from accesslens.streaming.event_time import stream_first_seen_hosts, stream_windowed_errors
from accesslens.tables import RunTables, export_run, export_tsv
from checks.inputs import (
    BATCH_LINES,
    LOG_PREFIX,
    finished_run,
    latin_folder,
    lines_with_parameters,
    log_folder,
    new_tables,
    padded_lines,
    parsed_lines,
    raw_sizes,
    requests,
    run,
    run_history,
    scanned,
    staged_scan,
    stored_results,
    stored_rows,
    zoned_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTERED[query.__name__.removesuffix("_")] = query
    return query


# -- sources -----------------------------------------------------------------


@register
def list_log_files_(spark, sf):
    files = list_log_files(spark, log_folder(spark, sf), LOG_PREFIX)
    return files.select("file_no", F.regexp_extract("path", r"chunk=(\d+)", 1).alias("chunk"))


@register
def scan_log_text_(spark, sf):
    return scanned(spark, sf).select("file_no", "line")


@register
def log_table_view_(spark, sf):
    log_table_view(spark, log_folder(spark, sf), LOG_PREFIX, "access_log")
    return spark.sql(
        """
        SELECT host, log_date, log_hour, http_method, resource_path, protocol_version,
               status_code, bytes_raw
        FROM access_log
        WHERE host IS NOT NULL
        """
    )


@register
def read_run_tables(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    stored = tables.read_ordered(MALFORMED_SUMMARY, run_id)
    return stored.select(
        "batch_id", "malformed_count", F.concat_ws("; ", "sample_lines").alias("sample")
    )


# -- batching ----------------------------------------------------------------


@register
def batch_by_record_count_(spark, sf):
    numbered = number_lines(staged_scan(spark, sf))
    return batch_by_record_count(numbered, BATCH_LINES).select("line_no", "batch_id", "line")


@register
def batch_by_file_(spark, sf):
    return batch_by_file(scanned(spark, sf)).select("batch_id", "line")


@register
def stream_file_batches(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based", "stream")
    return tables.read(QUERY_TABLES["query1"], run_id).drop("run_id")


@register
def stream_top_resources(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based", "stream")
    return tables.read(QUERY_TABLES["query2"], run_id).drop("run_id")


@register
def stream_hourly_errors(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based", "stream")
    return _plain(tables.read(QUERY_TABLES["query3"], run_id).drop("run_id"))


@register
def stream_batches(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based", "stream")
    timed = (F.col("batch_runtime_seconds") > 0).alias("timed")
    return tables.read(BATCH_METADATA, run_id).select(
        "batch_id", "batch_size", "malformed_count", "valid_records", timed
    )


@register
def stream_malformed(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based", "stream")
    return tables.read(MALFORMED_SUMMARY, run_id).select("batch_id", "malformed_count")


@register
def scan_latin_text(spark, sf):
    """Lines whose bytes are not ASCII come back as ISO-8859-1 has them."""
    return scan_log_text(spark, latin_folder(spark, sf)).select("line")


# -- lines and fields --------------------------------------------------------


@register
def parse_log_lines_(spark, sf):
    return parsed_lines(spark, sf).drop("line", "is_valid")


@register
def filter_valid_(spark, sf):
    return filter_valid(parsed_lines(spark, sf)).select("line_no", "host", "resource_path")


@register
def malformed_lines_(spark, sf):
    return malformed_lines(parsed_lines(spark, sf))


@register
def clean_bytes_(spark, sf):
    return raw_sizes(spark, sf).withColumn("bytes_transferred", clean_bytes(F.col("bytes_raw")))


@register
def cast_status(spark, sf):
    return filter_valid(parsed_lines(spark, sf)).select("line_no", "status_code")


@register
def error_predicate(spark, sf):
    failed = is_error(F.col("status_code"))
    return filter_valid(parsed_lines(spark, sf)).where(failed).select("line_no", "status_code")


@register
def error_rate_(spark, sf):
    failed, total = F.col("failed"), F.col("requests")
    per_host = parsed_lines(spark, sf).groupBy("host").agg(
        F.count_if(is_error(F.col("status_code"))).alias("failed"), F.count("host").alias("requests")
    )
    return per_host.select("host", error_rate(failed, total).alias("error_rate"))


@register
def trim_nonblank_(spark, sf):
    return trim_nonblank(padded_lines(spark, sf))


# -- aggregates --------------------------------------------------------------


@register
def daily_traffic_(spark, sf):
    return daily_traffic(parsed_lines(spark, sf))


@register
def top_resources_(spark, sf):
    return top_resources(parsed_lines(spark, sf))


@register
def hourly_errors_(spark, sf):
    return hourly_errors(parsed_lines(spark, sf))


@register
def malformed_count_(spark, sf):
    return malformed_count(parsed_lines(spark, sf))


def _batched(spark, sf):
    return batch_by_record_count(parsed_lines(spark, sf), BATCH_LINES)


@register
def daily_traffic_by_batch(spark, sf):
    return daily_traffic(_batched(spark, sf), by=BATCH)


@register
def top_resources_by_batch(spark, sf):
    return top_resources(_batched(spark, sf), by=BATCH)


@register
def hourly_errors_by_batch(spark, sf):
    return hourly_errors(_batched(spark, sf), by=BATCH)


@register
def batch_metadata_(spark, sf):
    return batch_metadata(_batched(spark, sf))


@register
def malformed_summary_(spark, sf):
    batched = _batched(spark, sf)
    summary = malformed_summary(batch_metadata(batched), malformed_samples(batched, ["line_no"]))
    return summary.select(
        "batch_id", "malformed_count", F.concat_ws("; ", "sample_lines").alias("sample")
    )


@register
def run_totals_(spark, sf):
    totals = run_totals(batch_metadata(_batched(spark, sf)))
    return totals.withColumn("average_batch_size", F.col("average_batch_size").cast("double"))


@register
def sorted_results_(spark, sf):
    return sorted_results(hourly_errors(parsed_lines(spark, sf)), "query3")


# -- events in time ----------------------------------------------------------


def _shown(instant: str):
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias(instant)


@register
def request_instants(spark, sf):
    """Zone offsets applied; days that no month has are NULL."""
    zoned = with_instants(parse_log_lines(zoned_lines(spark, sf)))
    return zoned.select("line_no", _shown("requested_at"))


@register
def requests_by_hour_(spark, sf):
    zoned = with_instants(parse_log_lines(zoned_lines(spark, sf)))
    return requests_by_hour(zoned).select(_shown("hour"), "request_count")


@register
def host_sessions(spark, sf):
    failed = F.when(is_error(F.col("status_code")), 1).otherwise(0).cast("bigint")
    size = F.coalesce("bytes_transferred", F.lit(0))
    found = visits(requests(spark, sf), sums={"total_bytes": size, "errors": failed})
    return found.select("host", "visit", _shown("started_at"), _shown("ended_at"), "requests", "total_bytes", "errors")


def _staged_requests(spark, sf, *columns):
    """Requests in time, parsed once for operators that read them more than once."""
    lines = requests(spark, sf).select("line_no", "requested_at", *columns)
    return stage(lines, scratch_path(spark, "requests"), spark)


def _asof_error(spark, sf, by, **options):
    lines = _staged_requests(spark, sf, by, "status_code")
    errors = lines.where(is_error(F.col("status_code")))
    errors = errors.select(by, "requested_at", F.col("line_no").alias("line"), F.col("status_code").alias("status"))
    lines = lines.select("line_no", by, "requested_at")
    found = asof_join(lines, errors, [by], "requested_at", ["line", "status"], "error_", **options)
    since = F.unix_seconds("requested_at") - F.unix_seconds("error_requested_at")
    return found.select("line_no", by, "error_line", "error_status", since.alias("seconds_since"))


@register
def asof_previous_error(spark, sf):
    """Every request with the latest earlier error of its path."""
    return _asof_error(spark, sf, "resource_path")


@register
def asof_recent_error_of_host(spark, sf):
    """Every request with the latest error of its host, itself included, if within two days."""
    return _asof_error(spark, sf, "host", exact=True, tolerance=2 * 86_400)


@register
def errors_in_incidents(spark, sf):
    """What came while a path kept failing: three server errors or more, six hours apart at most."""
    lines = _staged_requests(spark, sf, "host", "status_code", "resource_path")
    broken = visits(lines.where("status_code >= 500"), ["resource_path"], pause=6 * 3600).where("requests >= 3")
    broken = broken.select(F.col("resource_path").alias("path"), "visit", "started_at", "ended_at")
    inside = in_intervals(
        lines.drop("resource_path"), broken, "requested_at", "started_at", "ended_at", path=scratch_path(spark, "incidents")
    )
    return inside.groupBy("path", "visit", _shown("started_at"), _shown("ended_at")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if(is_error(F.col("status_code"))).alias("error_count"),
        F.count_distinct("host").alias("distinct_hosts"),
    )


def _windows(spark, sf, **options):
    # All files at once: their order of arrival decides nothing, and no line is late.
    found = stream_windowed_errors(
        spark, log_folder(spark, sf), scratch_path(spark, "windows"), LOG_PREFIX, files_per_trigger=1_000_000, **options
    )
    return found.select(_shown("window_start"), "request_count", "error_count", "closed")


@register
def stream_windowed_errors_(spark, sf):
    return _windows(spark, sf)


@register
def stream_sliding_errors(spark, sf):
    return _windows(spark, sf, window="6 hours", slide="2 hours", delay="1 day")


@register
def stream_first_seen_hosts_(spark, sf):
    found = stream_first_seen_hosts(spark, log_folder(spark, sf), scratch_path(spark, "hosts"), LOG_PREFIX, files_per_trigger=20)
    return found.select("host", _shown("first_seen"))


# -- totals, trends and sketches ---------------------------------------------


@register
def traffic_rollup_(spark, sf):
    return traffic_rollup(parsed_lines(spark, sf))


@register
def status_by_day_(spark, sf):
    return status_by_day(parsed_lines(spark, sf))


@register
def traffic_trend_(spark, sf):
    found = traffic_trend(parsed_lines(spark, sf))
    return found.withColumns({name: F.date_format(name, "yyyy-MM-dd") for name in ("day", "previous_day")})


def _sketches(spark, sf):
    """Sketches per batch, stored, and merged into one row (batch 0) without the lines."""
    stored = stage(traffic_sketches(_batched(spark, sf)), scratch_path(spark, "sketches"), spark)
    return stored.unionByName(merged_sketches(stored).withColumn("batch_id", F.lit(0)))


def _batched_and_all(spark, sf):
    lines = filter_valid(_batched(spark, sf)).select("batch_id", "host", "bytes_transferred")
    return lines.unionByName(lines.withColumn("batch_id", F.lit(0)))


@register
def approx_hosts_(spark, sf):
    """Estimates beside exact counts: within 5 %."""
    exact = _batched_and_all(spark, sf).groupBy("batch_id").agg(F.count_distinct("host").alias("exact_hosts"))
    both = approx_hosts(_sketches(spark, sf)).join(exact, "batch_id")
    off = F.abs(F.col("distinct_hosts") - F.col("exact_hosts"))
    return both.select("batch_id", "requests", "exact_hosts", (off <= 0.05 * F.col("exact_hosts")).alias("within"))


@register
def approx_bytes_quantiles_(spark, sf):
    """Estimated quantiles against the ranks that the lines give them: within 2 %."""
    found = approx_bytes_quantiles(_sketches(spark, sf))
    ranked = _batched_and_all(spark, sf).where("bytes_transferred IS NOT NULL").join(found, "batch_id").groupBy("batch_id", "quantile", "size")
    ranked = ranked.agg(
        F.count(F.lit(1)).alias("sizes"),
        F.count_if(F.col("bytes_transferred") < F.col("size")).alias("below"),
        F.count_if(F.col("bytes_transferred") <= F.col("size")).alias("up_to"),
    )
    rank, room = F.col("quantile") * F.col("sizes"), 0.02 * F.col("sizes") + 1
    within = (F.col("below") - room <= rank) & (rank <= F.col("up_to") + room)
    return ranked.select("batch_id", "quantile", "sizes", within.alias("within"))


@register
def query_parameters_(spark, sf):
    lines = filter_valid(parse_log_lines(lines_with_parameters(spark, sf)))
    each = lines.select("host", F.explode(query_parameters(F.col("resource_path"))).alias("parameter", "value"))
    return each.groupBy("parameter", "value").agg(
        F.count(F.lit(1)).alias("request_count"), F.count_distinct("host").alias("distinct_hosts")
    )


# -- run history -------------------------------------------------------------


@register
def latest_run_per_pipeline(spark, sf):
    return history.latest_run_per_pipeline(run_history(spark, sf), "O")


@register
def runs_by_ids(spark, sf):
    found = history.runs_by_ids(run_history(spark, sf), [70, 3, 999_999_999_999, 70, 41])
    return found.select("position", "run_id", "found", "pipeline_name", "runtime_seconds")


@register
def list_runs(spark, sf):
    return history.list_runs(run_history(spark, sf))


@register
def list_runs_filtered(spark, sf):
    return history.list_runs(run_history(spark, sf), "2-HIGH", limit=25)


@register
def latest_run(spark, sf):
    return history.latest_run(run_history(spark, sf), "5-LOW")


@register
def runtime_ranking(spark, sf):
    newest = history.latest_run_per_pipeline(run_history(spark, sf))
    return history.runtime_ranking(newest, ["batch_strategy"])


@register
def result_page(spark, sf):
    order = ["l_partkey", "l_suppkey", "l_extendedprice"]
    page = history.result_page(stored_rows(spark, sf), order, 3)
    return page.select("run_id", "place", "batch_id", "l_partkey", "l_extendedprice", "total_rows")


@register
def run_report_(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return _plain(run_report(tables, run_id).pages["query3"].drop("run_id"))


@register
def run_report_daily_traffic(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return run_report(tables, run_id).pages["query1"].drop("run_id")


@register
def run_report_top_resources(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return run_report(tables, run_id).pages["query2"].drop("run_id")


@register
def run_report_run(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return _plain(run_report(tables, run_id).run).drop("run_id", "runtime_seconds", "execution_timestamp")


@register
def run_report_batches(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return run_report(tables, run_id).batches.drop("run_id", "batch_runtime_seconds")


@register
def compare_runs(spark, sf):
    newest = history.latest_run_per_pipeline(run_history(spark, sf), "O")
    return history.compare_runs(newest)


@register
def compare_runs_side_by_side(spark, sf):
    newest = history.latest_run_per_pipeline(run_history(spark, sf), "F")
    return history.side_by_side(history.compare_runs(newest))


@register
def result_consistency(spark, sf):
    newest = history.latest_run_per_pipeline(run_history(spark, sf), "O")
    return history.result_consistency(newest, stored_results(spark, sf))


@register
def result_diff(spark, sf):
    parsed = parsed_lines(spark, sf)
    left = daily_traffic(batch_by_record_count(parsed, BATCH_LINES), by=BATCH)
    right = daily_traffic(batch_by_record_count(parsed, 2 * BATCH_LINES), by=BATCH)
    return history.result_diff(left, right)


# -- run tables, sinks and whole runs ----------------------------------------


def _plain(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with SQL."""
    return frame.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


@register
def load_query_results(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return tables.read(QUERY_TABLES["query1"], run_id).drop("run_id")


@register
def write_run_record(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return _plain(tables.read(RUN_METADATA, run_id)).drop(
        "run_id", "runtime_seconds", "execution_timestamp"
    )


def _row_counts(tables: RunTables) -> DataFrame:
    """Rows of every run table, per run."""
    counts = None
    for table in TABLE_COLUMNS:
        rows = tables.read(table).groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.withColumn("table_name", F.lit(table))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


@register
def init_tables(spark, sf):
    """Creating the tables once more keeps what a run stored in them."""
    tables = new_tables(spark)
    run(spark, sf, tables, "record_count")
    states = tables.init_tables()
    return states.join(_row_counts(tables), "table_name", "left").select("table_name", "status", "row_count")


@register
def reset_tables(spark, sf):
    """After a reset only the run made since is there."""
    tables = new_tables(spark)
    run(spark, sf, tables, "file_based")
    tables.reset_tables(confirm=True)
    run(spark, sf, tables, "record_count")
    return _row_counts(tables)


@register
def delete_run(spark, sf):
    """Of two runs, the one that was not deleted is left."""
    tables = new_tables(spark)
    first = run(spark, sf, tables, "file_based")
    run(spark, sf, tables, "record_count")
    tables.delete_run(first)
    return _row_counts(tables)


@register
def export_tsv_(spark, sf):
    folder = scratch_path(spark, "hourly-errors-tsv")
    rows = hourly_errors(parsed_lines(spark, sf))
    export_tsv(rows, folder)
    back = spark.read.option("sep", "\t").option("quote", "").schema(rows.schema)
    return back.csv(folder)


@register
def export_run_(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    folder = scratch_path(spark, "run-tsv")
    export_run(tables, run_id, folder)
    return _exported(spark, f"{folder}/query2", TABLE_COLUMNS[QUERY_TABLES["query2"]])


def _exported(spark, folder, columns):
    return spark.read.option("sep", "\t").option("quote", "").schema(columns).csv(folder)


@register
def export_run_daily_traffic(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    folder = scratch_path(spark, "run-tsv")
    export_run(tables, run_id, folder)
    return _exported(spark, f"{folder}/query1", TABLE_COLUMNS[QUERY_TABLES["query1"]])


@register
def export_run_hourly_errors(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    folder = scratch_path(spark, "run-tsv")
    export_run(tables, run_id, folder)
    return _plain(_exported(spark, f"{folder}/query3", TABLE_COLUMNS[QUERY_TABLES["query3"]]))


@register
def export_run_malformed(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    folder = scratch_path(spark, "run-tsv")
    export_run(tables, run_id, folder)
    return _exported(spark, f"{folder}/malformed", "batch_id int, malformed_count bigint")


@register
def run_etl(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based")
    return _plain(tables.read_ordered(QUERY_TABLES["query3"], run_id).drop("run_id"))


@register
def run_etl_record_count(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count")
    return tables.read_ordered(QUERY_TABLES["query2"], run_id).drop("run_id")


@register
def run_etl_sql(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count", "sql")
    return _plain(tables.read_ordered(QUERY_TABLES["query3"], run_id).drop("run_id"))


@register
def run_etl_sql_daily_traffic(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count", "sql")
    return tables.read_ordered(QUERY_TABLES["query1"], run_id).drop("run_id")


@register
def run_etl_sql_top_resources(spark, sf):
    tables, run_id = finished_run(spark, sf, "record_count", "sql")
    return tables.read_ordered(QUERY_TABLES["query2"], run_id).drop("run_id")


@register
def run_etl_batches(spark, sf):
    tables, run_id = finished_run(spark, sf, "file_based")
    return tables.read_ordered(BATCH_METADATA, run_id).drop("run_id", "batch_runtime_seconds")
