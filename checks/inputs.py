"""What the queries run on: log lines and run histories made from the given tables.

`events` become access-log lines, one per event, with the event id as line number.
`orders` become runs and `lineitem` their stored result rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions.log_time import with_instants
from accesslens.operators.parsing import parse_log_lines
from accesslens.plans.run_etl import run_etl
from accesslens.session import scratch_path, stage
from accesslens.sources import list_log_files, scan_log_text, with_file_no
from accesslens.tables import RunTables

# Lines per log file, and per record-count batch.
FILE_LINES = 2_500
BATCH_LINES = 3_000
LOG_PREFIX = "part-"

_staged: dict[tuple, object] = {}


def once(spark: SparkSession, what: tuple, make):
    """Make something once per application."""
    key = (spark.sparkContext.applicationId, *what)
    if key not in _staged:
        _staged[key] = make()
    return _staged[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- log lines ---------------------------------------------------------------


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, line): every event as a log line; every 97th is garbage."""
    return _as_lines(table(spark, sf_dir, "events"))


def _as_lines(events: DataFrame, *also: str) -> DataFrame:
    event_id = F.col("event_id")
    status = F.when(
        F.col("event_type") == "error", F.when(event_id % 2 == 0, F.lit("404")).otherwise("500")
    ).otherwise(F.when(event_id % 10 == 0, F.lit("304")).otherwise("200"))
    size = F.when(event_id % 10 == 0, F.lit("-")).otherwise(_hundredths())
    line = F.concat(
        F.lit("u"),
        F.col("user_id").cast("string"),
        F.lit(".example.net - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' -0400] "GET /'),
        F.col("event_type"),
        F.lit("/"),
        (event_id % 40).cast("string"),
        F.when(event_id % 13 == 0, F.lit("")).otherwise(" HTTP/1.0"),
        F.lit('" '),
        status,
        F.lit(" "),
        size,
    )
    garbage = F.concat(F.lit("garbage "), event_id.cast("string"))
    return events.select(
        *also, event_id.alias("line_no"), F.when(event_id % 97 == 0, garbage).otherwise(line).alias("line")
    )


def _hundredths():
    return F.floor(F.col("value") * 100).cast("bigint").cast("string")


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log_lines(log_lines(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid lines with the instant of each."""
    return with_instants(parsed_lines(spark, sf_dir)).where("is_valid")


def zoned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines in three time zones; every 41st has a day that no month has."""
    line_no, line = F.col("line_no"), F.col("line")
    zone = F.when(line_no % 3 == 0, F.lit(" -0730]")).when(line_no % 3 == 1, F.lit(" -0000]")).otherwise(F.lit(" -0400]"))
    zoned = F.replace(line, F.lit(" -0400]"), zone)
    nonsense = F.regexp_replace(zoned, r"\[\d\d/", "[45/")
    return log_lines(spark, sf_dir).withColumn("line", F.when(line_no % 41 == 0, nonsense).otherwise(zoned))


def lines_with_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with parameters in their paths, out of the events' JSON: one repeated, one without a value."""
    event_id, kind = F.col("event_id"), F.col("event_type")
    number = F.from_json("props", "map<string,bigint>")["k"].cast("string")
    again = F.when(event_id % 3 == 0, F.lit("&k=last")).otherwise(F.lit(""))
    parameters = F.concat(F.lit("?k="), number, F.lit("&tag="), kind, F.lit("%20"), (event_id % 5).cast("string"), again, F.lit("&flag#k=0"))
    events = table(spark, sf_dir, "events").select(event_id.alias("line_no"), parameters.alias("parameters"))
    with_them = F.regexp_replace("line", r"(\"\S+ [^ \"]+)", F.concat(F.lit("$1"), F.col("parameters")))
    return log_lines(spark, sf_dir).join(events, "line_no").select("line_no", with_them.alias("line"))


def padded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines between tabs, blanks and control characters; every seventh is blank."""
    blank = F.lit("\t \x01")
    padded = F.concat(F.lit("\t "), F.col("line"), F.lit(" \x0b"))
    return log_lines(spark, sf_dir).withColumn(
        "line", F.when(F.col("line_no") % 7 == 0, blank).otherwise(padded)
    )


def raw_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, bytes_raw) with dashes, trailing letters and numbers beyond a bigint."""
    event_id = F.col("event_id")
    raw = (
        F.when(event_id % 10 == 0, F.lit("-"))
        .when(event_id % 11 == 0, F.concat(_hundredths(), F.lit("x")))
        .when(event_id % 17 == 0, F.lit("99999999999999999999"))
        .otherwise(_hundredths())
    )
    return table(spark, sf_dir, "events").select(event_id.alias("line_no"), raw.alias("bytes_raw"))


# -- log files ---------------------------------------------------------------


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """The lines as text files of FILE_LINES each, in name order; returns a glob of their folders."""

    def write():
        root = scratch_path(spark, "log-files")
        chunk = F.expr(f"lpad(cast(event_id div {FILE_LINES} AS string), 9, '0')")
        # Events are in few splits: they are dealt out first and become lines in all tasks.
        events = table(spark, sf_dir, "events").withColumn("chunk", chunk).repartition("chunk")
        (
            _as_lines(events, "chunk")
            .sortWithinPartitions("chunk", "line_no")
            .select("chunk", "line")
            .write.partitionBy("chunk")
            .text(root)
        )
        return f"{root}/chunk=*"

    return once(spark, ("log_folder", sf_dir), write)


def latin_folder(spark: SparkSession, sf_dir: str) -> str:
    """The lines as one text folder in ISO-8859-1, each after its number and letters beyond ASCII."""

    def write():
        root = scratch_path(spark, "latin-files")
        line = F.concat(F.col("line_no").cast("string"), F.lit(" \u00e9\u00fc\u00df "), F.col("line"))
        lines = log_lines(spark, sf_dir).select(line.alias("line"))
        lines.write.csv(root, sep="\x01", quote="", escape="", encoding="ISO-8859-1")
        return root

    return once(spark, ("latin_folder", sf_dir), write)


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files read back, with the number of the file each line is in."""
    folder = log_folder(spark, sf_dir)
    files = list_log_files(spark, folder, LOG_PREFIX)
    return with_file_no(scan_log_text(spark, folder, LOG_PREFIX), files)


def staged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write():
        return stage(scanned(spark, sf_dir), scratch_path(spark, "scanned"))

    return once(spark, ("staged_scan", sf_dir), write)


# -- finished runs -----------------------------------------------------------


def new_tables(spark: SparkSession) -> RunTables:
    return RunTables(spark, scratch_path(spark, "run-tables"), f"logs_{uuid.uuid4().hex[:12]}")


def run(
    spark: SparkSession, sf_dir: str, tables: RunTables, strategy: str, pipeline: str = "dataframe", **options
) -> int:
    size = BATCH_LINES if strategy == "record_count" else None
    return run_etl(
        spark,
        tables,
        log_folder(spark, sf_dir),
        pipeline=pipeline,
        batch_strategy=strategy,
        batch_size=size,
        prefix=LOG_PREFIX,
        **options,
    )


def finished_run(
    spark: SparkSession, sf_dir: str, strategy: str, pipeline: str = "dataframe"
) -> tuple[RunTables, int]:
    """Tables shared by the queries that only read, and the id of one run in them."""
    tables = once(spark, ("tables", sf_dir), lambda: new_tables(spark))
    run_id = once(
        spark,
        ("run", sf_dir, strategy, pipeline),
        lambda: run(spark, sf_dir, tables, strategy, pipeline),
    )
    return tables, run_id


# -- run history -------------------------------------------------------------


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per order: priority as pipeline, status as strategy, price as runtime."""
    measured = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("records"),
            F.count_if(F.col("l_returnflag") == "R").alias("malformed"),
            F.count(F.lit(1)).cast("int").alias("batches"),
        )
    )
    records, batches = F.col("records"), F.col("batches")
    mean = (records.cast("decimal(20,0)") / batches.cast("decimal(10,0)")).cast("decimal(20,2)")
    zero = F.lit(0).cast("bigint")
    orders = table(spark, sf_dir, "orders")
    return orders.join(measured, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("pipeline_name"),
        F.lit("all").alias("query_name"),
        F.col("o_orderstatus").alias("batch_strategy"),
        F.coalesce(records, zero).alias("total_records_processed"),
        F.coalesce("malformed", zero).alias("total_malformed_records"),
        F.coalesce(batches, F.lit(0)).alias("total_batches"),
        F.coalesce(mean.cast("double"), F.lit(0.0)).alias("average_batch_size"),
        F.col("o_totalprice").alias("runtime_seconds"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("executed_on"),
    )


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored result row per line item: order as run, line number as batch."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("batch_id"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_returnflag",
    )


def stored_results(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The line items as three result tables, by return flag."""
    rows = stored_rows(spark, sf_dir)
    flags = {"query1": "A", "query2": "N", "query3": "R"}
    return {query: rows.where(F.col("l_returnflag") == flag) for query, flag in flags.items()}
