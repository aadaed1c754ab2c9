"""Fixed values and the columns of the six run tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must be exactly what every consumer of the logs agreed on.
# ---------------------------------------------------------------------------

# One access-log line. Groups: host, date, hour, method, path, protocol, status, bytes.
LOG_PATTERN = (
    r"^(\S+)\s+-\s+-\s+\[(\d{2}/\w{3}/\d{4}):(\d{2}):\d{2}:\d{2}\s+-\d{4}\]"
    r"\s+\"(\S+)\s+(\S+)(?:\s+(\S+))?\"\s+(\d{3})\s+(\S+)$"
)
LOG_GROUPS = (
    "host",
    "log_date",
    "log_hour",
    "http_method",
    "resource_path",
    "protocol_version",
    "status_code",
    "bytes_raw",
)
LOG_ENCODING = "ISO-8859-1"
NO_BYTES = "-"
FIRST_ERROR_STATUS = 400
LAST_ERROR_STATUS = 599
TOP_RESOURCES = 20
RATE_DECIMALS = 6

QUERY_NAMES = ("query1", "query2", "query3")
ALL_QUERIES = "all"
RECORD_COUNT = "record_count"
FILE_BASED = "file_based"
BATCH_STRATEGIES = (RECORD_COUNT, FILE_BASED)

# Names of the result columns stand with their types in TABLE_COLUMNS below; the order of rows in RESULT_ORDER.

# Rows a report shows per query, in the order of QUERY_NAMES.
PAGE_ROWS = {"query1": 50, "query2": 20, "query3": 50}

# ---------------------------------------------------------------------------
# Ours
# ---------------------------------------------------------------------------

# Implementation variants; each is recorded as the run's pipeline_name.
PIPELINES = ("dataframe", "sql", "stream")
SAMPLE_LINES = 5

RUN_METADATA = "run_metadata"
BATCH_METADATA = "batch_metadata"
MALFORMED_SUMMARY = "malformed_summary"
QUERY_TABLES = {
    "query1": "query1_daily_traffic",
    "query2": "query2_top_resources",
    "query3": "query3_hourly_errors",
}

_INT, _LONG, _STR = T.IntegerType(), T.LongType(), T.StringType()


def _columns(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


# Data columns only: every table is also partitioned by run_id and load_id.
TABLE_COLUMNS: dict[str, T.StructType] = {
    RUN_METADATA: _columns(
        ("pipeline_name", _STR),
        ("query_name", _STR),
        ("batch_strategy", _STR),
        ("configured_batch_size", _INT),
        ("total_records_processed", _LONG),
        ("total_malformed_records", _LONG),
        ("total_batches", _INT),
        ("average_batch_size", T.DecimalType(20, 2)),
        ("runtime_seconds", T.DecimalType(10, 3)),
        ("execution_timestamp", T.TimestampType()),
    ),
    BATCH_METADATA: _columns(
        ("batch_id", _INT),
        ("batch_size", _LONG),
        ("malformed_count", _LONG),
        ("valid_records", _LONG),
        ("batch_runtime_seconds", T.DecimalType(10, 3)),
    ),
    QUERY_TABLES["query1"]: _columns(
        ("batch_id", _INT),
        ("log_date", _STR),
        ("status_code", _INT),
        ("request_count", _LONG),
        ("total_bytes", _LONG),
    ),
    QUERY_TABLES["query2"]: _columns(
        ("batch_id", _INT),
        ("resource_path", _STR),
        ("request_count", _LONG),
        ("total_bytes", _LONG),
        ("distinct_host_count", _LONG),
    ),
    QUERY_TABLES["query3"]: _columns(
        ("batch_id", _INT),
        ("log_date", _STR),
        ("log_hour", _STR),
        ("error_request_count", _LONG),
        ("total_request_count", _LONG),
        ("error_rate", T.DecimalType(8, 6)),
        ("distinct_error_hosts", _LONG),
    ),
    MALFORMED_SUMMARY: _columns(
        ("batch_id", _INT),
        ("malformed_count", _LONG),
        ("sample_lines", T.ArrayType(_STR)),
    ),
}

# The order each query's rows are stored and paged in, after batch_id.
RESULT_ORDER = {
    "query1": (("log_date", "asc"), ("status_code", "asc")),
    "query2": (("request_count", "desc"), ("resource_path", "asc")),
    "query3": (("log_date", "asc"), ("log_hour", "asc")),
}
