"""Lines to fields, valid rows and malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.functions import cast_status, clean_bytes, group_of, once_per_row, split_groups

PARSED_COLUMNS = (
    "host",
    "log_date",
    "log_hour",
    "http_method",
    "resource_path",
    "protocol_version",
    "status_code",
    "bytes_raw",
    "bytes_transferred",
    "is_valid",
)


def parse_log_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add the fields of each line; on a malformed line they are all NULL.

    Every input column stays. A line is valid if it has a host: both come from the same
    cut, which runs once per line. A filter on any field stays above it; pushed below,
    it would repeat the pattern for every field it names. A line that begins with a
    newline is malformed, as is NULL.
    """
    kept = [c for c in lines.columns if c not in PARSED_COLUMNS]
    parts = F.col("_parts")

    def group(name):
        return group_of(parts, name)

    protocol = group("protocol_version")
    cut = lines.select(
        *kept,
        once_per_row(split_groups(F.col(line))).alias("_parts"),
    )
    return cut.select(
        *kept,
        group("host").alias("host"),
        group("log_date").alias("log_date"),
        group("log_hour").alias("log_hour"),
        group("http_method").alias("http_method"),
        group("resource_path").alias("resource_path"),
        F.when(protocol != "", protocol).alias("protocol_version"),
        cast_status(group("status_code")).alias("status_code"),
        group("bytes_raw").alias("bytes_raw"),
        clean_bytes(group("bytes_raw")).alias("bytes_transferred"),
        group("host").isNotNull().alias("is_valid"),
    )


def filter_valid(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("is_valid")


def malformed_lines(parsed: DataFrame) -> DataFrame:
    """Rows whose line did not match, without the empty fields."""
    return parsed.where("NOT is_valid").drop(*PARSED_COLUMNS)
