"""The same per-batch aggregates as Spark SQL text over a table of parsed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from accesslens.schema import FIRST_ERROR_STATUS, LAST_ERROR_STATUS, RATE_DECIMALS, TOP_RESOURCES
from accesslens.session import broadcast_if_small, stage

_FAILED = f"status_code BETWEEN {FIRST_ERROR_STATUS} AND {LAST_ERROR_STATUS}"

SQL = {
    "query1": """
        SELECT batch_id, log_date, status_code,
               count(host) AS request_count,
               coalesce(sum(bytes_transferred), 0) AS total_bytes
        FROM {logs}
        GROUP BY batch_id, log_date, status_code
        HAVING count(host) > 0
    """,
    "query2": """
        SELECT batch_id, resource_path, request_count, total_bytes, count(DISTINCT host) AS distinct_host_count
        FROM {logs} JOIN {top} USING (batch_id, resource_path)
        GROUP BY batch_id, resource_path, request_count, total_bytes
    """,
    "query3": f"""
        SELECT batch_id, log_date, log_hour, error_request_count, total_request_count,
               round(if(total_request_count > 0, error_request_count / total_request_count, 0.0D),
                     {RATE_DECIMALS}) AS error_rate,
               distinct_error_hosts
        FROM (
            SELECT batch_id, log_date, log_hour,
                   count_if({_FAILED}) AS error_request_count,
                   count(host) AS total_request_count,
                   count(DISTINCT CASE WHEN {_FAILED} THEN host END) AS distinct_error_hosts
            FROM {{logs}}
            GROUP BY batch_id, log_date, log_hour
            HAVING count(host) > 0
        )
    """,
}


# The paths that `query2` counts the hosts of.
TOP = f"""
    SELECT batch_id, resource_path, request_count, total_bytes
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY batch_id ORDER BY request_count DESC, resource_path) AS place
        FROM (
            SELECT batch_id, resource_path,
                   count(host) AS request_count,
                   coalesce(sum(bytes_transferred), 0) AS total_bytes
            FROM {{logs}}
            GROUP BY batch_id, resource_path
            HAVING count(host) > 0
        )
    )
    WHERE place <= {TOP_RESOURCES}
"""


def run_sql(query: str, batched: DataFrame, path: str | None = None) -> DataFrame:
    """Rows of a query; `path` keeps the top counts of `query2`, as in `top_resources`."""
    spark = batched.sparkSession
    frames = {"logs": batched}
    if query == "query2":
        top = spark.sql(TOP, logs=batched)
        frames["top"] = broadcast_if_small(stage(top, path)) if path else top
    return spark.sql(SQL[query], **frames)
