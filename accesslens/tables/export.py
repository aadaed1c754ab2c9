"""Result rows to tab-separated text and to relational databases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.schema import (
    ALL_QUERIES,
    MALFORMED_SUMMARY,
    QUERY_NAMES,
    QUERY_TABLES,
    RATE_DECIMALS,
)
from accesslens.tables.run_tables import RunTables

# Ten times the usual JDBC batch: result rows are narrow.
JDBC_BATCH_ROWS = 10_000
JDBC_CONNECTIONS = 8


def export_tsv(rows: DataFrame, folder: str) -> None:
    """One row per line, tabs between the columns, nothing quoted.

    No field of a log line can hold a tab or a newline, so none needs quoting; a
    CSV writer would put quotes around a path that contains one. Rates have six
    decimals.
    """
    texts = [F.coalesce(_as_text(rows, name), F.lit("")) for name in rows.columns]
    rows.select(F.concat_ws("\t", *texts).alias("value")).write.mode("overwrite").text(folder)


def export_run(tables: RunTables, run_id: int, folder: str) -> None:
    """A run's rows of each query that ran, and its malformed counts, a sub-folder each."""
    query = tables.run(run_id)["query_name"]
    for name in QUERY_NAMES if query == ALL_QUERIES else (query,):
        export_tsv(tables.read_ordered(QUERY_TABLES[name], run_id).drop("run_id"), f"{folder}/{name}")
    malformed = tables.read_ordered(MALFORMED_SUMMARY, run_id)
    export_tsv(malformed.select("batch_id", "malformed_count"), f"{folder}/malformed")


def _as_text(rows: DataFrame, name: str):
    column = F.col(name)
    if dict(rows.dtypes)[name] in ("double", "float"):
        return F.format_string(f"%.{RATE_DECIMALS}f", column.cast("double"))
    return column.cast("string")


def jdbc_options(url: str, table: str, **properties: str) -> dict[str, str]:
    """Writer options; driver class and credentials come from the caller."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(JDBC_BATCH_ROWS),
        "numPartitions": str(JDBC_CONNECTIONS),
        "isolationLevel": "READ_COMMITTED",
        **properties,
    }


def write_jdbc(rows: DataFrame, url: str, table: str, mode: str = "append", **properties: str) -> None:
    """Append rows to a database table from all tasks, over a bounded number of connections.

    Every task commits on its own. A job that fails leaves the rows of the tasks that were done,
    and running it again doubles them: append to an empty staging table and move its rows in one
    statement of the database.
    """
    rows.write.format("jdbc").options(**jdbc_options(url, table, **properties)).mode(mode).save()
