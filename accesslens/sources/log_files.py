"""Log files on any Hadoop file system: listing, scanning, and the SQL view."""

from __future__ import annotations

import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import decode_line, trim_control
from accesslens.functions.log_fields import NON_BLANK
from accesslens.operators.parsing import parse_log_lines
from accesslens.session import broadcast_if_small, setting

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING = pa.schema([("file_no", pa.int32()), ("path", pa.string())])


def _literal_glob(text: str) -> str:
    """Glob characters of a file name taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", text)


def open_text(reader, folder: str, prefix: str) -> DataFrame:
    """Raw lines of the files with this prefix, by a batch or a stream reader."""
    return reader.option("pathGlobFilter", f"{_literal_glob(prefix)}*").text(folder)


def open_logs(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Raw lines of a folder whose files are listed now; later files do not belong to the frame."""
    # Left alone, Spark lists folders in a task each.
    usual, tasks = int(spark.conf.get(_LISTING_TASKS)), 4 * spark.sparkContext.defaultParallelism
    try:
        with setting(spark, _LISTING_TASKS, min(usual, tasks)):
            return open_text(spark.read, folder, prefix)
    except AnalysisException as missing:
        raise FileNotFoundError(f"no such log folder: {folder}") from missing


def list_log_files(
    spark: SparkSession, folder: str, prefix: str = "", text: DataFrame | None = None
) -> DataFrame:
    """(file_no, path) of the plain files in `folder` whose name starts with `prefix`.

    Numbers run from 1 in the order of the paths as they are, not as a URI spells
    them. `folder` may be a glob. Sub-folders are not entered, unless their names are
    partitions (`day=...`) to Spark. Empty files are listed although a scan skips them.

    The listing is the file index of `text`, a frame of `open_logs`. Scan that same
    frame, and the two cannot disagree, whatever arrives in between. Without it the
    folder is listed anew. A row per file passes the driver, which holds the file
    index of any Spark scan anyway.
    """
    text = open_logs(spark, folder, prefix) if text is None else text
    paths = sorted(text.inputFiles(), key=lambda path: (unquote(path), path))
    if not paths:
        if prefix and spark.read.text(folder).inputFiles():
            raise FileNotFoundError(f"no file named {prefix}* in log folder: {folder}")
        raise FileNotFoundError(f"log folder is empty: {folder}")
    return spark.createDataFrame(pa.table([range(1, len(paths) + 1), paths], schema=_LISTING))


def scan_log_text(
    spark: SparkSession, folder: str, prefix: str = "", text: DataFrame | None = None
) -> DataFrame:
    """Non-blank lines, decoded and trimmed, with where each one was read.

    `scan_pos` grows with the position inside one (source_file, block_start)
    split. It depends on how the scan was cut into tasks, so stage a frame before
    using it (`number_lines` does). `text` is a frame of `open_logs` to scan instead
    of listing the folder anew.
    """
    return located_lines(open_logs(spark, folder, prefix) if text is None else text)


def located_lines(text: DataFrame) -> DataFrame:
    """The same for a text frame already opened, batch or streaming."""
    spots = [
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ]
    if not text.isStreaming:
        # Right above the scan and the row filter: consecutive within each split.
        spots.append(F.monotonically_increasing_id().alias("scan_pos"))
    kept = text.where(F.col("value").rlike(NON_BLANK))
    return kept.select(*spots, trim_control(decode_line(F.col("value"))).alias("line"))


def trim_nonblank(lines: DataFrame, column: str = "line") -> DataFrame:
    """Trim a column of lines and drop the blank ones, for lines of any origin."""
    kept = lines.where(F.col(column).rlike(NON_BLANK))
    return kept.withColumn(column, trim_control(F.col(column)))


def listing_by_scan_path(files: DataFrame) -> DataFrame:
    """The listing keyed the way a scan spells paths.

    A listing says `file:///a`, a scan `file:/a`. Keep both spellings on the
    small side, so that no expression runs per scanned line.
    """
    spelled = F.array_distinct(
        F.array("path", F.regexp_replace("path", r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/"))
    )
    return files.select("file_no", F.explode(spelled).alias("source_file"))


def with_file_no(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Replace `source_file` by its number in the listing; an unlisted file fails the job."""
    return with_file_no_of(lines, broadcast_if_small(listing_by_scan_path(files)))


def with_file_no_of(lines: DataFrame, named: DataFrame, listed_only: bool = False) -> DataFrame:
    """The same with a listing already keyed, for many frames of lines.

    `listed_only` leaves lines of unlisted files out instead of failing.
    """
    if listed_only:
        rest = [c for c in lines.columns if c != "source_file"]
        return lines.join(named, "source_file").select("file_no", *rest)
    unlisted = F.raise_error(F.concat(F.lit("file is not in the listing: "), F.col("source_file")))
    number = F.coalesce(F.col("file_no"), unlisted.cast("int")).alias("file_no")
    rest = [c for c in lines.columns if c != "source_file"]
    return lines.join(named, "source_file", "left").select(number, *rest)


def log_table_view(spark: SparkSession, folder: str, prefix: str = "", name: str = "access_log") -> DataFrame:
    """A table of parsed fields over a log folder, to query by name in SQL.

    Malformed lines are rows whose columns are all NULL.
    """
    parsed = parse_log_lines(scan_log_text(spark, folder, prefix))
    table = parsed.select(
        "host",
        "log_date",
        "log_hour",
        "http_method",
        "resource_path",
        "protocol_version",
        "status_code",
        "bytes_raw",
        "bytes_transferred",
    )
    table.createOrReplaceTempView(name)
    return table
