"""Windows over the time of requests, as files arrive: a watermark, late lines apart, and state that survives restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.functions import is_error
from accesslens.functions.log_time import with_instants
from accesslens.operators.parsing import parse_log_lines
from accesslens.session import make_folder, path_exists, setting
from accesslens.sources.log_files import located_lines, open_text

_WINDOWS = "window_start timestamp, window_end timestamp, request_count bigint, error_count bigint"
_SEEN = "host string, first_seen timestamp"


def windowed_errors(requests: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """(window_start, window_end, request_count, error_count) of tumbling windows, or sliding ones.

    For a batch and a stream alike: `requests` are parsed lines with `requested_at`. Lines without
    an instant are in no window, and a window without lines is no row.
    """
    failed = F.when(is_error(F.col("status_code")), 1).otherwise(0)
    span = F.window("requested_at", window, slide) if slide else F.window("requested_at", window)
    counted = requests.where("requested_at IS NOT NULL").groupBy(span.alias("window"))
    counted = counted.agg(F.count(F.lit(1)).alias("request_count"), F.sum(failed).cast("bigint").alias("error_count"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "request_count", "error_count")


def stream_requests(spark: SparkSession, folder: str, prefix: str = "", files_per_trigger: int = 1) -> DataFrame:
    """Valid requests of the files of a folder as a stream, with the time of each."""
    reader = spark.readStream.option("maxFilesPerTrigger", int(files_per_trigger))
    parsed = parse_log_lines(located_lines(open_text(reader, folder, prefix)))
    return with_instants(parsed).where("requested_at IS NOT NULL").select("host", "resource_path", "status_code", "requested_at")


def stream_windowed_errors(
    spark: SparkSession,
    folder: str,
    work: str,
    prefix: str = "",
    window: str = "1 hour",
    slide: str | None = None,
    delay: str = "2 hours",
    files_per_trigger: int = 1,
) -> DataFrame:
    """Count errors in windows over the files that are there now; returns all windows so far.

    The rows of `windowed_errors`, and `closed`: a window is closed, and appended to the results once
    and for all, when the watermark (the latest time seen, less `delay`) has passed its end. Those
    still open are read from the state. A line that comes after its window was closed is late: it is
    in no window, see `late_requests`. If no line is, the rows equal the batch's over the same files.

    `work` keeps results and progress. Call again with the same folder after a failure or when more
    files have come: the stream goes on where it was, and no file is counted twice.
    """
    results, progress = f"{work}/windows", f"{work}/progress"
    requests = stream_requests(spark, folder, prefix, files_per_trigger).withWatermark("requested_at", delay)
    stream = (
        windowed_errors(requests, window, slide)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(results)
    )
    stream.awaitTermination()
    closed = spark.read.schema(_WINDOWS).parquet(results).withColumn("closed", F.lit(True))
    if not path_exists(spark, f"{progress}/state"):
        return closed
    state = spark.read.format("statestore").load(progress)
    counts = state.select(F.col("key")[state.schema["key"].dataType.names[0]].alias("window"), "value.count", "value.sum")
    still = counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("count").alias("request_count"),
        F.col("sum").cast("bigint").alias("error_count"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(still)


def late_requests(windows: DataFrame, batch: DataFrame) -> DataFrame:
    """(window_start, late_requests, late_errors): lines that a stream's `windows` lack of a batch's over the same files."""
    ours = windows.groupBy("window_start").agg(F.sum("request_count").alias("_requests"), F.sum("error_count").alias("_errors"))
    missing = [
        (F.col(f"{name}_count") - F.coalesce(F.col(f"_{name}s"), F.lit(0))).alias(f"late_{name}s") for name in ("request", "error")
    ]
    return batch.join(ours, "window_start", "left").select("window_start", *missing).where("late_requests > 0")


def stream_first_seen_hosts(
    spark: SparkSession,
    folder: str,
    work: str,
    prefix: str = "",
    files_per_trigger: int = 1,
    state_partitions: int | None = None,
) -> DataFrame:
    """(host, first_seen) of all hosts in the files that are there now; returns the rows so far.

    The stream keeps the earliest request of every host as state and says a host once, when it comes
    up, and once more for each earlier request that a later file brings; the frame that comes back has
    the earliest. `work` keeps results and state: call again after a failure or when more files have
    come, and only what is new is read and said.

    Every micro-batch opens and commits each part of the state, however few hosts it touches, so there
    are only as many as the cores that are there at the first call, or `state_partitions`; at most the
    session's shuffle partitions. The number stays with `work`.
    """
    results = f"{work}/hosts"
    make_folder(spark, results)
    requests = stream_requests(spark, folder, prefix, files_per_trigger)
    # The time is that of the micro-batch, also when it is repeated; of equal requests the first to be said counts.
    said = F.struct(F.col("requested_at").alias("first_seen"), F.current_timestamp().alias("said_at"))
    earliest = requests.select("host", said.alias("said")).groupBy("host").agg(F.min("said").alias("earliest"))
    news = earliest.where(F.col("earliest.said_at") == F.current_timestamp()).select("host", "earliest.first_seen")

    def say(found: DataFrame, epoch: int) -> None:
        found.write.mode("overwrite").parquet(f"{results}/epoch={epoch}")

    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), state_partitions or spark.sparkContext.defaultParallelism)
    # A stream takes the settings that are there when it starts.
    with setting(spark, "spark.sql.shuffle.partitions", parts):
        stream = (
            news.writeStream.foreachBatch(say)
            .outputMode("update")
            .option("checkpointLocation", f"{work}/progress")
            .trigger(availableNow=True)
            .start()
        )
    stream.awaitTermination()
    return spark.read.schema(_SEEN).parquet(results).groupBy("host").agg(F.min("first_seen").alias("first_seen"))
