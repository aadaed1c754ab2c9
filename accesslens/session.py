"""Session settings, the shared scratch folder, and size-checked broadcasting."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a broadcast may hold on each executor: a listing of a million files, say.
BROADCAST_BYTES = 256 * 2**20
FIELD_BYTES = 16

# Partitions to shuffle into: text per partition, and how few.
SHUFFLE_BYTES = 256 * 2**20
FEWEST_SHUFFLES = 200

# Splits to scan in: the usual size, grown so that even 100 TB make only so many tasks.
SCAN_BYTES = 128 * 2**20
MOST_SCANS = 200_000

# The largest top count that is cut in every task before the shuffle.
EARLY_LIMIT = 1_000_000

_local_folders: dict[str, str] = {}


def shuffle_partitions(input_bytes: int) -> int:
    """How many partitions to shuffle into before adaptive execution merges small ones.

    About one per 256 MB of text. Merging can only lower the number, so it has to
    start high enough for a partition to fit in a task's memory.
    """
    return max(input_bytes // SHUFFLE_BYTES, FEWEST_SHUFFLES)


def scan_bytes(input_bytes: int) -> int:
    """How much text one scan task reads."""
    return max(SCAN_BYTES, input_bytes // MOST_SCANS)


def build_session(
    app_name: str = "accesslens", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps.

    `input_bytes`, the size of the logs, sets the sizes of scan splits and shuffles.
    """
    if input_bytes is not None:
        sizes = {
            "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)),
            "spark.sql.files.maxPartitionBytes": str(scan_bytes(input_bytes)),
        }
        conf = {**sizes, **conf}
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Tasks keep only their own best rows for any top count up to this.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", str(EARLY_LIMIT))
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: int | str) -> Iterator[None]:
    """A session setting that holds within the block, for what is planned or started there."""
    usual = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a single-JVM local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    # A local cluster has executors of their own, as any other has.
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="accesslens-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, path: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a frame once and go on from the written copy.

    Later jobs read only the columns they need, a lost executor costs no
    recomputation, and values that depend on the scan order are frozen.
    """
    frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return (spark or frame.sparkSession).read.schema(frame.schema).parquet(path)


def fits_broadcast(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a frame, measured now, takes at most `limit` bytes; it should be staged or local."""
    width = F.lit(FIELD_BYTES * len(frame.columns))
    for name, kind in frame.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    size = frame.agg(F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()["size"]
    return size <= limit


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the frame fits.

    Beyond the limit the frame comes back unhinted, and the join shuffles with
    adaptive skew splitting.
    """
    return F.broadcast(frame) if fits_broadcast(frame, limit) else frame


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) for a path on any storage Hadoop knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> bool:
    """Create a folder; False if it was there already."""
    fs, target = hadoop_path(spark, path)
    return not fs.exists(target) and fs.mkdirs(target)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder this library wrote; False if it was not there."""
    fs, target = hadoop_path(spark, path)
    return fs.delete(target, True)


_creating = threading.Lock()


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there already, whoever created it."""
    fs, target = hadoop_path(spark, path)
    with _creating:
        if fs.exists(target):
            return False
        try:
            fs.create(target, False).close()
        except Py4JJavaError as failed:
            if fs.exists(target):
                return False
            raise OSError(f"cannot create {path}") from failed
        return True


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    fs, target = hadoop_path(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []
