"""Blocks: rows that hold arrays of whole numbers as small byte strings, and tables of such rows."""

from __future__ import annotations

import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame

MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers from 0, in as few bytes each as the largest needs, compressed.

    `rising` numbers are stored as differences.
    """
    values = np.ascontiguousarray(values, np.uint64)
    if rising and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, rising: bool = False) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    values = np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.uint64)
    return np.cumsum(values, dtype=np.uint64) if rising else values


def mixed(values: np.ndarray) -> np.ndarray:
    """Hash bits of whole numbers, spread over 64 bits."""
    values = np.asarray(values).astype(np.uint64)
    for shift in (32, 29):
        values = (values ^ (values >> np.uint64(shift))) * MIX
    return values ^ (values >> np.uint64(32))


def cuts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def bucketed(blocks: DataFrame, path: str) -> DataFrame:
    """Rows written in buckets by their column `block`: answers joined to them move, they do not."""
    spark = blocks.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.format("parquet").option("path", path).option("compression", "none")
    writer.bucketBy(buckets, "block").saveAsTable(name)
    table = spark.table(name)
    # The files stay; only their entry in the session's catalog goes.
    spark.sql(f"DROP TABLE {name}")
    return table
