"""Approximate aggregates: sketches stored per batch, merged over any batches and runs without the lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 2^12 registers: distinct counts are within 1.6 % in two of three cases. 64 KB or less a sketch.
HOST_BITS = 12
# Ranks of quantiles are within 1 % nearly always.
BYTES_K = 350
QUANTILES = (0.5, 0.9, 0.99)


def traffic_sketches(parsed: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """(by, hosts, sizes, requests): a sketch of distinct hosts and one of response sizes per group.

    Only valid lines count, and sizes that are numbers. Every task sketches its own lines; what is
    shuffled is a sketch per group and task, however many lines there are. Sketches are plain binary
    columns: stored with a batch, they can be merged with any others later.
    """
    return (
        parsed.groupBy(*by)
        .agg(
            F.hll_sketch_agg(F.col("host"), HOST_BITS).alias("hosts"),
            F.kll_sketch_agg_bigint("bytes_transferred", BYTES_K).alias("sizes"),
            F.count("host").alias("requests"),
        )
        .where("requests > 0")
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same rows for coarser groups, or one row for all; equal to sketching the lines together."""
    return sketches.groupBy(*by).agg(
        F.hll_union_agg("hosts").alias("hosts"),
        F.kll_merge_agg_bigint("sizes").alias("sizes"),
        F.sum("requests").alias("requests"),
    )


def approx_hosts(sketches: DataFrame) -> DataFrame:
    """The columns beside the sketches, and `distinct_hosts`, estimated."""
    kept = [name for name in sketches.columns if name not in ("hosts", "sizes")]
    return sketches.select(*kept, F.hll_sketch_estimate("hosts").alias("distinct_hosts"))


def approx_bytes_quantiles(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The columns beside the sketches, and a row per quantile: `quantile`, `size`; no row without sizes."""
    kept = [name for name in sketches.columns if name not in ("hosts", "sizes")]
    shares = F.array(*(F.lit(float(q)) for q in quantiles))
    sizes = F.kll_sketch_get_quantile_bigint("sizes", shares)
    pairs = F.explode(F.arrays_zip(shares.alias("quantile"), sizes.alias("size"))).alias("_pair")
    rows = sketches.where(F.kll_sketch_get_n_bigint("sizes") > 0).select(*kept, pairs)
    return rows.select(*kept, "_pair.quantile", "_pair.size")
