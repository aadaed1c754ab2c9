"""Sources mixed to target weights by hash-seeded Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.text import filled, whole_rows, with_outputs
from accesslens.session import BROADCAST_BYTES, scratch_path, stage

SEED = 17
# Hexadecimal digits of a hash that a double holds exactly.
DIGITS = 13


def hashed(*parts: Column) -> Column:
    """52 hash bits of the parts as a bigint; null parts count as empty."""
    text = F.concat_ws("|", *(filled(part.cast("string")) for part in parts))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")


def log_factorial(k: Column) -> Column:
    """ln k!, by the factorial itself as far as a bigint holds it and by Stirling's series beyond."""
    x = k.cast("double")
    exact = F.log(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))
    rest = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    return F.when(k <= 20, exact).otherwise(x * F.log(x) - x + F.log(2 * math.pi * x) / 2 + rest)


def poisson_distributions(rates: DataFrame) -> DataFrame:
    """(_source, _first, _cdf): P(count <= k) for k = `_first` and on, of each `_rate` above zero.

    Only counts within twelve deviations of the mean, beyond which a double tells no probability
    from zero or one: the rows made grow with the root of the rate, and are added up once.
    """
    rate, k = F.col("_rate"), F.col("k")
    width = 12 * F.sqrt(rate) + 24
    band = F.sequence(F.greatest(F.floor(rate - width), F.lit(0)).cast("bigint"), F.ceil(rate + width).cast("bigint"))
    terms = rates.where("_rate > 0").select("_source", "_rate", F.explode(band).alias("k"))
    so_far = Window.partitionBy("_source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum(F.exp(k * F.log(rate) - rate - log_factorial(k))).over(so_far)
    terms = terms.select("_source", "k", below.alias("below"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "below")))["below"]
    return terms.groupBy("_source").agg(F.min("k").alias("_first"), ordered.alias("_cdf"))


def count_at(cdf: Column, u: Column) -> Column:
    """How many entries of a rising array are not above `u`, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cdf) + 1.0)).cast("int"))

    def halved(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        inside = at["low"] < at["high"]
        right = inside & (F.get(cdf, middle) <= u)
        low = F.when(right, middle + 1).otherwise(at["low"])
        high = F.when(inside & ~right, middle).otherwise(at["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(cdf).alias("high")), halved)["low"]


def source_rates(
    docs: DataFrame, source: str = "source", weights: Mapping[str, float] | None = None, epochs: float = 1.0
) -> DataFrame:
    """Per source (`_source`): documents, target repetition rate and its distribution from `_first` on.

    The mix has `epochs` times the input's documents on average. Without weights every source
    gets the same share. A source without a weight, null included, gets none.
    """
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_docs"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        pairs = [F.lit(value) for pair in weights.items() for value in pair]
        known = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
        weight = F.coalesce(F.try_element_at(known, F.col("_source")), F.lit(0.0)).cast("double")
    counts = counts.withColumn("_weight", weight)
    # Two numbers come to the driver.
    totals = counts.agg(F.sum("_docs").alias("docs"), F.sum("_weight").alias("weights")).first()
    share = F.lit(float(epochs)) * F.col("_weight") * F.lit(totals["docs"]) / (F.lit(totals["weights"]) * F.col("_docs"))
    rated = counts.withColumn("_rate", F.when(F.col("_weight") > 0, share).otherwise(F.lit(0.0)))
    known = poisson_distributions(rated).withColumnRenamed("_source", "_of")
    rated = rated.join(known, F.col("_source").eqNullSafe(F.col("_of")), "left")
    first, cdf = F.coalesce("_first", F.lit(0)).cast("int"), F.coalesce("_cdf", F.array(F.lit(1.0)))
    return rated.select("_source", "_docs", "_rate", first.alias("_first"), cdf.alias("_cdf"))


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Mapping[str, float] | None = None,
    epochs: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Each document as often as its Poisson count says, over all shuffled.

    Added columns: n_copies, copy (from 1), shuffle_key (52 hash bits; rows lie in its order
    within partitions that are dealt by it, so the order is a random one and repeatable).

    The count inverts the Poisson distribution of the source's rate at a uniform hash of seed
    and doc_id, so it depends on nothing but these and the source's number of documents. A
    count of zero leaves a document out: that is what replication to a rate below one means.
    Null sources are one source; null ids hash as the empty string; rows that share an id get
    the same count. Null and empty texts are replicated like others. An empty table gives an
    empty result. An input column named like an added one is replaced.
    """
    rates = stage(source_rates(docs, source, weights, epochs), scratch_path(docs.sparkSession, "rates"))
    # A row per source. Few enough, they are sent to all tasks; else a source with many documents
    # is a skewed key of a join, which adaptive execution splits.
    size = rates.agg(F.coalesce(F.sum(F.size("_cdf") * 8 + F.octet_length(filled("_source")) + 64), F.lit(0)))
    if size.first()[0] <= BROADCAST_BYTES:
        rates = F.broadcast(rates)
    rows = whole_rows(docs)
    drawn = hashed(F.lit(seed), F.col("_row")[doc_id]) / F.lit(float(16**DIGITS))
    rows = rows.join(rates, F.col("_row")[source].eqNullSafe(F.col("_source")))
    count = F.col("_first") + F.transform(F.array(drawn), lambda u: count_at(F.col("_cdf"), u))[0]
    rows = rows.select("_row", count.alias("n_copies"))
    rows = rows.where(F.col("n_copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = hashed(F.lit(seed), F.col("_row")[doc_id], F.col("copy"))
    rows = rows.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    outputs = {name: F.col(name) for name in ("n_copies", "copy", "shuffle_key")}
    return with_outputs(rows, docs.columns, outputs)
