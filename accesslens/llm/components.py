"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.session import delete_path, stage


def _least(links: DataFrame) -> DataFrame:
    """Each node `a` of links a -> b with the least of itself and its neighbours."""
    return links.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the least one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    stars = both.join(_least(both), "a").where(F.col("b") > F.col("a"))
    return stars.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    stars = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return stars.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """(a, b): every node `a` that is not the least of its component, and that least node `b`.

    Every round is written to `folder`, so that a lost executor repeats one round at most; their
    number grows with the logarithm of the nodes, not with the length of a chain of links.
    """
    spark = links.sparkSession
    mark = F.struct(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b") % 2**40), F.lit(0))).alias("mark")
    current = stage(links.select("a", "b").where("a <> b").distinct(), f"{folder}/round-0", spark)
    before, number = current.agg(mark).first()["mark"], 0
    while before[0]:
        number += 1
        following = stage(_small_star(_large_star(current)), f"{folder}/round-{number}", spark)
        after = following.agg(mark).first()["mark"]
        delete_path(spark, f"{folder}/round-{number - 1}")
        current = following
        if after == before:
            break
        before = after
    return current
