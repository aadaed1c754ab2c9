"""Repeated lines, found with levelled sorted runs of line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm.text import WHITE, ascii_lower, filled, whole_rows, with_outputs
from accesslens.session import scratch_path, stage

FEWEST_CHARS = 20
FEWEST_DOCS = 3
BATCHES = 4
FANOUT = 2
KEY = ["h", "g"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


class LineRuns:
    """Sorted runs of line hashes in levels, for batches that come one after the other.

    A run holds keys that no earlier run holds: (h, g, holder, n_docs), sorted by hash, where
    holder is the largest id of the batch that brought the key and n_docs how many of its
    documents have it. Once a level has `fanout` runs they are merged into one of the next.
    What later batches meet again is kept as counts (h, g, n_docs).
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.again: list[DataFrame] = []
        self.written = 0

    def _write(self, rows: DataFrame) -> DataFrame:
        self.written += 1
        return stage(rows, f"{self.folder}/run-{self.written}", self.spark)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, keys: DataFrame) -> None:
        """Merge-anti-join a batch (h, g, holder, n_docs; a row per key) with the runs, add the rest."""
        fresh = keys
        if self.runs():
            held = self._together(self.runs()).select(*KEY)
            self.again.append(
                self._write(keys.join(held.hint("merge"), KEY, "left_semi").select(*KEY, "n_docs"))
            )
            fresh = keys.join(held.hint("merge"), KEY, "left_anti")
        self.levels[0].append(self._write(fresh.sortWithinPartitions(*KEY)))
        self._compact()

    def _compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                merged = self._together(runs).repartition(*KEY).sortWithinPartitions(*KEY)
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level] = []
                self.levels[level + 1].append(self._write(merged))

    @staticmethod
    def _together(frames: list[DataFrame]) -> DataFrame:
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    def totals(self) -> DataFrame:
        """(h, g, holder, n_docs) over all batches."""
        rows = self._together(self.runs())
        if self.again:
            more = self._together(self.again).withColumn("holder", F.lit(None).cast(rows.schema["holder"].dataType))
            rows = rows.unionByName(more)
        return rows.groupBy(*KEY).agg(F.max("holder").alias("holder"), F.sum("n_docs").alias("n_docs"))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = FEWEST_CHARS,
    min_docs: int = FEWEST_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Every input row with lines dropped that a document of a larger id also holds.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of at least
    `min_chars` code points in at least `min_docs` documents lose all their lines, except in
    the largest id holding it. Added columns: n_lines, n_dropped, kept_text.

    Documents go in `batches` ranges of ids, the highest first, so that the run that brings a
    key names the id that keeps it. Keys are compared by 96 hash bits.

    A null or empty text has one empty line, which stays. Rows that share an id are one
    document: its lines count once and none of them is dropped for another of its rows. Null
    ids are one document, below all others. Ties and repeated rows get the same result each.
    An empty table gives an empty result. An input column named like an added one is replaced.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "line-runs")
    rows = whole_rows(docs).select(
        "_row",
        F.col("_row")[doc_id].alias("_id"),
        F.xxhash64(filled(F.col("_row")[text])).alias("_text"),
    )
    lines = F.split(filled(F.col("_row")[text]), "\n")
    found = rows.select("_id", "_text", F.posexplode(lines).alias("_at", "_line"))
    found = found.select("_id", "_text", "_at", line_key(F.col("_line")).alias("_key"))
    found = found.where(F.length("_key") >= min_chars)
    found = stage(
        found.select("_id", "_text", "_at", F.xxhash64("_key").alias("h"), F.hash("_key").alias("g")),
        f"{folder}/lines",
        spark,
    )
    # Any bounds give the same result; `batches` numbers come to the driver.
    shares = [i / batches for i in range(1, batches)]
    bounds = found.agg(F.percentile_approx("_id", shares, 1000)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    # Batch 0 has the highest ids. A null id is not below any bound, so it goes to the last batch.
    batch = F.lit(len(bounds))
    for i, bound in enumerate(bounds):
        batch = F.when(F.col("_id") > bound, len(bounds) - 1 - i).otherwise(batch)
    keys = found.groupBy(*KEY, "_id").agg(F.lit(1).alias("_one")).withColumn("_batch", batch)
    keys = stage(
        keys.groupBy("_batch", *KEY).agg(F.max("_id").alias("holder"), F.count(F.lit(1)).alias("n_docs")),
        f"{folder}/keys",
        spark,
    )
    runs = LineRuns(spark, folder, fanout)
    for i in range(len(bounds) + 1):
        runs.add(keys.where(F.col("_batch") == i).drop("_batch"))
    repeated = runs.totals().where((F.col("n_docs") >= min_docs) & F.col("holder").isNotNull()).drop("n_docs")
    # Written, so that both sides of the join are plain shuffles, of which a frequent line's can be split.
    repeated = stage(repeated, f"{folder}/repeated", spark)
    drops = found.join(repeated, KEY).where(F.col("_id").isNull() | (F.col("_id") < F.col("holder")))
    drops = drops.select(F.col("_id").alias("_drop_id"), F.col("_text").alias("_drop_text"), "_at").distinct()
    drops = drops.groupBy("_drop_id", "_drop_text").agg(F.collect_list("_at").alias("_drops"))
    rows = rows.join(
        drops, F.col("_id").eqNullSafe(F.col("_drop_id")) & (F.col("_text") == F.col("_drop_text")), "left"
    )
    # Split again: the lines as well as the text would be twice the text to shuffle.
    rows = rows.withColumn("_lines", lines)
    n = F.size("_lines")
    # Set difference by hashing keeps the order of the first array.
    places = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_drops"))
    kept = F.when(F.col("_drops").isNull(), F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(F.when(F.size(places) > 0, places).otherwise(F.array().cast("array<int>")),
                                 lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    outputs = {
        "n_lines": n.cast("bigint"),
        "n_dropped": F.when(F.col("_drops").isNull(), 0).otherwise(F.size("_drops")).cast("bigint"),
        "kept_text": kept,
    }
    return with_outputs(rows, docs.columns, outputs)
