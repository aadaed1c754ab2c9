"""Token sequences of a fixed size, packed by exact complements and then by best fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.text import filled
from accesslens.llm.tokens import encoder
from accesslens.session import scratch_path, stage

CAPACITY = 1024
END_ID = 2

Pattern = tuple[int, ...]


class ComplementIndex:
    """Which lengths are left, asked for singles, pairs and triples of a given sum."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)

    def _single(self, total: int, most: int) -> Pattern | None:
        return (total,) if 0 < total <= most and self.left[total] else None

    def _pair(self, total: int, most: int) -> Pattern | None:
        """Two lengths, the longer one as long as can be."""
        long = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        if not len(long):
            return None
        short = total - long
        fits = (self.left[long] > 0) & (self.left[short] > 0) & ((long != short) | (self.left[long] > 1))
        at = int(fits.argmax())
        return (int(long[at]), int(short[at])) if fits[at] else None

    def _triple(self, total: int, most: int) -> Pattern | None:
        for long in range(min(most, total - 2), (total + 2) // 3 - 1, -1):
            if self.left[long]:
                self.left[long] -= 1
                rest = self._pair(total - long, long)
                self.left[long] += 1
                if rest:
                    return (long, *rest)
        return None

    def exact(self, length: int, capacity: int) -> Pattern | None:
        """Lengths, this one first, that fill a sequence without a gap."""
        gap = capacity - length
        if not gap:
            return (length,)
        self.left[length] -= 1
        rest = self._single(gap, length) or self._pair(gap, length) or self._triple(gap, length)
        self.left[length] += 1
        return (length, *rest) if rest else None

    def take(self, pattern: Pattern) -> int:
        """Use a pattern as often as its lengths allow."""
        lengths, uses = np.unique(pattern, return_counts=True)
        copies = int((self.left[lengths] // uses).min())
        self.left[lengths] -= uses * copies
        return copies


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns of lengths, with how many sequences are packed like each.

    `counts[n]` pieces have length n. Exact fillings go first, the longest pieces leading; what
    is left goes, again longest first, where it leaves the smallest gap. Only the number of
    pieces of each length matters, so the work and the plan depend on `capacity` alone.
    """
    index, plan = ComplementIndex(counts), []
    for length in range(capacity, 0, -1):
        while index.left[length]:
            pattern = index.exact(length, capacity)
            if pattern is None:
                break
            plan.append((pattern, index.take(pattern)))
    # Sequences that still have room, by the size of the gap: pattern and copies.
    open_bins: list[list[tuple[Pattern, int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        n = int(index.left[length])
        while n:
            gap = next((g for g in range(length, capacity + 1) if open_bins[g]), None)
            if gap is None:
                most = capacity // length
                full, rest = divmod(n, most)
                if full:
                    open_bins[capacity - most * length].append(((length,) * most, full))
                if rest:
                    open_bins[capacity - rest * length].append(((length,) * rest, 1))
                break
            pattern, copies = open_bins[gap].pop()
            used = min(n, copies)
            if used < copies:
                open_bins[gap].append((pattern, copies - used))
            open_bins[gap - length].append(((*pattern, length), used))
            n -= used
    return plan + [group for groups in open_bins for group in groups]


def slot_table(plan: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Runs of the pieces of a length (by rank) that take the same place in like sequences."""
    runs, next_rank, sequence = [], {}, 0
    for pattern, copies in plan:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            runs.append((length, rank, sequence, offset))
            next_rank[length] = rank + copies
            offset += length
        sequence += copies
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), columns))


def place_column(slots: dict[str, np.ndarray], length: Column, rank: Column) -> Column:
    """(sequence_id, offset) of the piece with this rank among those of its length."""

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        n, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        at = np.empty(len(n), np.int64)
        for one in np.unique(n):
            first, last = np.searchsorted(slots["length"], [one, one + 1])
            here = n == one
            at[here] = first + np.searchsorted(slots["rank"][first:last], r[here], "right") - 1
        return pd.DataFrame({"sequence_id": slots["sequence"][at] + r - slots["rank"][at], "offset": slots["offset"][at]})

    return place(length, rank)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Documents as pieces of at most `capacity` ids.

    (doc_id, piece, start, length, ids: little-endian unsigned 32-bit, _part, _rank: the place
    among the pieces of this length that the same task made). Write the result before its parts
    and ranks are used: tasks are numbered as they run.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, piece int, start bigint, length bigint, ids binary, _part int, _rank bigint"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(tokenizer_path).ids
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, ids = [], []
            for i, one in enumerate(batch.column(1)):
                whole = encode(one.as_py()) + end
                total = len(whole) // 4
                stop = (total - 1) % capacity + 1
                start = piece = 0
                while start < total:
                    rows.append((i, piece, start, stop - start, part, seen[stop - start]))
                    ids.append(whole[4 * start : 4 * stop])
                    seen[stop - start] += 1
                    piece, start, stop = piece + 1, stop, stop + capacity
            i, piece, start, length, parts, ranks = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(i)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(ids, pa.binary()),
                    pa.array(parts, pa.int32()),
                    pa.array(ranks),
                ],
                names=[doc_id, "piece", "start", "length", "ids", "_part", "_rank"],
            )

    return docs.select(F.col(doc_id).alias(doc_id), filled(text).alias("_text")).mapInArrow(cut, schema)


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> tuple[DataFrame, DataFrame]:
    """Every piece's place in a sequence, and the pieces with their ids.

    Returns (placed, pieces). placed: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, _part, _rank; a row per piece, offsets of a sequence without a gap from 0. pieces:
    what `token_pieces` gives, written once; `packed_tokens` joins the two.

    A document's ids are those of its text and `end_id`; one longer than `capacity` is cut into
    pieces of `capacity` ids, the first of which may be shorter. Null and empty texts are the
    end id alone. Repeated rows and ids are packed each on its own; null ids stay null. An empty
    table gives an empty result. Other columns are not read, whatever their names.

    Only counts per length reach the driver, and the plan it makes of them is bounded by
    `capacity`; pieces are told apart by their rank among equal lengths, which tasks count as
    they write and one sum per task and length makes global.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "packing")
    pieces = stage(token_pieces(docs, tokenizer_path, doc_id, text, capacity, end_id), f"{folder}/pieces", spark)
    sizes = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stage(
        sizes.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))), f"{folder}/sizes", spark
    )
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("_n")).collect():  # a row per length
        counts[length] = n
    slots = slot_table(plan_packing(counts, capacity))
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    ranked = narrow.join(sizes.drop("_n"), ["length", "_part"])
    placed = ranked.withColumn("_at", place_column(slots, F.col("length"), F.col("_first") + F.col("_rank")))
    return (
        placed.select(
            doc_id, "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset", "_part", "_rank"
        ),
        pieces,
    )


def packed_tokens(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): every sequence's ids joined in order; a sequence has `capacity` ids at most."""
    rows = placed.select("sequence_id", "offset", "length", "_part", "_rank").join(
        pieces.select("length", "_part", "_rank", "ids"), ["length", "_part", "_rank"]
    )
    joined = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_rows"))
    whole = F.aggregate("_rows", F.lit(b"").cast("binary"), lambda ids, row: F.concat(ids, row["ids"]))
    return joined.select("sequence_id", whole.alias("ids"))
