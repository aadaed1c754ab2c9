"""Spelling variants: words one edit apart, by search schemes over a bidirectional FM-index.

Two words that differ by one inserted, deleted or replaced code point share a half: with the first word
cut in the middle, either its left half begins the other word or its right half ends it. So words are
dealt out by halves, every group of halves is indexed, and a word is looked up by matching a half from
the delimiter on exactly and going on across the other with one error, up to the next delimiter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.text import ascii_lower, filled
from accesslens.session import scratch_path, stage

RUN = r"[A-Za-zÀ-ÿ]"
# Words an index holds, and that are looked up in it side by side.
INDEXED = 8192
# A variant's form is so many times as frequent.
MORE_FREQUENT = 10


def _rotations(text: np.ndarray) -> np.ndarray:
    """Where the rotations of a cyclic text begin, in their order."""
    rank, width = text.astype(np.int64), 1
    while True:
        _, rank = np.unique(rank * (len(text) + 1) + np.roll(rank, -width), return_inverse=True)
        width *= 2
        if width >= len(text) or rank.max() == len(text) - 1:
            return np.argsort(rank, kind="stable")


class _Ranks:
    """The last column of the sorted rotations: how often each symbol stands above a row."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = _rotations(text)
        column = text[self.order - 1]
        self.above = np.zeros((len(text) + 1, symbols), np.int32)
        self.above[np.arange(1, len(text) + 1), column] = 1
        np.cumsum(self.above, axis=0, out=self.above)
        # Of all symbols before one together, and where rotations that begin with one begin.
        self.smaller = np.cumsum(self.above, axis=1, dtype=np.int32) - self.above
        self.first = self.smaller[-1].astype(np.int64)

    def extended(self, row: np.ndarray, twin: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """Intervals here and in the twin index after one more symbol at this index's end."""
        above = self.above[row, symbol]
        smaller = self.smaller[row + size, symbol] - self.smaller[row, symbol]
        return self.first[symbol] + above, twin + smaller, self.above[row + size, symbol] - above


class VariantIndex:
    """A bidirectional index of distinct words, each between delimiters (symbol 0).

    An interval is (row, twin, size): rows of the rotations that begin with a string, and of the
    rotations of the reversed text that begin with the reversed string.
    """

    def __init__(self, words: np.ndarray):
        codes = [np.frombuffer(word.encode("utf-32-le"), np.uint32) for word in words]
        self.letters = np.unique(np.concatenate(codes))
        self.lengths = np.array([len(one) for one in codes])
        self.spelt = self.coded(codes)
        ends = np.concatenate(([0], np.cumsum(self.lengths + 1)))
        text = np.zeros(ends[-1], np.int64)
        inside = np.ones(len(text), bool)
        inside[ends[:-1]] = False
        text[inside] = self.spelt[self.spelt >= 0]
        self.sides = _Ranks(text, len(self.letters) + 1), _Ranks(text[::-1], len(self.letters) + 1)
        # The first rows are the rotations that begin with a delimiter, one for each word.
        self.word_at = np.searchsorted(ends, self.sides[0].order[: len(words)])

    def coded(self, codes: list[np.ndarray]) -> np.ndarray:
        """Words as rows of symbols, filled up with -1; a letter that no word has is the last symbol's next."""
        table = np.full((len(codes), max(map(len, codes)) + 1), -1, np.int64)
        for row, one in zip(table, codes):
            row[: len(one)] = one
        known = table >= 0
        place = np.searchsorted(self.letters, table[known])
        there = self.letters[np.minimum(place, len(self.letters) - 1)] == table[known]
        table[known] = np.where(there, place + 1, len(self.letters) + 1)
        return table

    def near(self, queries: np.ndarray, lengths: np.ndarray, halves: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for words one edit from a query whose first `halves` symbols are exact.

        With `reverse` the queries are spelt backwards, and words are found from their ends. A pair may
        come out more than once, and a query comes out with itself if two edits undo each other.
        """
        side = self.sides[0] if reverse else self.sides[1]
        symbols = len(self.letters) + 1
        number, delimiters = np.arange(len(queries)), len(self.word_at)
        row = twin = np.zeros(len(queries), np.int64)
        size = np.full(len(queries), delimiters)
        found: list[tuple[np.ndarray, ...]] = []
        for at in range(int(lengths.max()) + 1):
            exact = at < halves[number]
            spent = [number[:0]] * 5
            if not exact.all():
                spent = self._errors(side, number[~exact], at, row[~exact], twin[~exact], size[~exact], queries, lengths)
                found.append(spent)
            more = at < lengths[number]
            number, row, twin, size = number[more], row[more], twin[more], size[more]
            symbol = queries[number, at]
            known = symbol < symbols
            number, row, twin, size, symbol = number[known], row[known], twin[known], size[known], symbol[known]
            row, twin, size = side.extended(row, twin, size, symbol)
            alive = size > 0
            number, row, twin, size = number[alive], row[alive], twin[alive], size[alive]
        number, at, row, twin, size = (np.concatenate(part) for part in zip(*found))
        while True:
            ended = at > lengths[number]
            if ended.all():
                break
            # The rest is exact, and a delimiter ends it.
            symbol = np.where(at < lengths[number], queries[number, np.minimum(at, queries.shape[1] - 1)], 0)
            symbol = np.where(ended, 0, symbol)
            known = symbol < symbols
            number, at, row, twin, size, symbol, ended = (one[known] for one in (number, at, row, twin, size, symbol, ended))
            new_row, new_twin, new_size = side.extended(row, twin, size, symbol)
            row, twin, size = (np.where(ended, old, new) for old, new in ((row, new_row), (twin, new_twin), (size, new_size)))
            at = at + ~ended
            alive = size > 0
            number, at, row, twin, size = (one[alive] for one in (number, at, row, twin, size))
        return number, self.word_at[row if reverse else twin]

    def _errors(self, side: _Ranks, number, at, row, twin, size, queries, lengths) -> tuple[np.ndarray, ...]:
        """(query, next symbol, row, twin, size) with the one error made here, for every symbol it can be made with."""
        counts = side.above[row + size, 1:] - side.above[row, 1:]
        one, symbol = np.nonzero(counts)
        symbol += 1
        grown = side.extended(row[one], twin[one], size[one], symbol)
        inserted = (number[one], np.full(len(one), at), *grown)
        within = at < lengths[number[one]]
        other = within & (symbol != queries[number[one], min(at, queries.shape[1] - 1)])
        replaced = (number[one][other], np.full(other.sum(), at + 1), *(part[other] for part in grown))
        left = at < lengths[number]
        deleted = (number[left], np.full(left.sum(), at + 1), row[left], twin[left], size[left])
        return tuple(np.concatenate(parts) for parts in zip(inserted, replaced, deleted))


def _search(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """What the words of one bucket find: how many near words, and the most frequent of them."""
    columns = ["word", "n_near", "best_n", "best"]
    if queries.empty or entries.empty:
        return pd.DataFrame([], columns=columns)
    keys = pd.Index(entries["key"].unique())
    queries = queries[queries["key"].isin(keys)]
    words, word_of = np.unique(entries["word"].to_numpy(dtype=object).astype(str), return_inverse=True)
    held = np.unique(keys.get_indexer(entries["key"]).astype(np.int64) * len(words) + word_of)
    frequency = np.zeros(len(words), np.int64)
    frequency[word_of] = entries["n"].to_numpy()
    index = VariantIndex(words)
    found = []
    for side in (0, 1):
        mine = queries[queries["side"] == side]
        for start in range(0, len(mine), INDEXED):
            some = mine.iloc[start : start + INDEXED]
            codes = [np.frombuffer(word.encode("utf-32-le"), np.uint32) for word in some["word"]]
            lengths = np.array([len(one) for one in codes])
            halves = lengths // 2
            straight = index.coded(codes)
            if side:
                spelt, exact = index.coded([one[::-1] for one in codes]), lengths - halves
            else:
                spelt, exact = straight, halves
            query, word = index.near(spelt, lengths, exact, bool(side))
            query, word = np.divmod(np.unique(query * len(words) + word), len(words))
            # Only words of the query's own half count here, and only one side counts a word.
            key = keys.get_indexer(some["key"])[query]
            place = np.searchsorted(held, key * len(words) + word)
            good = held[np.minimum(place, len(held) - 1)] == key * len(words) + word
            width = min(straight.shape[1], index.spelt.shape[1])
            same = straight[query, :width] == index.spelt[word, :width]
            in_half = np.arange(width) < halves[query][:, None]
            begins = (same | ~in_half).all(axis=1) & (halves[query] <= index.lengths[word])
            good &= begins if not side else ~begins
            itself = (index.lengths[word] == lengths[query]) & same.all(axis=1)
            good &= ~itself
            spelling = some["word"].to_numpy(dtype=object)[query[good]]
            found.append(pd.DataFrame({"word": spelling, "best": words[word[good]], "best_n": frequency[word[good]]}))
    found = pd.concat(found).sort_values(["best_n", "best"], ascending=[False, True], kind="stable")
    grouped = found.groupby("word", sort=False)
    result = grouped.agg(n_near=("best", "size"), best_n=("best_n", "first"), best=("best", "first")).reset_index()
    return result[columns]


def _halves(word: str, lengths: range) -> list[Column]:
    """A word's two halves, cut as words of its length plus each of `lengths` are, as (side, half)."""
    size = F.length(word)
    cut = []
    for more in lengths:
        left = F.floor((size + more) / 2).cast("int")
        right = (size + more - left).cast("int")
        cut.append(F.struct(F.lit(0).alias("side"), F.substring(F.col(word), F.lit(1), left).alias("half")))
        cut.append(F.struct(F.lit(1).alias("side"), F.substring(F.col(word), size - right + 1, right).alias("half")))
    return cut


def near_words(words: DataFrame, folder: str, indexed: int = INDEXED) -> DataFrame:
    """(word, n_near, best_n, best): for words with near ones, their number and the most frequent.

    `words` is (word, n), each word once. A half that more than `indexed` words share is split: a part
    of its words is indexed at a time, and a part of them looked up in each.
    """
    spark = words.sparkSession
    entries = words.select("word", "n", F.explode(F.array_distinct(F.array(*_halves("word", range(-1, 2))))).alias("cut"))
    entries = entries.select("word", "n", "cut.side", "cut.half")
    queries = words.select("word", F.explode(F.array(*_halves("word", range(1)))).alias("cut")).select("word", "cut.side", "cut.half")
    sizes = stage(entries.groupBy("side", "half").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"{folder}/sizes", spark)
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = int(max(1, -(-total // indexed)))
    # A half that only one word has finds that word itself.
    parts = F.ceil(F.col("size") / indexed).cast("bigint")
    sizes = sizes.select("side", "half", parts.alias("parts"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(sizes, ["side", "half"]).withColumn(own, F.pmod(F.xxhash64("word"), F.col("parts")))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        key = F.concat_ws(":", "side", "_indexed", "_asked", "half")
        rows = rows.withColumns({"key": key, "bucket": F.pmod(F.xxhash64(key), F.lit(buckets))})
        # Columns of their own: both sides come from the same words.
        rows = rows.drop("half", "parts", "_indexed", "_asked")
        return rows.toDF(*rows.columns)

    entries = dealt(entries, "_indexed", "_asked").groupBy("bucket")
    queries = dealt(queries, "_asked", "_indexed").groupBy("bucket")
    found = entries.cogroup(queries).applyInPandas(_search, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 1) -> DataFrame:
    """(id, run): maximal runs of letters (`RUN`) of at least so many code points, A-Z lower-cased."""
    every = F.regexp_extract_all(filled(text), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("id"), F.explode(every).alias("run"))
    return rows.select("id", ascii_lower(F.col("run")).alias("run"))


def spelling_variants(words: DataFrame, more_frequent: int = MORE_FREQUENT, indexed: int = INDEXED) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of `words`, (word, n) with every word once.

    Words are near if one code point inserted, deleted or replaced makes one of the other. A word's
    form is the most frequent near word (ties: the first in code-point order), if it is at least
    `more_frequent` times as frequent; its root is the last of the forms that follow from it, or the
    word itself. Words need two code points at least; null words and an empty table give no rows.
    """
    spark = words.sparkSession
    folder = scratch_path(spark, "spelling")
    words = stage(words.where("word IS NOT NULL").select("word", "n"), f"{folder}/words", spark)
    near = words.join(near_words(words, folder, indexed), "word", "left")
    chosen = F.col("best_n") >= more_frequent * F.col("n")
    rows = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n"),
    )
    rows = stage(rows, f"{folder}/forms", spark)
    # Every round doubles how far a root looks; forms grow tenfold a step, so there are few.
    roots, number = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = roots.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        further = stage(further, f"{folder}/roots-{number}", spark)
        roots, number = further.drop("moved"), number + 1
        if not further.where("moved").head(1):
            break
    rows = rows.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
