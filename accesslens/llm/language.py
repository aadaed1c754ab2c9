"""Language identification by rank-order profiles of n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.text import whole_rows, with_outputs

LONGEST_GRAM = 3
PROFILE = 400
UNKNOWN = "und"
BLANK = 32
SIGN_BITS = 21
# Profile entries counted in one worker before they are handed on.
HELD = 2_000_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text, as numbers, and how often each comes.

    Letters are lower-cased; whatever lies between them is one blank. An n-gram may begin or end
    with a blank, but has none inside, and a blank alone is none.
    """
    signs = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    signs = np.where(_letters()[signs], signs, BLANK)
    signs = np.concatenate(([BLANK], signs, [BLANK])).astype(np.int64)
    blank = signs == BLANK
    kept = ~(blank & np.concatenate(([False], blank[:-1])))
    signs, blank = signs[kept], blank[kept]
    grams = []
    for n in range(1, LONGEST_GRAM + 1):
        places = len(signs) - n + 1
        if places <= 0:
            break
        value, broken = np.zeros(places, np.int64), np.zeros(places, bool)
        for k in range(n):
            value |= signs[k : k + places] << (SIGN_BITS * k)
            if 0 < k < n - 1 or n == 1:
                broken |= blank[k : k + places]
        grams.append(value[~broken])
    return _counted(np.concatenate(grams)) if grams else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return values[first], np.diff(np.append(first, len(values)))


def _top(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, ties by number."""
    return grams[np.lexsort((grams, -counts))[:most]]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank from 0): the most frequent n-grams of each language.

    Every labelled text counts, whole. Tasks add up their n-grams before they are shuffled, and
    a language's list is cut to `size` in every task before it is ranked. Rows with a null
    language or text teach nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = defaultdict(list)
        held = 0

        def added_up() -> Iterator[pa.RecordBatch]:
            for name, pieces in parts.items():
                grams, places = np.unique(np.concatenate([p[0] for p in pieces]), return_inverse=True)
                sums = np.bincount(places, np.concatenate([p[1] for p in pieces])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(sums)], ["lang", "gram", "n"]
                )
            parts.clear()

        for batch in batches:
            for name, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                counted = gram_counts(one.as_py())
                parts[name].append(counted)
                held += len(counted[0])
                if held > HELD:
                    yield from added_up()
                    held = 0
        yield from added_up()

    labelled = docs.select(F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")).dropna()
    counts = labelled.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    return ranked.select("lang", "gram", (F.col("rank") - 1).alias("rank"))


def identify(docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = PROFILE) -> DataFrame:
    """Every input row with the language whose profile its most frequent n-grams fit best.

    Added columns: lang_pred, score. A document's ranks are compared with every profile's; an
    n-gram out of place costs the difference, one that a profile lacks costs `size`. score is
    one less the distance over the largest possible one. Languages at the same distance: the
    first by name. Null texts and texts without a letter are `und` with score zero, as is
    everything if there are no profiles. Repeated rows get the same answer, an empty table an
    empty result; an input column named like an added one is replaced. Whole texts are read.

    The profiles come to the driver: `size` rows for each language.
    """
    rows = profiles.collect()
    names = sorted({row["lang"] for row in rows})
    known = np.array(sorted({row["gram"] for row in rows}), np.int64)
    place = {name: i for i, name in enumerate(names)}
    # A last line for n-grams that no profile has.
    ranks = np.full((len(known) + 1, len(names)), -1, np.int64)
    for row in rows:
        ranks[np.searchsorted(known, row["gram"]), place[row["lang"]]] = row["rank"]

    def judge(text: str | None) -> tuple[str, float]:
        if not text or not names:
            return UNKNOWN, 0.0
        mine = _top(*gram_counts(text), size)
        if not len(mine):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        at = np.where(known[at] == mine, at, len(known))
        theirs = ranks[at]
        cost = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(mine))[:, None]))
        total = cost.sum(axis=0)
        best = int(total.argmin())
        return names[best], float(1 - total[best] / (size * len(mine)))

    @F.pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(one) for one in texts], columns=["lang_pred", "score"])

    frame = whole_rows(docs)
    frame = frame.withColumn("_judged", judged(F.col("_row")[text]))
    outputs = {name: F.col("_judged")[name] for name in ("lang_pred", "score")}
    return with_outputs(frame, docs.columns, outputs)
