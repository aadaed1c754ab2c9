"""Line-first cleaning: failing lines go, then documents that lost too much text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.text import WORD, filled, held, whole_rows, with_outputs, words

SYMBOLS = "[#*$%&|<>]"
SEPARATORS = ("|", ">", "/", "-")
# Marks of sentences and clauses, of other scripts too.
PUNCTUATION = r"[.!?,;:]|(?=[^\x00-\x7F])\p{Po}"
BOILERPLATE = (
    "(?i)(all rights reserved|cookie policy|privacy policy|terms of use|terms of service"
    "|enable javascript|javascript is disabled|click here|skip to content|sign up for"
    "|log in to|subscribe to our)"
)

# Line rules.
MOST_SYMBOLS = 0.1  # of the characters in words
NAVIGATION_MARKS = 3  # standing alone, and at least every fourth word
UNPUNCTUATED_WORDS = 40  # so many words need at least one punctuation mark
BOILERPLATE_WORDS = 25  # a longer line that names a policy is prose about it

# Document rules.
FEWEST_WORDS = 50
MOST_REPEATED = 50  # per cent of words
MOST_LOST = 0.5  # of the characters in words


def _word_chars(parts: Column) -> Column:
    return F.length(F.array_join(parts, ""))


def line_fails(line: Column) -> Column:
    """Whether one line breaks the punctuation, navigation or boilerplate rule.

    A line without a word never fails.
    """

    def judge(parts: Column) -> Column:
        n = F.size(parts)
        marks = F.size(F.filter(parts, lambda word: word.isin(*SEPARATORS)))
        symbols = F.regexp_count(line, F.lit(SYMBOLS))
        return (n > 0) & (
            (symbols > MOST_SYMBOLS * _word_chars(parts))
            | ((marks >= NAVIGATION_MARKS) & (marks * 4 >= n))
            | ((n >= UNPUNCTUATED_WORDS) & ~line.rlike(PUNCTUATION))
            | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
        )

    # An array of one binds the words, so that they are split once.
    return F.transform(F.array(words(line)), judge)[0]


def _repeat_words(windows: Column) -> Column:
    """Words inside windows whose hash comes twice or more; a word in several counts once.

    Sorting (hash, place) brings equal windows together: n log n for a text of any length.
    """

    def covered(order: Column) -> Column:
        same = F.filter(
            order,
            lambda at, i: (at["h"] == F.get(order, i - 1)["h"]) | (at["h"] == F.get(order, i + 1)["h"]),
        )
        return F.transform(F.array(F.sort_array(F.transform(same, lambda at: at["i"]))), steps)[0]

    def steps(places: Column) -> Column:
        reach = F.transform(places, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - at, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("bigint"), lambda total, step: total + step)

    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Most texts repeat no window, and a hash set finds that out without sorting.
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
        F.transform(F.array(order), covered)[0]
    )


def line_first_clean(docs: DataFrame, text: str = "text", max_lost: float = MOST_LOST) -> DataFrame:
    """Every input row with its figures, its cleaned text and the verdict.

    Added columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (figures of
    the input text), n_lines, n_lines_removed, lost_chars, cleaned_text, base_failed, kept.

    Null text counts as no words: rejected, cleaned text empty. Empty text likewise. Ties do
    not occur, and repeated rows are judged alike, each on its own. An empty table gives an
    empty result. An input column named like an added one is replaced, others stay. Texts of
    any length are judged whole; nothing is shuffled.
    """
    parts, lines, hashes, windows = (F.col(f"_{name}") for name in ("words", "lines", "hashes", "windows"))
    frame = whole_rows(docs).withColumn("_text", filled(F.col("_row")[text]))
    frame = frame.withColumns({"_words": words(F.col("_text")), "_lines": F.split("_text", "\n")})
    frame = frame.withColumns(
        {
            "_hashes": F.transform(parts, lambda word: F.xxhash64(word)),
            "_kept": F.filter(lines, lambda line: ~line_fails(line)),
            "_worded": F.filter(lines, lambda line: line.rlike(WORD)),
        }
    )
    after = lambda i, k: F.get(hashes, i + k)
    frame = frame.withColumn(
        "_windows",
        F.slice(
            F.transform(hashes, lambda h, i: F.xxhash64(h, after(i, 1), after(i, 2))),
            F.lit(1),
            F.greatest(F.size(hashes) - 2, F.lit(0)),
        ),
    )
    frame = frame.select(
        "_row",
        held(F.size(parts).cast("bigint")).alias("n_words"),
        _word_chars(parts).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(windows).alias("n_repeat_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size("_kept")).cast("bigint").alias("n_lines_removed"),
        (_word_chars(parts) - _word_chars(words(F.array_join("_kept", "\n")))).cast("bigint").alias("lost_chars"),
        F.array_join("_kept", "\n").alias("cleaned_text"),
    )
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    frame = frame.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("word_chars"))
    added = [name for name in frame.columns if name != "_row"]
    return with_outputs(frame, docs.columns, {**{name: F.col(name) for name in added}, "kept": kept})
