"""Words one edit apart, against all pairs."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from __spark_entry__ import SMOKE_DATA
from accesslens.llm import spelling
from accesslens.llm.queries import LLM_QUERIES
from hard_rows import COLUMNS


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    same = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[same + (len(a) == len(b)) :] == long[same + 1 :]


def brute(counts, more_frequent=10):
    rows, form = {}, {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        best = min(near, key=lambda w: (-counts[w], w)) if near else None
        if best is not None and counts[best] >= more_frequent * n:
            form[word] = best
        rows[word] = (n, len(near))
    result = []
    for word, (n, near) in rows.items():
        root = word
        while root in form:
            root = form[root]
        result.append((word, form.get(word), root, n, near, counts[form[word]] if word in form else None))
    return result


def variants(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)
    return [tuple(row) for row in spelling.spelling_variants(words, **options).collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def random_counts(seed, size, letters, lengths, near=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
    counts = {}
    for _ in range(size):
        base = word()
        counts[base] = rng.choice((2, 20, 300, 300, 5000))
        for _ in range(near):
            at, letter = rng.randrange(len(base) + 1), rng.choice(letters)
            made = rng.choice((base[:at] + letter + base[at:], base[:at] + base[at + 1 :], base[:at] + letter + base[at + 1 :]))
            if len(made) >= min(lengths):
                counts[made] = rng.choice((2, 20, 300))
    return counts


@pytest.mark.parametrize("indexed", [8192, 60, 5])
def test_all_pairs(spark, indexed):
    counts = random_counts(1, 150, "abcé\U0001f600", range(7, 12))
    assert ordered(variants(spark, counts, indexed=indexed)) == ordered(brute(counts))


def test_few_letters_and_short_words(spark):
    """Nearly all words are near each other, many in more than one way; halves are hot."""
    counts = random_counts(2, 120, "ab", range(2, 7))
    assert ordered(variants(spark, counts, indexed=20)) == ordered(brute(counts))


def test_one_half_of_all_words(spark):
    """A half that every word shares is split, and no task holds more of it than it is made for."""
    rng = random.Random(5)
    counts = {"prefix" + "".join(rng.choice("xyz") for _ in range(6)): rng.choice((2, 40)) for _ in range(400)}
    assert ordered(variants(spark, counts, indexed=30)) == ordered(brute(counts))


def test_chains_and_ties(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 30, "aaaaaabb": 400, "aaaaabbb": 5000, "zaaaaaaa": 30, "longword": 2, "langword": 20, "lungword": 20}
    rows = {row[0]: row for row in variants(spark, counts)}
    assert rows["aaaaaaaa"][1:3] == ("aaaaaaab", "aaaaabbb")
    assert rows["longword"][1:3] == ("langword", "langword")
    assert ordered(rows.values()) == ordered(brute(counts))


def test_index_by_itself():
    rng = np.random.default_rng(3)
    words = np.unique(["".join(rng.choice(list("abc"), rng.integers(3, 7))) for _ in range(80)])
    index = spelling.VariantIndex(words)
    for reverse in (False, True):
        codes = [np.frombuffer((w[::-1] if reverse else w).encode("utf-32-le"), np.uint32) for w in words]
        lengths = np.array([len(w) for w in words])
        query, word = index.near(index.coded(codes), lengths, lengths // 2, reverse)
        found = {(words[q], words[w]) for q, w in zip(query, word) if q != w}
        half = lambda w: w[::-1][: len(w) // 2] if reverse else w[: len(w) // 2]
        wanted = {
            (a, b) for a in words for b in words
            if one_edit(a, b) and (b[::-1] if reverse else b).startswith(half(a))
        }
        assert wanted <= found and all(one_edit(a, b) for a, b in found)


def test_nulls_and_empty_tables(spark):
    words = spark.createDataFrame([(None, 5), ("alone word", 2)], "word string, n bigint")
    assert [tuple(row) for row in spelling.spelling_variants(words).collect()] == [("alone word", None, "alone word", 2, 0, None)]
    assert spelling.spelling_variants(words.where("false")).collect() == []


def counts_of(texts):
    counts = Counter()
    for key, text in texts:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def test_query_on_hard_rows(spark, tmp_path):
    """Nulls, repeated rows, very long runs, and letters just outside the range."""
    from hard_rows import HARD, PROSE

    rows = [*HARD, (20, "Wörterbuch WÖRTERBUCH wörterbuch Worterbuch ıstanbulda çĀğdaşlar ÇAĞDAŞLAR ×÷×÷×÷×÷ ×÷×÷×÷×", "de", "a", 9)]
    rows += [(30 + i, PROSE * 3 + (" forgoten forgottten" if i < 3 else " forgotten FORGOTTEN"), "en", "a", 9) for i in range(60)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    found = LLM_QUERIES["op11_spelling_variants"](spark, str(tmp_path)).collect()
    assert ordered(map(tuple, found)) == ordered(brute(counts_of((row[0], row[1]) for row in rows)))
    assert any(row.form for row in found)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert LLM_QUERIES["op11_spelling_variants"](spark, f"{tmp_path}/none").collect() == []


def test_given_documents(spark, texts):
    counts = counts_of(texts)
    some = dict(random.Random(1).sample(sorted(counts.items()), 1500))
    found = {row.word: row for row in LLM_QUERIES["op11_spelling_variants"](spark, SMOKE_DATA).collect()}
    assert {word: row.n for word, row in found.items()} == counts
    assert ordered(variants(spark, some, indexed=500)) == ordered(brute(some))
