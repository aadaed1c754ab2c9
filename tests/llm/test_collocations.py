"""Phrase counts and scores against plain Python, in blocks, tiles and rounds of any size."""

import random
import re
from collections import Counter, defaultdict

import pytest

from accesslens.llm import collocations as module
from accesslens.llm.collocations import collocations, split_words
from hard_rows import HARD


def pieces(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, most_words=3, least=10, top=2000):
    """[(lang, text)] -> rows of the operator"""
    counts = defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            for size in range(1, most_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    result = []
    for lang, f in counts.items():
        n, scored = sum(c for p, c in f.items() if len(p) == 1), []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(a, inside.get(p[i : i + size], 0))
        for p, a in candidates.items():
            if 100 * inside.get(p, -a) >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def random_rows(seed=1, docs=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "New", "york", "city", "\x1c\x00", " x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for _ in range(docs):
        text = []
        for word in rng.choices(words, weights, k=rng.randrange(0, 120)):
            text.append("New York City" if word == "york" else word)
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "?!\r"]))
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(text)))
    return rows + [(None, None), ("en", ""), ("fr", " .,. "), ("en", "hot pair " * 900), ("de", "a"), ("hot", "very " * 3000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


def found(docs, **options):
    return sorted(map(tuple, collocations(docs, **options).collect()))


SMALL = {"TILE_PAIRS": 700, "FAN_IN": 4, "CELL": 7, "OPEN_TOKENS": 100}


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, monkeypatch, small):
    """The same with blocks that cut long pieces, many strips, sparse tiles and several rounds."""
    if small:
        for name, value in SMALL.items():
            monkeypatch.setattr(module, name, value)
    rows = random_rows()
    wanted = brute(rows)
    assert len(wanted) > 60 and any(len(row[2].split(" ")) == 3 for row in wanted)
    assert found(frame(spark, rows), **({"block_tokens": 300} if small else {})) == wanted


@pytest.mark.parametrize("words", [2, 4])
def test_phrases_of_other_lengths(spark, monkeypatch, words):
    monkeypatch.setattr(module, "TILE_PAIRS", 2000)
    rows = random_rows(2, 80)
    assert found(frame(spark, rows), most_words=words, least=5, top=30, block_tokens=500) == brute(rows, words, 5, 30)


def test_ties_at_the_last_rank(spark):
    rows = [("en", "\n".join(f"x{i} y{i}" for i in range(60)))] * 11
    wanted = brute(rows, top=7)
    assert found(frame(spark, rows), top=7) == wanted and len(wanted) == 7


def test_products_beyond_64_bits(spark):
    """Counts as large data has them: scores are whole numbers without rounding."""
    big = 3_037_000_500
    pairs = spark.createDataFrame([("en", 0, 1, big - 1)], "lang string, w1 long, w2 long, f long")
    words = spark.createDataFrame([("en", 0, big), ("en", 1, big + 7)], "lang string, w1 long, f long")
    row = module._scored(pairs, {1: words}, 2).first()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 7))


def test_words():
    text = "A.b\x0b c\tÉD;e!\xa0f\x85g \x00h\x1ci\n" * 2
    assert [w.decode() for w in split_words(text) if w != module.BREAK] == sum(pieces(text), [])


def test_hard_rows(spark, hard, none):
    docs = hard.unionByName(hard).unionByName(hard)
    assert found(docs) == brute([(row[2], row[1]) for row in HARD * 3])
    assert found(none) == []
    nulls = hard.selectExpr("CAST(NULL AS string) AS text", "lang")
    assert found(nulls) == []
