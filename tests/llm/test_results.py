"""Every operator's query against SQL or brute force, over the smallest tables."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from __spark_entry__ import SMOKE_DATA, oracle_sql, queries
from accesslens.llm import phrases
from accesslens.llm.queries import LLM_ORACLE, LLM_QUERIES
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def db():
    return connect(SMOKE_DATA)


@pytest.mark.parametrize("name", LLM_ORACLE)
def test_query_equals_sql(spark, db, name):
    assert difference(LLM_QUERIES[name](spark, SMOKE_DATA), db, LLM_ORACLE[name]) is None


def test_registered():
    assert {*LLM_QUERIES, "pipeline"} <= queries().keys()
    assert LLM_ORACLE.items() <= oracle_sql().items()
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))


def run(spark, name):
    return {row["doc_id"]: row for row in LLM_QUERIES[name](spark, SMOKE_DATA).collect()}


def test_language(spark, documents):
    rows = run(spark, "op1_language_id")
    held = lambda key: zlib.crc32(str(key).encode()) % 4 == 2
    langs = {row.doc_id: row.lang for row in documents.collect()}
    assert rows.keys() == langs.keys()
    assert all(row.held_out == held(key) and 0 <= row.score <= 1 for key, row in rows.items())
    right = [rows[key].lang_pred == lang for key, lang in langs.items() if held(key)]
    assert len(right) > 20 and np.mean(right) > 0.95
    texts = {row.doc_id: row.text for row in documents.collect()}
    profiles = brute.languages((texts[key], lang) for key, lang in langs.items() if not held(key))
    for key, text in texts.items():
        lang, score = brute.language(text, profiles)
        assert (rows[key].lang_pred, rows[key].score) == (lang, pytest.approx(score, abs=1e-12))


def test_suffix_dedup(spark, texts):
    rows = run(spark, "op4_suffix_dedup")
    wanted = [(k, n, r, s, brute.sha(kept)) for k, n, r, s, kept in brute.removed_bytes(texts)]
    assert sorted(tuple(row) for row in rows.values()) == sorted(wanted)


def test_simhash(spark, texts):
    rows = LLM_QUERIES["op5_simhash"](spark, SMOKE_DATA).collect()
    assert sorted(map(tuple, rows)) == sorted(brute.simhash_components(texts))


def check_packing(rows, wanted):
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(wanted, key=repr)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences)


def test_packing(spark, texts):
    rows = LLM_QUERIES["op6_pack_sequences"](spark, SMOKE_DATA).collect()
    used = check_packing(rows, brute.pieces(texts))
    assert used <= 1.05 * sum(row.length for row in rows) / 1024 + 2


def test_phrases(spark, texts):
    rows = run(spark, "op7_phrase_fingerprint")
    texts = sorted(texts)
    for (key, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        row = rows[key]
        assert (row.n_chars, row.edited_sha256) == (n, brute.sha(edited))
        for shown, whole in ((row.fingerprint, text), (row.edited_fingerprint, edited)):
            assert [*phrases.read(shown).tolist()] == brute.phrase_signature(whole.encode())
        sets = [brute.phrases(one.encode()) for one in (text, edited, following)]
        least = [brute.phrase_signature(one.encode()) for one in (text, edited, following)]
        for near, i in ((row.near_edited, 1), (row.near_next, 2)):
            assert near == pytest.approx(brute.alike(least[0], least[i]))
            exact = len(sets[0] & sets[i]) / max(1, len(sets[0] | sets[i]))
            assert abs(near - exact) < 0.3
    assert np.mean([row.near_edited - row.near_next for row in rows.values()]) > 0.3


def test_katz(spark, texts):
    rows = run(spark, "op8_katz_scores")
    held = lambda key: zlib.crc32(str(key).encode()) % 5 == 1
    model = brute.Katz([text for key, text in texts if not held(key)])
    for key, text in texts:
        row, tokens = rows[key], model.tokens(text)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held(key), len(tokens), model.total)
        assert row.n_known == sum(w in model.unigrams for w in tokens)
        assert row.score == pytest.approx(model.score(text), rel=1e-9)
        assert row.base_score == pytest.approx(model.base(text), rel=1e-9)
    tested = [row for row in rows.values() if row.held_out]
    assert sum(row.score for row in tested) > sum(row.base_score for row in tested)


def test_katz_is_normalised(texts):
    """The brute-force model, to which the operator is held, sums to one over words and the unknown one."""
    model = brute.Katz([text for _, text in texts[:40]])
    known = [[c for c in model.contexts if len(c) == n][:20] for n in (1, 2)]
    assert all(map(len, known))
    for context in [(), (None,), ("\n",), ("no word of it",), ("no word", "of it"), *sum(known, [])]:
        whole = sum(model.likely(context, w) for w in [*model.unigrams, "unknown word"])
        assert whole == pytest.approx(1, abs=1e-9)


def test_pipeline(spark, documents):
    """Every stage's work on what the one before kept."""
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "mix_to_weights", "pack"
    ]
    rows = [(row.doc_id, row.text, row.source) for row in documents.collect()]
    judged = [(key, *brute.quality(text), source) for key, text, source in rows]
    rows = [(key, text, source) for key, text, kept, source in judged if kept]
    assert 0 < len(rows) < len(judged)
    deduped = brute.dedup_lines([row[:2] for row in rows])
    rows = [(key, text, source) for (key, _, _, text), (_, _, source) in zip(deduped, rows)]
    groups = brute.simhash_components([row[:2] for row in rows])
    before = len(rows)
    rows = [row for row, (key, _, first) in zip(rows, groups) if key == first]
    assert len(rows) < before
    copies = brute.mixed_copies([(key, source) for key, _, source in rows])
    assert 0 in copies and max(copies) > 1
    rows = [row[:2] for row, n in zip(rows, copies) for _ in range(n)]
    packed = corpus_pipeline.run(spark, SMOKE_DATA).collect()
    check_packing(packed, brute.pieces(rows, Tokenizer.from_file(brute.TOKENIZER)))


def test_stages_return_documents(spark, documents):
    import corpus_pipeline

    docs = documents
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SMOKE_DATA)
        assert docs.dtypes == documents.dtypes
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
