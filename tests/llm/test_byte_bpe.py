"""Ids as `tiktoken` gives them, texts read back, and the decoder against Python's."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import brute
from __spark_entry__ import SMOKE_DATA
from accesslens.llm import byte_bpe
from accesslens.llm.queries import LLM_QUERIES
from hard_rows import HARD

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = [
    "abcdeàéüß '", "中文かなあいうえお", "привет мир ", "0123456789 ,.!?-—=#\n\t\r  ", "'s're don't I'll ",
    "".join(map(chr, range(0x20, 0x3000, 11))), "\U0001f600\U00032000՘֋꟎\U00011de0 a1", "aaaa    ----____",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ours():
    return byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_random_texts(library, ours):
    rng = random.Random(3)
    for _ in range(4_000):
        signs = "".join(rng.sample(SIGNS, rng.randrange(1, 4)))
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(60)))
        assert ours.ids(text) == packed(library.encode_ordinary(text)), text
        assert ours.text(ours.ids(text)) == text


def test_forgetting_changes_nothing(library, monkeypatch, texts):
    monkeypatch.setattr(byte_bpe, "STATES", 40)
    monkeypatch.setattr(byte_bpe, "PAIRS", 30)
    small = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    for _, text in texts[:20]:
        assert small.ids(text) == packed(library.encode_ordinary(text))
        assert small.text(small.ids(text)) == text
    assert len(small.transducer.states) <= 40


def test_steps_look_no_further_than_they_have_to(texts, monkeypatch):
    """A prefix has one last token: none is tried after it. Readings that differ at once are not taken apart."""
    apart = []
    tokens = byte_bpe._tokens
    monkeypatch.setattr(byte_bpe, "_tokens", lambda packed: apart.append(packed) or tokens(packed))
    fresh = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    for _, text in texts:
        fresh.ids(text or "")
    transducer = fresh.transducer
    assert len(transducer.agreeing) < len(transducer.steps)
    assert len(apart) < 2 * len(transducer.steps)


def test_lookahead_is_bounded(ours):
    """A run of a million bytes: no state holds readings longer than the longest token."""
    transducer = ours.transducer
    longest = max(map(len, transducer.ranks))
    assert len(transducer.encode(b"ab" * 500_000)) >= 500_000 * 2 // longest
    assert max(map(len, transducer.states)) <= longest + 2


def test_ranks_that_do_not_rise(ours):
    """Pairs are decided by the merges themselves where a token's rank is below its parts'."""
    ranks = {bytes([byte]): byte + 10 for byte in range(256)} | {b"abc": 1, b"ab": 2, b"bc": 3, b"cab": 0, b"zzz": 4}
    library = tiktoken.Encoding("odd", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    transducer = byte_bpe.MergeTransducer(ranks)
    rng = random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choice("abcz") for _ in range(rng.randrange(1, 14)))
        assert transducer.encode(text.encode()) == library.encode_ordinary(text), text


def test_bytes_that_are_no_utf8(ours):
    rng = random.Random(2)
    tokens = ours.transducer.bytes_of
    for _ in range(3_000):
        ids = [rng.randrange(len(tokens)) for _ in range(rng.randrange(6))]
        ids += [ours.transducer.ranks[bytes([rng.randrange(256)])] for _ in range(rng.randrange(6))]
        rng.shuffle(ids)
        assert ours.text(packed(ids)) == b"".join(tokens[i] for i in ids).decode("utf-8", "replace")
    decoder = byte_bpe.StreamDecoder(tokens)
    shown = [decoder.feed([ours.transducer.ranks[bytes([byte])]]) for byte in "é\U0001f600".encode()]
    assert shown == ["", "é", "", "", "", "\U0001f600"] and decoder.finish() == ""


def test_remembered_steps_are_bounded(library, monkeypatch, texts):
    monkeypatch.setattr(byte_bpe, "STATES", 50)
    monkeypatch.setattr(byte_bpe, "STEPS", 1)
    small = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    transducer = small.transducer
    for _, text in texts[:20]:
        assert small.ids(text) == packed(library.encode_ordinary(text))
        assert len(transducer.begins) <= 50 and len(transducer.steps) <= 50
    emitted = [step[1] for step in transducer.steps.values()]
    assert len(set(map(id, emitted))) == len(set(emitted))


def test_texts_are_encoded_once(spark):
    """Decoding reads the ids of the same call, so Spark does not encode a second time for it."""
    query = LLM_QUERIES["op13_byte_bpe"](spark, SMOKE_DATA)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    made = next(line for line in plan.split("\n") if "ArrowEvalPython" in line)
    assert made.count("of(") == 1


def test_ids_and_text_alone(spark, library):
    rows = spark.createDataFrame([("don't é 中文\U0001f600",), ("",), (None,)], "text string").repartition(2)
    path, pattern = PATH, public_tokenizers.PATTERN
    made = rows.select("text", byte_bpe.token_ids(rows.text, path, pattern).alias("ids"))
    made = made.withColumn("read", byte_bpe.token_text(made.ids, path, pattern))
    for text, ids, read in made.collect():
        assert bytes(ids) == packed(library.encode_ordinary(text or "")) and read == (text or "")


def test_query(spark, texts, library):
    rows = LLM_QUERIES["op13_byte_bpe"](spark, SMOKE_DATA).collect()
    wanted = []
    for key, text in texts:
        ids = library.encode_ordinary(text or "")
        wanted.append((key, len(ids), brute.sha(packed(ids)), brute.sha(library.decode_bytes(ids))))
    assert sorted(map(tuple, rows)) == sorted(wanted)


def test_hard_rows(hard, none, library):
    run = lambda docs: byte_bpe.encode_and_decode(docs, PATH, public_tokenizers.PATTERN)
    assert run(none).collect() == []
    found = run(hard.withColumn("IDS", hard.text))
    assert len({name.lower() for name in found.columns}) == len(found.columns)
    rows = [(row["doc_id"], row["n_tokens"], bytes(row["ids"]), row["decoded"], row["fp"]) for row in found.collect()]
    wanted = []
    for key, text, *_ in HARD:
        ids = library.encode_ordinary(text or "")
        wanted.append((key, len(ids), packed(ids), text or "", "extra"))
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
