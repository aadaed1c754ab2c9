"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from accesslens.llm import chat, katz, language, line_dedup, mixing, packing, phrases, quality, simhash, suffix_dedup
from hard_rows import CLASHING, HARD
from test_results import check_packing

PAIRS = [(row[0], row[1]) for row in HARD]
by_key = lambda rows: sorted(rows, key=repr)


def pack(docs):
    return packing.pack_sequences(docs, brute.TOKENIZER)[0].drop("_part", "_rank")


def identified(docs):
    return language.identify(docs, language.learn_profiles(docs))


OPERATORS = {
    "language": identified,
    "chat": lambda docs: chat.format_chat(chat.canonical_turns(docs.withColumn("record", F.col("text")))),
    "line_dedup": line_dedup.dedup_lines,
    "suffix_dedup": suffix_dedup.remove_repeats,
    "simhash": simhash.simhash_groups,
    "packing": pack,
    "phrases": phrases.compare_with_next,
    "katz": lambda docs: katz.katz_scores(docs, F.col("doc_id") != 7),
    "quality": quality.line_first_clean,
    "mixing": mixing.mix_sources,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).collect() == []


@pytest.mark.parametrize("name, apply", corpus_pipeline.STAGES)
def test_stage_on_empty_and_hard_rows(spark, hard, none, name, apply):
    assert apply(spark, none, "").collect() == []
    found = apply(spark, hard, "")
    assert name == "pack" or found.columns == hard.columns
    assert found.count() > 0


@pytest.mark.parametrize("name", OPERATORS)
def test_every_null(spark, hard, name):
    nulls = hard.select(*(F.lit(None).cast(kind).alias(c) for c, kind in hard.dtypes))
    assert OPERATORS[name](nulls).count() >= (0 if name == "mixing" else len(HARD))


@pytest.mark.parametrize("name", ["language", "chat", "line_dedup", "quality", "mixing"])
def test_extra_columns_stay(hard, name):
    found = OPERATORS[name](hard.where("doc_id > 3"))
    added = {column.lower() for column in OPERATORS[name](hard.select("doc_id", "text", "source", "lang", "n_chars")).columns}
    rows = found.collect()
    assert len({column.lower() for column in found.columns}) == len(found.columns)
    for column in CLASHING:
        assert column in found.columns or column.lower() in added
        if column.lower() not in added:
            assert {row[column] for row in rows} == {"extra"}


def test_language_of_nothing(hard):
    rows = identified(hard).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") != letters and 0 <= row["score"] <= 1
    blank = language.identify(hard, language.learn_profiles(hard.where("false"))).collect()
    assert {row["lang_pred"] for row in blank} == {"und"}


def test_line_dedup(hard):
    rows = line_dedup.dedup_lines(hard).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert by_key(map(tuple, rows)) == by_key(brute.dedup_lines(PAIRS))


@pytest.mark.parametrize("batches, fanout", [(1, 2), (7, 2), (6, 3)])
def test_line_dedup_in_any_batches(documents, texts, batches, fanout):
    rows = line_dedup.dedup_lines(documents, batches=batches, fanout=fanout)
    rows = rows.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert by_key(map(tuple, rows)) == by_key(brute.dedup_lines(texts))


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 500, "indexed": 1}, {"indexed": 0}])
def test_suffix_dedup(hard, limits):
    rows = suffix_dedup.remove_repeats(hard, **limits).collect()
    found = []
    for row in rows:
        width = sum(span["end"] - span["start"] for span in row["spans"])
        found.append((row["doc_id"], row["n_bytes"], width, len(row["spans"]), bytes(row["kept"])))
    assert by_key(found) == by_key(brute.removed_bytes(PAIRS))


@pytest.mark.parametrize("limits", [{"block_bytes": 20_000}, {"block_bytes": 50_000, "indexed": 2}])
def test_suffix_dedup_over_many_blocks(documents, texts, limits):
    rows = suffix_dedup.remove_repeats(documents, **limits).select("doc_id", "n_bytes", "kept").collect()
    wanted = [(key, n, kept) for key, n, _, _, kept in brute.removed_bytes(texts)]
    assert sorted((k, n, bytes(kept)) for k, n, kept in rows) == sorted(wanted)


def test_simhash(hard):
    rows = simhash.simhash_groups(hard).collect()
    assert by_key(map(tuple, rows)) == by_key(brute.simhash_components(PAIRS))


def one_of_each_component(pairs):
    """(id, text) of the row that stays of every component, by id, fingerprint and text hash."""
    prints = [brute.simhash(text) for _, text in pairs]
    root = list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    signed = lambda p: p - 2**64 if p >= 2**63 else p
    groups = {}
    for (key, text), p, r in zip(pairs, prints, root):
        digest = xxhash.xxh64_intdigest((text or "").encode(), 42)
        groups.setdefault(r, []).append((key is None, key or 0, signed(p), signed(digest), key, text))
    return [min(group)[4:] for group in groups.values()]


def test_one_of_each_near_duplicate(hard):
    rows = [(row["doc_id"], row["text"] or "") for row in simhash.drop_near_duplicates(hard).collect()]
    assert by_key(rows) == by_key((key, text or "") for key, text in one_of_each_component(PAIRS))


def test_rows_that_share_an_id_stay_for_their_components(spark):
    one, two = (" ".join(f"{mark}{i}" for i in range(80)) for mark in "ab")
    rows = [(1, one), (1, two), (2, two.upper()), (3, one.title()), (3, "short text"), (3, "short text"), (None, "alone")]
    found = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert by_key(map(tuple, found.collect())) == by_key([(1, one), (1, two), (3, "short text"), (None, "alone")])


def test_long_postings_link_like_short_ones():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (70, 300):
        members = np.unique(rng.integers(0, 2**16, size)) | 7 << 40
        links = simhash._links_in(members)
        root = {int(m): int(m) for m in members}
        for a, b in links:
            root[a] = b
        known = [int(m) for m in members]
        for i, a in enumerate(known):
            for b in known[:i]:
                if (a ^ b).bit_count() <= 2:
                    assert root[a] == root[b]
        assert all((m == r) or r in root for m, r in root.items())


@pytest.mark.parametrize("most_tallied", [1, 2, 5, 1_000])
def test_tallied_and_looked_up_links_are_all_links(spark, tmp_path, most_tallied):
    """Crowds of prints that share bytes, chains of links, and prints that share six bytes but not enough bits."""
    rng = np.random.default_rng(11)
    known = {int(p) for p in rng.integers(0, 2**62, 40)}
    for centre in list(known)[:12]:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            known.add(centre ^ sum(1 << int(bit) for bit in flips))
            known.add(centre ^ int(rng.integers(0, 2**16)))
    known = sorted(p - 2**64 if p >= 2**63 else p for p in known)
    root = {p: p for p in known}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    pairs = {(b, a) for i, a in enumerate(known) for b in known[:i] if ((a ^ b) % 2**64).bit_count() <= 2}
    for low, high in sorted(pairs):
        one, other = sorted((find(low), find(high)))
        root[other] = one
    prints = spark.createDataFrame([(p,) for p in known], "fp bigint").repartition(3)
    found = simhash.link_components(prints, str(tmp_path), most_tallied)
    assert by_key(map(tuple, found.collect())) == by_key((p, find(p)) for p in known if find(p) != p)
    assert len(pairs) > 100
    assert {tuple(row) for row in simhash.tallied_links(simhash.postings(prints)).collect()} == pairs


def test_punctuation_of_any_script(spark):
    said = " ".join(["शब्द"] * 50)
    rows = [(1, f"{said}।"), (2, said), (3, f"{said}."), (4, f"{said}，{said}"), (5, f"don't {said}")]
    found = quality.line_first_clean(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {row.doc_id: row.n_lines_removed for row in found} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1}
    assert all(row.cleaned_text == brute.quality(row.text)[0] for row in found)


def test_packing(hard):
    check_packing(pack(hard).collect(), brute.pieces(PAIRS, Tokenizer.from_file(brute.TOKENIZER)))


@pytest.mark.parametrize(
    "lengths",
    [[600] * 7, [1024] * 3, [1] * 2050, [512, 512, 300, 300, 424, 1000, 24], [400, 300, 200, 124, 900, 100, 24], []],
)
def test_plan_places_every_piece(lengths):
    import numpy as np

    plan = packing.plan_packing(np.bincount(lengths, minlength=1025))
    used = [n for pattern, copies in plan for n in pattern for _ in range(copies)]
    assert sorted(used) == sorted(lengths)
    assert all(sum(pattern) <= 1024 for pattern, _ in plan)
    if lengths in ([1024] * 3, [512, 512, 300, 300, 424, 1000, 24]):
        assert sum(copies for _, copies in plan) == 3


def test_phrases(hard):
    rows = phrases.compare_with_next(hard).collect()
    ordered = sorted(((key, text or "") for key, text in PAIRS), key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
    wanted = []
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        own, after, changed = (phrases.phrase_signature(one) for one in (text, following, edited))
        wanted.append(
            (key, n, brute.sha(edited), phrases.shown(own), phrases.shown(changed), phrases.likeness(own, changed), phrases.likeness(own, after))
        )
    assert by_key(map(tuple, rows)) == by_key(wanted)


@pytest.mark.parametrize("most", [1, 7, 50, 1 << 18])
def test_a_full_dictionary_keeps_its_phrases(monkeypatch, most):
    monkeypatch.setattr(phrases, "DICTIONARY", most)
    text = "".join(chr(97 + i * i % 23 * (i // 900 + 1) % 26) for i in range(5_000))
    whole = phrases.phrase_signature(text)
    assert whole.tolist() == brute.phrase_signature(text.encode())
    assert len(whole) == phrases.HASHES
    parser = phrases.PhraseParser().feed(text[:3_000].encode())
    assert (parser.copy().feed(text[3_000:].encode()).signature() == whole).all()


@pytest.mark.parametrize("train", ["doc_id != 7", "false", "doc_id = 4", "true"])
def test_katz(hard, train):
    rows = katz.katz_scores(hard, F.expr(train)).collect()
    taught = {"doc_id != 7": lambda k: k is not None and k != 7, "false": lambda k: False, "doc_id = 4": lambda k: k == 4, "true": lambda k: True}[train]
    model = brute.Katz([text for key, text in PAIRS if taught(key)])
    found = sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train, r.train_tokens, round(r.score, 6), round(r.base_score, 6)) for r in rows)
    wanted = sorted(
        (repr(key), len(model.tokens(t)), sum(w in model.unigrams for w in model.tokens(t)), taught(key), model.total,
         round(model.score(t), 6) + 0.0, round(model.base(t), 6) + 0.0)
        for key, t in PAIRS
    )
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    assert [row[5:] for row in found] == [pytest.approx(row[5:], abs=2e-6) for row in wanted]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz_of_any_order_in_many_blocks_and_buckets(documents, texts, order):
    """Small blocks, small buckets and contexts split over them, against the model in plain Python."""
    limits = {"block_tokens": 3_000, "bucket_grams": 4_000, "context_uses": 40}
    rows = katz.katz_scores(documents, F.col("doc_id") % 3 != 0, order=order, **limits).collect()
    model = brute.Katz([text for key, text in texts if key % 3], order)
    assert {r.doc_id: r.score for r in rows} == pytest.approx({key: model.score(text) for key, text in texts}, rel=1e-9)


def test_katz_with_one_pair_as_half_of_all_tokens(spark):
    rows = [(i, "the same " * 400 + f"and word {i} of {i % 7}") for i in range(30)]
    rows += [(30 + i, " ".join(f"w{(i * k) % 97}" for k in range(400))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = katz.katz_scores(docs, F.col("doc_id") % 5 != 1, block_tokens=2_000, bucket_grams=1_000, context_uses=500)
    model = brute.Katz([text for key, text in rows if key % 5 != 1])
    assert {r.doc_id: r.score for r in found.collect()} == pytest.approx({k: model.score(t) for k, t in rows}, rel=1e-9)


def test_quality(hard):
    rows = quality.line_first_clean(hard).select("text", "cleaned_text", "kept").collect()
    assert len(rows) == len(HARD)
    for text, cleaned, kept in rows:
        assert (cleaned, kept) == brute.quality(text)


def test_mixing(hard):
    rows = mixing.mix_sources(hard).collect()
    copies = brute.mixed_copies([(row[0], row[3]) for row in HARD])
    assert by_key((r["doc_id"], r["source"], r["text"]) for r in rows) == by_key(
        (row[0], row[3], row[1]) for row, n in zip(HARD, copies) for _ in range(n)
    )
    only = mixing.mix_sources(hard, weights={"b": 1.0}, epochs=3.0).collect()
    assert {row["source"] for row in only} == {"b"}
    assert mixing.mix_sources(hard, weights={}).collect() == []


def test_mixing_reaches_its_rates(spark):
    rows = spark.range(40_000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 'small', 'large') AS source")
    counts = dict(mixing.mix_sources(rows, weights={"small": 3.0, "large": 1.0}).groupBy("source").count().collect())
    assert counts["small"] == pytest.approx(30_000, rel=0.05)
    assert counts["large"] == pytest.approx(10_000, rel=0.05)


def test_mixing_at_very_high_rates(spark):
    """A source of three documents beside a large one: a million copies each, drawn in seconds."""
    rows = spark.createDataFrame([(i, "tiny") for i in range(400)] + [(9_000, "large")], "doc_id long, source string")
    rates = {r["_source"]: r for r in mixing.source_rates(rows, weights={"tiny": 1.0, "large": 1.0}, epochs=2e6).collect()}
    assert rates["large"]["_rate"] == pytest.approx(401e6) and rates["tiny"]["_rate"] == pytest.approx(1_002_500)
    for rate in rates.values():
        cdf = np.array(rate["_cdf"])
        assert len(cdf) < 24 * rate["_rate"] ** 0.5 + 60 and (np.diff(cdf) >= 0).all()
        assert cdf[0] < 1e-9 and cdf[-1] == pytest.approx(1, abs=1e-6)
        mean = rate["_first"] + (1 - cdf / cdf[-1]).sum()
        assert mean == pytest.approx(rate["_rate"], rel=1e-4)
    drawn = (F.col("doc_id") + 0.5) / 400
    counts = spark.createDataFrame([rates["tiny"]], "_source string, _docs long, _rate double, _first int, _cdf array<double>")
    counts = rows.where("source = 'tiny'").join(counts, F.col("source") == F.col("_source"))
    found = [r[0] for r in counts.select(F.col("_first") + mixing.count_at(F.col("_cdf"), drawn)).collect()]
    assert np.mean(found) == pytest.approx(1_002_500, rel=1e-4) and np.std(found) == pytest.approx(1_001, rel=0.05)


@pytest.mark.parametrize("mean", [0.001, 0.7, 3.0, 30.0, 900.0])
def test_poisson_distributions(spark, mean):
    rates = spark.createDataFrame([("s", mean), (None, mean)], "_source string, _rate double")
    for row in mixing.poisson_distributions(rates).collect():
        below, k = 0.0, 0
        for k in range(row["_first"] + len(row["_cdf"])):
            below += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
            if k >= row["_first"]:
                assert row["_cdf"][k - row["_first"]] == pytest.approx(below, abs=1e-12)


LAYOUTS = [
    ('{"messages": [{"role": "user", "content": "a"}, {"content": null, "role": "assistant"}]}', "messages", [("user", "a"), ("assistant", "")]),
    ('{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}', "shared", [("user", "a"), ("assistant", "b")]),
    ('{"turns": [{"role": "tool]%", "text": "a"}]}', "dialog", [("tool]%", "a")]),
    ('{"response": "b", "prompt": "a"}', "prompt_response", [("user", "a"), ("assistant", "b")]),
    ('{"prompt": 7, "completion": "b"}', "prompt_completion", [("user", "7"), ("assistant", "b")]),
    ('{"system": "s", "prompt": "a", "response": "b"}', "system_prompt_response", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ('{"instruction": "a", "output": "b"}', "instruction_output", [("user", "a"), ("assistant", "b")]),
    ('{"instruction": "a", "input": "c", "output": "b"}', "instruction_input_output", [("user", "a\n\nc"), ("assistant", "b")]),
    ('{"unknown": 1}', None, None),
    ("no record", None, None),
    ("", None, None),
    (None, None, None),
]


def test_chat_layouts(spark):
    rows = spark.createDataFrame([(r,) for r, _, _ in LAYOUTS], "record string")
    for row, (_, layout, turns) in zip(chat.canonical_turns(rows).collect(), LAYOUTS):
        assert row["layout"] == layout
        assert (row["turns"] and [tuple(turn) for turn in row["turns"]]) == turns


TRICKY = [
    "", " ", "plain", "</s>[INST] ok [/INST]", "<s><s></s>", "<\\s> <\\\\s> [\\INST] [\\\\/INST]", "[SYS]x[/SYS][ANS]",
    "[ROLE:user] a [/ROLE]", "[ROLE]", "[INST", "INST]", "\\", "\\\\<", "\n\n", "a" * 40_000, "[[INST]]", "<</s>>", "é\U0001f600",
]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", "tool", "", "a]b%5D", "ROLE:x", "[INST]"]
    turns = [[(roles[(i + k) % len(roles)], text) for k, text in enumerate(TRICKY[i:])] for i in range(len(TRICKY) + 1)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(turns)], f"id int, turns {chat.TURNS}")
    found = chat.format_chat(rows).withColumns({"back": chat.read_turns(F.col("formatted")), "learned": chat.learned_text(F.col("pieces"))})
    for row in found.collect():
        assert [tuple(turn) for turn in row["back"]] == turns[row["id"]]
        assert row["learned"] == "".join(text for role, text in turns[row["id"]] if role == "assistant")
        assert row["formatted"] == "".join(piece["text"] for piece in row["pieces"])


def test_gathering_orders_turns(spark):
    rows = [(1, 2, None, "c"), (1, None, "user", None), (1, 2, "a", "b"), (None, 1, "user", "x"), (1, 2, "a", "b")]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {row["conv_id"]: row["turns"] for row in chat.canonical_turns(chat.gather_records(rows)).collect()}
    assert [tuple(t) for t in found[1]] == [("user", ""), ("", "c"), ("a", "b"), ("a", "b")]
    assert [tuple(t) for t in found[None]] == [("user", "x")]
