"""Long periodic runs that documents share."""

import brute
from accesslens.llm import suffix_dedup
from accesslens.llm.packed import unpack


def test_surroundings_of_a_run_are_asked_once(spark, monkeypatch):
    runs = ["-" * 6_000, "ha " * 2_000, " \n" * 3_000]
    rows = [(2 * i + k, f"{i} before {k} {run} {k} after {i}") for i, run in enumerate(runs) for k in range(2)]
    staged, stage = {}, suffix_dedup.stage

    def kept(frame, path, spark=None):
        staged[path.rsplit("/", 1)[1]] = out = stage(frame, path, spark)
        return out

    monkeypatch.setattr(suffix_dedup, "stage", kept)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "kept").collect()
    wanted = [(key, n, kept) for key, n, _, _, kept in brute.removed_bytes(rows)]
    assert sorted((k, n, bytes(kept)) for k, n, kept in found) == sorted(wanted)
    asked = staged["edges"].where(f"bucket IS NOT NULL AND kind = {suffix_dedup.EDGE}").collect()
    asked = sum(len(unpack(row["codes"])) for row in asked)
    print("EDGE questions:", asked)
    assert 0 < asked < 1_000
