"""SimHash near duplicates, by a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslens.llm.components import components
from accesslens.llm.text import filled, whole_rows, with_outputs
from accesslens.session import broadcast_if_small, scratch_path, stage

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
BYTES = 8
# Each differing bit can spoil one byte: so many positional bytes are shared for certain.
SHARED_BYTES = BYTES - MOST_BITS
# A posting is keyed by so many of them, and a pair that shares bytes for certain shares so many postings.
KEY_BYTES = 4
SHARED_POSTINGS = comb(SHARED_BYTES, KEY_BYTES)
# Pairs of a posting are tallied up to so many members, so that there are at most 1.5 pairs a member; in longer
# ones links are looked up.
MOST_TALLIED = 4
# Up to this many members of a posting are compared pair by pair where links are looked up.
PAIRWISE = 64
# Shingles whose bits are counted at a time.
SLICE = 1 << 16


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed integer; zero without words."""
    # Lower-casing and splitting bytes know ASCII letters and white space only.
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(parts)) - 1
    digest = xxhash.xxh64_digest
    places = zip(starts[: len(parts) - span].tolist(), ends[span:].tolist())
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in places]), np.uint8).reshape(-1, BYTES)
    ones = np.zeros(8 * BYTES, np.int64)
    for at in range(0, len(hashes), SLICE):
        ones += np.unpackbits(hashes[at : at + SLICE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def simhash_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(text, shingle_words) for text in texts], dtype="int64")

    return of(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 2 * BYTES, "0")


def _signed(bits: int) -> int:
    return bits - 2**64 if bits >= 2**63 else bits


def postings(prints: DataFrame, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(choice, shared, fp): each fingerprint under every choice of `key_bytes` positional bytes."""
    keys = []
    for choice, places in enumerate(combinations(range(BYTES), key_bytes)):
        kept = sum(0xFF << (8 * i) for i in places)
        shared = F.col("fp").bitwiseAND(F.lit(_signed(kept)).cast("bigint"))
        keys.append(F.struct(F.lit(choice).cast("tinyint").alias("choice"), shared.alias("shared")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.choice", "key.shared", "fp")


def _lists(keyed: DataFrame) -> DataFrame:
    """(members): the postings that hold more than one fingerprint."""
    lists = keyed.groupBy("choice", "shared").agg(F.sort_array(F.collect_list("fp")).alias("members"))
    return lists.where(F.size("members") > 1).select("members")


def _shared_postings(prints: DataFrame, folder: str) -> DataFrame:
    """(choice, shared, fp, n): the rows of postings with n fingerprints, more than one.

    Most postings hold one fingerprint. Counting them shuffles numbers only, and the rest is few.
    """
    keyed = postings(prints)
    counts = keyed.groupBy("choice", "shared").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return keyed.join(broadcast_if_small(stage(counts, f"{folder}/shared")), ["choice", "shared"])


def tallied_links(keyed: DataFrame) -> DataFrame:
    """(a, b): fingerprints within `MOST_BITS` bits that share enough postings.

    Two fingerprints within that many bits have at least `SHARED_BYTES` bytes in common at the
    same places, and so at least `SHARED_POSTINGS` postings. Pairs below that count go; the bits of
    those that reach it are verified.
    """
    members, size = F.col("members"), F.size("members")
    others = lambda a, i: F.slice(members, i + 2, size)
    pairs = F.transform(members, lambda a, i: F.transform(others(a, i), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    met = _lists(keyed).select(F.explode(F.flatten(pairs)).alias("pair")).select("pair.a", "pair.b")
    enough = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("tally")).where(F.col("tally") >= SHARED_POSTINGS)
    return enough.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS).select("a", "b")


def _pairwise_least(prints: np.ndarray) -> np.ndarray:
    """For each of a few fingerprints the place of the least one it is linked with in the list."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= MOST_BITS
    least = np.arange(len(prints))
    while True:
        lower = np.where(near, least[None, :], len(prints)).min(axis=1)
        if (lower == least).all():
            return least
        least = lower


def _flipped_least(prints: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The same for a long list, where pairs would be too many.

    The members differ in the bits `free` alone: all values within `MOST_BITS` of each member
    are looked up in a table of the members, 136 look-ups a member.
    """
    values = np.zeros(len(prints), np.int64)
    for i, bit in enumerate(free):
        values |= ((prints >> bit) & np.uint64(1)).astype(np.int64) << i
    place = np.full(1 << len(free), -1, np.int64)
    place[values] = np.arange(len(prints))
    flips = [sum(1 << i for i in bits) for n in range(1, MOST_BITS + 1) for bits in combinations(range(len(free)), n)]
    least = np.arange(len(prints))
    while True:
        lower = least.copy()
        for flip in flips:
            partner = place[values ^ flip]
            np.minimum(lower, np.where(partner >= 0, least[partner], lower), out=lower)
        lower = np.minimum(lower, lower[lower])
        if (lower == least).all():
            return least
        least = lower


def _links_in(members: np.ndarray) -> list[tuple[int, int]]:
    """Links within one posting: each member to the least one it reaches there."""
    prints = np.sort(members.astype(np.int64)).view(np.uint64)
    if len(prints) <= PAIRWISE:
        least = _pairwise_least(prints)
    else:
        differing = int(np.bitwise_or.reduce(prints ^ prints[0]))
        least = _flipped_least(prints, np.array([i for i in range(64) if differing >> i & 1], np.uint64))
    child = np.flatnonzero(least != np.arange(len(prints)))
    signed = prints.view(np.int64)
    return list(zip(signed[child].tolist(), signed[least[child]].tolist()))


LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


@F.pandas_udf(T.ArrayType(LINK))
def posting_links(members: pd.Series) -> pd.Series:
    return pd.Series([[{"a": a, "b": b} for a, b in _links_in(np.asarray(one))] for one in members])


def looked_up_links(prints: DataFrame) -> DataFrame:
    """(a, b): the same links up to their transitive closure, looked up instead of tallied.

    Keys are all `SHARED_BYTES` bytes that two such fingerprints share, so the members of a list
    differ in two bytes only and are never more than 65,536.
    """
    lists = _lists(postings(prints, SHARED_BYTES))
    return lists.select(F.explode(posting_links("members")).alias("link")).select("link.a", "link.b")


def link_components(prints: DataFrame, folder: str, most_tallied: int = MOST_TALLIED) -> DataFrame:
    """(a, b): fingerprints `a` that are linked to others, with the least `b` of their component.

    Postings are counted first. Where more than `most_tallied` fingerprints share one, their pairs
    would be too many: those fingerprints are looked up among each other, and the posting takes no
    part in the tally. A linked pair shares a long posting, and is found there, or none, and then
    its tally is whole: no link is lost.
    """
    keyed = stage(_shared_postings(prints, folder), f"{folder}/postings")
    tallied = tallied_links(keyed.where(F.col("n") <= most_tallied))
    crowded = keyed.where(F.col("n") > most_tallied).select("fp").distinct()
    return components(tallied.unionByName(looked_up_links(crowded)), folder)


def _classes(rows: DataFrame, folder: str) -> DataFrame:
    """(fp, root): every fingerprint of `rows` with the least one of its component."""
    # Dealt out before they are multiplied into postings: a small file would be one task.
    prints = stage(rows.select("fp").distinct().repartition("fp"), f"{folder}/prints", rows.sparkSession)
    linked = link_components(prints, folder).withColumnsRenamed({"a": "fp", "b": "root"})
    return prints.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, fingerprint, component_id): a row per input row.

    Documents whose fingerprints differ in at most two bits are linked; component_id is the
    smallest id that can be reached. Copies share a fingerprint and count once in the index.
    Null and empty texts and texts without words have fingerprint zero and link like others.
    Rows that share an id are fingerprinted each. Null ids take part; a component of null ids
    alone has a null component_id. An empty table gives an empty result, and other columns of
    the input are not read, whatever their names.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "simhash")
    read = docs.select(F.col(doc_id).alias("_id"), filled(text).alias("_text"))
    rows = stage(read.select("_id", simhash_column(F.col("_text"), shingle_words).alias("fp")), f"{folder}/rows", spark)
    least = rows.groupBy("fp").agg(F.min("_id").alias("first"))
    roots = _classes(rows, folder).join(least, "fp")
    firsts = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(firsts, "root").select("fp", "component_id")
    # One row per fingerprint on the right: a group of copies is split like any skewed key.
    return rows.join(classes, "fp").select(
        F.col("_id").alias(doc_id), hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """The input's rows and columns, one row per component: the one of the smallest id.

    Components are those of `simhash_groups`. Every component keeps a row of its own, also where
    rows share an id without sharing a text: of such rows in one component the one of the smaller
    fingerprint stays, then of the smaller text hash. Null ids come after all others. Of rows equal
    in id and text one stays. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "simhash")
    read = docs.select(F.col(doc_id).alias("_id"), filled(text).alias("_text"))
    rows = read.select("_id", F.xxhash64("_text").alias("_hash"), simhash_column(F.col("_text"), shingle_words).alias("fp"))
    rows = stage(rows, f"{folder}/rows", spark)
    # Rows are picked by their keys, added up per fingerprint first; texts move once, to be joined.
    first = F.min(F.struct(F.col("_id").isNull().alias("unknown"), "_id", "fp", "_hash")).alias("first")
    firsts = rows.groupBy("fp").agg(first).join(_classes(rows, folder), "fp")
    kept = firsts.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = kept.select(*_row_key(F.col("_id"), F.col("_hash")))
    # The join deals rows out by the very keys that the last step needs.
    known = whole_rows(docs).select("_row", *_row_key(F.col("_row")[doc_id], F.xxhash64(filled(F.col("_row")[text]))))
    names = [name for name in known.columns if name != "_row"]
    stay = known.join(kept, names, "left_semi").dropDuplicates(names)
    return with_outputs(stay, docs.columns, {})


def _row_key(key: Column, digest: Column) -> list[Column]:
    """A row's id and text hash without nulls, so that a plain join finds it."""
    shown = F.coalesce(key.cast("string"), F.lit(""))
    return [key.isNotNull().alias("_known"), shown.alias("_key"), digest.alias("_hash")]
