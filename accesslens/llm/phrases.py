"""Lempel-Ziv phrase fingerprints: minimum hashes of a text's dictionary phrases."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.text import filled
from accesslens.session import scratch_path, stage

HASHES = 64
# So many phrases are kept in a dictionary; older ones in sorted arrays, which take far less memory.
DICTIONARY = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15
# The share of a text that an edit replaces: a quarter.
EDITED = 4


class PhraseParser:
    """Parses bytes into phrases: each is the longest known one and the byte that makes it new.

    A phrase is its number, from 1 in the order they were found, times 256; a step is a phrase and
    the byte that follows. `children` has the phrases that recent steps make. When it is full its
    steps are merged into `steps`, sorted, with the phrases that they make in `made`, so that no
    phrase is ever forgotten. `found` has those steps in the order they were found.
    """

    def __init__(self):
        self.children: dict[int, int] = {}
        self.phrase = 0
        self.found: list[np.ndarray] = []
        self.steps = self.made = np.zeros(0, np.int64)

    def copy(self) -> PhraseParser:
        twin = PhraseParser()
        twin.children, twin.phrase, twin.found = self.children.copy(), self.phrase, self.found.copy()
        twin.steps, twin.made = self.steps, self.made
        return twin

    def _settle(self) -> None:
        """Moves the dictionary into the sorted arrays."""
        n = len(self.children)
        self.found.append(np.fromiter(self.children, np.int64, n))
        steps = np.concatenate((self.steps, self.found[-1]))
        order = np.argsort(steps, kind="stable")
        made = np.concatenate((self.made, np.fromiter(self.children.values(), np.int64, n)))
        self.steps, self.made = steps[order], made[order]
        self.children.clear()

    def feed(self, data: bytes) -> PhraseParser:
        phrase, children = self.phrase, self.children
        get, number = children.get, len(self.steps) + len(children) << 8
        full = len(self.steps) + DICTIONARY << 8
        steps, made, older = memoryview(self.steps), memoryview(self.made), len(self.steps)
        for byte in data:
            step = phrase | byte
            phrase = get(step)
            if phrase is None:
                if older:
                    at = bisect_left(steps, step)
                    if at < older and steps[at] == step:
                        phrase = made[at]
                        continue
                number += 256
                children[step] = number
                phrase = 0
                if number == full:
                    self._settle()
                    steps, made, older = memoryview(self.steps), memoryview(self.made), len(self.steps)
                    full = number + (DICTIONARY << 8)
        self.phrase = phrase
        return self

    def _hashes(self) -> np.ndarray:
        """A hash of every phrase's bytes: ((b1 m + b2) m + b3) ..., for all side by side.

        value = factor * (value of `before`) + rest; every round puts twice as many bytes into it.
        """
        steps = np.concatenate([*self.found, np.fromiter(self.children, np.int64, len(self.children))])
        n = len(steps)
        before = np.concatenate(([0], steps >> 8))
        factor, rest = np.full(n + 1, MULTIPLIER, np.uint64), np.zeros(n + 1, np.uint64)
        factor[0], rest[1:] = 1, (steps & 255) + 1
        while before.any():
            rest += factor * rest[before]
            factor *= factor[before]
            before = before[before]
        return rest[1:]

    def signature(self) -> np.ndarray:
        """The smallest hashes of all phrases, in order."""
        mixed = self._hashes()
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return np.unique((mixed >> np.uint64(32)).astype(np.uint32))[:HASHES]


def phrase_signature(text: str) -> np.ndarray:
    return PhraseParser().feed(text.encode()).signature()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of common phrases, estimated from the smallest hashes of both sets together."""
    mine, theirs = set(one.tolist()), set(other.tolist())
    union = sorted(mine | theirs)[:HASHES]
    return sum(h in mine and h in theirs for h in union) / len(union) if union else 1.0


def shown(signature: np.ndarray) -> str:
    """A signature as text: eight hexadecimal digits for each hash."""
    return signature.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def phrase_fingerprint(text: Column) -> Column:
    """A text's fingerprint: null counts as empty, and texts without a phrase have the empty one."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shown(phrase_signature(one)) for one in texts], dtype="object")

    return of(filled(text))


def phrase_likeness(one: Column, other: Column) -> Column:
    """How like two fingerprints are, 0 to 1."""

    @F.pandas_udf("double")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness(read(a), read(b)) for a, b in zip(left, right)], dtype="float64")

    return of(one, other)


class _Document:
    """A text parsed once, ready to be edited: the part that stays is not parsed again."""

    def __init__(self, text: str):
        self.n_chars, self.text = len(text), text
        stays = self.n_chars - self.n_chars // EDITED
        self.head = text[:stays].encode()
        parser = PhraseParser().feed(self.head)
        self.parser = parser.copy()
        self.signature = parser.feed(text[stays:].encode()).signature()

    def result(self, following: _Document) -> tuple:
        edit = following.text[: self.n_chars // EDITED].encode()
        edited = self.parser.feed(edit).signature()
        return (
            self.n_chars,
            hashlib.sha256(self.head + edit).hexdigest(),
            shown(self.signature),
            shown(edited),
            likeness(self.signature, edited),
            likeness(self.signature, following.signature),
        )


RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Documents go in ascending order of id, rows of the same id by text; null ids come first, and
    after the last row comes the first again. The edited text has its last quarter (in code
    points, rounded down) replaced by as many of the next text's first ones, or all it has.

    Null texts count as empty: no phrases, and like each other entirely. A single row is its own
    next. An empty table gives an empty result; other columns are not read, whatever their names.

    Texts are dealt out by ranges of ids once. A task compares neighbours as they stream by; the
    first and last row of every task are matched with those of the next in a second, small step.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "phrases")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"_id {kind}, {RESULT}, _part int, _edge string, _text string"
    names = [part.split()[0] for part in schema.split(", ")]

    def rows_of(records: list[tuple]) -> pa.RecordBatch:
        kinds = [id_kind[0], pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), *[pa.string()] * 2]
        columns = zip(*records) if records else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    id_kind: list[pa.DataType] = []
    none = (None,) * 6

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            id_kind[:] = [batch.schema.field(0).type]
            found = []
            for key, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = _Document(one.as_py())
                if last is None:
                    found.append((key, *none, part, "first", one.text))
                else:
                    found.append((last[0], *last[1].result(one), part, None, None))
                last = key, one
            yield rows_of(found)
        if last:
            yield rows_of([(last[0], *none, part, "last", last[1].text)])

    ordered = docs.select(F.col(doc_id).alias("_id"), filled(text).alias("_text"))
    ordered = ordered.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    staged = stage(ordered.mapInArrow(compare, schema), f"{folder}/compared", spark)
    parts = sorted(row["_part"] for row in staged.where("_edge = 'first'").select("_part").collect())  # one a task
    follow = [(part, parts[(i + 1) % len(parts)]) for i, part in enumerate(parts)]
    follow = spark.createDataFrame(follow, "_part int, _next int")
    ends = staged.where("_edge = 'last'").select("_id", "_text", "_part").join(follow, "_part")
    firsts = staged.where("_edge = 'first'").select(F.col("_part").alias("_next"), F.col("_text").alias("_following"))

    @F.pandas_udf(RESULT)
    def at_edge(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        pairs = zip(texts, following)
        return pd.DataFrame([_Document(a).result(_Document(b)) for a, b in pairs], columns=names[1:7])

    ends = ends.join(firsts, "_next").withColumn("_result", at_edge("_text", "_following"))
    inner = staged.where("_edge IS NULL").select("_id", *names[1:7])
    outer = ends.select("_id", "_result.*")
    return inner.unionByName(outer).withColumnRenamed("_id", doc_id)
