"""Byte strings that documents share, removed from all but the first that has them.

Equal strings of `LENGTH` bytes have the same anchors: positions where a short byte string has the
smallest hash within reach. Anchors that other documents have too are found first (`shared`), then
those with the same surroundings, whose bytes all repeat (`covered`). What is left, the edges of
shared regions, goes to run-length indexes by anchor, which stream matches to the byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.packed import MIX, bucketed, cuts, mixed, pack, unpack
from accesslens.llm.run_index import RunIndex
from accesslens.llm.text import filled
from accesslens.session import scratch_path, stage

LENGTH = 50
GRAM = 24
# Gram places of one string, and the bytes around an anchor that such strings can reach.
REACH = LENGTH - GRAM + 1
BEFORE = LENGTH - GRAM
AROUND = BEFORE + LENGTH
# A string around an anchor has so many bytes before it or more, or some on both sides, or so many
# after: (bytes before, bytes after) of what it contains in each of these cases.
EXTENDED = ((2 * BEFORE // 3 + 1, 0), (BEFORE // 3 + 1, BEFORE // 3 + 1), (0, 2 * BEFORE // 3 + 1))
BLOCK_BYTES = 1_500_000
SLICE = 1_000_000
BUCKET_ANCHORS = 1_000_000
BUCKET_STRINGS = 80_000
# An anchor with more different surroundings is not indexed: its strings are compared by hash.
INDEXED = 5_000
FACTORS = (np.random.default_rng(9).integers(0, 2**63, AROUND + 2, np.uint64) << np.uint64(1)) | np.uint64(1)
ROWS = 20_000
# Anchors that need no look, those at the edge of a shared region, and those at one with too many surroundings.
NONE, EDGE, WIDE = 0, 1, 2


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place, as a number."""
    return np.lib.stride_tricks.sliding_window_view(data, 8).copy().view("<u8").ravel()


def _finished(value: np.ndarray) -> np.ndarray:
    """63 hash bits, never zero, of sums of products; in place."""
    value ^= value >> np.uint64(32)
    value *= MIX
    value ^= value >> np.uint64(29)
    value >>= np.uint64(1)
    value |= np.uint64(1)
    return value


def _steps(size: int) -> list[int]:
    """Where eight bytes each are read, to read `size` bytes."""
    return [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]


def _hashes_at(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each of some places."""
    value = np.zeros(len(places), np.uint64)
    for factor, step in zip(FACTORS, _steps(size)):
        value += words[places + step] * factor
    return _finished(value)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` bytes from each place, as `_hashes_at` gives it."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    words = _words(data)
    n = len(data) - GRAM + 1
    value = np.zeros(n, np.uint64)
    for factor, step in zip(FACTORS, _steps(GRAM)):
        value += words[step : step + n] * factor
    return _finished(value)


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """The best of `size` neighbours from each place on."""
    span, out = 1, values
    while 2 * span <= size:
        out = best(out[: len(out) - span], out[span:])
        span *= 2
    rest = size - span
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def _string_starts(ends: np.ndarray, n: int) -> np.ndarray:
    """At which of n places a string of `LENGTH` bytes starts that ends in the same document."""
    begins = np.concatenate(([0], ends[:-1]))
    fits = ends - begins >= LENGTH
    edge = np.zeros(n + 1, np.int64)
    edge[begins[fits]] += 1
    np.add.at(edge, ends[fits] - LENGTH + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors.

    An anchor's hash is the smallest within some string of `LENGTH` bytes of one document, so the
    strings that two documents share have an anchor at the same place.
    """
    starts = _string_starts(ends, len(data))
    n, margin = len(data) - GRAM + 1, REACH - 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    # Slice by slice, with the neighbours that decide at its edges, so that long texts need no more room.
    for a in range(0, n, SLICE):
        first, last = max(0, a - margin), min(n, a + SLICE + margin)
        hashes = gram_hashes(data[first : last + GRAM - 1])
        if len(hashes) < REACH:
            continue
        least = _sliding(hashes, REACH, np.minimum)
        least = np.where(starts[first : first + len(least)], least, 0)
        pad = np.zeros(margin, np.uint64)
        most = _sliding(np.concatenate((pad, least, pad)), REACH, np.maximum)
        places = np.flatnonzero(most == hashes)
        places = places[(places >= a - first) & (places < a + SLICE - first)]
        found.append((places + first, hashes[places]))
    return np.concatenate([one[0] for one in found]), np.concatenate([one[1] for one in found])


def _within(marks: np.ndarray, places: np.ndarray, back: int, ahead: int) -> np.ndarray:
    """How many marks lie from `back` before each place to `ahead` after it, exclusive."""
    sums = np.concatenate(([0], np.cumsum(marks)))
    n = len(marks)
    return sums[np.clip(places + ahead, 0, n)] - sums[np.clip(places - back, 0, n)]


def _marked(places: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[places] = True
    return out


def _around(data: np.ndarray, ends: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, skipped, length): what surrounds anchors within their documents, shifted to the left."""
    doc = np.searchsorted(ends, places, "right")
    begin = np.concatenate(([0], ends[:-1]))[doc]
    first, last = np.maximum(places - BEFORE, begin), np.minimum(places + LENGTH, ends[doc])
    at = first[:, None] + np.arange(AROUND)
    inside = at < last[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0), first - (places - BEFORE), last - first


def _surroundings(data: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of what surrounds each anchor."""
    out = np.zeros(len(places), np.uint64)
    for at in range(0, len(places), ROWS):
        rows, skipped, length = _around(data, ends, places[at : at + ROWS])
        rows = np.column_stack((rows.astype(np.uint64), skipped.astype(np.uint64), length.astype(np.uint64)))
        out[at : at + ROWS] = mixed((rows * FACTORS).sum(axis=1, dtype=np.uint64))
    return out


def _extended(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """32 hash bits of each of the `EXTENDED` strings around anchors, zero beyond their documents."""
    words = _words(data) if len(data) >= 8 else np.zeros(0, np.uint64)
    out = np.zeros((len(places), len(EXTENDED)), np.uint32)
    for i, (before, after) in enumerate(EXTENDED):
        size = before + GRAM + after
        inside = (places - before >= begins) & (places + GRAM + after <= ends)
        out[inside, i] = (_hashes_at(words, places[inside] - before, size) >> np.uint64(31)).astype(np.uint32) | 1
    return out


def _codes(ids: bytes, nulls: bytes) -> np.ndarray:
    """Document ids as unsigned numbers in the same order, null first."""
    codes = np.frombuffer(ids, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.where(unpack(nulls) > 0, np.uint64(0), codes)


def _open(row) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8)
    return data, unpack(row["ends"], True).astype(np.int64)


def _batch(rows: list[tuple], names: list[str], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[n]) for c, n in zip(columns, names)], names=names)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Documents (_id, _text) as blocks of some megabytes: a row each."""
    names = ["block", "ids", "nulls", "ends", "data"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        kinds = {"block": pa.int64()} | dict.fromkeys(names[1:], pa.binary())

        def flush() -> pa.RecordBatch:
            numbers = np.array([key or 0 for key in ids], np.int64).tobytes()
            nulls = pack(np.array([key is None for key in ids]))
            ends = pack(np.cumsum([len(text) for text in texts]), True)
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return _batch([(block, numbers, nulls, ends, data)], names, kinds)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(key)
                texts.append(text.as_py().encode())
                held += len(texts[-1])
                if held >= block_bytes:
                    yield flush()
                    block, ids, texts, held = block + 1, [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(cut, "block bigint, ids binary, nulls binary, ends binary, data binary")


def _anchor_keys(hashes: np.ndarray) -> np.ndarray:
    """48 bits: an anchor taken for another's only costs a comparison more."""
    return hashes >> np.uint64(15)


def _ask_shared(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, keys, several): a block's distinct anchors, and which several of its documents have."""
    names = ["bucket", "block", "keys", "several"]
    kinds = {"bucket": pa.int64(), "block": pa.int64(), "keys": pa.binary(), "several": pa.binary()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, ends = _open(row)
                places, hashes = anchors(data, ends)
                keys, bucket, at = _distinct(_anchor_keys(hashes), buckets)
                doc = np.searchsorted(ends, places, "right")
                first, last = np.full(len(keys), len(ends)), np.full(len(keys), -1)
                np.minimum.at(first, at, doc)
                np.maximum.at(last, at, doc)
                edges = cuts(bucket)
                yield _batch(
                    [
                        (int(bucket[a]), row["block"], pack(keys[a:b], True), pack((first != last)[a:b]))
                        for a, b in zip(edges[:-1], edges[1:])
                    ],
                    names,
                    kinds,
                )

    return blocks.select("block", "ends", "data").mapInArrow(ask, "bucket bigint, block bigint, keys binary, several binary")


def _distinct(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ordered by bucket and key, the buckets, and the place of every key among them."""
    known, at = np.unique(keys, return_inverse=True)
    bucket = (known % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(known), np.int64)
    rank[order] = np.arange(len(known))
    return known[order], bucket[order], rank[at]


def _split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


def _answer_shared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys = [unpack(one, True) for one in rows["keys"]]
    several = np.concatenate([unpack(one) for one in rows["several"]])
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.bincount(at, 1.0 + several, len(known))
    shared = _split((times > 1)[at], [len(one) for one in keys])
    return pd.DataFrame({"bucket": key[0], "block": rows["block"].to_numpy(), "shared": [pack(one) for one in shared]})


ASKED = (
    "bucket bigint, block bigint, keys binary, around binary, codes binary, extended binary, "
    "places binary, at binary, n bigint"
)
EDGES = (
    "bucket bigint, block bigint, kind int, strings binary, lengths binary, codes binary, "
    "covered binary, edges binary, wide binary"
)


def _ask_covered(blocks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """Per block (null bucket) its shared anchors, and its questions about their surroundings."""
    names = [part.split()[0] for part in ASKED.split(", ")]

    def ask(key: tuple, mine: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(said):
            return pd.DataFrame([], columns=names)
        row = mine.iloc[0]
        data, ends = _open(row)
        places, hashes = anchors(data, ends)
        keys, _, at = _distinct(_anchor_keys(hashes), buckets)
        shared = np.concatenate([unpack(one) for one in said.sort_values("bucket")["shared"]])[at] > 0
        places, keys = places[shared], _anchor_keys(hashes[shared])
        around = _surroundings(data, ends, places)
        doc = np.searchsorted(ends, places, "right")
        codes = _codes(row["ids"], row["nulls"])[doc]
        extended = _extended(data, np.concatenate(([0], ends[:-1]))[doc], ends[doc], places)
        order = np.lexsort((codes, around, keys, keys % np.uint64(buckets)))
        k, s = keys[order], around[order]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (s[1:] != s[:-1]))) if len(k) else np.zeros(0, bool)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        first = order[new]
        bucket = (keys[first] % np.uint64(buckets)).astype(np.int64)
        edges = cuts(bucket)
        asked = [
            (
                int(bucket[a]), key[0], pack(keys[first[a:b]]), around[first[a:b]].tobytes(),
                pack(codes[first[a:b]]), extended[first[a:b]].tobytes(), None, None, int(b - a),
            )
            for a, b in zip(edges[:-1], edges[1:])
        ]
        own = (None, key[0], None, None, None, None, pack(places, True), pack(at), 0)
        return pd.DataFrame([own, *asked], columns=names)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(ask, ASKED)


def _answer_covered(key: tuple, rows: pd.DataFrame, indexed: int) -> pd.DataFrame:
    """The smallest document with the same surroundings, and whether other surroundings are like them."""
    keys = [unpack(one) for one in rows["keys"]]
    flat, codes = np.concatenate(keys), np.concatenate([unpack(one) for one in rows["codes"]])
    around = np.concatenate([np.frombuffer(one, np.uint64) for one in rows["around"]])
    order = np.lexsort((codes, around, flat))
    k, s = flat[order], around[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])))
    group = np.cumsum(new) - 1
    least = codes[order[new]][group]
    first = order[new]
    _, anchor, others = np.unique(flat[first], return_inverse=True, return_counts=True)
    extended = np.concatenate([np.frombuffer(one, np.uint32).reshape(-1, len(EXTENDED)) for one in rows["extended"]])[first]
    # Different surroundings can have a string in common only if they are alike in one of these.
    alike = np.zeros(len(first), bool)
    for column in extended.T:
        _, at, times = np.unique(mixed(flat[first]) + column, return_inverse=True, return_counts=True)
        alike |= (times[at] > 1) & (column > 0)
    kind = np.where(alike, np.where(others[anchor] > indexed, WIDE, EDGE), NONE)[group]
    out_least, out_kind = np.empty_like(codes), np.empty(len(codes), np.int64)
    out_least[order], out_kind[order] = least, kind
    sizes = [len(one) for one in keys]
    return pd.DataFrame(
        {
            "bucket": key[0],
            "block": rows["block"].to_numpy(),
            "least": [pack(one) for one in _split(out_least, sizes)],
            "kind": [pack(one) for one in _split(out_kind, sizes)],
        }
    )


def _ask_edges(blocks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """Per block (null bucket) what is covered and what was asked, and the questions.

    EDGE questions are the surroundings of anchors, by anchor, each once a document however often it
    has them; WIDE ones are hashes of strings.
    """
    names = [part.split()[0] for part in EDGES.split(", ")]

    def ask(key: tuple, mine: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        own = said[said["places"].notna()]
        places = unpack(own["places"].iloc[0], True).astype(np.int64) if len(own) and len(mine) else []
        if not len(places):
            return pd.DataFrame([], columns=names)
        row, at = mine.iloc[0], unpack(own["at"].iloc[0]).astype(np.int64)
        data, ends = _open(row)
        said = said[said["least"].notna()].sort_values("bucket")
        least = np.concatenate([unpack(one) for one in said["least"]])[at]
        kind = np.concatenate([unpack(one) for one in said["kind"]])[at]
        doc_codes = _codes(row["ids"], row["nulls"])
        codes = doc_codes[np.searchsorted(ends, places, "right")]
        covered = least < codes
        # Strings with a covered anchor repeat, and an earlier document asks for them.
        settled = _within(_marked(places[covered], len(data)), np.arange(len(data)), 0, REACH) > 0
        open_starts = _string_starts(ends, len(data)) & ~settled
        asks = ~covered & (_within(open_starts, places, BEFORE, 1) > 0)
        edge, wide = places[asks & (kind == EDGE)], places[asks & (kind == WIDE)]
        words = _words(data)
        bucket = (_anchor_keys(_hashes_at(words, edge, GRAM)) % np.uint64(buckets)).astype(np.int64)
        codes, around = doc_codes[np.searchsorted(ends, edge, "right")], _surroundings(data, ends, edge)
        order = np.lexsort((codes, around, bucket))
        differs = [one[order][1:] != one[order][:-1] for one in (bucket, around, codes)]
        new = np.concatenate(([True], np.any(differs, axis=0)))[: len(order)]
        edge_at = np.empty(len(order), np.int64)
        edge_at[order] = np.cumsum(new) - 1
        everywhere, first = edge, order[new]
        edge, bucket, codes = edge[first], bucket[first], codes[first]
        out, edges = [], cuts(bucket)
        for a, b in zip(edges[:-1], edges[1:]):
            rows, _, length = _around(data, ends, edge[a:b])
            strings = zstandard.ZstdCompressor(level=1).compress(rows.tobytes())
            out.append((int(bucket[a]), key[0], EDGE, strings, pack(length), pack(codes[a:b]), None, None, None))
        near = _within(_marked(wide, len(data)), np.arange(len(data)), 0, REACH) > 0
        starts = np.flatnonzero(open_starts & near)
        strings, bucket, at = _distinct(_hashes_at(words, starts, LENGTH), buckets)
        codes = np.full(len(strings), np.iinfo(np.uint64).max)
        np.minimum.at(codes, at, doc_codes[np.searchsorted(ends, starts, "right")])
        wides = cuts(bucket)
        for a, b in zip(wides[:-1], wides[1:]):
            asked = strings[a:b].tobytes(), None, pack(codes[a:b])
            out.append((int(bucket[a]), key[0], WIDE, *asked, None, None, None))
        own = pack(places[covered], True), pack(np.concatenate((everywhere, edge_at))), pack(starts, True) + pack(at)
        sizes = len(pack(starts, True))
        return pd.DataFrame([(None, key[0], sizes, None, None, None, *own), *out], columns=names)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(ask, EDGES)


def _answer_edges(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """EDGE: a bit for every place of the surroundings from which a string repeats; WIDE: the smallest document."""
    codes = [unpack(one) for one in rows["codes"]]
    flat = np.concatenate(codes)
    if key[1] == EDGE:
        lengths = np.concatenate([unpack(one) for one in rows["lengths"]]).astype(np.int64)
        expand = zstandard.ZstdDecompressor().decompress
        strings = np.concatenate([np.frombuffer(expand(one), np.uint8) for one in rows["strings"]]).reshape(-1, AROUND)
        least = RunIndex(strings, lengths, flat, LENGTH).smallest_owners()[:, :REACH]
        out = ((least < flat[:, None]).astype(np.uint64) << np.arange(REACH, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    else:
        strings = np.concatenate([np.frombuffer(one, np.uint64) for one in rows["strings"]])
        known, at = np.unique(strings, return_inverse=True)
        out = np.full(len(known), np.iinfo(np.uint64).max)
        np.minimum.at(out, at, flat)
        out = out[at]
    answers = [pack(one) for one in _split(out, [len(one) for one in codes])]
    return pd.DataFrame({"bucket": key[0], "block": rows["block"].to_numpy(), "kind": key[1], "answer": answers})


def _remove(key: tuple, mine: pd.DataFrame, said: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """Every document of a block with its removed spans and the rest of its bytes."""
    row = mine.iloc[0]
    data, ends = _open(row)
    begins = np.concatenate(([0], ends[:-1]))
    edge = np.zeros(len(data) + 1, np.int64)

    def mark(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(edge, first, 1)
        np.add.at(edge, last, -1)

    own = said[said["covered"].notna()]
    if len(own):
        own = own.iloc[0]
        covered = unpack(own["covered"], True).astype(np.int64)
        doc = np.searchsorted(ends, covered, "right")
        mark(np.maximum(covered - BEFORE, begins[doc]), np.minimum(covered + LENGTH, ends[doc]))
        said = said[said["answer"].notna()].sort_values("bucket")
        edges = [unpack(one) for one in said.loc[said["kind"] == EDGE, "answer"]]
        if edges:
            places, at = unpack(own["edges"]).astype(np.int64).reshape(2, -1)
            bits = np.concatenate(edges)[at]
            begin = np.maximum(places - BEFORE, begins[np.searchsorted(ends, places, "right")])
            for step in range(REACH):
                first = begin[(bits >> np.uint64(step)) & np.uint64(1) > 0] + step
                mark(first, first + LENGTH)
        wide = [unpack(one) for one in said.loc[said["kind"] == WIDE, "answer"]]
        if wide:
            starts = unpack(own["wide"][: int(own["kind"])], True).astype(np.int64)
            least = np.concatenate(wide)[unpack(own["wide"][int(own["kind"]) :]).astype(np.int64)]
            first = starts[least < _codes(row["ids"], row["nulls"])[np.searchsorted(ends, starts, "right")]]
            mark(first, first + LENGTH)
    gone = np.cumsum(edge[:-1]) > 0
    ids = pd.array(np.frombuffer(row["ids"], np.int64), "Int64")
    ids[unpack(row["nulls"]) > 0] = pd.NA
    spans, kept = [], []
    for a, b in zip(begins.tolist(), ends.tolist()):
        one = gone[a:b]
        turns = np.flatnonzero(np.diff(one.view(np.int8), prepend=0, append=0))
        spans.append([{"start": x, "end": y} for x, y in turns.reshape(-1, 2).tolist()])
        kept.append(data[a:b][~one].tobytes())
    return pd.DataFrame({columns[0]: ids, "n_bytes": ends - begins, "spans": spans, "kept": kept})


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, indexed: int = INDEXED
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): a row per input row.

    Texts are taken as UTF-8 bytes. Every byte goes that is covered by a string of `LENGTH` bytes
    which also starts in a document of a smaller id; overlaps count, strings never cross documents
    and are judged on the input. spans: the removed runs (start, end), in order; kept: the rest.

    Null and empty texts have no bytes. A null id is smaller than any other. Rows that share an id
    take nothing from each other. An empty table gives an empty result; other columns are not read,
    whatever their names. Whole texts are read, and strings occurring in any number of documents
    count: anchors with more than `indexed` different surroundings are compared string by string
    with hashes of 64 bits instead of in an index, to keep one index small. Surroundings and shared
    anchors are compared by hashes of 64 and 48 bits; the latter are confirmed by the former.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "repeats")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("_id"), filled(text).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    blocks = bucketed(_blocks(rows, block_bytes), f"{folder}/blocks")
    buckets = 1 + size // (REACH // 2 * BUCKET_ANCHORS)
    shared = _ask_shared(blocks, buckets).groupBy("bucket")
    shared = shared.applyInPandas(_answer_shared, "bucket bigint, block bigint, shared binary")
    asked = stage(_ask_covered(blocks, shared, buckets), f"{folder}/covered", spark)
    covered = asked.where("bucket IS NOT NULL").groupBy("bucket")
    answer = lambda key, rows: _answer_covered(key, rows, indexed)
    covered = covered.applyInPandas(answer, "bucket bigint, block bigint, least binary, kind binary")
    covered = covered.unionByName(asked.where("bucket IS NULL").select("bucket", "block", "places", "at"), True)
    anchors_left = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    asked = stage(_ask_edges(blocks, covered, 1 + anchors_left // BUCKET_STRINGS), f"{folder}/edges", spark)
    answers = asked.where("bucket IS NOT NULL").groupBy("bucket", "kind")
    answers = answers.applyInPandas(_answer_edges, "bucket bigint, block bigint, kind int, answer binary")
    own = asked.where("bucket IS NULL").select("bucket", "block", "kind", "covered", "edges", "wide")
    answers = answers.unionByName(own, True)
    schema = f"`{doc_id}` bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    remove = lambda key, mine, said: _remove(key, mine, said, [doc_id])
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(remove, schema)
