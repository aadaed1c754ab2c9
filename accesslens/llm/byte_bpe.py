"""Byte-level BPE: merges compiled into a lazily determinised transducer, and a streaming decoder.

The merges turn a piece into the one sequence of tokens in which every token is rebuilt from its own
bytes and every pair of neighbours from the bytes of both: merging is local, so a merge that crosses a
border in the whole piece would cross it in the pair. That makes encoding a matter of automata: read
bytes down the trie of tokens, end a token where it agrees with the one before. Which token ends where
is open for a few bytes, so a state holds every reading that is still possible, and a token is emitted
once all of them share it. No reading is open for longer than the longest token.
"""

from __future__ import annotations

import base64
import gc
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.text import filled, whole_rows, with_outputs
from accesslens.llm.tokens import ChunkIds

# States, and pairs of tokens, that a worker remembers before it starts anew (some 200 MB); results do not change.
STATES = 300_000
PAIRS = 100_000
# Steps remembered for each of these states, on the average.
STEPS = 4
ROOT = 0
NOTHING = -1
NODE_BITS = 24
# Bytes at the start of a piece that are read in one step.
HEAD = 4
NODES = (1 << NODE_BITS) - 1
TOKEN_BITS = 20
TOKENS = (1 << TOKEN_BITS) - 1


def _tokens(packed: int) -> list[int]:
    """The open tokens of a reading, in order."""
    found = []
    while packed:
        found.append((packed & TOKENS) - 1)
        packed >>= TOKEN_BITS
    return found[::-1]


def _first(packed: int) -> int:
    """The first open token of a reading, as it is packed."""
    while packed > TOKENS:
        packed >>= TOKEN_BITS
    return packed


def _reading(tokens: list[int], node: int) -> int:
    packed = 0
    for token in tokens:
        packed = packed << TOKEN_BITS | token + 1
    return packed << NODE_BITS | node


class MergeTransducer:
    """Token ids of a piece of bytes, read byte by byte.

    A state is the last token that is settled, and the readings of all bytes after it: the tokens
    that are open yet, and the node of the trie that the bytes after them lead to, in one number.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.children: dict[int, int] = {}
        self.token_at: list[int] = [NOTHING]
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                step = node << 8 | byte
                if step not in self.children:
                    self.children[step] = len(self.token_at)
                    self.token_at.append(NOTHING)
                node = self.children[step]
            self.token_at[node] = rank
        # A reading at any other node cannot go on.
        self.inner = {step >> 8 for step in self.children}
        self.agreeing: dict[int, bool] = {}
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, int]] | None] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple[int, ...]] = []
        self.number_of: dict[tuple[int, ...], int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        # Equal outputs of steps are one object.
        self.outputs: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.ends: dict[int, list[int]] = {}
        # What the first bytes of pieces lead to: one step instead of several.
        self.begins: dict[bytes, tuple[int, list[int]]] = {}
        self.start = self._number((NOTHING, ROOT))

    def _number(self, state: tuple[int, ...]) -> int:
        known = self.number_of.get(state)
        if known is None:
            known = self.number_of[state] = len(self.states)
            self.states.append(state)
        return known

    def merged(self, data: bytes, fewest: int = 1) -> list[bytes]:
        """The merges themselves, lowest rank first and leftmost among equals; for a token or two."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > fewest:
            ranks = [self.ranks.get(a + b, len(self.ranks)) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == len(self.ranks):
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that a token's last merge joins; None for a byte, or if merging ends elsewhere."""
        known = self.halves.get(token, NOTHING)
        if known is NOTHING:
            parts = self.merged(token, 2)
            whole = len(parts) == 2 and parts[0] + parts[1] in self.ranks
            known = self.halves[token] = (parts[0], parts[1]) if whole and len(self.merged(token)) == 1 else None
        return known

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """What stands at an end of a token while it is merged, each with the rank that swallows it.

        None if ranks do not rise on the way: then the order of merges is not theirs.
        """
        key = (token, side)
        if key not in self.edges:
            parts, after = [(token, len(self.ranks))], token
            while (halves := self._halves(after)) is not None:
                rank = self.ranks[after]
                if any(len(half) > 1 and self.ranks[half] >= rank for half in halves):
                    parts = None
                    break
                after = halves[side]
                parts.append((after, rank))
            rebuilt = parts is not None and len(parts[-1][0]) == 1
            self.edges[key] = parts[::-1] if rebuilt else None
        return self.edges[key]

    def agree(self, before: int, token: int) -> bool:
        """Whether merging gives back exactly these two neighbours (or the first token alone)."""
        pair = before + 1 << TOKEN_BITS | token
        known = self.agreeing.get(pair)
        if known is None:
            if len(self.agreeing) >= PAIRS:
                self.agreeing.clear()
            known = self.agreeing[pair] = self._agree(before, token)
        return known

    def _agree(self, before: int, token: int) -> bool:
        after = self.bytes_of[token]
        if before == NOTHING:
            return self.merged(after) == [after]
        first = self.bytes_of[before]
        left, right = self._edge(first, 1), self._edge(after, 0)
        if left is None or right is None:
            return self.merged(first + after) == [first, after]
        # Merges go by rising rank: follow what touches the border from both sides. A merge across it
        # comes first if its rank is lower; among equals the leftmost does.
        i = j = 0
        last = len(self.ranks)
        while True:
            (one, one_ends), (two, two_ends) = left[i], right[j]
            across = self.ranks.get(one + two, last)
            if across < one_ends and across <= two_ends and across < last:
                return False
            if one_ends == two_ends == last:
                return True
            if one_ends <= two_ends:
                i += 1
            else:
                j += 1

    def _step(self, state: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The readings after one more byte, and the tokens that all of them share by now."""
        readings, children, inner, token_at, settled = [], self.children, self.inner, self.token_at, state[0]
        agreeing, complete = self.agreeing, False
        for reading in state[1:]:
            node = reading & NODES
            child = children.get(node << 8 | byte)
            if child is None:
                continue
            if child in inner:
                readings.append(reading - node + child)
            token = token_at[child]
            # A prefix has one complete reading: once it is found, no other token ends here.
            if token != NOTHING and not complete:
                open_tokens = reading >> NODE_BITS
                before = open_tokens & TOKENS if open_tokens else settled + 1
                agrees = agreeing.get(before << TOKEN_BITS | token)
                if agrees is None:
                    agrees = self.agree(before - 1, token)
                if agrees:
                    complete = True
                    readings.append((open_tokens << TOKEN_BITS | token + 1) << NODE_BITS)
        # The first reading began its token first, so no other has fewer open tokens.
        if readings[0] <= NODES:
            return (settled, *readings), ()
        shared = 0
        # The readings that differ most are the first and the last; only if they agree are all taken apart.
        if _first(readings[0] >> NODE_BITS) == _first(readings[-1] >> NODE_BITS):
            paths = [_tokens(reading >> NODE_BITS) for reading in readings]
            shared = next((i for i, one in enumerate(zip(*paths)) if len(set(one)) > 1), len(paths[0]))
        if not shared:
            # Every reading has a token after the settled one, which decides nothing any more.
            return (NOTHING, *readings), ()
        emitted = paths[0][:shared]
        kept = [_reading(path[shared:], reading & NODES) for path, reading in zip(paths, readings)]
        return (emitted[-1] if kept[0] <= NODES else NOTHING, *kept), tuple(emitted)

    def _determinise(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        if len(self.states) >= STATES or len(self.steps) >= STATES * STEPS:
            state = self.states[number]
            self._forget()
            number = self._number(state)
        state, emitted = self._step(self.states[number], byte)
        reached = self.steps[number << 8 | byte] = self._number(state), self.outputs.setdefault(emitted, emitted)
        return reached

    def _read(self, state: int, data: bytes) -> tuple[int, list[int]]:
        """The state after some bytes, and the tokens emitted on the way."""
        found: list[int] = []
        known = self.steps.get
        for byte in data:
            step = known(state << 8 | byte)
            if step is None:
                step, known = self._determinise(state, byte), self.steps.get
            state, emitted = step
            if emitted:
                found += emitted
        return state, found

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match of the splitting pattern; one that is a token by itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        begun = self.begins.get(piece[:HEAD])
        if begun is None:
            begun = self._read(self.start, piece[:HEAD])
            if len(self.begins) >= STATES:
                self.begins.clear()
            self.begins[piece[:HEAD]] = begun
        state, found = begun
        if len(piece) > HEAD:
            state, more = self._read(state, piece[HEAD:])
            found = found + more
        left = self.ends.get(state)
        if left is None:
            # Every prefix has one complete reading: the one that is back at the root.
            left = next(_tokens(one >> NODE_BITS) for one in self.states[state][1:] if one & NODES == ROOT)
            self.ends[state] = left
        return found + left


# How many bytes follow a first byte, and what the second may be where not every continuation is allowed.
_FOLLOWING = {**dict.fromkeys(range(0xC2, 0xE0), 1), **dict.fromkeys(range(0xE0, 0xF0), 2), **dict.fromkeys(range(0xF0, 0xF5), 3)}
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def utf8_step(pending: bytes, byte: int) -> tuple[str, bytes]:
    """The UTF-8 state machine: the text that a byte completes, and the bytes that stay open.

    What cannot be continued becomes U+FFFD, and the byte that shows it is read anew.
    """
    if pending:
        low, high = _SECOND.get(pending[0], (0x80, 0xBF)) if len(pending) == 1 else (0x80, 0xBF)
        if not low <= byte <= high:
            text, left = utf8_step(b"", byte)
            return "\ufffd" + text, left
        pending += bytes([byte])
        return (pending.decode(), b"") if len(pending) > _FOLLOWING[pending[0]] else ("", pending)
    if byte < 0x80:
        return chr(byte), b""
    return ("", bytes([byte])) if byte in _FOLLOWING else ("\ufffd", b"")


def _utf8_steps(pending: bytes, data: bytes) -> tuple[str, bytes]:
    text = []
    for byte in data:
        done, pending = utf8_step(pending, byte)
        text.append(done)
    return "".join(text), pending


class _WholeTexts(dict):
    """Texts of tokens that begin and end between characters, found as needed; None for others."""

    def __init__(self, tokens: dict[int, bytes]):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, token: int) -> str | None:
        text, pending = _utf8_steps(b"", self.tokens[token])
        # A replaced byte may be the rest of a character that is open by then.
        self[token] = known = None if pending or "\ufffd" in text else text
        return known


class StreamDecoder:
    """Text of token ids as they come: a character is given out once its last byte is there."""

    def __init__(self, tokens: dict[int, bytes], whole: dict[int, str | None] | None = None):
        self.tokens, self.pending = tokens, b""
        self.whole = _WholeTexts(tokens) if whole is None else whole

    def feed(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        texts = list(map(self.whole.__getitem__, ids))
        if self.pending or None in texts:
            # The machine goes through the bytes where a character is open.
            for i, text in enumerate(texts):
                if text is None or self.pending:
                    texts[i], self.pending = _utf8_steps(self.pending, self.tokens[ids[i]])
        return "".join(texts)

    def finish(self) -> str:
        """What is left open at the end is one replacement character."""
        left, self.pending = self.pending, b""
        return "\ufffd" if left else ""


def _newer_signs() -> str:
    """Letters and digits that `regex` knows and the installed `tiktoken` does not yet, as a class.

    The two follow different versions of Unicode; results have to be those of `tiktoken`.
    """
    import tiktoken

    single = {bytes([byte]): byte for byte in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    signs = regex.findall(r"[\p{L}\p{N}]", every)
    known = tiktoken.Encoding("signs", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    newer = sorted(set(signs) - set(bytes(known.encode_ordinary("".join(signs))).decode()))
    ranges: list[list[int]] = []
    for code in map(ord, newer):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges)


def _latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of code points below 256, with its classes spelt out; None if it has others.

    `re` takes less than half the time of `regex`, but knows no Unicode properties.
    """
    signs = "".join(map(chr, range(256)))
    classes = {name: re.escape("".join(regex.findall(name, signs))) for name in (r"\p{L}", r"\p{N}", r"\s")}
    parts, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|[^\\]", pattern, re.DOTALL):
        if part in classes:
            parts.append(classes[part] if inside else f"[{classes[part]}]")
        elif part == r"\S" and not inside:
            parts.append(f"[^{classes[chr(92) + 's']}]")
        elif part.startswith("\\") and part[1:].isalnum():
            return None
        else:
            inside = part == "[" or inside and part != "]"
            parts.append(part)
    return re.compile("".join(parts))


class ByteBpe:
    """Ids of texts and texts of ids, by a file of ranks and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.transducer = MergeTransducer(ranks)
        self.plain = self.settled = regex.compile(pattern)
        self.latin = _latin_pattern(pattern)
        self.newer, signs = None, _newer_signs()
        if signs:
            self.newer = regex.compile(f"[{signs}]")
            for name in ("L", "N"):
                pattern = pattern.replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--[{signs}]]")
            self.settled = regex.compile(f"(?V1){pattern}")
        # Most pieces of a text have been seen before.
        self.known = ChunkIds(lambda piece: self.transducer.encode(piece.encode()))
        self.whole = _WholeTexts(self.transducer.bytes_of)

    def _pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            split = self.latin or self.plain
        except UnicodeEncodeError:
            split = self.settled if self.newer is not None and self.newer.search(text) else self.plain
        return split.findall(text)

    def ids(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self._pieces(text)))

    def text(self, ids: bytes) -> str:
        decoder = StreamDecoder(self.transducer.bytes_of, self.whole)
        return decoder.feed(np.frombuffer(ids, "<u4").tolist()) + decoder.finish()


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per file and Python worker."""
    return ByteBpe(path, pattern)


def token_ids(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text as little-endian unsigned 32-bit numbers; null counts as empty."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        # Nothing here refers back to itself, and looking for what does costs a quarter of the time.
        gc.disable()
        try:
            return pd.Series([byte_bpe(path, pattern).ids(one) for one in texts], dtype="object")
        finally:
            gc.enable()

    return of(filled(text))


def token_text(ids: Column, path: str, pattern: str) -> Column:
    """The text of such ids; bytes that are no UTF-8 become U+FFFD. Null stays null."""

    @F.pandas_udf("string")
    def of(many: pd.Series) -> pd.Series:
        gc.disable()
        try:
            return pd.Series([None if one is None else byte_bpe(path, pattern).text(one) for one in many], dtype="object")
        finally:
            gc.enable()

    return of(ids)


def _joined(kind: pa.DataType, values: bytearray, ends: list[int]) -> pa.Array:
    """Values that follow each other, as one array over the same bytes."""
    offsets = np.array([0, *ends], np.int32)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def ids_and_text(text: Column, path: str, pattern: str) -> Column:
    """(ids, decoded): the ids of a text and the text read back from them; null counts as empty.

    One call makes both: Spark would run a function that another one reads once more for it. Of a
    batch no more than one text is held as Python objects.
    """

    @F.arrow_udf("ids binary, decoded string")
    def of(texts: pa.Array) -> pa.Array:
        bpe = byte_bpe(path, pattern)
        ids, ids_ends, decoded, decoded_ends = bytearray(), [], bytearray(), []
        gc.disable()
        try:
            for one in texts:
                found = bpe.ids(one.as_py())
                ids += found
                ids_ends.append(len(ids))
                decoded += bpe.text(found).encode()
                decoded_ends.append(len(decoded))
        finally:
            gc.enable()
        columns = [_joined(pa.binary(), ids, ids_ends), _joined(pa.string(), decoded, decoded_ends)]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    return of(filled(text))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The input's rows and columns, and `n_tokens`, `ids` and `decoded`: the text read back from them.

    `path` is a file of ranks, a token in base64 and its rank per line, and `pattern` splits texts
    before the merges; special tokens are ordinary text. Null and empty texts have no ids and decode
    to the empty text. Every row is encoded by itself, so repeated rows and null ids stay as they
    are; outputs replace input columns of their names. An empty table gives an empty result.
    """
    rows = whole_rows(docs).withColumn("_made", ids_and_text(F.col("_row")[text], path, pattern))
    outputs = {
        "n_tokens": (F.octet_length("_made.ids") / 4).cast("bigint"),
        "ids": F.col("_made.ids"),
        "decoded": F.col("_made.decoded"),
    }
    return with_outputs(rows, docs.columns, outputs)
