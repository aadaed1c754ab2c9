"""Token ids of whole texts, by a public tokenizer that Python workers load from its file."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

# The Unicode white space that byte-level tokenizers split at (fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A run that byte-level splitting never joins with its neighbours: a word with the space before
# it, white space up to the last sign before a word, white space at the end.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters up to here are letters in every version of Unicode.
SETTLED = re.compile("[^\\u0000-\\u024f]")
# Chunks a worker remembers in each of two generations, and the longest: at most some 100 MB. Pieces are shorter.
REMEMBERED = 250_000
REMEMBERED_PIECES = 400_000
LONGEST = 48


def _signs(kind: str) -> str:
    """The settled signs whose Unicode category begins so, for a class of a pattern."""
    return "".join(sign for sign in map(chr, range(0x250)) if unicodedata.category(sign).startswith(kind))


LETTERS, DIGITS = _signs("L"), _signs("N")
# SPLIT for settled texts. What most pieces are comes first; alternatives that begin differently may change places.
PIECE = re.compile(
    f" [{LETTERS}]+|[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{DIGITS}]+| ?[^{SPACE}{LETTERS}{DIGITS}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def _is_settled(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not SETTLED.search(text)
    return True


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


class ChunkIds(dict):
    """Ids of chunks as they are asked for; those not asked for in a long time are forgotten."""

    def __init__(self, encode, remembered: int = REMEMBERED):
        super().__init__()
        self.encode, self.older, self.remembered = encode, {}, remembered

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = array("I", self.encode(chunk)).tobytes()
        if len(chunk) <= LONGEST:
            if len(self) >= self.remembered:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class TextEncoder:
    """Ids as the `tokenizers` library gives them, without added special tokens.

    A plain byte-level BPE splits texts into pieces first, most of which a worker has seen: their
    ids are looked up, and only new ones are encoded. Of texts with signs that are not settled, chunks
    take the place of pieces where such a sign is. Anything else is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.special = [token["content"] for token in parts["added_tokens"]]
        pieces, self.known = self._piece_encoder(parts), None
        if pieces:
            encode = pieces._core_bpe.encode_single_piece
            self.known = ChunkIds(lambda piece: encode(piece.encode()), REMEMBERED_PIECES)
            # Chunks with signs that are not settled.
            self.others = ChunkIds(lambda chunk: self.whole.encode(chunk, add_special_tokens=False).ids)

    @staticmethod
    def _piece_encoder(parts: dict):
        """An encoder with the same merges, if the tokenizer is a plain byte-level BPE."""
        import tiktoken

        split, model = parts["pre_tokenizer"] or {}, parts["model"]
        plain = (
            parts["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not plain:
            return None
        signs = _byte_signs()
        special = {token["content"] for token in parts["added_tokens"]}
        ranks = {
            bytes(signs[sign] for sign in piece): rank for piece, rank in model["vocab"].items() if piece not in special
        }
        return tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers."""
        if self.known is None or any(token in text for token in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _is_settled(text):
            return b"".join(map(self.known.__getitem__, PIECE.findall(text)))
        parts = []
        for chunk in CHUNK.findall(text):
            if SETTLED.search(chunk):
                parts.append(self.others[chunk])
            else:
                parts += map(self.known.__getitem__, PIECE.findall(chunk))
        return b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per file and Python worker."""
    return TextEncoder(path)
