"""The contracts, one document after the other in plain Python."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(f"[{WHITE}]", text or "") if w]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def line_fails(line):
    parts = words(line)
    if not parts:
        return False
    chars = sum(map(len, parts))
    symbols = sum(c in "#*$%&|<>" for c in line)
    marks = sum(w in "|>/-" and len(w) == 1 for w in parts)
    boilerplate = (
        "all rights reserved|cookie policy|privacy policy|terms of use|terms of service|enable javascript"
        "|javascript is disabled|click here|skip to content|sign up for|log in to|subscribe to our"
    )
    return (
        symbols > 0.1 * chars
        or (marks >= 3 and marks * 4 >= len(parts))
        or (len(parts) >= 40 and not any(c in ".!?,;:" or c > "\x7f" and unicodedata.category(c) == "Po" for c in line))
        or (len(parts) <= 25 and re.search(boilerplate, line, re.IGNORECASE | re.ASCII) is not None)
    )


def quality(text):
    """(cleaned text, kept)"""
    text = text or ""
    parts = words(text)
    windows = Counter(zip(parts, parts[1:], parts[2:]))
    repeated = {i + k for i, w in enumerate(zip(parts, parts[1:], parts[2:])) if windows[w] > 1 for k in range(3)}
    failed = len(parts) < 50 or 100 * len(repeated) > 50 * len(parts)
    cleaned = "\n".join(line for line in text.split("\n") if not line_fails(line))
    all_chars, left = sum(map(len, parts)), sum(map(len, words(cleaned)))
    return cleaned, not failed and all_chars - left <= 0.5 * all_chars


def line_key(line):
    return ascii_lower(line.strip(WHITE))


def dedup_lines(docs):
    """[(id, text)] -> [(id, lines, dropped, text)]; a null id is below all others."""
    below = lambda key: (key is not None, key or 0)
    holders = defaultdict(set)
    for key, text in docs:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(key)
    out = []
    for key, text in docs:
        lines = (text or "").split("\n")
        gone = [
            len(k) >= 20 and len(holders[k]) >= 3 and key != max(holders[k], key=below)
            for k in map(line_key, lines)
        ]
        out.append((key, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def simhash(text):
    parts = words(ascii_lower(text or ""))
    if not parts:
        return 0
    n = min(3, len(parts))
    hashes = [xxhash.xxh64_intdigest(" ".join(parts[i : i + n]), 42) for i in range(len(parts) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs):
    """[(id, text)] -> [(id, fingerprint, component)]"""
    prints = [simhash(text) for _, text in docs]
    known = sorted(set(prints))
    root = {p: p for p in known}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (key, _), p in zip(docs, prints):
        if key is not None:
            least[find(p)] = min(key, least.get(find(p), key))
    return [(key, f"{p:016x}", least.get(find(p))) for (key, _), p in zip(docs, prints)]


def mixed_copies(docs):
    """[(id, source)] -> copies of each, at equal shares of the sources."""
    counts = Counter(source for _, source in docs)
    out = []
    for key, source in docs:
        rate = len(docs) / (len(counts) * counts[source])
        u = int(hashlib.md5(f"17|{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 16**13
        total, logp, k = 0.0, -rate, 0
        while True:
            total += math.exp(logp)
            if u < total or k > rate + 12 * math.sqrt(rate) + 24:
                break
            k += 1
            logp += math.log(rate) - math.log(k)
        out.append(k)
    return out


def pieces(docs, tokenizer=None):
    """[(id, text)] -> [(id, piece, start, length, crc)]"""
    tokenizer = tokenizer or Tokenizer.from_file(TOKENIZER)
    out = []
    for key, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out.append((key, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def removed_bytes(docs):
    """[(id, text)] -> [(id, bytes, removed, spans, kept)]; a null id is below all others."""
    data = [(key, (text or "").encode()) for key, text in docs]
    rank = lambda key: (key is not None, key or 0)
    first = {}
    for key, one in data:
        for i in range(len(one) - 49):
            first[one[i : i + 50]] = min(first.get(one[i : i + 50], rank(key)), rank(key))
    out = []
    for key, one in data:
        gone = bytearray(len(one))
        for i in range(len(one) - 49):
            if first[one[i : i + 50]] < rank(key):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((key, len(one), sum(gone), spans, bytes(c for c, g in zip(one, gone) if not g)))
    return out


def phrases(data):
    """The set of Lempel-Ziv phrases of bytes."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


def phrase_signature(data):
    """The 64 least hashes of the phrases: base-M numbers of the bytes plus one, mixed, their upper halves."""
    found = set()
    for phrase in phrases(data):
        h = 0
        for byte in phrase:
            h = (h * 0x9E3779B97F4A7C15 + byte + 1) % 2**64
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ h >> 33) * factor % 2**64
        found.add(h >> 32)
    return sorted(found)[:64]


def alike(one, other):
    """The share of the least hashes of both signatures that both have."""
    union = sorted({*one, *other})[:64]
    return sum(h in one and h in other for h in union) / len(union) if union else 1.0


def grams(text):
    """The 400 most frequent n-grams, up to three signs, of the letters of a text; ties by last sign first."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")
    counts = Counter()
    for word in filter(None, words):
        counts.update(word)
        for n in (2, 3):
            counts.update(f" {word} "[i : i + n] for i in range(len(word) + 3 - n))
    return counts


def ranked(counts):
    return sorted(counts, key=lambda gram: (-counts[gram], [0] * (3 - len(gram)) + [ord(c) for c in gram[::-1]]))[:400]


def languages(docs):
    """[(text, lang)] -> {lang: {n-gram: rank}}"""
    counts = defaultdict(Counter)
    for text, lang in docs:
        if text is not None and lang is not None:
            counts[lang].update(grams(text))
    return {lang: {gram: i for i, gram in enumerate(ranked(own))} for lang, own in counts.items() if own}


def language(text, profiles):
    """(lang, score) by out-of-place distance."""
    mine = ranked(grams(text))
    if not mine or not profiles:
        return "und", 0.0
    cost = {
        lang: sum(abs(i - ranks[gram]) if gram in ranks else 400 for i, gram in enumerate(mine))
        for lang, ranks in profiles.items()
    }
    best = min(sorted(cost), key=cost.get)
    return best, 1 - cost[best] / (400 * len(mine))


def _kept(n):
    """Discounted counts by Katz's formula, or from a fitted line; by n[r], r from 1 to 6."""
    for fitted in (False, True):
        if fitted:
            seen = [r for r in range(1, 7) if n[r]]
            if len(seen) < 2:
                break
            slope, height = np.polyfit(np.log(seen), np.log([n[r] for r in seen]), 1)
            n_ = [0, *(math.exp(height + slope * math.log(r)) for r in range(1, 7))]
        else:
            n_ = n
        if all(n_[1:]) and 6 * n_[6] < n_[1]:
            beyond = 6 * n_[6] / n_[1]
            kept = [((r + 1) * n_[r + 1] / (r * n_[r]) - beyond) / (1 - beyond) for r in range(1, 6)]
            if all(0 < d < 1 for d in kept):
                return lambda c: c * kept[c - 1] if c <= 5 else c
    less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return lambda c: c - less if c <= 5 else c


class Katz:
    """N-grams with start and end, backing off order by order to unigrams with one unknown word."""

    def __init__(self, texts, order=3):
        self.order = order
        said = [[None, *self.tokens(text)] for text in texts]
        self.counts = {
            k: Counter(tuple(one[i - k + 1 : i + 1]) for one in said for i in range(max(1, k - 1), len(one)))
            for k in range(1, order + 1)
        }
        self.unigrams = Counter({gram[0]: n for gram, n in self.counts[1].items()})
        self.total, self.distinct = sum(self.unigrams.values()), len(self.unigrams)
        spectrum = lambda counts: [0, *(sum(c == r for c in counts.values()) for r in range(1, 7))]
        self.keep = {k: _kept(spectrum(counts)) for k, counts in self.counts.items()}
        self.kept = sum(self.keep[1](c) for c in self.unigrams.values())
        self.contexts, self.mass, self.lower = Counter(), Counter(), Counter()
        for k in range(2, order + 1):
            for gram, c in self.counts[k].items():
                self.contexts[gram[:-1]] += c
                self.mass[gram[:-1]] += self.keep[k](c)
                self.lower[gram[:-1]] += self.likely(gram[1:-1], gram[-1])

    @staticmethod
    def tokens(text):
        return [*words(ascii_lower(text or "")), "\n"]

    def unigram(self, w):
        if not self.total:
            return 1.0
        c = self.unigrams.get(w, 0)
        if self.kept >= self.total:
            return max(c, 1) / (self.total + 1)
        return (self.keep[1](c) if c else self.total - self.kept) / self.total

    def likely(self, context, w):
        """The probability of a token after a tuple of tokens."""
        if not context:
            return self.unigram(w)
        shorter = self.likely(context[1:], w) if context != (None,) else self.unigram(w)
        if context not in self.contexts:
            return shorter
        total = self.contexts[context] if self.mass[context] < self.contexts[context] else self.mass[context] + 1
        gram = (*context, w)
        if gram in self.counts[len(gram)]:
            return self.keep[len(gram)](self.counts[len(gram)][gram]) / total
        return (1 - self.mass[context] / total) / (1 - self.lower[context]) * shorter

    def score(self, text):
        said = [None, *self.tokens(text)]
        least = lambda i: max(0, i - self.order + 1)
        return sum(math.log10(self.likely(tuple(said[least(i) : i]), said[i])) for i in range(1, len(said)))

    def base(self, text):
        bottom = self.total + 0.5 * (self.distinct + 1)
        return sum(math.log10((self.unigrams.get(w, 0) + 0.5) / bottom) for w in self.tokens(text))
