"""Katz backoff language-model scores: Good-Turing n-grams of any order over discounted unigrams.

The corpus goes through tables in the shared folder, whose rows are blocks of packed numbers (a row
per token would be ten times as large): `blocks` of documents with words numbered within the block,
`words` by hash with their counts, and for every order from two on the n-grams by context with their
counts. What a block asks of a table it sends once per distinct n-gram, however often it uses it;
numbers, counts and the weights of unseen n-grams' contexts come back by block, which works out the
probabilities itself, and the next order is asked with them. Only whole numbers are sent: a word's
probability at the order below is its count there, discounted, over the count of its context.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.packed import bucketed, cuts, mixed, pack, unpack
from accesslens.llm.text import filled
from accesslens.session import broadcast_if_small, delete_path, scratch_path, setting, stage

ORDER = 3
BLOCK_TOKENS = 1_000_000
BUCKET_WORDS = 1_000_000
BUCKET_GRAMS = 1_000_000
# The n-grams of a context that comes more often than this go into several buckets.
CONTEXT_USES = 250_000
GOOD_TURING = 5
# Shuffle files go once what was made of them is written; each order would add its own otherwise.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# No word has white space, so these cannot be words.
END, START = b"\n", 0


def _katz(n: list) -> list[float] | None:
    """Katz's discounts from the numbers of n-grams by count, if each is one."""
    k = GOOD_TURING
    if not all(n[1:]) or (k + 1) * n[k + 1] >= n[1]:
        return None
    beyond = (k + 1) * n[k + 1] / n[1]
    kept = [((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond) for r in range(1, k + 1)]
    return kept if all(0 < d < 1 for d in kept) else None


@dataclass(frozen=True)
class Discounts:
    """How much of its count an n-gram keeps, by its count up to `GOOD_TURING`."""

    kept: tuple[float, ...]

    @staticmethod
    def of(n: list[int]) -> Discounts:
        """From the numbers n[r] of n-grams that come r times, r up to `GOOD_TURING` + 1.

        Katz's formula. Where the numbers are too uneven for it (copies in a corpus make them so)
        it takes them from a line fitted to their logarithms, as Gale's simple Good-Turing does,
        and where even that discounts nothing, every low count loses n1 / (n1 + 2 n2).
        """
        seen = np.flatnonzero(n)
        tries = [n]
        if len(seen) > 1:
            slope, height = np.polyfit(np.log(seen), np.log(np.array(n)[seen]), 1)
            tries.append([0.0, *np.exp(height + slope * np.log(np.arange(1, GOOD_TURING + 2)))])
        for numbers in tries:
            kept = _katz(numbers)
            if kept is not None:
                return Discounts((0.0, *kept))
        less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return Discounts((0.0, *((r - less) / r for r in range(1, GOOD_TURING + 1))))

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        low = np.array(self.kept)
        return counts * np.where(counts <= GOOD_TURING, low[np.minimum(counts, GOOD_TURING)], 1.0)


@dataclass(frozen=True)
class Unigrams:
    """Discounted word probabilities; all words that training lacks are one, which gets the rest."""

    tokens: int
    distinct: int
    discounts: Discounts
    kept: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        if self.kept >= self.tokens:  # nothing is discounted: one token more, for the unknown word
            return np.where(counts > 0, counts, 1) / (self.tokens + 1)
        known = self.discounts.mass(counts)
        return np.where(counts > 0, known, self.tokens - self.kept) / self.tokens

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


@dataclass(frozen=True)
class Model:
    """What is known of the orders so far: the words, and the discounts of every longer one."""

    unigrams: Unigrams
    discounts: dict[int, Discounts]

    def below(self, level: int, counts: np.ndarray, bases: np.ndarray) -> np.ndarray:
        """Probabilities at the order below of words that training has there, by their counts and contexts' bases."""
        if level == 2:
            return self.unigrams.probability(counts)
        return self.discounts[level - 1].mass(counts) / bases


def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """Documents (_id, _text, _train) as blocks with words numbered in order of appearance; the end is 0."""
    schema = "block bigint, ids binary, flags binary, ends binary, tokens binary, words binary, counts binary, n_words bigint, n_tokens bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32

        def fresh() -> tuple[defaultdict, list, list, list]:
            numbers: defaultdict = defaultdict()
            numbers.default_factory = numbers.__len__
            numbers[END]
            return numbers, [], [], []

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(one) for one in tokens])
            flat = np.concatenate(tokens)
            trained = np.repeat(np.array(train, bool), np.diff(ends, prepend=0))
            hashes = np.fromiter((xxhash.xxh64_intdigest(word) for word in numbers), np.uint64, len(numbers))
            counts = np.bincount(flat[trained], minlength=len(numbers))
            columns = [
                pa.array([block]),
                pa.array([np.array([key or 0 for key in ids], np.int64).tobytes()], pa.binary()),
                pa.array([pack(np.array(train) + 2 * np.array([key is None for key in ids]))], pa.binary()),
                *(pa.array([data], pa.binary()) for data in (pack(ends, True), pack(flat))),
                pa.array([hashes.tobytes()], pa.binary()),
                pa.array([pack(counts)], pa.binary()),
                pa.array([len(numbers)]),
                pa.array([len(flat)]),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        arrow = pa.schema(
            [
                ("block", pa.int64()),
                *((name, pa.binary()) for name in ("ids", "flags", "ends", "tokens", "words", "counts")),
                ("n_words", pa.int64()),
                ("n_tokens", pa.int64()),
            ]
        )
        numbers, ids, train, tokens = fresh()
        held = 0
        for batch in batches:
            for key, one, trains in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                # Splitting and lower-casing bytes know ASCII alone.
                said = one.as_py().encode().lower().split()
                tokens.append(np.fromiter((*map(numbers.__getitem__, said), 0), np.int64, len(said) + 1))
                ids.append(key)
                train.append(trains)
                held += len(said) + 1
                if held >= block_tokens:
                    yield flush()
                    block, held = block + 1, 0
                    numbers, ids, train, tokens = fresh()
        if ids:
            yield flush()

    return docs.mapInArrow(cut, schema)


def _staged(frame: DataFrame, path: str) -> DataFrame:
    """Written once, without the shuffle files that this took."""
    with setting(frame.sparkSession, CLEANUP, "true"):
        return stage(frame, path)


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kind) for column, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def _word_counts(blocks: DataFrame, buckets: int, folder: str) -> DataFrame:
    """(block, bucket, answers: numbers and counts of the words asked; null block: the table itself)."""
    asked = [("bucket", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = np.frombuffer(row["words"], np.uint64), unpack(row["counts"])
                order = _word_order(words, buckets)
                bucket = (words % np.uint64(buckets))[order]
                at = cuts(bucket)
                yield _table(
                    [
                        (int(bucket[a]), row["block"], pack(words[order][a:b], True), pack(counts[order][a:b]))
                        for a, b in zip(at[:-1], at[1:])
                    ],
                    asked,
                )

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = [unpack(data, True) for data in rows["words"]]
        counts = np.concatenate([unpack(data) for data in rows["counts"]]).astype(np.int64)
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, counts).astype(np.int64)
        # Frequent words get small numbers; no other bucket has the same ones.
        number = np.empty(len(known), np.uint64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(known), dtype=np.uint64)
        number = number * np.uint64(buckets) + np.uint64(key[0] + 1)
        ends = np.cumsum([len(one) for one in words])
        said = []
        for block, end, n in zip(rows["block"], ends, map(len, words)):
            mine = at[end - n : end]
            said.append((key[0], block, pack(number[mine]), pack(total[mine])))
        table = (key[0], -1, pack(known, True), pack(total))
        return pd.DataFrame([*said, table], columns=["bucket", "block", "numbers", "counts"])

    rows = blocks.select("block", "words", "counts").mapInArrow(ask, "bucket bigint, block bigint, words binary, counts binary")
    rows = rows.groupBy("bucket").applyInPandas(answer, "bucket bigint, block bigint, numbers binary, counts binary")
    return _staged(rows, f"{folder}/words")


def _word_order(words: np.ndarray, buckets: int) -> np.ndarray:
    return np.lexsort((words, words % np.uint64(buckets)))


def _spectrum(table: DataFrame, column: str) -> list[int]:
    """Over all n-grams of a table of packed counts: how many, their sum, and how many come r times."""
    top = GOOD_TURING + 1

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(top + 2, np.int64)
        for batch in batches:
            for one in batch.column(0):
                counts = unpack(one.as_py()).astype(np.int64)
                sums += [(counts > 0).sum(), counts.sum(), *(np.count_nonzero(counts == r) for r in range(1, top + 1))]
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["sums"])

    sums = table.select(column).mapInArrow(tally, "sums array<bigint>")
    total = sums.agg(*(F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(str(i)) for i in range(top + 2))).first()
    return list(total)


def pack_floats(values: np.ndarray) -> bytes:
    """Floats as places among their distinct values, which are far fewer."""
    known, at = np.unique(values, return_inverse=True)
    return len(known).to_bytes(8, "little") + known.tobytes() + pack(at)


def unpack_floats(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(data, np.float64, n, 8)[unpack(data[8 + 8 * n :]).astype(np.int64)]


ANSWERS = ("level", "bucket", "block", "numbers", "counts", "extras", "weights")
ANSWER_SCHEMA = "level int, bucket bigint, block bigint, numbers binary, counts binary, extras binary, weights binary"


def _joined(said: pd.DataFrame, name: str, read=unpack) -> np.ndarray:
    parts = [read(data) for data in said[name]]
    return np.concatenate(parts) if parts else read(pack_floats(np.zeros(0)) if read is unpack_floats else pack(np.zeros(0)))


@dataclass(frozen=True)
class Spread:
    """Into how many buckets words and n-grams go, and how often a context comes that goes into several."""

    words: int
    grams: int
    context_uses: int

    def parts(self, counts: np.ndarray) -> np.ndarray:
        return 1 + counts // self.context_uses


@dataclass(frozen=True)
class _Asked:
    """The distinct n-grams of a block, in the order in which buckets are asked for them; `first` is a token that ends each."""

    tokens: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bucket: np.ndarray
    first: np.ndarray


class _Block:
    """A block's tokens and what the tables have said of its n-grams, order after order.

    `at` is the n-gram of the present order that a token ends; `number` and `count` are known of
    each, and `base`, what its context's probabilities are shares of. The last one is none, and with
    single words the start, the context of a first token. `likely` is each token's probability after
    as many tokens as the order allows.
    """

    def __init__(self, row: pd.Series, said: pd.DataFrame, spread: Spread, model: Model, level: int):
        words = np.frombuffer(row["words"], np.uint64)
        self.spread, self.order = spread, 1
        self.tokens, self.ends = unpack(row["tokens"]).astype(np.int64), unpack(row["ends"], True).astype(np.int64)
        self.lengths = np.diff(self.ends, prepend=0)
        self.place = np.arange(len(self.tokens)) - np.repeat(self.ends - self.lengths, self.lengths)
        self.number, self.count = np.empty(len(words) + 1, np.uint64), np.empty(len(words) + 1, np.int64)
        said = said.sort_values(["level", "bucket"])
        of = lambda k: said[said["level"] == k]
        order = _word_order(words, spread.words)
        self.number[order], self.count[order] = _joined(of(1), "numbers"), _joined(of(1), "counts")
        # A text starts as often as it ends.
        self.number[-1], self.count[-1] = START, self.count[0]
        self.words, self.known, self.at = self.number, self.count, self.tokens
        self.word_rank, self.word_hash = _ranks(self.words), mixed(self.words)
        self.base = np.zeros(len(self.count), np.int64)
        self.likely = model.unigrams.probability(self.count)[self.tokens]
        for k in range(2, level + 1):
            self._take(self.ask(), of(k), model.discounts[k])

    def ask(self) -> _Asked:
        """The n-grams of the next order whose contexts training has; other tokens keep their probability."""
        before = np.concatenate(([0], self.at[:-1]))
        before[self.place < max(1, self.order - 1)] = len(self.count) - 1
        tokens = np.flatnonzero(self.count[before] > 0)
        before = before[tokens]
        keys = _ranks(self.number)[before] * len(self.words) + self.word_rank[self.tokens[tokens]]
        order, edges = _grouped(keys)
        first = tokens[order[edges[:-1]]]
        left, right = before[order[edges[:-1]]], self.tokens[first]
        part = self.word_hash[right] % self.spread.parts(self.count[left]).astype(np.uint64)
        bucket = (mixed(mixed(self.number)[left] + part) % np.uint64(self.spread.grams)).astype(np.int64)
        # Numbers of 16 bits are sorted in time proportional to how many they are.
        place = np.argsort(bucket.astype(np.uint16) if self.spread.grams <= 1 << 16 else bucket, kind="stable")
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        at = np.empty(len(tokens), np.int64)
        at[order] = np.repeat(rank, np.diff(edges))
        return _Asked(tokens, at, left[place], right[place], bucket[place], first[place])

    def _take(self, asked: _Asked, said: pd.DataFrame, discounts: Discounts) -> None:
        """The answers make the next order the present one."""
        counts = _joined(said, "counts").astype(np.int64)
        base = self.count[asked.left] + _joined(said, "extras").astype(np.int64)
        seen = counts > 0
        factor = discounts.mass(counts) / base
        factor[~seen] = _joined(said, "weights", unpack_floats)
        factor = factor[asked.at]
        self.likely[asked.tokens] = np.where(seen[asked.at], factor, factor * self.likely[asked.tokens])
        self.order += 1
        if len(said) and said["numbers"].iloc[0] is None:
            return
        ranks = [unpack(data) for data in said["numbers"]]
        # A bucket's own numbers; with it they are those of all buckets.
        buckets = np.repeat(said["bucket"].to_numpy(np.uint64), [len(one) for one in ranks])
        ranks = np.concatenate(ranks) if ranks else np.zeros(0, np.uint64)
        number = np.where(ranks > 0, (ranks - np.uint64(1)) * np.uint64(self.spread.grams) + buckets + np.uint64(1), 0)
        self.number, self.count = np.append(number.astype(np.uint64), np.uint64(0)), np.append(counts, 0)
        self.base = np.append(base, 0)
        self.at = np.full(len(self.tokens), len(self.count) - 1)
        self.at[asked.tokens] = asked.at


def _ranks(values: np.ndarray) -> np.ndarray:
    """Places of the values in rising order."""
    ranks = np.empty(len(values), np.int64)
    ranks[np.argsort(values)] = np.arange(len(values))
    return ranks


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys together, rising, and where in it they begin, and the end."""
    order = np.argsort(keys)
    return order, cuts(keys[order])


REQUEST = ("contexts", "sizes", "totals", "bases", "words", "counts", "below")


def _requests(blocks: DataFrame, answers: DataFrame, level: int, spread: Spread, model: Model) -> DataFrame:
    """(bucket, block, and per bucket the distinct n-grams that a block asks for).

    They come by context: its number, how many n-grams, its count, and the base of the order below;
    then each one's last word, its training count in the block, and where there is one, its count at
    the order below.
    """
    schema = "bucket bigint, block bigint, " + ", ".join(f"{name} binary" for name in REQUEST)

    def ask(key: tuple, mine: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        row = mine.iloc[0]
        block = _Block(row, said, spread, model, level - 1)
        asked = block.ask()
        shorter = block.at[asked.first]
        trained = np.repeat((unpack(row["flags"]) & np.uint64(1)).astype(float), block.lengths)[asked.tokens]
        counts = np.bincount(asked.at, trained, len(asked.left))
        below = np.where(counts > 0, block.count[shorter], 0)
        edges, out = cuts(asked.bucket), []
        for a, b in zip(edges[:-1], edges[1:]):
            at = cuts(asked.left[a:b])
            context, begin = asked.left[a:b][at[:-1]], a + at[:-1]
            out.append(
                (
                    int(asked.bucket[a]), key[0], pack(block.number[context], True), pack(np.diff(at)),
                    pack(block.count[context]), pack(block.base[shorter[begin]]),
                    pack(block.words[asked.right[a:b]]), pack(counts[a:b]), pack(below[a:b]),
                )
            )
        return pd.DataFrame(out, columns=["bucket", "block", *REQUEST])

    left = blocks.select("block", "flags", "ends", "tokens", "words").groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInPandas(ask, schema)


TABLE = ("contexts", "sizes", "totals", "counts", "below")


def _keys(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number for each pair, rising with the context, then the word."""
    bits = [int(values.max(initial=0)).bit_length() for values in (context, last)]
    if sum(bits) > 64:
        context, last = (np.unique(values, return_inverse=True)[1].astype(np.uint64) for values in (context, last))
        bits = [int(values.max(initial=0)).bit_length() for values in (context, last)]
    return context << np.uint64(bits[1]) | last


def _gram_table(requests: DataFrame, path: str, level: int, spread: Spread, model: Model) -> DataFrame:
    """The requests of each bucket merged: a row with its n-grams by context, and the places of those each block asked.

    Of contexts it has the size and the count; the number only of those that other buckets share, and
    what the words seen after it have at the order below only where that is used, see `_used`.
    """
    names = ["bucket", *TABLE, "blocks", "block_ends", "asked"]
    schema = "bucket bigint, " + ", ".join(f"{name} binary" for name in names[1:])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = _joined(rows, "sizes").astype(np.int64)
        contexts = np.concatenate([unpack(data, True) for data in rows["contexts"]])
        context, total, base = (np.repeat(values, sizes) for values in (contexts, _joined(rows, "totals"), _joined(rows, "bases")))
        counted = [unpack(data) for data in rows["counts"]]
        lengths = [len(one) for one in counted]
        order, edges = _grouped(_keys(context, _joined(rows, "words")))
        first = order[edges[:-1]]
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(first)), np.diff(edges))
        counts = np.add.reduceat(np.concatenate(counted)[order], edges[:-1]).astype(np.int64)
        below = np.maximum.reduceat(_joined(rows, "below")[order], edges[:-1]).astype(np.int64)
        begin = cuts(context[first])
        totals = total[first[begin[:-1]]]
        lower = np.where(counts > 0, model.below(level, below, base[first].astype(np.int64)), 0.0)
        used, split = _used(counts, begin[:-1], totals, spread)
        # A block's places rise; a step for each block lets them rise over all.
        asked = at + np.repeat(np.arange(len(rows)) * len(counts), lengths)
        row = (
            key[0], pack(context[first[begin[:-1][split]]], True), pack(np.diff(begin)), pack(totals), pack(counts),
            np.add.reduceat(lower, begin[:-1])[used].tobytes(), rows["block"].to_numpy(np.int64).tobytes(),
            pack(np.cumsum(lengths), True), pack(asked, True),
        )
        return pd.DataFrame([row], columns=names)

    return _staged(requests.groupBy("bucket").applyInPandas(merge, schema), path)


def _used(counts: np.ndarray, begin: np.ndarray, totals: np.ndarray, spread: Spread) -> tuple[np.ndarray, np.ndarray]:
    """Contexts whose weight matters, as an n-gram asked of them is unseen or other buckets have their rest; the latter."""
    split = spread.parts(totals.astype(np.int64)) > 1
    return split | np.logical_or.reduceat(counts == 0, begin), split


def _context_sums(row: dict, discounts: Discounts, spread: Spread) -> tuple[np.ndarray, ...]:
    """Counts of a bucket's n-grams; of contexts where they begin, the count, the discounted sum, and of the words
    seen after each the sum at the order below (0 if unused); which contexts are split."""
    counts, totals = unpack(row["counts"]).astype(np.int64), unpack(row["totals"]).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(unpack(row["sizes"]).astype(np.int64))[:-1]))
    used, split = _used(counts, begin, totals, spread)
    below = np.zeros(len(begin))
    below[used] = np.frombuffer(row["below"], np.float64)
    return counts, begin, totals, np.add.reduceat(discounts.mass(counts), begin), below, np.flatnonzero(split)


def _split_contexts(table: DataFrame, discounts: Discounts, spread: Spread, path: str) -> DataFrame:
    """(bucket, split): per bucket the sums of the contexts that it shares with others."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("bucket", pa.int64()), ("context", pa.int64()), ("mass", pa.float64()), ("lower", pa.float64())]
        for batch in batches:
            for row in batch.to_pylist():
                contexts = unpack(row["contexts"], True).tolist()
                if contexts:
                    *_, mass, below, split = _context_sums(row, discounts, spread)
                    yield _table([(row["bucket"], one, mass[i], below[i]) for one, i in zip(contexts, split)], fields)

    rows = table.select("bucket", *TABLE).mapInArrow(sums, "bucket bigint, context bigint, mass double, lower double")
    whole = rows.groupBy("context").agg(
        F.sum("mass").alias("mass"), F.sum("lower").alias("lower"), F.collect_list("bucket").alias("buckets")
    )
    whole = whole.select(F.explode("buckets").alias("bucket"), F.struct("context", "mass", "lower").alias("split"))
    return _staged(whole.groupBy("bucket").agg(F.collect_list("split").alias("split")), path)


def _answers(table: DataFrame, split: DataFrame, discounts: Discounts, level: int, spread: Spread, last: bool) -> DataFrame:
    """What blocks asked: numbers (of the n-grams that training has) and counts, whether their context gets one
    token more, and the weights of the contexts of those that training lacks."""
    fields = list(zip(ANSWERS, (pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts, begin, total, mass, below, places = _context_sums(row, discounts, spread)
                shared = {one["context"]: one for one in row["split"] or ()}
                for context, i in zip(unpack(row["contexts"], True).tolist(), places):
                    mass[i], below[i] = shared[context]["mass"], shared[context]["lower"]
                # A context that loses nothing by discounts gets one token more, for what it lacks.
                extra = mass >= total
                weight = (1 - mass / (total + extra)) / (1 - below)
                of = np.repeat(np.arange(len(total)), np.diff(np.append(begin, len(counts))))
                number = np.zeros(len(counts), np.int64)
                if not last:
                    number[np.argsort(-counts, kind="stable")] = np.arange(1, len(counts) + 1)
                    number[counts == 0] = 0
                asked = unpack(row["asked"], True).astype(np.int64)
                ends = unpack(row["block_ends"], True).astype(np.int64)
                found = []
                for i, block in enumerate(np.frombuffer(row["blocks"], np.int64).tolist()):
                    mine = asked[ends[i - 1] if i else 0 : ends[i]] - i * len(counts)
                    found.append(
                        (
                            level, row["bucket"], block, None if last else pack(number[mine]), pack(counts[mine]),
                            pack(extra[of[mine]]), pack_floats(weight[of[mine[counts[mine] == 0]]]),
                        )
                    )
                yield _table(found, fields)

    rows = table.join(broadcast_if_small(split), "bucket", "left")
    return rows.select(*table.columns, "split").mapInArrow(answer, ANSWER_SCHEMA)


def katz_scores(
    docs: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block_tokens: int = BLOCK_TOKENS,
    bucket_grams: int = BUCKET_GRAMS,
    context_uses: int = CONTEXT_USES,
) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score): a row per input row.

    `train` says which documents teach the model, `order` how long its n-grams are. Tokens are the
    text's words, A-Z lower-cased, and one end; the start is the context of the first token, and no
    context goes back beyond it. score is the log10 probability of the text. A token whose n-gram
    training has gets the discounted share of its context; any other the probability after a
    context one token shorter, weighted so that every context's probabilities sum to one; a context
    that training lacks passes the shorter one's probability on. Unigrams are discounted for the
    unknown word. base_score adds a half to every unigram count instead. n_known counts tokens seen
    in training.

    Counts cover all training documents, and all texts are scored whole. Words are told apart by
    64 hash bits. Null and empty texts are the end alone. Ids are whole numbers or null; rows
    that share an id are scored each. Without training documents every token is the unknown
    word, of probability one. An empty table gives an empty result; other columns are not read.

    Every distinct n-gram of a block is sent once an order. A context that comes more than
    `context_uses` times is split over buckets by word, and its sums are added up afterwards.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "katz")
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"), filled(text).alias("_text"), F.coalesce(train, F.lit(False)).alias("_train")
    )
    blocks = bucketed(_blocks(rows, block_tokens), f"{folder}/blocks")
    size = lambda column: F.coalesce(F.sum(column), F.lit(0))
    n_words, n_tokens = blocks.agg(size("n_words"), size("n_tokens")).first()
    # A block has no more distinct n-grams than tokens.
    spread = Spread(1 + n_words // BUCKET_WORDS, 1 + n_tokens // bucket_grams, context_uses)
    words = _word_counts(blocks, spread.words, folder)
    distinct, tokens, *n = _spectrum(words.where("block < 0"), "counts")
    unigrams = _unigrams(words.where("block < 0"), tokens, distinct, Discounts.of([0, *n]))
    model = Model(unigrams, {})
    none = "CAST(NULL AS BINARY)"
    answers = words.where("block >= 0").selectExpr("1 AS level", "*", f"{none} AS extras", f"{none} AS weights")
    for level in range(2, order + 1):
        path, known = f"{folder}/grams-{level}", f"{folder}/answers-{level}"
        table = _gram_table(_requests(blocks, answers, level, spread, model), path, level, spread, model)
        _, _, *n = _spectrum(table, "counts")
        discounts = Discounts.of([0, *n])
        split = _split_contexts(table, discounts, spread, f"{folder}/split-{level}")
        said = _answers(table, split, discounts, level, spread, level == order)
        model = Model(unigrams, {**model.discounts, level: discounts})
        answers = answers.unionByName(said)
        if level < order:
            # Dealt out by block once: the next order reads them where its blocks are.
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            with setting(spark, CLEANUP, "true"):
                answers = bucketed(answers.repartition(buckets, "block"), known)
            for done in (path, f"{folder}/words" if level == 2 else f"{folder}/answers-{level - 1}"):
                delete_path(spark, done)
    schema = f"`{doc_id}` bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint"
    schema += ", base_score double, score double"

    def add_up(key: tuple, mine: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        row = mine.iloc[0]
        block = _Block(row, said, spread, model, order)
        doc = np.repeat(np.arange(len(block.ends)), block.lengths)
        sums = lambda weights: np.bincount(doc, weights, len(block.ends))
        flags = unpack(row["flags"])
        ids = pd.array(np.frombuffer(row["ids"], np.int64), "Int64")
        ids[(flags & np.uint64(2)) > 0] = pd.NA
        return pd.DataFrame(
            {
                doc_id: ids,
                "train": (flags & np.uint64(1)) > 0,
                "n_tokens": block.lengths,
                "n_known": sums(block.known[block.tokens] > 0).astype(np.int64),
                "train_tokens": tokens,
                "base_score": sums(unigrams.base(block.known)[block.tokens]),
                "score": sums(np.log10(block.likely)),
            }
        )

    left = blocks.select("block", "ids", "flags", "ends", "tokens", "words").groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInPandas(add_up, schema)


def _unigrams(table: DataFrame, tokens: int, distinct: int, discounts: Discounts) -> Unigrams:
    """The word model; what discounts leave is summed over the whole table."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [float(discounts.mass(unpack(one.as_py()).astype(np.int64)).sum()) for batch in batches for one in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([sum(sums)], pa.float64())], names=["kept"])

    total = table.select("counts").mapInArrow(kept, "kept double").agg(F.coalesce(F.sum("kept"), F.lit(0.0))).first()[0]
    return Unigrams(tokens, distinct, discounts, total)
