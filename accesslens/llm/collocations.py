"""Phrase collocations: pairs of frequency-ranked ids counted in tiles, frequent pairs ranked again.

Words get ids by falling frequency. A pair of ids is an address in a square that is cut into tiles by
strips of equal mass: the strips of frequent ids are narrow, so their tiles are small squares that are
nearly full and are counted by `bincount`; those of rare ids are wide and nearly empty, and are sorted
coordinates with counts. Frequent pairs are ranked like words, and a pair's id and the word after it
make the triples, and so on.

Texts are tokenized once, into blocks that stay where they are. What moves is a block's distinct words
and, for each tile, its distinct addresses with their counts, as small byte strings.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.packed import bucketed, cuts, pack, unpack
from accesslens.llm.text import filled
from accesslens.session import broadcast_if_small, scratch_path, stage

MOST_WORDS = 3
LEAST_COUNT = 10
TOP = 2000
SCORE_UNIT = 1_000_000
UNKNOWN_LANG = "und"

# Tokens of a block (and characters that are split at a time), and of all blocks of a task that are not finished.
BLOCK_TOKENS = 1 << 20
OPEN_TOKENS = 4 << 20
# Pairs that a tile is made for, tiles along a side, and the largest tile that is counted densely.
TILE_PAIRS = 1 << 22
STRIPS = 64
DENSE = 1 << 20
# Rows of a tile that are added up in one group.
FAN_IN = 64
# Ids that are numbered in one group.
CELL = 100_000

BREAK = b"\xff"
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
BLOCKS = "block bigint, lang string, tail int, words array<string>, counts array<bigint>, tokens binary"
TILES = "lang string, tile bigint, block bigint, addresses binary, counts binary"


def split_words(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased, with a `BREAK` for every sign that ends a piece."""
    return text.encode().lower().translate(_BREAKS).replace(BREAK, b" \xff ").split()


def _slices(text: str, size: int) -> Iterator[str]:
    """A text in parts of some `size` characters that end where a word does."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in " \t.,;:!?\n\x0b\x0c\r":
            end += 1
        yield text[at:end]
        at = end


class _Block:
    """Tokens of one language in one task, by numbers of its own; 0 ends a piece."""

    def __init__(self):
        self.words: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.words[BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, block: int, lang: str, following: list[bytes]) -> tuple:
        """`following`: the words after the block in the same text, which its last phrases end with."""
        counts = np.bincount(np.concatenate(self.parts), minlength=len(self.words))
        self.add(following)
        counts = np.concatenate((counts, np.zeros(len(self.words) - len(counts), np.int64)))
        words = [word.decode() for word in self.words if word != BREAK]
        return block, lang, len(following), words, counts[1:], pack(np.concatenate(self.parts))


def _blocks(docs: DataFrame, most_words: int, block_tokens: int) -> DataFrame:
    """Rows of BLOCKS out of (lang, text)."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = map((TaskContext.get().partitionId() << 32).__add__, count())
        held: dict[str, _Block] = {}
        rows: list[tuple] = []

        def finish(lang: str, following: list[bytes]) -> None:
            rows.append(held.pop(lang).row(next(numbers), lang, following))

        def shown() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            names = [part.split()[0] for part in BLOCKS.split(", ")]
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _slices(text.as_py(), block_tokens):
                    words = split_words(part)
                    if lang in held and held[lang].size >= block_tokens:
                        finish(lang, words[: most_words - 1])
                    held.setdefault(lang, _Block()).add(words)
                    if rows:
                        yield shown()
                if lang not in held:
                    continue
                held[lang].add([BREAK])
                if held[lang].size >= block_tokens:
                    finish(lang, [])
                elif sum(block.size for block in held.values()) >= max(OPEN_TOKENS, block_tokens):
                    finish(max(held, key=lambda one: held[one].size), [])
            if rows:
                yield shown()
        for lang in list(held):
            finish(lang, [])
        if rows:
            yield shown()

    return docs.mapInArrow(tokenize, BLOCKS)


def _ranked(found: DataFrame, keys: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """(lang, *keys, f, id) with ids by falling `f`, dense from 0 in each language; and their strips.

    Places of equal counts are dealt out in cells of bounded size; what is added up over all of a
    language is the histogram of counts, not its words. Strips: (lang, bounds), the first id of each
    strip and the end.
    """
    spark = found.sparkSession
    found = stage(found, f"{path}/counts", spark)
    cells = 1 + found.count() // CELL
    celled = found.withColumn("cell", F.pmod(F.xxhash64(*keys), F.lit(cells)))
    sized = celled.groupBy("lang", "f", "cell").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("lang").orderBy(F.desc("f"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    mass = F.sum(F.col("size") * F.col("f"))
    sized = sized.select(
        "lang", "f", "cell",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("places"),
        F.coalesce(mass.over(before), F.lit(0)).alias("mass"),
        mass.over(Window.partitionBy("lang")).alias("total"),
    )
    nth = F.row_number().over(Window.partitionBy("lang", "f", "cell").orderBy(*keys)) - 1
    strips = F.least(F.lit(STRIPS), F.ceil(F.sqrt(F.col("total") / TILE_PAIRS)))
    strip = F.floor((F.col("mass") + F.col("nth") * F.col("f")) / F.col("total") * strips).cast("int")
    placed = celled.withColumn("nth", nth).join(broadcast_if_small(stage(sized, f"{path}/sizes", spark)), ["lang", "f", "cell"])
    placed = placed.select("lang", *keys, "f", (F.col("places") + F.col("nth")).alias("id"), strip.alias("strip"))
    placed = stage(placed, f"{path}/ranked", spark)
    firsts = placed.groupBy("lang", "strip").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    bounds = F.array_append(F.array_sort(F.collect_list("first")), F.max("last") + 1)
    return placed.drop("strip"), stage(firsts.groupBy("lang").agg(bounds.alias("bounds")), f"{path}/strips", spark)


def _in_tiles(left: np.ndarray, right: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tile and address in it of each pair of ids; `rows` and `columns` are the bounds of the strips."""
    i = np.searchsorted(rows, left, "right") - 1
    j = np.searchsorted(columns, right, "right") - 1
    width = columns[j + 1] - columns[j]
    return i * (len(columns) - 1) + j, (left - rows[i]) * width + right - columns[j]


def _area(tile: int, rows: np.ndarray, columns: np.ndarray) -> int:
    i, j = divmod(tile, len(columns) - 1)
    return int((rows[i + 1] - rows[i]) * (columns[j + 1] - columns[j]))


def _counted(addresses: np.ndarray, counts: np.ndarray | None, area: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct addresses in order, and their counts: a full tile directly, an empty one by sorting."""
    if area <= DENSE and area <= 16 * len(addresses):
        # Sums of whole numbers below 2^53 are exact in doubles, which `bincount` uses for weights.
        cells = np.bincount(addresses, counts, area).astype(np.int64)
        found = np.flatnonzero(cells)
        return found, cells[found]
    order = np.argsort(addresses, kind="stable")
    addresses = addresses[order]
    counts = np.ones(len(order), np.int64) if counts is None else counts[order]
    ends = cuts(addresses)
    return addresses[ends[:-1]], np.add.reduceat(counts, ends[:-1]) if len(order) else counts


class _Phrases:
    """A block's words, and which phrase of the words so far begins at each token (or -1)."""

    def __init__(self, row: dict, levels: int):
        local = unpack(row["tokens"]).astype(np.int64)
        ids = np.full(row["n_words"] + 1, -1, np.int64)
        ids[row["locals"]] = row["ids"]
        self.words = ids[local]
        self.own = len(local) - row["tail"]
        self.columns = np.array(row["bounds_1"], np.int64)
        self.phrases, self.rows = self.words, self.columns
        for level in range(2, levels + 1):
            at, tile, address = self._positions(level)
            longer = np.full(len(local), -1, np.int64)
            for known in row[f"phrases_{level}"] or []:
                here = tile == known["tile"]
                addresses, numbers = unpack(known["addresses"], True).astype(np.int64), unpack(known["ids"]).astype(np.int64)
                place = np.minimum(np.searchsorted(addresses, address[here]), len(addresses) - 1)
                longer[at[here]] = np.where(addresses[place] == address[here], numbers[place], -1)
            self.phrases, self.rows = longer, np.array(row[f"bounds_{level}"] or [], np.int64)

    def _positions(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens at which a phrase of so many words may begin, with its tile and address.

        Both the phrase without its last word and the one without its first have to be frequent.
        """
        n = len(self.words) - words + 1
        left, right = self.phrases[: max(n, 0)], self.words[words - 1 :]
        good = (left >= 0) & (right >= 0)
        if words > 2:
            good &= self.phrases[1 : n + 1] >= 0
        at = np.flatnonzero(good)
        return at, *_in_tiles(left[at], right[at], self.rows, self.columns)

    def tiles(self, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(tile, addresses, counts) of the phrases of so many words that begin in the block itself."""
        at, tile, address = self._positions(words)
        tile, address = tile[at < self.own], address[at < self.own]
        order = np.argsort(tile, kind="stable")
        tile, address = tile[order], address[order]
        ends = cuts(tile)
        for a, b in zip(ends[:-1], ends[1:]):
            yield int(tile[a]), *_counted(address[a:b], None, _area(int(tile[a]), self.rows, self.columns))


def _count_blocks(known: DataFrame, words: int) -> DataFrame:
    """Rows of TILES: what each block has of phrases of so many words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = list(_Phrases(row, words - 1).tiles(words))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([row["lang"]] * len(found), pa.string()),
                        "tile": pa.array([tile for tile, _, _ in found], pa.int64()),
                        "block": pa.array([row["block"]] * len(found), pa.int64()),
                        "addresses": pa.array([pack(addresses, True) for _, addresses, _ in found], pa.binary()),
                        "counts": pa.array([pack(counts) for _, _, counts in found], pa.binary()),
                    }
                )

    return known.mapInArrow(of, TILES)


def _merged(tiles: DataFrame, parts: int, rows: DataFrame, columns: DataFrame, least: int, path: str) -> DataFrame:
    """(lang, a, b, f): pairs of ids whose counts over all blocks add up to `least` or more.

    A tile's rows are added up `FAN_IN` at a time, in as many rounds as it takes, so no group grows
    with the number of blocks.
    """
    spark = tiles.sparkSession
    bounds = rows.withColumnRenamed("bounds", "_rows").join(columns.withColumnRenamed("bounds", "_columns"), "lang")
    tiles = tiles.select("lang", "tile", F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "addresses", "counts")
    tiles = tiles.join(broadcast_if_small(stage(bounds, f"{path}/bounds", spark)), "lang")

    def total(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        addresses = np.concatenate([unpack(one, True) for one in group["addresses"]]).astype(np.int64)
        counts = np.concatenate([unpack(one) for one in group["counts"]]).astype(np.int64)
        first = group.iloc[0]
        return _counted(addresses, counts, _area(int(first["tile"]), *(np.asarray(first[x], np.int64) for x in ("_rows", "_columns"))))

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        addresses, counts = total(group)
        first = group.iloc[0]
        return pd.DataFrame(
            {
                **{name: pd.Series([value], dtype=kind) for name, value, kind in zip(("lang", "tile", "part"), key, ("object", "int64", "int64"))},
                "addresses": [pack(addresses, True)],
                "counts": [pack(counts)],
                **{name: pd.Series([list(first[name])], dtype="object") for name in ("_rows", "_columns")},
            }
        )

    def frequent(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        addresses, counts = total(group)
        addresses, counts = addresses[counts >= least], counts[counts >= least]
        tile = int(key[1])
        over, under = (np.asarray(group.iloc[0][x], np.int64) for x in ("_rows", "_columns"))
        i, j = divmod(tile, len(under) - 1)
        width = max(1, int(under[j + 1] - under[j]))
        found = {"a": over[i] + addresses // width, "b": under[j] + addresses % width, "f": counts}
        lang = pd.Series([key[0]] * len(counts), dtype="object")
        return pd.DataFrame({"lang": lang, "tile": tile, "address": addresses, **found})

    while parts > 1:
        order = ["lang", "tile", "part", "addresses", "counts", "_rows", "_columns"]
        tiles = tiles.select(*order)
        tiles = tiles.groupBy("lang", "tile", "part").applyInPandas(add, tiles.schema)
        parts = -(-parts // FAN_IN)
        tiles = stage(tiles.withColumn("part", F.pmod("part", F.lit(parts))), f"{path}/parts-{parts}", spark)
    return tiles.groupBy("lang", "tile").applyInPandas(
        frequent, "lang string, tile bigint, address bigint, a bigint, b bigint, f bigint"
    )


def _known_to_blocks(tiles: DataFrame, phrases: DataFrame, parts: int, level: int) -> DataFrame:
    """(block, phrases_level): the frequent phrases that a block has, with their ids, by tile.

    A tile's frequent addresses meet its rows of many blocks at a time, once for each part.
    """
    part = F.pmod(F.xxhash64("block"), F.lit(parts))
    rows = tiles.select("lang", "tile", part.alias("part"), "block", "addresses")
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    lists = phrases.select("lang", "tile", F.explode(every).alias("part"), "address", "id")

    def find(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(known["address"].to_numpy())
        wanted, ids = known["address"].to_numpy()[order], known["id"].to_numpy()[order]
        found = []
        for tile, block, addresses in zip(rows["tile"], rows["block"], rows["addresses"] if len(wanted) else ()):
            have = unpack(addresses, True).astype(np.int64)
            place = np.minimum(np.searchsorted(wanted, have), len(wanted) - 1)
            hit = wanted[place] == have
            if hit.any():
                found.append((block, tile, pack(have[hit], True), pack(ids[place[hit]])))
        return pd.DataFrame(found, columns=["block", "tile", "addresses", "ids"])

    keys = ["lang", "tile", "part"]
    found = rows.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInPandas(
        find, "block bigint, tile bigint, addresses binary, ids binary"
    )
    listed = F.collect_list(F.struct("tile", "addresses", "ids")).alias(f"phrases_{level}")
    return found.groupBy("block").agg(listed)


def _exact(number: str) -> Column:
    return F.col(number).cast("decimal(16,0)")


def _scored(phrases: DataFrame, tables: dict[int, DataFrame], words: int) -> DataFrame:
    """Candidates of so many words with `l`, `r` and `score` of their lowest cut, ties to the first."""
    names = [f"w{i}" for i in range(1, words + 1)]
    cut = phrases.select("lang", *names, F.col("f").alias("a"))
    for k in range(1, words):
        for side, part in (("l", names[:k]), ("r", names[k:])):
            known = tables[len(part)]
            renamed = {f"w{i}": name for i, name in enumerate(part, 1)}
            known = known.select("lang", *(F.col(w).alias(name) for w, name in renamed.items()), F.col("f").alias(f"{side}{k}"))
            cut = cut.join(known, ["lang", *part])
    cuts_of = []
    for k in range(1, words):
        product = _exact("a") * _exact("a") * F.lit(SCORE_UNIT).cast("decimal(7,0)")
        score = F.call_function("div", product, _exact(f"l{k}") * _exact(f"r{k}"))
        cuts_of.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = cuts_of[0] if len(cuts_of) == 1 else F.least(*cuts_of)
    return cut.withColumn("_lowest", lowest).select("lang", *names, "a", "_lowest.l", "_lowest.r", "_lowest.score")


def _not_inside(candidates: DataFrame, longer: DataFrame, words: int) -> DataFrame:
    """Candidates that no phrase of one word more holds at least half the time.

    A still longer phrase is no more frequent than the one between, which is a candidate then too.
    """
    names = [f"w{i}" for i in range(1, words + 1)]
    ends = [longer.select("lang", *(F.col(f"w{i + after}").alias(name) for i, name in enumerate(names, 1)), "f") for after in (0, 1)]
    most = ends[0].unionByName(ends[1]).groupBy("lang", *names).agg(F.max("f").alias("_longer"))
    return candidates.join(most, ["lang", *names], "left").where("_longer IS NULL OR 100 * _longer < 50 * a").drop("_longer")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    most_words: int = MOST_WORDS,
    least: int = LEAST_COUNT,
    top: int = TOP,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `most_words` words.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at
    blanks and tabs. `a` counts a phrase within pieces, overlaps included, and is at least `least`; `l`
    and `r` count the two parts of the cut that scores lowest (the first of equal ones), `n` all words of
    the language, and score is a million times a a / (l r), rounded down, in whole numbers. A phrase
    goes that stands inside a longer one at least half the time. Ranks go by score, `a`, and phrase.

    A null language is `und`; null and empty texts have no words. Repeated rows and rows of one id all
    count. Columns but the two are not read, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "collocations")
    read = docs.select(F.coalesce(lang, F.lit(UNKNOWN_LANG)).alias("lang"), filled(text).alias("text"))
    blocks = bucketed(_blocks(read, most_words, block_tokens), f"{folder}/blocks")
    parts = max(1, -(-blocks.count() // FAN_IN))

    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "word"))
    listed = listed.select("block", "lang", (F.col("local") + 1).alias("local"), F.col("word.words").alias("word"), "word.counts")
    totals = stage(listed.groupBy("lang", "word").agg(F.sum("counts").alias("f")), f"{folder}/totals", spark)
    vocabulary, strips = _ranked(totals.where(F.col("f") >= least), ["word"], f"{folder}/words")
    bounds = {1: strips}
    tables = {1: vocabulary.select("lang", F.col("id").alias("w1"), "f")}
    ids = listed.join(vocabulary, ["lang", "word"]).groupBy("block").agg(F.collect_list(F.struct("local", "id")).alias("ids"))
    ids = ids.select("block", F.col("ids.local").alias("locals"), F.col("ids.id").alias("ids"))
    known = blocks.select("block", "lang", "tail", F.size("words").alias("n_words"), "tokens").join(ids, "block")
    known = known.join(strips.withColumnRenamed("bounds", "bounds_1"), "lang")
    names: dict[int, list[str]] = {1: ["w1"]}
    for words in range(2, most_words + 1):
        here = f"{folder}/phrases-{words}"
        names[words] = [f"w{i}" for i in range(1, words + 1)]
        tiles = stage(_count_blocks(known, words), f"{here}/tiles", spark)
        found = _merged(tiles, parts, bounds[words - 1], bounds[1], least, here)
        ranked, bounds[words] = _ranked(found, ["tile", "address", "a", "b"], here)
        if words == 2:
            spelt = ranked.withColumnsRenamed({"a": "w1", "b": "w2"})
        else:
            # `a` is the number of the phrase without its last word.
            shorter = numbered.select("lang", F.col("id").alias("a"), *names[words - 1])
            spelt = ranked.join(shorter, ["lang", "a"]).withColumnRenamed("b", f"w{words}")
        numbered = stage(spelt.select("lang", "id", *names[words], "f"), f"{here}/spelt", spark)
        tables[words] = numbered.drop("id")
        if words < most_words:
            known = known.join(_known_to_blocks(tiles, ranked, parts, words), "block", "left")
            known = known.join(bounds[words].withColumnRenamed("bounds", f"bounds_{words}"), "lang", "left")

    candidates = None
    for words in range(2, most_words + 1):
        scored = _scored(tables[words], tables, words)
        if words < most_words:
            scored = _not_inside(scored, tables[words + 1], words)
        scored = scored.select("lang", F.array(*names[words]).alias("words"), "a", "l", "r", "score")
        candidates = scored if candidates is None else candidates.unionByName(scored)
    # The best of every cell first, so that no task sorts a language; ties stay until phrases are spelt.
    cell = F.pmod(F.xxhash64("words"), F.lit(STRIPS))
    for share in (["lang", cell], ["lang"]):
        place = F.rank().over(Window.partitionBy(*share).orderBy(F.desc("score"), F.desc("a")))
        candidates = candidates.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")
    best = stage(candidates, f"{folder}/best", spark)
    each = best.select("*", F.posexplode("words").alias("_at", "id"))
    spelt = vocabulary.select("lang", "id", "word").join(broadcast_if_small(each), ["lang", "id"])
    spelt = spelt.groupBy("lang", "words", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_spelt"))
    spelt = spelt.withColumn("phrase", F.array_join(F.col("_spelt.word"), " "))
    sums = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = spelt.join(sums, "lang").withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
