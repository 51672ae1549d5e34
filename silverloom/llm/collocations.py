"""Phrase collocations by direct-address tiles.

Words are ranked by frequency over the corpus, so that a word's id is its rank and frequent words have small ids. A pair of
neighbours is a cell (left id, right id) of a table that is split into tiles of ``TILE`` x ``TILE`` ids; a tile's cells are
dealt over ``STRIPES`` stripes, so that the tile of the most frequent words is no task's alone. A task counts the cells of
its texts, and after one shuffle each stripe is added up: into a dense array by ``numpy.bincount`` where it is well filled,
else as sorted coordinates (COO). Pairs that reach ``least`` are then ranked by frequency themselves and become the left
ids of the next round, whose cells are phrases of three words, and so on up to ``longest``. A phrase can only be frequent
if its first and its last part are, so ids are kept for frequent words and phrases alone and nothing is lost.

Ids are held by every task, so their number is bounded: ``head`` words and phrases of each length, the most frequent. If
more are frequent, phrases that hold one of the others are counted under their own names by an ordinary grouping, so that
the result is whole at every size. A sieve (one bit for the hash of each frequent word or phrase of a length) keeps what
cannot be frequent out of that grouping.

Cases: a null text counts as empty, a null language as ``und`` (as does the language of that name). Rows that repeat count
each time. An empty table, and one without frequent phrases, give an empty result. Ids are not read, and further columns
are ignored. Counts are exact to 15 digits; scores are computed in decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import broadcast_if_small, join_counted, materialize, whole_texts

#: Bits of a side of a tile, and of the number of stripes that its cells are dealt over.
TILE, STRIPES = 10, 6
#: Words, and phrases of each longer length, that have ids.
HEAD_WORDS, HEAD_PHRASES = 1 << 19, 1 << 21
#: Bits of the sieve of frequent words or phrases of one length, which is made where not all of them have ids.
SIEVE = 27
#: Joins the ids of a cell to one number.
SPREAD = 1_000_003
#: Counters and cells that a task holds before it hands them on.
HELD = 1 << 20
#: Rows that a task adds up at a time, and the filling from which a stripe is counted in a dense array.
GATHERED, DENSE = 1 << 18, 1 / 16
CELLS = 1 << (2 * TILE - STRIPES)

STOP = b"."
#: What ends a piece becomes a full stop, and a tab a space.
MARKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b".........\x20")


def sequence(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a ``STOP`` wherever a piece ends, and at the end."""
    marked = (text or "").encode("utf-8", "surrogatepass").lower().translate(MARKS)
    return (marked + STOP).replace(STOP, b" . ").split()


def by_language(batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    """The words of a batch, one sequence for each language."""
    for lang, texts in batch.groupby("lang", sort=False)["text"]:
        words: list[bytes] = []
        for text in texts:
            words += sequence(text)
        yield lang, words


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, words in by_language(batch):
            held.setdefault(lang, Counter()).update(words)
        if sum(map(len, held.values())) >= HELD:
            yield from _named(held)
            held = {}
    yield from _named(held)


def _named(held: dict[str, Counter]) -> Iterator[pd.DataFrame]:
    for lang, counts in held.items():
        counts.pop(STOP, None)
        names = list(counts)
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pd.DataFrame({"lang": lang, "phrase": [p.decode("utf-8", "surrogatepass") for p in part], "f": [counts[p] for p in part]})


@dataclass(frozen=True)
class Level:
    """Phrases of one length that have ids, by rank, as tasks need them: words by name, longer ones by their cell.

    ``whole`` says that every frequent phrase of the length is among them.
    """

    whole: bool
    words: dict[str, dict[bytes, int]] | None = None
    cells: np.ndarray | None = None
    ranks: np.ndarray | None = None
    sieve: np.ndarray | None = None

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """Whether hashes may be those of frequent words or phrases; without a sieve those without ids are not."""
        if self.sieve is None:
            return np.zeros(len(hashes), dtype=bool)
        places = hashes & ((1 << SIEVE) - 1)
        return (self.sieve[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1

    def ids(self, cells: np.ndarray) -> np.ndarray:
        """The ids of cells, -1 where a cell has none."""
        if not len(self.cells):
            return np.full(len(cells), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        return np.where(self.cells[at] == cells, self.ranks[at], -1)

    def cells_of(self, ids: np.ndarray) -> np.ndarray:
        by_rank = np.empty(len(self.cells), dtype=np.int64)
        by_rank[self.ranks] = self.cells
        return by_rank[ids]

    def names(self) -> tuple[list[str], list[bytes]]:
        """Language and name of each word by id."""
        named = sorted((i, lang, name) for lang, of in self.words.items() for name, i in of.items())
        return [lang for _, lang, _ in named], [name for *_, name in named]


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return whole_texts(docs.where(F.col(text_col).isNotNull()).select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")))


def head_of(frequent: DataFrame, head: int, *columns: str) -> tuple[pa.Table, bool]:
    """``columns`` and f of the most frequent rows, by rank, at most ``head``, cut at a power of two; whether that is all."""
    power = F.floor(F.log2("f")).cast("int")
    sizes = {r.power: r.n for r in frequent.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect()}
    kept, cut = 0, 64
    for p in sorted(sizes, reverse=True):
        if kept + sizes[p] > head:
            break
        kept, cut = kept + sizes[p], p
    found = frequent.where(power >= cut).select(*columns, "f").toArrow()
    return found.sort_by([("f", "descending"), *((c, "ascending") for c in columns)]), kept == sum(sizes.values())


def sieve_of(frequent: DataFrame, hashes: Column) -> np.ndarray:
    """The sieve of the rows of ``frequent``: 2 to the power of ``SIEVE`` bits, made in pieces of 4 KB by the grouping."""
    place = hashes.bitwiseAND(F.lit((1 << SIEVE) - 1)) + 1
    pieces = frequent.select(place.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"))
    out = np.zeros(1 << (SIEVE - 3), dtype=np.uint8)
    for row in pieces.collect():  # at most a row for each 4 KB
        out[(row.k - 1) << 12 : row.k << 12] = np.frombuffer(row.bits, dtype=np.uint8)
    return out


def name_hash(lang: str = "lang", phrase: str = "phrase") -> Column:
    return F.crc32(F.concat(F.col(lang), F.lit(" "), F.col(phrase)).cast("binary"))


def _named_passes(level: Level, lang: str, phrases: list[bytes]) -> np.ndarray:
    """Whether phrases may be frequent, by the hash of their names."""
    if level.sieve is None or not phrases:
        return np.zeros(len(phrases), dtype=bool)
    start = zlib.crc32(f"{lang} ".encode())
    return level.passes(np.fromiter((zlib.crc32(p, start) for p in phrases), dtype=np.int64, count=len(phrases)))


#: In place of an id: surely not frequent, meets a stop or the end, and perhaps frequent but without an id.
RARE, ENDS, UNNAMED = -1, -2, -3


def _phrase_ids(lang: str, words: list[bytes], levels: list[Level]) -> list[np.ndarray]:
    """ids[m][i]: the id of the phrase of m + 1 words at i, or what stands in place of one."""
    names = levels[0].words.get(lang, {}) | {STOP: ENDS}
    first = np.fromiter(map(names.get, words, repeat(RARE)), dtype=np.int64, count=len(words))
    rare = np.flatnonzero(first == RARE)
    first[rare[_named_passes(levels[0], lang, [words[i] for i in rare])]] = UNNAMED
    ids = [first]
    for m, level in enumerate(levels[1:], 1):
        right = first[m:]
        left = ids[-1][: len(right)]
        found = np.full(len(words), ENDS, dtype=np.int64)
        here = np.where((left == ENDS) | (right == ENDS), ENDS, RARE)
        known = np.flatnonzero((left >= 0) & (right >= 0))
        of_known = level.ids((left[known] << 32) | right[known])
        lost = of_known == RARE
        of_known[lost] = np.where(level.passes(left[known[lost]] * SPREAD + right[known[lost]]), UNNAMED, RARE)
        here[known] = of_known
        named = np.flatnonzero(((left == UNNAMED) & (right != RARE) & (right != ENDS)) | ((right == UNNAMED) & (left >= 0)))
        here[named[_named_passes(level, lang, [b" ".join(words[i : i + m + 1]) for i in named])]] = UNNAMED
        found[: len(right)] = here
        ids.append(found)
    return ids


def cell_counter(levels: Broadcast):
    """Counts of cells (key of a stripe, cell, n) of the phrases one word longer than the last of ``levels``, and of names.

    Phrases that hold a word or part without an id, which may yet be frequent, are counted by name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[Level] = levels.value
        m = len(known)
        cells, named, held = [], {}, 0
        for batch in batches:
            for lang, words in by_language(batch.to_pandas()):
                ids = _phrase_ids(lang, words, known)
                n = len(words) - m
                if n <= 0:
                    continue
                left, rest, right = ids[-1][:n], ids[-1][1 : n + 1], ids[0][m : m + n]
                frequent = np.ones(n, dtype=bool)
                for part in (left, rest, right):
                    frequent &= (part != RARE) & (part != ENDS)
                direct = frequent & (left >= 0) & (right >= 0)
                cells.append((left[direct] << 32) | right[direct])
                held += len(cells[-1])
                for at in np.flatnonzero(frequent & ~direct):
                    counts = named.setdefault(lang, Counter())
                    counts[b" ".join(words[at : at + m + 1])] += 1
            if held >= HELD or sum(map(len, named.values())) >= HELD:
                yield from _handed_on(cells, named)
                cells, named, held = [], {}, 0
        yield from _handed_on(cells, named)

    return run


def _summed(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates: equal codes meet and their counts are added."""
    if not len(code):
        return code, count
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[starts], np.add.reduceat(count, starts)


CELL_COLUMNS = pa.schema([("key", pa.int64()), ("cell", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _handed_on(cells: list[np.ndarray], named: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    if cells:
        code, count = np.unique(np.concatenate(cells), return_counts=True)
        left, right = code >> 32, code & 0xFFFFFFFF
        tile = ((left >> TILE) << 32) | (right >> TILE)
        place = ((left & ((1 << TILE) - 1)) << TILE) | (right & ((1 << TILE) - 1))
        key, cell = (tile << STRIPES) | (place & ((1 << STRIPES) - 1)), (place >> STRIPES).astype(np.int32)
        for at in range(0, len(code), 100_000):
            part = slice(at, at + 100_000)
            none = pa.nulls(len(code[part]), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(cell[part]), none, none, pa.array(count[part])], schema=CELL_COLUMNS)
    for part in _named(named):
        none = [pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int32())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(part["lang"], pa.string()), pa.array(part["phrase"], pa.string()), pa.array(part["f"], pa.int64())], schema=CELL_COLUMNS)


FOUND_COLUMNS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()), ("left", pa.int64()), ("right", pa.int64())])


def stripe_adder(least: int, levels: Broadcast):
    """Adds up rows (key, cell, n) that come sorted by key, and names the cells that reach ``least``."""

    def add(key: np.ndarray, cell: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        full = sizes >= DENSE * CELLS
        keys, cells, sums = [], [], []
        for start, size in zip(starts[full], sizes[full], strict=True):
            part = slice(start, start + size)
            counts = np.bincount(cell[part], weights=n[part].astype(np.float64), minlength=CELLS) if n[part].sum() < 2**53 else None
            if counts is None:  # beyond what a double holds exactly
                c, s = _summed(cell[part], n[part])
            else:
                c = np.flatnonzero(counts)
                s = counts[c].astype(np.int64)
            keys.append(np.full(len(c), key[start]))
            cells.append(c)
            sums.append(s)
        thin = np.repeat(~full, sizes)
        key, cell, n = key[thin], cell[thin], n[thin]
        order = np.lexsort((cell, key))
        key, cell, n = key[order], cell[order], n[order]
        if len(key):
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
            keys.append(key[starts])
            cells.append(cell[starts])
            sums.append(np.add.reduceat(n, starts))
        return np.concatenate(keys), np.concatenate(cells), np.concatenate(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[Level] = levels.value
        langs, names = known[0].names()

        def found(key: np.ndarray, cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            keep = n >= least
            key, cell, n = key[keep], cell[keep].astype(np.int64), n[keep]
            place, tile = (cell << STRIPES) | (key & ((1 << STRIPES) - 1)), key >> STRIPES
            left, right = ((tile >> 32) << TILE) | (place >> TILE), ((tile & 0xFFFFFFFF) << TILE) | (place & ((1 << TILE) - 1))
            words, rest = [right], left
            for level in reversed(known[1:]):
                cells = level.cells_of(rest)
                words, rest = [cells & 0xFFFFFFFF, *words], cells >> 32
            words = [rest, *words]
            spelt = [b" ".join(names[i] for i in ids).decode("utf-8", "surrogatepass") for ids in zip(*(w.tolist() for w in words), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([langs[i] for i in rest.tolist()], pa.string()), pa.array(spelt, pa.string()), pa.array(n), pa.array(left), pa.array(right)], schema=FOUND_COLUMNS)

        held, rows = [], 0
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("key", "cell", "n")))
            rows += len(held[-1][0])
            if rows >= GATHERED:
                key, cell, n = add(*(np.concatenate(c) for c in zip(*held, strict=True)))
                done = key != held[-1][0][-1]  # the rows of the last key may go on in the next batch
                yield found(key[done], cell[done], n[done])
                held = [(key[~done], cell[~done], n[~done])]
                rows = 0  # what stays is at most one stripe
        if held:
            yield found(*add(*(np.concatenate(c) for c in zip(*held, strict=True))))

    return run


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, head: tuple[int, int] = (HEAD_WORDS, HEAD_PHRASES), lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All frequent words and phrases (lang, phrase, size, f), and the words of each language (lang, n); both written."""
    sc = docs.sparkSession.sparkContext
    texts = _texts(docs, lang_col, text_col)
    words = materialize(texts.mapInPandas(_count_words, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    counted = [words.where(F.col("f") >= least).withColumn("size", F.lit(1))]
    top, whole = head_of(counted[0], head[0], "lang", "phrase")
    ids: dict[str, dict[bytes, int]] = {}
    for i, (lang, phrase) in enumerate(zip(top["lang"].to_pylist(), top["phrase"].to_pylist(), strict=True)):
        ids.setdefault(lang, {})[phrase.encode("utf-8", "surrogatepass")] = i
    levels = [Level(whole, words=ids, sieve=None if whole else sieve_of(counted[0], name_hash()))]
    for size in range(2, longest + 1):
        shared = sc.broadcast(levels)
        cells = texts.mapInArrow(cell_counter(shared), "key long, cell int, lang string, phrase string, n long")
        if not all(level.whole for level in levels):
            cells = materialize(cells, "cells")  # read twice, by cells and by names
        dealt = cells.where("key is not null").select("key", "cell", "n").repartition("key").sortWithinPartitions("key")
        found = dealt.mapInArrow(stripe_adder(least, shared), "lang string, phrase string, f long, left long, right long")
        if not all(level.whole for level in levels):
            named = cells.where("phrase is not null").groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
            found = found.unionByName(named, allowMissingColumns=True)
        found = materialize(found, "phrases")
        counted.append(found.select("lang", "phrase", "f").withColumn("size", F.lit(size)))
        if size < longest:
            top, whole = head_of(found.where("left is not null"), head[1], "left", "right")
            cell = (top["left"].to_numpy() << 32) | top["right"].to_numpy()
            order = np.argsort(cell)
            whole = whole and found.where("left is null").isEmpty()
            hashes = F.when(F.col("left").isNull(), name_hash()).otherwise(F.col("left") * SPREAD + F.col("right"))
            levels = [*levels, Level(whole, cells=cell[order], ranks=order.astype(np.int64), sieve=None if whole else sieve_of(found, hashes))]
    out = counted[0].select("lang", "phrase", "size", "f")
    for more in counted[1:]:
        out = out.unionByName(more.select("lang", "phrase", "size", "f"))
    return materialize(out, "frequent"), totals


def _part(first: int | Column, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exactly."""
    wide = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)}) as bigint)")


def scored(frequent: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its weakest cut: lang, phrase, size, a, l, r, score."""
    candidates = frequent.where("size > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
    cuts = candidates.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = materialize(cuts.select("lang", "phrase", "size", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")), "cuts")
    used = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).groupBy("lang", "phrase").agg(F.count("*").alias("n"))
    parts = materialize(frequent.select("lang", "phrase", "f").join(used, ["lang", "phrase"]), "parts")
    for column, name in (("first", "l"), ("rest", "r")):
        cuts = join_counted(cuts, parts.select("lang", F.col("phrase").alias(column), F.col("f").alias(name), "n"), ["lang", column])
    each = F.struct(score("a", "l", "r").alias("score"), "k", "l", "r")
    weakest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(each).alias("w"))
    return weakest.select("lang", "phrase", "size", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), F.col("w.score").alias("score"))


def contained(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the greatest count of a longer frequent phrase that holds each phrase of two words or more."""
    longer = frequent.where("size > 2").withColumn("words", F.split("phrase", " "))
    spans = longer.select("lang", "f", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    placed = spans.select("lang", "f", "words", "part", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("at"))
    return placed.groupBy("lang", _part(F.col("at"), F.col("part")).alias("phrase")).agg(F.max("f").alias("longer"))


def mine(docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000, head: tuple[int, int] = (HEAD_WORDS, HEAD_PHRASES), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase that a longer one holds is dropped if the longer one has at least ``percent`` of its occurrences.
    """
    frequent, totals = phrase_counts(docs, longest, least, head, lang_col, text_col)
    judged = scored(frequent).join(contained(frequent), ["lang", "phrase"], "left")
    kept = judged.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(broadcast_if_small(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
