"""Approximate nearest neighbours: a hash-prefix forest.

Every tree has a long hash of each vector: the signs of ``BITS`` random projections, a bit each. In each tree rows are
kept in the order of their hashes, so that all rows with an equal prefix of any length lie together. A query finds its
longest match in every tree by a binary search, then ascends in all trees at once, a bit at a time, from the longest
match of all: each level adds the rows that share so many bits with it in some tree. New candidates are scored, in
double precision, on the original vectors. The queries of a block ascend together: the rows that a level adds, for all
queries and trees, are one array.

A query ascends until rows as near as its ``k``-th best so far would have been met with a chance of ``TARGET``: two
vectors at an angle of a share a bit with a chance p = 1 - a / pi, so they share ``level`` bits in one of ``TREES``
trees with a chance 1 - (1 - p^level)^TREES. Near neighbours stop it at long prefixes, far ones let it ascend further,
and a query with fewer than ``k`` rows ascends to the empty prefix, which all rows share. Nothing is fitted or capped.

Nearness is the largest inner product. To make it an angle, vectors are divided by the largest norm of all and get one
more component that fills them up to the unit sphere, which queries lack.

The index is spread by the hashes themselves: a bucket is a range of the first tree's hashes, and one that holds very
many rows is split by a hash of the id. A bucket is written once, with the sorted arrays of its trees. The ascent has
three steps, and the ``k``-th best of one bounds the next: down to ``LONG`` bits in a query's own bucket, down to
``LONG`` bits in all others, and on from there, for the queries that have to. Queries go in blocks to the buckets where
some tree has rows of the prefix down to which they ascend, and to no other. A prefix is one row that lists its buckets
and its blocks, so a join has no more rows than there are prefixes, and one tree comes before all others, which are only
asked about blocks that do not go to every bucket by then. Each tile of a bucket and up to ``TILE_BLOCKS`` blocks is a
group of bounded size. On clustered vectors a block so meets few buckets, and few
queries take the last step; on independent directions every bucket has rows of every short prefix, and the work is
queries times rows.

Cases: vectors that are null, empty, all zero or hold null or non-finite components take no part, nor do null ids. A
query only meets vectors of its own dimension. Equal scores go to the smaller id. Repeated rows (an id with the same
vector) count once; an id with different vectors is ranked by its best one. Fewer candidates than ``k`` are all
returned. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import broadcast_if_small, materialize

TREES, BITS = 64, 128
#: The chance with which a row as near as the last of the ``k`` best is to be met.
TARGET = 0.9
BUCKET_ROWS, BLOCK_QUERIES = 4096, 2048
#: Blocks that a bucket meets in one task at most, so that its trees are sent once for all of them.
TILE_BLOCKS = 8
#: The bits that rows share with a query before it has met all buckets' rows of so long a prefix.
LONG = 12
#: Lengths of prefix by which blocks are sent to buckets: the longest that is no longer than a query's level.
ROUTES = (*range(9), 12, 16, 24, 32, 48)
SEED = 20
#: Levels to which an ascent goes in one step, up to ``LONG``; rows of the levels between are told apart by their hashes.
BANDS = (64, 48, 32, 24, 16)
#: Queries that ascend together, and rows of their trees that are looked at together (more, if one query has more).
TOGETHER, PLACES = 256, 1 << 18
#: The tree that is asked first where blocks go; the first tree orders the buckets, so its prefixes are in few of them.
SCOUT = 1


@lru_cache(maxsize=8)
def planes(dim: int) -> np.ndarray:
    """Normals of the random projections of all trees, for vectors with the added component."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim + 1, TREES * BITS), dtype=np.float32)


def hashes(vectors: np.ndarray, norm: float | None) -> np.ndarray:
    """(rows, TREES, bytes) hashes of rows, or with ``norm`` None of queries; the first projection is the highest bit."""
    if norm is None:
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        rest = np.zeros(len(unit))
    else:
        unit = vectors / norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
    out = np.empty((len(vectors), TREES, BITS // 8), dtype=np.uint8)
    for at in range(0, len(vectors), 256):
        part = np.column_stack([unit[at : at + 256], rest[at : at + 256]]).astype(np.float32)
        signs = part @ planes(vectors.shape[1]) > 0
        out[at : at + 256] = np.packbits(signs.reshape(-1, TREES, BITS), axis=2)
    return out


def from_bytes(values: pd.Series | list[bytes]) -> np.ndarray:
    """Hashes that were stored as one value of bytes for each row."""
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, TREES, BITS // 8)


def strings(codes: np.ndarray) -> np.ndarray:
    """Hashes as byte strings, whose order is the order of their bits."""
    return np.ascontiguousarray(codes).view(f"S{BITS // 8}")[..., 0]


def words(codes: np.ndarray) -> np.ndarray:
    """Hashes as (2, ...) halves of 64 bits, whose order is the order of their bits."""
    return np.ascontiguousarray(np.moveaxis(np.ascontiguousarray(codes).view(">u8"), -1, 0)).astype(np.uint64)


def leading_zeros(x: np.ndarray) -> np.ndarray:
    """Bits before the first set one of 64."""
    high = x >> np.uint64(32)
    half = np.where(high > 0, high, x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return 32 - np.frexp(half)[1] + np.where(high > 0, 0, 32)


def last_level(score: np.ndarray, norms: np.ndarray, norm: float) -> np.ndarray:
    """The longest prefix at which rows of at least ``score`` have been met with a chance of ``TARGET``."""
    share = 1 - np.arccos(np.clip(score / (norms * norm), -1, 1)) / np.pi
    with np.errstate(divide="ignore"):
        level = np.log(1 - (1 - TARGET) ** (1 / TREES)) / np.log(share)
    level = np.where(share < 1, np.clip(level, 0, BITS), BITS)
    return np.where(np.isneginf(score), 0, level).astype(np.int64)


class Forest:
    """The trees of one bucket: its rows, and for each tree their order and their sorted hashes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, order: np.ndarray, ordered: np.ndarray):
        self.ids, self.vectors, self.norm, self.order, self.codes = ids, vectors, norm, order, ordered
        self.halves, self.flat, self.at = words(ordered), order.ravel(), np.arange(TREES) * len(ids)
        heads = (self.halves[0] >> np.uint64(64 - LONG)).astype(np.int64)
        self.nodes = np.array([np.concatenate([[0], np.bincount(h, minlength=1 << LONG).cumsum()]) for h in heads])

    @classmethod
    def planted(cls, ids: np.ndarray, vectors: np.ndarray, norm: float, codes: np.ndarray) -> Forest:
        by_tree = codes.transpose(1, 0, 2)
        order = np.argsort(strings(by_tree), axis=1, kind="stable")
        return cls(ids, vectors, norm, order.astype(np.int32), np.take_along_axis(by_tree, order[:, :, None], axis=1))

    def stored(self) -> dict[str, bytes]:
        return {"ids": self.ids.tobytes(), "vectors": self.vectors.tobytes(), "ranks": self.order.tobytes(), "codes": self.codes.tobytes()}

    @classmethod
    def read(cls, row: pd.Series) -> Forest:
        ids = np.frombuffer(row["ids"], dtype=np.int64)
        vectors = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
        order = np.frombuffer(row["ranks"], dtype=np.int32).reshape(TREES, len(ids))
        return cls(ids, vectors, row["norm"], order, np.frombuffer(row["codes"], dtype=np.uint8).reshape(TREES, len(ids), -1))

    def spans(self, heads: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, TREES) first and end places of the rows that share ``level`` bits of prefix, 64 at most.

        ``heads`` are the first halves of the queries' hashes. Up to ``LONG`` bits the places are in a table.
        """
        if level <= LONG:
            node = ((heads >> np.uint64(64 - LONG)) >> np.uint64(LONG - level)).astype(np.int64)
            trees = np.arange(TREES)
            return self.nodes[trees, node << (LONG - level)], self.nodes[trees, (node + 1) << (LONG - level)]
        free = np.uint64((1 << (64 - level)) - 1)
        lows, highs = (heads & ~free).T, (heads | free).T
        first = [np.searchsorted(s, x, "left") for s, x in zip(self.halves[0], lows, strict=True)]
        end = [np.searchsorted(s, x, "right") for s, x in zip(self.halves[0], highs, strict=True)]
        return np.transpose(first), np.transpose(end)

    def longest(self, heads: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bits of a query's longest match in any tree, ``BITS`` where it is longer than a half.

        ``first`` to ``end`` are the rows that share a half. The rows of a tree are in order, so where there are none the
        longest match is one of the two rows around that place.
        """
        out, n = np.where((first < end).any(axis=1), BITS, -1), len(self.ids)
        for place, there in ((first - 1, first > 0), (end, end < n)):
            shared = leading_zeros(self.halves[0][np.arange(TREES), np.clip(place, 0, n - 1)] ^ heads)
            np.maximum(out, np.where(there, shared, -1).max(axis=1), out=out)
        return out

    def places(self, starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(queries, query, place in ``flat``) of all places from starts to stops, some queries at a time."""
        sizes = np.maximum(stops - starts, 0)
        upto = sizes.sum(axis=1).cumsum()
        at = 0
        while at < len(sizes):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES, "right")))
            size = sizes[at:stop].ravel()
            ends = size.cumsum()
            yield slice(at, stop), np.repeat(np.arange(at, stop), sizes[at:stop].sum(axis=1)), np.repeat(starts[at:stop].ravel() - ends + size, size) + np.arange(ends[-1])
            at = stop

    def climb(self, codes: np.ndarray, until: np.ndarray, since: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, queries, rows that they first meet there), from the longest match of all trees on, down to ``until``.

        With ``since`` the queries go on from that level, whose rows they have met before.

        All trees of a query ascend together; some queries are given at a time, each from its longest match on. The
        caller may raise ``until`` of a query between two levels.
        """
        heads, tails = words(codes)
        n, met = len(self.ids), np.zeros((len(codes), len(self.ids)), dtype=bool)
        seen = met.ravel()
        first, end = self.spans(heads, 64 if since is None else since)
        if since is None:
            top, start = BITS, self.longest(heads, first, end)
            end = first.copy()
        else:
            top, start = since - 1, np.full(len(codes), since - 1)
            for _, q, places in self.places(first + self.at, end + self.at):
                seen[q * n + self.flat[places]] = True
        for bottom in (b for b in (*BANDS, *range(LONG, -1, -1)) if b <= top):
            going = np.flatnonzero((until <= top) & (start >= bottom))
            going = going[~met[going].all(axis=1)]
            if not len(going):
                top = bottom - 1
                continue
            low, high = self.spans(heads[going], bottom)
            starts, stops = np.hstack([low, end[going]]), np.hstack([first[going], high])
            first[going], end[going] = low, high
            if not bottom:  # the empty prefix, which all rows share
                q, rows = np.nonzero(~met[going])
                yield 0, going[q], rows
                return
            at = np.tile(self.at, 2)
            for part, q, places in self.places(starts + at, stops + at):
                asked, rows = going[q], self.flat[places]
                if top == bottom:
                    before = met[going[part]]
                    seen[asked * n + rows] = True
                    q, rows = np.nonzero(met[going[part]] & ~before)
                    if len(q):
                        yield bottom, going[part][q], rows
                    continue
                new = ~seen[asked * n + rows]
                asked, rows, places = asked[new], rows[new], places[new]
                tree = places // n
                shared = leading_zeros(self.halves[0].ravel()[places] ^ heads[asked, tree])
                if (whole := shared == 64).any():
                    shared[whole] += leading_zeros(self.halves[1].ravel()[places[whole]] ^ tails[asked[whole], tree[whole]])
                key = asked * n + rows
                order = np.lexsort((-shared, key))
                order = order[np.diff(key[order], prepend=-1) != 0]  # a row's longest match in any tree
                asked, rows, shared = asked[order], rows[order], shared[order]
                for level in np.unique(shared)[::-1].tolist():
                    here = (shared == level) & (until[asked] <= level)
                    if here.any():
                        seen[asked[here] * n + rows[here]] = True
                        yield level, asked[here], rows[here]
            top = bottom - 1

    def ascend(self, codes: np.ndarray, until: np.ndarray, since: int | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
        """(level, query, rows first met there): ``climb``, query by query."""
        for level, queries, rows in self.climb(codes, until, since):
            for q in np.unique(queries).tolist():
                yield level, q, rows[queries == q]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, bounds: np.ndarray, k: int, since: int | None = None, least: int = 0) -> tuple[pd.DataFrame, np.ndarray]:
        """The best ``k`` candidates of each query here with how many it met, and the queries' bounds.

        A bound is a score that ``k`` rows are known to have; minus infinity where there are none. Queries go on from
        level ``since``, if given, and stop at the level ``least`` at the latest.
        """
        found, out = [pd.DataFrame({c: [] for c in ("id", "vec_id", "score", "met")})], [bounds[:0]]
        for at in range(0, len(queries), TOGETHER):
            some = slice(at, at + TOGETHER)
            rows, now = self.search_some(query_ids[some], queries[some], codes[some], bounds[some], k, since, least)
            found = [*found, rows] if len(rows) else found
            out.append(now)
        return pd.concat(found[1:] or found, ignore_index=True), np.concatenate(out)

    def search_some(self, query_ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, bounds: np.ndarray, k: int, since: int | None, least: int) -> tuple[pd.DataFrame, np.ndarray]:
        norms, bounds = np.sqrt((queries * queries).sum(axis=1)), bounds.copy()
        until, count = np.maximum(least, last_level(bounds, norms, self.norm)), np.zeros(len(queries), dtype=np.int64)
        best, best_ids = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1, dtype=np.int64)
        products: list[np.ndarray] = []

        def scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            pieces = [slice(i, i + 8192) for i in range(0, len(q), 8192)]
            return np.concatenate([np.zeros(0), *[(self.vectors[rows[p]] * queries[q[p]]).sum(axis=1) for p in pieces]])

        def score(q: np.ndarray, rows: np.ndarray) -> None:
            other = self.ids[rows] != query_ids[q]
            q, rows = q[other], rows[other]
            count[:] += np.bincount(q, minlength=len(queries))
            if not products and 16 * len(q) > len(queries) * len(self.ids):
                products.append(queries @ self.vectors.T)
            if products:  # the product rounds in another order: what may be among the best is summed up again
                bar = bounds[q]
                near = np.isneginf(bar) | (products[0][q, rows] >= bar - 1e-9 * np.maximum(1.0, np.abs(bar)))
                q, rows = q[near], rows[near]
            exact = scores(q, rows)
            near = exact >= bounds[q]
            q, ids, exact = q[near], self.ids[rows[near]], exact[near]
            if not len(q):
                return
            touched = np.unique(q)
            held = np.repeat(touched, k), best_ids[touched].ravel(), best[touched].ravel()
            q, ids, exact = (np.concatenate(x) for x in zip((q, ids, exact), held, strict=True))
            order = np.lexsort((ids, -exact, q))
            q, ids, exact = q[order], ids[order], exact[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            q, rank, ids, exact = (x[rank < k] for x in (q, rank, ids, exact))
            best[q, rank], best_ids[q, rank] = exact, ids
            distinct = (np.diff(np.sort(best_ids[touched], axis=1), axis=1) != 0).all(axis=1)
            last = best[touched, k - 1]
            raised = touched[distinct & (last > bounds[touched])]
            bounds[raised] = best[raised, k - 1]
            until[raised] = np.maximum(least, last_level(bounds[raised], norms[raised], self.norm))

        wait_q = wait_rows = np.zeros(0, dtype=np.int64)
        for _, q, rows in self.climb(codes, until, since):  # rows are scored once there are more than k of them
            q, rows = np.concatenate([wait_q, q]), np.concatenate([wait_rows, rows])
            ready = np.bincount(q, minlength=len(queries))[q] > k
            wait_q, wait_rows = q[~ready], rows[~ready]
            score(q[ready], rows[ready])
        score(wait_q, wait_rows)
        q, place = np.nonzero(best > -np.inf)
        return pd.DataFrame({"id": query_ids[q], "vec_id": best_ids[q, place], "score": best[q, place], "met": np.where(place == 0, count[q], 0)}), bounds


def usable(vector: Column) -> Column:
    """Whether an array column is a vector that can take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


#: Rows of a planted bucket: its trees (``tree``), its own queries with their bounds (``query``), and what they found.
PLANTED = (
    "kind string, dim int, bucket long, norm double, ids binary, vectors binary, ranks binary, codes binary, "
    "block long, id long, vector array<double>, bound double, vec_id long, score double, met long"
)
QUERY = "dim int, bucket long, block long, norm double, id long, vector array<double>, codes binary, bound double"
FOUND = "id long, vec_id long, score double, met long"


def planted(rows: DataFrame, k: int) -> DataFrame:
    """PLANTED: every bucket with its sorted trees, and the search of the queries that are its own rows."""
    names = [c.split()[0] for c in PLANTED.split(", ")]

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        first = group.iloc[0]
        vectors, ids = np.stack(group["vector"].to_numpy()), group["id"].to_numpy()
        forest = Forest.planted(ids, vectors, first["norm"], from_bytes(group["codes"]))
        out = [pd.DataFrame([{"kind": "tree", **forest.stored()}])]
        asks = group["asks"].to_numpy(dtype=bool)
        if asks.any():
            codes = hashes(vectors[asks], None)
            found, bounds = forest.search(ids[asks], vectors[asks], codes, np.full(asks.sum(), -np.inf), k, least=0 if first["n"] <= BUCKET_ROWS else LONG)
            own = group[asks][["block", "id", "vector"]]
            out += [own.assign(kind="query", bound=bounds, codes=[c.tobytes() for c in codes]), found.assign(kind="found")]
        out = pd.concat(out, ignore_index=True).reindex(columns=names)
        out = out.assign(dim=first["dim"], bucket=first["bucket"], norm=first["norm"]).astype({c: "Int64" for c in ("block", "id", "vec_id", "met")})
        plain = ("ids", "vectors", "ranks", "codes", "vector")  # pandas marks what is missing by a float
        return out.assign(**{c: out[c].astype(object).where(out[c].notna(), None) for c in plain})

    return rows.groupBy("dim", "bucket").applyInPandas(plant, PLANTED)


def prefixes(rows: DataFrame, keep: str, trees: list[int]) -> DataFrame:
    """(dim, route, tree, prefix) in ``trees`` of rows with the lengths of prefix in ``routes``, and the set of ``keep``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            head = words(from_bytes(batch["codes"]))[0]
            for route in sorted({int(r) for routes in batch["routes"] for r in routes}):
                has = np.array([route in routes for routes in batch["routes"]])
                asked = trees if route else trees[:1]
                prefix = (head[has][:, asked] >> np.uint64(63 - route)) >> np.uint64(1)
                n = int(has.sum())
                out = pd.DataFrame({"dim": np.repeat(batch["dim"].to_numpy()[has], len(asked)), keep: np.repeat(batch[keep].to_numpy()[has], len(asked)), "route": route})
                yield out.assign(tree=np.tile(asked, n), prefix=prefix.ravel().astype(np.int64)).drop_duplicates()

    found = rows.select("dim", keep, "codes", "routes").mapInPandas(run, f"dim int, {keep} long, route int, tree int, prefix long")
    return found.groupBy("dim", "route", "tree", "prefix").agg(F.collect_set(keep).alias(keep))


def meetings(rows: DataFrame, queries: DataFrame, trees: list[int]) -> DataFrame:
    """(dim, bucket, block), distinct, with a prefix in ``trees`` in common; both sides have their ``routes``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[tuple[int, int], set[int]] = {}
        for batch in batches:
            new = []
            for dim, buckets, blocks in zip(batch["dim"], batch["bucket"], batch["block"], strict=True):
                for block in blocks:
                    before = met.setdefault((dim, block), set())
                    new += [(dim, bucket, block) for bucket in set(buckets) - before]
                    before.update(buckets)
            yield pd.DataFrame(new, columns=["dim", "bucket", "block"])

    common = prefixes(rows, "bucket", trees).join(prefixes(queries, "block", trees), ["dim", "route", "tree", "prefix"])
    return common.select("dim", "bucket", "block").mapInPandas(run, "dim int, bucket long, block long").distinct()


def meeting_tiles(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """(dim, bucket, block) where some tree of the bucket has rows of the prefix of a query's route.

    One tree is asked for all blocks, the others for those that do not meet all buckets in it.
    """
    in_use = queries.groupBy("dim").agg(F.collect_set("route").alias("routes"))  # a row for each dimension, ROUTES at most
    in_use = rows.groupBy("dim").agg(F.countDistinct("bucket").alias("buckets")).join(in_use, "dim")
    in_use = broadcast_if_small(materialize(in_use, "routes"))
    rows, queries = rows.join(in_use.drop("buckets"), "dim"), queries.withColumn("routes", F.array("route"))
    tiles = materialize(meetings(rows, queries, [SCOUT]), "tiles")
    all_met = tiles.groupBy("dim", "block").count().join(in_use, "dim").where(F.col("count") == F.col("buckets")).select("dim", "block")
    left = queries.join(broadcast_if_small(materialize(all_met, "all-met")), ["dim", "block"], "left_anti")
    if left.isEmpty():
        return tiles
    others = meetings(rows.join(left.select("dim").distinct(), "dim", "left_semi"), left, [t for t in range(TREES) if t != SCOUT])
    return materialize(tiles.unionByName(others).distinct(), "more-tiles")


def with_level(queries: DataFrame) -> DataFrame:
    """``queries`` with the level down to which they have to ascend by their bounds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            norms = np.array([np.sqrt((v * v).sum()) for v in batch["vector"]])
            yield batch.assign(level=last_level(batch["bound"].to_numpy(), norms, batch["norm"].to_numpy()))

    return queries.mapInPandas(run, f"{QUERY}, level long")


def with_bounds(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``queries`` with the bounds that follow from all that they have found."""
    found = found.groupBy("id", "vec_id").agg(F.max("score").alias("score"))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"))))
    last = best.where(F.col("rank") == k).select("id", F.col("score").alias("last"))
    last = broadcast_if_small(materialize(last, "bounds"))
    return queries.join(last, "id", "left").withColumn("bound", F.greatest("bound", F.coalesce("last", F.lit(float("-inf"))))).select(*queries.columns)


def elsewhere(rows: DataFrame, trees: DataFrame, queries: DataFrame, k: int, since: int | None, least: int) -> DataFrame:
    """FOUND in all buckets where ``queries`` have to ascend from level ``since`` to ``least``, or to their own level.

    Without ``since`` their own buckets are left out, where they have been.
    """
    down_to = F.greatest("level", F.lit(least))
    route = F.array_max(F.filter(F.array(*[F.lit(r) for r in ROUTES]), lambda r: r <= down_to))
    tiles = meeting_tiles(rows, queries.withColumn("route", route))
    place = F.row_number().over(Window.partitionBy("dim", "bucket").orderBy("block"))
    tiles = materialize(tiles.withColumn("part", F.floor((place - 1) / TILE_BLOCKS)), "parts")
    parts, tiles = materialize(tiles.select("dim", "bucket", "part").distinct(), "bucket-parts"), broadcast_if_small(tiles)
    key = ["dim", "bucket", "part"]

    def tile(bucket: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if since is None:
            asked = asked[asked["home"] != asked["bucket"]]
        if bucket.empty or asked.empty:
            return pd.DataFrame({"id": [], "vec_id": [], "score": [], "met": []})
        forest, vectors = Forest.read(bucket.iloc[0]), np.stack(asked["vector"].to_numpy())
        found, _ = forest.search(asked["id"].to_numpy(), vectors, from_bytes(asked["codes"]), asked["bound"].to_numpy(), k, since, least)
        return found

    sent = queries.withColumnRenamed("bucket", "home").join(tiles, ["dim", "block"]).select(*key, "home", "id", "vector", "codes", "bound")
    buckets = trees.join(broadcast_if_small(parts), ["dim", "bucket"]).select(*key, "norm", "ids", "vectors", "ranks", "codes")
    return buckets.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(tile, FOUND)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score, candidates (how many were scored): the ``k`` nearest found of each query."""
    as_double = F.col(vector_col).cast("array<double>")
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), as_double.alias("vector"), is_query.alias("asks"))
    plain = plain.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct().withColumn("dim", F.size("vector"))
    plain = materialize(plain, "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    sizes = plain.groupBy("dim").agg(F.max(norm).alias("norm"), F.count("*").alias("n"))
    sizes = materialize(sizes.withColumn("bits", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BUCKET_ROWS))).cast("int")), "vector-counts")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("dim", sort=False):
                codes = hashes(np.stack(part["vector"].to_numpy()), part["norm"].iloc[0])
                head = np.ascontiguousarray(codes[:, 0, :4]).view(">u4")[:, 0].astype(np.int64)
                yield part.assign(codes=[c.tobytes() for c in codes], place=head >> (32 - part["bits"].to_numpy())).drop(columns=["bits"])

    placed = plain.join(broadcast_if_small(sizes), "dim").mapInPandas(place, "dim int, id long, vector array<double>, asks boolean, norm double, n long, codes binary, place long")
    placed = materialize(placed.withColumn("area", F.shiftright("place", 4)), "placed")
    split = lambda rows, at_most: F.ceil(rows / at_most).cast("long")
    cells = placed.groupBy("dim", "place").agg(split(F.count("*"), BUCKET_ROWS).alias("parts"))
    areas = placed.groupBy("dim", "area").agg(F.greatest(F.lit(1), split(F.count_if("asks"), BLOCK_QUERIES)).alias("blocks"))
    index = placed.join(broadcast_if_small(materialize(cells, "cells")), ["dim", "place"]).join(broadcast_if_small(materialize(areas, "areas")), ["dim", "area"])
    within = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    named = lambda place, seed, n: F.shiftleft(place, 24) + within(seed, n)
    index = index.select("dim", "id", "vector", "asks", "norm", "n", "codes", named("place", 1, "parts").alias("bucket"), named("area", 2, "blocks").alias("block"))
    forest = materialize(planted(index, k), "forest")
    # new names, since trees and queries meet again
    of = lambda kind, *columns: forest.where(F.col("kind") == kind).select(*[F.col(c).alias(c) for c in columns])
    trees = of("tree", "dim", "bucket", "norm", "ids", "vectors", "ranks", "codes")
    found = of("found", "id", "vec_id", "score", "met")
    several = index.where(F.col("n") > BUCKET_ROWS)
    queries = of("query", *[c.split()[0] for c in QUERY.split(", ")]).join(broadcast_if_small(sizes.where(F.col("n") > BUCKET_ROWS).select("dim")), "dim", "left_semi")
    queries = materialize(with_level(queries.select(*[c.split()[0] for c in QUERY.split(", ")])), "queries")
    if not queries.isEmpty():
        found = found.unionByName(materialize(elsewhere(several, trees, queries, k, None, LONG), "found-long"))
        queries = materialize(with_level(with_bounds(queries.drop("level"), found, k)).where(F.col("level") < LONG), "queries-short")
    if not queries.isEmpty():
        found = found.unionByName(materialize(elsewhere(several, trees, queries, k, LONG, 0), "found-short"))
    found = found.withColumnRenamed("id", "query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.sum("met").alias("met"))
    found = found.withColumn("candidates", F.sum("met").over(Window.partitionBy("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "candidates")
