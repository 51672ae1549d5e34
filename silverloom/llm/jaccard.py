"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures before exact sorted-array intersection.

A document's set is its distinct shingles of ``n`` words, as sorted 64-bit hashes. Two documents link when
100 * |A and B| >= percent * |A or B|. Documents of equal sets form a class and only one of each class is compared.

Finding candidates loses no link. Sizes are cut into bands. If the smaller of a linking pair has at most U shingles
(the end of its band), the two differ in at most D = floor(U * (100 - percent) / percent) shingles. The hash space is
cut into m > D + 1 segments; at least m - D of them hold the same shingles in both documents. Of these the largest (by
size, then position) is among the D + 1 largest segments of either document, so it is enough that a document emits a
key for each of its D + 1 largest segments: the band, the segment and a hash of the segment's shingles. A document also
emits keys for the band below where its size can still link with it. A passage that many documents share makes no hot
key, since a key holds a whole segment, of which other shingles of the document are a part.

The documents of one key are a group, and groups of the same documents are one. Within a group bitmaps of hashed
shingles, as wide as the band asks for, bound the overlap of two documents from above; a group returns a spanning forest
of the pairs that the bound leaves, never pairs, and the components of these forests are the candidate clusters. A
passage that documents share, or a document that links with neither of two others, so makes no cluster of them. Clusters
are compared exactly: bitmaps again, then intersection of what is left and not yet in one component. Both groups and
clusters are cut into blocks by size, and tiles of two blocks whose sizes can link are compared; large ones take more
tiles, not larger. The forests' components are the answer. Whole arrays of hashes are only sent within clusters.

Cases: A-Z is lower-cased, words are split at ASCII white space only; fewer than ``n`` words make one shingle of all of
them; a text that is null, empty or only white space has an empty set and links with nothing. Rows with one id and
different texts are documents of their own. A null id links as any other; ``component_id`` is the smallest id that is
known, or null. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import KEY, broadcast_if_small, join_counted, materialize, prefix_sums, text_key, whole_texts, with_marks
from silverloom.llm.components import connected_components

#: Words remembered by a task, and the rows of ids up to which a join with whole texts is a broadcast.
CACHE, BROADCAST_IDS = 100_000, 200_000
#: A block of a tile has at most so many documents, and so many shingles (and one document more).
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 1 << 22
#: Bits of the widest bitmap.
MAX_BITS = 1 << 16
#: One row in so many is looked at for hot keys, and how often a key must occur there to be hot.
SAMPLED, HOT_IN_SAMPLE = 256, 64
#: Parts of a band of sizes when documents are put into blocks.
BAND_PARTS = 64
TILE = ["cluster", "first", "last"]
U64 = np.uint64
ODD = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)]


class Words(dict):
    """Hashes of words, as bytes; forgets all when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def shingle_set(text: str | None, n: int, words: Words) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=U64)
    hashes = np.fromiter(map(words.__getitem__, found), dtype=U64, count=len(found))
    width = min(n, len(hashes))
    last = len(hashes) - width + 1
    total = np.full(last, U64(width), dtype=U64)
    for k in range(width):
        total = (total + hashes[k : k + last]) * ODD[k % len(ODD)]
        total ^= total >> U64(29)
    return np.unique(mixed(total))


class Bands:
    """Size bands, the differences D that each allows, and its number of segments."""

    def __init__(self, percent: int):
        self.percent, self.ends = percent, [1]

    def cover(self, size: int) -> None:
        while self.ends[-1] < size:
            last = self.ends[-1] + 1
            self.ends.append(max(last, last * 3 // 2 - 1))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, D, segments) under which a set of this size emits keys: its own band, and those it may reach down to."""
        self.cover(size)
        out = []
        for band, end in enumerate(self.ends):
            start = self.ends[band - 1] + 1 if band else 1
            if start <= size and size * self.percent <= 100 * end:
                differ = end * (100 - self.percent) // self.percent
                out.append((band, differ, 1 if differ == 0 else differ + 2 + differ // 4))
            if start > size:
                break
        return out


def segment_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the largest segments of a set, for each band it takes part in."""
    upto = np.zeros(len(hashes) + 1, dtype=U64)
    np.cumsum(mixed(hashes ^ ODD[3]), out=upto[1:])
    keys = []
    for band, differ, m in bands.of(len(hashes)):
        segment = ((hashes >> U64(32)) * U64(m)) >> U64(32)
        counts = np.bincount(segment.astype(np.int64), minlength=m)
        ends = np.cumsum(counts)
        largest = np.argsort(-counts, kind="stable")[: differ + 1]
        content = upto[ends[largest]] - upto[ends[largest] - counts[largest]]
        name = (largest.astype(U64) << U64(16)) + U64(band * 2 + 1)
        keys.append(mixed(content + mixed(name * ODD[0])))
    return np.concatenate(keys)


def set_id(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def with_sets(docs: DataFrame, n: int, percent: int, id_col: str) -> DataFrame:
    """One row per row of ``docs``: row_id, doc_id, the text's name, n_shingles, set_id, bits, keys; written to the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bands = Words(), Bands(percent)
        for batch in batches:
            sets = [shingle_set(t, n, words) for t in batch["text"]]
            keys = [segment_keys(s, bands).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
            yield batch.drop(columns="text").assign(n_shingles=[len(s) for s in sets], set_id=[set_id(s) for s in sets], bits=[bitmap(s) for s in sets], keys=keys)

    plain = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), *text_key(), "text")
    return materialize(whole_texts(plain).mapInPandas(run, "row_id long, doc_id long, key_h long, key_c long, key_n int, n_shingles long, set_id binary, bits binary, keys array<long>"), "sets")


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each hash, in a power of two of bits that is at least twice their number, up to MAX_BITS."""
    bits = 1 << int(np.clip(2 * len(hashes), 64, MAX_BITS) - 1).bit_length()
    marks = np.zeros(bits, dtype=bool)
    marks[(hashes & U64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def stacked(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, the wider ones folded to the width of the narrowest."""
    width = min(map(len, maps))
    rows = [np.frombuffer(m, dtype=np.uint8) for m in maps]
    rows = [r if len(r) == width else np.bitwise_or.reduce(r.reshape(-1, width), axis=0) for r in rows]
    return np.stack(rows).view(U64)


def compare(sizes: np.ndarray, maps: np.ndarray, percent: int, split: int | None = None, arrays: list[np.ndarray] | None = None) -> list[int]:
    """The root (an index) of each document's component, documents being joined where they can link by their bitmaps,

    and with ``arrays`` only where they do link. ``split``: only pairs of one index below and one from there on.
    """
    root = np.arange(len(sizes))
    order = np.argsort(sizes, kind="stable")
    ranked, side = sizes[order], order if split is None else (order < split)
    for at, i in enumerate(order):
        end = np.searchsorted(ranked, sizes[i] * 100 // percent, side="right")
        js = order[at + 1 : end]
        js = js[root[js] != root[i]]
        if split is not None:
            js = js[(js < split) != side[at]]
        if not len(js):
            continue
        need = -(-percent * (sizes[i] + sizes[js]) // (100 + percent))
        above = sizes[i] - np.bitwise_count(maps[i] & ~maps[js]).sum(axis=1, dtype=np.int64)
        fits = above >= need
        js, need = js[fits], need[fits]
        if not len(js):
            continue
        other = sizes[js] - np.bitwise_count(maps[js] & ~maps[i]).sum(axis=1, dtype=np.int64)
        js, need = js[other >= need], need[other >= need]
        if arrays is None:
            root[np.isin(root, root[js])] = root[i]
            continue
        mine = arrays[i]
        for j, least in zip(js, need, strict=True):
            if root[j] != root[i]:
                place = np.searchsorted(mine, arrays[j])
                place[place == len(mine)] = 0
                if int((mine[place] == arrays[j]).sum()) >= least:
                    root[root == root[j]] = root[i]
    return root.tolist()


def _tile_forest(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Edges (node, node) of a spanning forest of one tile; rows are (block, node, size, bitmap, hashes or None)."""
    if len(rows) < 2:
        return []
    rows.sort(key=lambda r: (r[0], r[1]))
    nodes, blocks = [r[1] for r in rows], [r[0] for r in rows]
    split = blocks.index(blocks[-1]) if blocks[0] != blocks[-1] else None
    arrays = None if rows[0][4] is None else [r[4] for r in rows]
    roots = compare(np.array([r[2] for r in rows], dtype=np.int64), stacked([r[3] for r in rows]), percent, split, arrays)
    return [(nodes[i], nodes[r]) for i, r in enumerate(roots) if r != i]


def forests(tiled: DataFrame, percent: int) -> DataFrame:
    """(u, v): spanning forests of all tiles. ``tiled``: TILE, block, node, and n_shingles with bits, or hashes."""
    exact = "hashes" in tiled.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_tile, rows = None, []
        for batch in batches:
            found = []
            data = batch["hashes"] if exact else zip(batch["n_shingles"], batch["bits"], strict=True)
            for node, block, held, *tile in zip(batch["node"], batch["block"], data, *(batch[c] for c in TILE), strict=True):
                if tile != open_tile:
                    found += _tile_forest(rows, percent)
                    open_tile, rows = tile, []
                if exact:
                    hashes = np.array(held, dtype=np.int64).view(U64)
                    rows.append((block, node, len(hashes), bitmap(hashes), hashes))
                else:
                    rows.append((block, node, *held, None))
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")
        yield pd.DataFrame(_tile_forest(rows, percent), columns=["u", "v"], dtype="int64")

    return tiled.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(run, "u long, v long")


def groups_of(sets: DataFrame, firsts: DataFrame) -> DataFrame:
    """(cluster, node): the nodes of each key that several have. Keys of the same nodes give one group."""
    keyed = sets.select("row_id", F.explode("keys").alias("key"))
    copies = firsts.where("row_id <> node").select("row_id")
    keyed = keyed.join(broadcast_if_small(materialize(copies, "copies"), BROADCAST_IDS), "row_id", "left_anti")
    # a key of very many rows must not meet in one task: such keys are seen in a sample, and their members are summed up
    # by pre-aggregation and a join that can be split; all other keys take one shuffle and a window
    sampled = keyed.where(F.pmod(F.xxhash64("row_id"), F.lit(SAMPLED)) == 0).groupBy("key").agg(F.count("*").alias("n"))
    hot = broadcast_if_small(materialize(sampled.where(F.col("n") >= HOT_IN_SAMPLE).select("key"), "hot-keys"), BROADCAST_IDS)
    members = {"n": F.count("row_id"), "least": F.min("row_id"), "all": F.bit_xor(F.xxhash64("row_id"))}
    apart, by_key = keyed.join(hot, "key", "left_semi"), Window.partitionBy("key")
    many = apart.join(apart.groupBy("key").agg(*[c.alias(name) for name, c in members.items()]), "key")
    few = keyed.join(hot, "key", "left_anti").withColumns({name: c.over(by_key) for name, c in members.items()})
    both = few.where("n > 1").unionByName(many.where("n > 1").select(*few.columns))
    return both.select(F.xxhash64(*members).alias("cluster"), F.col("row_id").alias("node")).distinct()


def clusters_of(sets: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """(node, cluster): nodes that can link by their bitmaps with another one of their group, by connected cluster."""
    groups = materialize(groups_of(sets, firsts), "groups")
    large = groups.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_DOCS).select("cluster")
    large = broadcast_if_small(materialize(large, "large-groups"), BROADCAST_IDS)
    marks = sets.select(F.col("row_id").alias("node"), "n_shingles", "bits")
    whole = groups.join(large, "cluster", "left_anti").select("node", *[F.lit(0).cast("long").alias(c) for c in ("block", "first", "last")], "cluster")
    cut = groups.join(large, "cluster", "left_semi").join(marks.drop("bits"), "node")
    tiled = whole.unionByName(tiles_of(cut, percent)).join(marks, "node")
    return connected_components(forests(tiled, percent)).select("node", F.col("root").alias("cluster"))


def tiles_of(members: DataFrame, percent: int) -> DataFrame:
    """(node, block, cluster, first, last): the blocks of each cluster and the tiles (of two blocks) they take part in. ``members``: node, cluster, n_shingles."""
    # a band of sizes may hold most of a cluster: its parts are by a hash of the node
    parts = F.pmod(F.xxhash64("node"), F.lit(BAND_PARTS))
    banded = members.withColumn("band", F.floor(F.log2("n_shingles") * 16) * BAND_PARTS + parts)
    weight = (F.col("n_shingles") / BLOCK_SHINGLES + F.lit(1 / BLOCK_DOCS)).cast("decimal(24,12)")
    placed = prefix_sums(banded, ["cluster"], "band", [F.col("n_shingles"), F.col("node")], weight, "before")
    placed = materialize(placed.select("node", "cluster", "n_shingles", F.floor("before").alias("block")), "blocks")
    blocks = placed.groupBy("cluster", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    pairs = a.join(b, F.col("a.cluster") == F.col("b.cluster")).where((F.col("a.block") <= F.col("b.block")) & (F.col("b.low") * percent <= F.col("a.high") * 100))
    mine = F.explode(F.array_distinct(F.array("a.block", "b.block"))).alias("block")
    tiled = pairs.select(F.col("a.cluster").alias("cluster"), mine, F.col("a.block").alias("first"), F.col("b.block").alias("last"))
    return placed.join(tiled, ["cluster", "block"]).select("node", "block", "cluster", "first", "last")


def link_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: row_id, doc_id, the text's name, n_shingles, node (its class), root, component_id."""
    sets = with_sets(docs, n, percent, id_col)
    filled = sets.where("n_shingles > 0")
    classes = filled.groupBy("set_id").agg(F.min("row_id").alias("node"), F.count("*").alias("rows"))
    several = broadcast_if_small(materialize(classes.where("rows > 1").select("set_id", "node"), "classes"), BROADCAST_IDS)
    thin = sets.drop("keys", "bits")
    firsts = thin.join(several, "set_id", "left").withColumn("node", F.when(F.col("n_shingles") > 0, F.coalesce("node", "row_id")).otherwise(F.col("row_id")))
    firsts = materialize(firsts, "firsts")
    clusters = clusters_of(sets, firsts, percent)
    members = firsts.where("row_id = node").join(clusters, "node")
    members = materialize(members, "members")
    tiled = tiles_of(members.select("node", "cluster", "n_shingles"), percent)
    # a row for each document with its tiles, so that the join with whole texts does not grow with the tiles
    tiles = tiled.groupBy("node").agg(F.collect_list(F.struct("block", *TILE)).alias("__tiles"))
    wanted = members.select("node", "doc_id", *KEY, F.col("set_id").alias("__set_id")).join(tiles, "node")
    wanted = wanted.select("doc_id", *KEY, "__set_id", F.col("node").alias("__node"), "__tiles")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    both = with_marks(texts, wanted, "inner", {"doc_id": "doc_id"}, BROADCAST_IDS)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            sets = [shingle_set(t, n, words) for t in batch["text"]]
            same = [set_id(s) == bytes(i) for s, i in zip(sets, batch["__set_id"], strict=True)]
            out = pd.DataFrame({"node": batch["__node"], "tiles": batch["__tiles"], "hashes": [s.view(np.int64) for s in sets]})
            yield out[same]

    tile_type = "array<struct<block:long,cluster:long,first:long,last:long>>"
    arrays = whole_texts(both.drop("doc_id")).mapInPandas(hashed, f"node long, tiles {tile_type}, hashes array<long>")
    arrays = arrays.select("node", "hashes", F.inline("tiles"))
    roots = connected_components(forests(arrays, percent))
    rooted = materialize(firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    linked = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")).where("n > 1")
    out = join_counted(rooted, materialize(linked, "components"), "root", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the least id (a null id only where there is no other)."""
    linked = link_components(docs, n, percent, id_col).withColumn("place", F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "row_id"))
    best = linked.groupBy("root").agg(F.min_by(F.struct("doc_id", *KEY), "place").alias("first"), F.count("*").alias("n")).where("n > 1")
    linked = join_counted(linked, materialize(best, "kept-rows"), "root")  # only components of several rows
    is_first = F.struct("doc_id", *KEY).eqNullSafe(F.col("first"))
    copies = linked.groupBy("doc_id", *KEY).agg(F.max(is_first).alias("first"), F.sum(is_first.cast("int")).alias("n"))
    copies = materialize(copies.where("not first or n > 1"), "near-copies")
    kept = with_marks(docs, copies.select("doc_id", *KEY), "left_anti", {id_col: "doc_id"})
    again = copies.where("first").select("doc_id", *KEY)
    if again.isEmpty():
        return kept
    # rows that repeat both id and text: one of them stays
    repeated = with_marks(docs.withColumns({f"__k{i}": c for i, c in enumerate(text_key())}), again, "left_semi", {id_col: "doc_id"})
    rank = F.row_number().over(Window.partitionBy(id_col, "__k0", "__k1", "__k2").orderBy(F.xxhash64(*docs.columns), *docs.columns))
    return kept.unionByName(repeated.withColumn("__rank", rank).where("__rank = 1").select(*docs.columns))
