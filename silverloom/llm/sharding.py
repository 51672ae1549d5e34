"""Sharding: minimax contiguous partition of ordered atomic groups.

Groups are the rows of equal text; a group is never split. They are ordered by the SHA-256 of the text. The smallest
capacity for which a greedy left-to-right packing needs at most ``n_shards`` shards is found by binary search, and the
order is cut there. A shard is then a range of digests, so a row finds its shard by comparing its digest with
``n_shards - 1`` constants and no join is needed.

The search never sees all groups. It works on a digest of sizes: pieces of the order (ranges of digests) with their
total size, exact once a piece holds a single group. Two packings bracket the answer: one that may cut anywhere within
a piece of several groups, one that may cut only between pieces. Pieces that a cut might fall into are split by two
more hex digits, in one aggregation for each round, until both packings agree; the driver holds some thousand pieces.

Cases: a null text has no bytes, hence size 1, and forms one group with the empty text (crc 0). Repeated rows stay as
they are, each with its own slot. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import materialize, prefix_sums

#: Hex digits that name the first pieces, and digits added when a piece is split.
FIRST_DIGITS, MORE_DIGITS = 3, 2
#: Parts of a piece of rows with one text when slots are numbered.
SALTS = 64


class SizeDigest:
    """Ordered pieces: (prefix, total size, smallest digest, whether it is one group)."""

    def __init__(self, pieces: list[tuple[str, int, str, bool]]):
        self.pieces = sorted(pieces)
        self.ends = [0, *accumulate(p[1] for p in self.pieces)]
        self.total = self.ends[-1]

    def reach(self, start: int, capacity: int, anywhere: bool) -> int:
        """The last position that a shard from ``start`` of this capacity may end at."""
        goal = min(start + capacity, self.total)
        at = bisect_right(self.ends, goal) - 1
        if anywhere and at < len(self.pieces) and not self.pieces[at][3]:
            return goal
        return max(start, self.ends[at])

    def pack(self, capacity: int, n_shards: int, anywhere: bool) -> list[int]:
        at, cuts = 0, []
        for _ in range(n_shards):
            at = self.reach(at, capacity, anywhere)
            cuts.append(at)
        return cuts

    def least_capacity(self, n_shards: int, anywhere: bool) -> int:
        low, high = -(-self.total // n_shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.pack(mid, n_shards, anywhere)[-1] == self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def unclear(self, n_shards: int) -> list[str]:
        """Prefixes of the pieces of several groups that a cut of the best packing might fall into."""
        low, high = self.least_capacity(n_shards, True), self.least_capacity(n_shards, False)
        first, last = self.pack(low, n_shards, False), self.pack(high, n_shards, True)
        found = set()
        for a, b in zip(first, last, strict=True):
            for i in range(max(0, bisect_right(self.ends, a) - 1), min(len(self.pieces), bisect_left(self.ends, b))):
                if not self.pieces[i][3]:
                    found.add(self.pieces[i][0])
        return sorted(found)

    def cuts(self, n_shards: int) -> tuple[int, list[int]]:
        """The least capacity, and cuts that keep to it with the shards as even as the known boundaries allow."""
        capacity = self.least_capacity(n_shards, False)
        latest_start, at = [self.total], self.total
        for _ in range(n_shards):  # the first position from which so many shards still suffice
            at = self.ends[bisect_left(self.ends, max(0, at - capacity))]
            latest_start.append(at)
        at, cuts = 0, []
        for left in range(n_shards - 1, 0, -1):
            even = at + (self.total - at) / (left + 1)
            lowest, highest = max(at, latest_start[left]), self.reach(at, capacity, False)
            near = bisect_left(self.ends, even)
            options = [self.ends[i] for i in (near - 1, near) if 0 <= i < len(self.ends) and lowest <= self.ends[i] <= highest]
            at = min(options, key=lambda x: abs(x - even), default=min(max(lowest, at), highest))
            cuts.append(at)
        return capacity, cuts


def size_digest(sized: DataFrame, n_shards: int) -> SizeDigest:
    """Totals of the pieces of the order, fine enough for the exact minimax cut of ``sized`` (size, key)."""

    def pieces(rows: DataFrame, digits: int) -> list[tuple[str, int, str, bool]]:
        out = rows.groupBy(F.substring("key", 1, digits).alias("p")).agg(F.sum("size").alias("s"), F.min("key").alias("a"), F.max("key").alias("b"))
        return [(r.p, r.s, r.a, r.a == r.b) for r in out.collect()]

    digits = FIRST_DIGITS
    found = SizeDigest(pieces(sized, digits))
    while coarse := found.unclear(n_shards):
        digits = max(len(p) for p in coarse)
        split = [p for p in coarse if len(p) == digits]
        finer = pieces(sized.where(F.substring("key", 1, digits).isin(split)), digits + MORE_DIGITS)
        gone = set(split)
        found = SizeDigest([p for p in found.pieces if p[0] not in gone] + finer)
    return found


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row of ``docs`` into a shard; see the module for the law and the cases.

    Returns id, size, text_crc32, law ('bytes'), shard, slot (gapless within the shard), grown_shard (null).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text.cast("binary"), 256).alias("key"),
        ),
        "sized",
    )
    found = size_digest(sized, n_shards)
    _, cuts = found.cuts(n_shards)
    starts = [found.pieces[bisect_left(found.ends, c)][2] if c < found.total else None for c in cuts]
    shard = F.lit(0)
    for key in starts:
        if key is not None:
            shard = shard + (F.col("key") >= F.lit(key)).cast("int")
        # a cut at the end leaves the shards after it empty
    rows = sized.withColumn("shard", shard).withColumn(
        "piece", F.conv(F.substring("key", 1, 2), 16, 10).cast("int") * SALTS + F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    )
    slotted = prefix_sums(rows, ["shard"], "piece", [F.col("key"), F.col("doc_id")], F.lit(1).cast("long"), "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
