"""Connected components of an edge table by alternating large and small stars, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import join_counted, materialize


#: Nodes with the most neighbours are looked up in a broadcast table of at most so many rows.
BROADCAST_NODES = 100_000


def _with_least(pairs: DataFrame) -> DataFrame:
    """Add to (u, v) the least of u and its neighbours, found by pre-aggregation; no task meets all neighbours of one u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = materialize(least.select("u", F.least("u", "m").alias("m"), "n"), "least")
    return join_counted(pairs, least, "u", most=BROADCAST_NODES)


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), longs: root is the least node of its component.

    Every round is written to the shared folder. It ends when a round changes nothing, after some log2 of the longest
    path; a graph of stars takes one. Self-edges and repeated edges do no harm; an empty table gives an empty result.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.sum(F.pmod(F.hash("u", "v"), F.lit(1 << 30)))).first())

    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        small = _with_least(large.where("u <> v"))
        stars = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(stars.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        was, seen = seen, state(now)
        if was == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
