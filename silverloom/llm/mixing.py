"""Mixing sources to target weights: a low-discrepancy schedule of equal-token blocks.

Each source's documents are laid on a line in a shuffled order (a hash of the id) and the line is cut into blocks of
equal word counts (one word more or less). Slots of the mix are points of the golden-ratio sequence; cumulative slot
weights map each point to a source, and the r-th slot of a source takes its block r modulo the number of its blocks.
Every prefix of the schedule is therefore close to the target weights, and a rerun gives the same schedule.

Targets: sources in code-point order, null last, weigh 1, 2, 3, repeating, and share the whole size by weight; a target
stops at ``max_passes`` times its source, and what is over is shared again by weight until none is above.

The sources themselves, a row each, pass through windows of one task, as their ranks and running weights ask for: some
hundred thousand sources are meant, not one for each document. Their documents never do.

Cases: a null text has size 0 and is taken 0 times; so is any document without words. A null source is a source of its
own, after all others. Repeated rows are documents of their own; equal (id, size) rows may swap places, which changes
nothing in the result. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import KEY, WORD_CLASS, broadcast_if_small, materialize, prefix_sums, text_key, with_marks

GOLDEN = 0.6180339887498949
#: Blocks of a source: at least MIN_BLOCKS (fewer only where it has fewer words), and of at most BLOCK_WORDS words.
MIN_BLOCKS, BLOCK_WORDS = 1024, 1_000_000
#: Parts of the unit interval in which points meet sources, and slots ranked together.
CELLS, CHUNK = 4096, 65_536
MAX_PASSES = 3
#: Parts of a source when its documents are laid on the line.
PIECES = 1024


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source of ``sized`` (source, size): idx, source_size, weight, target (double).

    The capped targets are a prefix of the sources by cap over weight, so the fixed point of the resharing is the
    largest share that any such prefix leaves; it takes one window over the sources, a row each.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    idx = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.withColumn("idx", idx)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("idx") % len(weights) + 1).cast("int")).cast("long")
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_passes)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "idx").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0))
    sources = sources.withColumn("share", left / weight_left)
    share = F.max("share").over(everything)
    return sources.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * share)).drop("share", "cap")


def with_blocks(targets: DataFrame, min_blocks: int, block_words: int) -> DataFrame:
    """Add the number of blocks, their base length and how many have one word more, and the range of slot points."""
    blocks = F.least("source_size", F.greatest(F.lit(min_blocks), F.ceil(F.col("source_size") / block_words))).cast("long")
    df = targets.withColumn("blocks", blocks)
    df = df.withColumn("base", F.when(F.col("blocks") > 0, F.expr("source_size div blocks")).otherwise(0))
    df = df.withColumn("longer", F.col("source_size") - F.col("base") * F.col("blocks"))
    df = df.withColumn("slots", F.when(F.col("source_size") > 0, F.col("blocks") * F.col("target") / F.col("source_size")).otherwise(0.0))
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("all_slots", F.sum("slots").over(Window.partitionBy())).withColumn("upto", F.sum("slots").over(upto))
    df = df.withColumn("high", F.when(F.col("all_slots") > 0, F.col("upto") / F.col("all_slots")).otherwise(0.0))
    return df.withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("idx"))).drop("upto")


def schedule(blocked: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """The mix in order: slot, idx (source), block, pass. ``blocked`` is a small materialised table, one row a source."""
    spark = blocked.sparkSession
    n = int(round(blocked.agg(F.coalesce(F.max("all_slots"), F.lit(0.0))).first()[0]))
    point = F.col("slot") * GOLDEN + 0.5
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point))
    slots = slots.withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    cell = lambda c: F.least(F.floor(F.col(c) * CELLS), F.lit(CELLS - 1)).cast("int")
    ranges = blocked.where("high > low").withColumn("cell", F.explode(F.sequence(cell("low"), cell("high"))))
    ranges = ranges.select("cell", "idx", "low", "high", "blocks")
    hit = slots.join(ranges, "cell").where("point >= low and point < high")
    hit = hit.withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    ranked = prefix_sums(hit, ["idx"], "chunk", [F.col("slot")], F.lit(1).cast("long"), "rank")
    ranked = ranked.withColumn("block", F.col("rank") % F.col("blocks")).withColumn("pass", F.expr("rank div blocks"))
    return ranked.where(F.col("pass") < max_passes).select("slot", "idx", "block", "pass")


def block_start(k: Column) -> Column:
    """The first word of block ``k``: the blocks with one word more are spread evenly."""
    return k * F.col("base") + F.floor(k * F.col("longer") / F.col("blocks")).cast("long")


def block_of(x: Column) -> Column:
    """The block that holds word ``x`` of the line: an estimate, put right by one where rounding asks for it."""
    near = F.floor(x / F.col("source_size") * F.col("blocks")).cast("long")
    return F.when(block_start(near) > x, near - 1).when(block_start(near + 1) <= x, near + 1).otherwise(near)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    min_blocks: int = MIN_BLOCKS,
    block_words: int = BLOCK_WORDS,
    max_passes: int = MAX_PASSES,
    extra: list[Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken (words, repeats counted).

    ``extra`` columns are carried along.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_CLASS + "+")).cast("long")
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), "source", size.alias("size"), *(extra or [])), "mix-sized")
    blocked = materialize(with_blocks(source_targets(sized, max_passes=max_passes), min_blocks, block_words), "mix-sources")
    uses = schedule(blocked, max_passes).groupBy("idx", "block").agg(F.count("*").alias("uses"))
    per_source = broadcast_if_small(blocked.select(F.col("source").alias("s"), "idx", "source_size", "target", "base", "longer", "blocks"))
    rows = sized.join(per_source, sized.source.eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit(17))).withColumn("piece", F.pmod("h", F.lit(PIECES)))
    laid = prefix_sums(rows, ["idx"], "piece", [F.col("h"), F.col("doc_id"), F.col("size")], F.col("size"), "start")
    names = [*sized.columns, "source_size", "target"]
    cut = laid.where("size > 0").withColumn("block", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("start") + F.col("size") - 1))))
    upto = F.least(block_start(F.col("block") + 1), F.col("start") + F.col("size"))
    overlap = upto - F.greatest(block_start(F.col("block")), F.col("start"))
    taken = cut.join(uses, ["idx", "block"], "left").withColumn("words", overlap * F.coalesce("uses", F.lit(0)))
    taken = taken.groupBy("idx", "start", *names).agg(F.sum("words").alias("taken")).select(*names, "taken")
    return taken.unionByName(laid.where("size = 0").select(*names, F.lit(0).cast("long").alias("taken")))


def resample(docs: DataFrame) -> DataFrame:
    """``docs`` mixed by whole documents: each row as often as the mix takes its words, rounded.

    Rows that repeat id, source and text share what the mix takes of them equally; rows without words are taken 0 times.
    """
    taken = mix(docs, extra=text_key()).groupBy("doc_id", "source", *KEY).agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("ratio"))
    marks = taken.select("doc_id", "source", *KEY, F.floor(F.col("ratio") + 0.5).cast("int").alias("__copies")).where(F.col("__copies") > 0)
    mixed = with_marks(docs, marks, "inner", {"doc_id": "doc_id", "source": "source"})
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
