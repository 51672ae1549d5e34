"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space as the contracts name it: space and tab to carriage return.
WS = " \t\n\x0b\f\r"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a new one where that is unset (local runs)."""
    sc = spark.sparkContext
    set_to = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not set_to:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        set_to = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(set_to)
    return set_to.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_texts(df: DataFrame, rows: int = 500) -> DataFrame:
    """``df``, its session set so that Python workers get at most ``rows`` rows at a time: rows hold whole texts.

    Spark reads the setting when a job runs, which is after the caller has its DataFrame, so it stays set.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, rows)
    return df


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Mark a materialised side for broadcast when it has at most ``rows`` rows; beyond that the join is shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def join_counted(df: DataFrame, counted: DataFrame, on: str | list[str], how: str = "inner", most: int = 100_000) -> DataFrame:
    """Join ``counted`` (one row for each ``on``, with ``n``, its rows in ``df``; materialised) to ``df``; n is dropped.

    No task meets all rows of one value: values with at least total / ``most`` rows, of which there can be at most
    ``most``, come by broadcast; the rest is shuffled.
    """
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    many = -(-total // most)
    if many <= 1:
        return df.join(F.broadcast(counted.drop("n")), on, how)
    hot, cold = counted.where(F.col("n") >= many).drop("n"), counted.where(F.col("n") < many).drop("n")
    rest = df.join(F.broadcast(hot.select(on)), on, "left_anti")
    return df.join(F.broadcast(hot), on).unionByName(rest.join(cold, on, how))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows of the smallest hash of ``key``: a bounded sample that any rerun draws again.

    Rows above a hash that leaves about twice as many are dropped first, so that what is sorted does not grow.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    total = df.count()
    if total > 4 * n:
        df = df.where(spread < (1 << 40) * 2 * n // total)
    return df.orderBy(spread, key).limit(n)


def prefix_sums(
    df: DataFrame, group: list[str], piece: str, order: list[Column], value: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its group, rows being in (piece, order).

    Two levels, so that no task holds a whole group: totals by (group, piece), their running sum within the group, and
    a window within each piece. ``piece`` must split every group into a bounded number of parts.
    """
    keys = [*group, piece]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return placed.join(offsets, keys).withColumn(name, F.col("__offset") + F.col("__within")).drop("__offset", "__within")


def text_key(text: str = "text") -> list[Column]:
    """Columns that name a text: two hashes and its length; null texts share one name."""
    return [F.xxhash64(text).alias("key_h"), F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(-1)).alias("key_c"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("key_n")]


KEY = ["key_h", "key_c", "key_n"]


def with_marks(docs: DataFrame, marks: DataFrame, how: str, by: dict[str, str], rows: int = 300_000) -> DataFrame:
    """Join ``marks`` (KEY, other columns and new ones) to ``docs`` on the text's name and, null-safely, on ``by``.

    ``by`` maps columns of ``docs`` to columns of ``marks``. Up to ``rows`` marks are broadcast, more are shuffled. The
    columns of ``docs`` stay as they are; the new ones of ``marks`` must be named with a leading ``__``.
    """
    named = marks.select(*[F.col(c).alias(f"__{c}") for c in [*KEY, *by.values()]], *[c for c in marks.columns if c not in [*KEY, *by.values()]])
    named = broadcast_if_small(materialize(named, "marks"), rows)
    keyed = docs.withColumns({f"__d{k}": c for k, c in enumerate(text_key())})
    on = F.lit(True)
    for k, c in enumerate(KEY):
        on = on & (keyed[f"__d{k}"] == named[f"__{c}"])
    for mine, theirs in by.items():
        on = on & keyed[mine].eqNullSafe(named[f"__{theirs}"])
    out = keyed.join(named, on, how)
    return out.drop(*[f"__d{k}" for k in range(len(KEY))], *[f"__{c}" for c in [*KEY, *by.values()]])
