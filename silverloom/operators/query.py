"""Reads of gold: filters, shards, keyset pages, counts, releases and vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.functions import expr as X

# Rows of a page by default and at most.
DEFAULT_LIMIT, MAX_LIMIT = 1_000, 100_000
EVAL_ROLES = ["val", "test"]
KEYS = {"images": "image_id", "boxes": "box_id", "embeddings": "image_id", "crop_embeddings": "box_id"}


@dataclass(frozen=True)
class Selection:
    """Which rows of gold are wanted; None is no restriction."""

    dataset: tuple[str, ...] | None = None
    split: tuple[str, ...] | None = None
    role: tuple[str, ...] | None = None
    class_name: tuple[str, ...] | None = None
    commercial_use: bool | None = None
    shard: int | None = None
    num_shards: int | None = None
    release: int | str | None = None

    def __post_init__(self) -> None:
        if (self.shard is None) != (self.num_shards is None):
            raise ValueError("shard and num_shards belong together")
        if self.num_shards is not None and not 0 <= self.shard < self.num_shards:
            raise ValueError(f"shard {self.shard} is not below num_shards {self.num_shards}")

    @classmethod
    def of(cls, **parameters: object) -> Selection:
        if unknown := sorted(set(parameters) - set(cls.__dataclass_fields__)):
            raise ValueError(f"unknown parameters {unknown}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in parameters.items()})

    def may_return_eval(self) -> bool:
        return self.role is None or bool(set(self.role) & set(EVAL_ROLES))


def resolve_release(selection: Selection, table: str, releases: list[int]) -> int | None:
    """The release to read evaluation rows from, or None for the draft.

    A selection that can return evaluation rows names a release or 'draft'; vectors come from the draft alone.
    """
    wanted = selection.release
    if wanted is None:
        if selection.may_return_eval() and table in ("images", "boxes"):
            raise ValueError("name a release number or 'draft' to read evaluation rows")
        return None
    if wanted == "draft":
        return None
    if table not in ("images", "boxes"):
        raise ValueError("vectors are read from the draft only")
    if int(wanted) not in releases:
        raise LookupError(f"no release {wanted}")
    return int(wanted)


def select_rows(table: DataFrame, selection: Selection) -> DataFrame:
    """The rows of a gold table; filters on dataset and split prune the partitions that are read."""
    out = table
    for name in ("dataset", "split", "role", "class_name"):
        wanted = getattr(selection, name)
        if wanted is not None and name in table.columns:
            out = out.where(F.col(name).isin(list(wanted)))
    if selection.commercial_use is not None:
        out = out.where(F.col("commercial_use") == selection.commercial_use)
    if selection.num_shards is not None:
        out = out.where(X.shard_of("image_id", selection.num_shards) == selection.shard)
    return out


def images_of_classes(images: DataFrame, boxes: DataFrame, class_names: tuple[str, ...]) -> DataFrame:
    """Images that hold a box of one of the classes."""
    return images.join(boxes.where(F.col("class_name").isin(list(class_names))).select("image_id"), "image_id", "left_semi")


def checked_limit(limit: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit {limit} is not within 1 and {MAX_LIMIT}")


def page(rows: DataFrame, key: str, after: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The next ``limit`` rows by key after the key ``after``; each task keeps a page at most."""
    checked_limit(limit)
    out = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return out.orderBy(key).limit(limit)


def next_after(ids: DataFrame, key: str, limit: int) -> str | None:
    """The key to continue after, or None when the page was not full; ``ids`` is the page of keys, not of vectors."""
    got = ids.agg(F.count("*").alias("n"), F.max(key).alias("last")).first()
    return got["last"] if got["n"] == limit else None


def with_vectors(ids: DataFrame, vectors: DataFrame, match: list[str], limit: int = MAX_LIMIT) -> DataFrame:
    """Vectors of a page of at most ``limit`` ids, which is broadcast; vectors are only read then."""
    return vectors.join(F.broadcast(ids.limit(limit)), match)


def release_view(gold: DataFrame, release: DataFrame) -> DataFrame:
    """Training rows of gold and the evaluation rows of a frozen release."""
    return gold.where(~F.col("role").isin(EVAL_ROLES)).unionByName(release.where(F.col("role").isin(EVAL_ROLES)))


def eval_rows(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("role").isin(EVAL_ROLES))


def row_digests(table: DataFrame, by: list[str]) -> DataFrame:
    """Rows and an order-free digest of their content for each group.

    Each row's SHA-256 is cut into four 60-bit numbers whose sums make the digest, so equal row sets have equal digests
    however the files were written. The sums are exact.
    """
    columns = sorted(table.columns)
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    parts = [F.conv(F.substring("sha", 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(4)]
    hashed = table.select(*by, F.sha2(text, 256).alias("sha")).select(*by, *[p.alias(f"part_{i}") for i, p in enumerate(parts)])
    # the halves of 30 bits are summed as integers, which is faster than sums of decimals and as exact
    high = lambda c: F.sum(F.shiftright(c, 30)).cast("decimal(20,0)") * F.lit(1 << 30).cast("decimal(10,0)")
    low = lambda c: F.sum(F.col(c).bitwiseAND((1 << 30) - 1)).cast("decimal(20,0)")
    sums = [(high(f"part_{i}") + low(f"part_{i}")).cast("string") for i in range(4)]
    return hashed.groupBy(*by).agg(F.count("*").alias("num_rows"), F.concat_ws("-", *sums).alias("digest"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, with the side's name; none when both are equal as sets of rows."""
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
