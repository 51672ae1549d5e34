"""Data-quality checks. Each returns a frame of problems; an empty one means the check passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.plans.scratch import small
from silverloom.schemas import CLASSES, IMAGE_KEY, struct

TOLERANCE = 1e-6


def box_problems(boxes: DataFrame, images: DataFrame) -> DataFrame:
    """(box_id, problem): the first rule that a box breaks."""
    sized = images.select(*IMAGE_KEY, "width", "height", F.lit(True).alias("has_image"))
    own = (
        F.when(~F.col("class_name").isin(CLASSES), "unknown class")
        .when((F.col("w") <= 0) | (F.col("h") <= 0), "no area")
        .when((F.col("x") < -TOLERANCE) | (F.col("y") < -TOLERANCE), "starts outside the image")
        .when((F.col("x") + F.col("w") > F.col("width") + TOLERANCE) | (F.col("y") + F.col("h") > F.col("height") + TOLERANCE), "ends outside the image")
    )
    # an id and what is wrong with its row is all that meets by id
    met = boxes.join(sized, IMAGE_KEY, "left").select("box_id", "has_image", own.alias("own"))
    met = met.withColumn("copies", F.count("*").over(Window.partitionBy("box_id")))
    problem = F.when(F.col("has_image").isNull(), "no image row").when(F.col("copies") > 1, "repeated box id").otherwise(F.col("own"))
    return met.select("box_id", problem.alias("problem")).where("problem is not null")


def repeated(df: DataFrame, key: str, problem: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit(problem).alias("problem"))


def gold_key_problems(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """(id, problem): image ids and box ids that repeat, and boxes whose image is not in gold."""
    lost = boxes.join(images.select("image_id"), "image_id", "left_anti").select(F.col("box_id").alias("id"), F.lit("box without image").alias("problem"))
    return repeated(images, "image_id", "repeated image id").unionByName(repeated(boxes, "box_id", "repeated box id")).unionByName(lost)


def missing_files(declared: DataFrame, listed: DataFrame, key: str = "path") -> DataFrame:
    """Declared names that a listing does not hold (images that do not exist, incomplete copies)."""
    return declared.select(key).distinct().join(listed.select(key), key, "left_anti")


def orphan_events(latest: DataFrame, silver: DataFrame) -> DataFrame:
    """Live latest events of boxes that silver does not hold."""
    return latest.where(~F.col("is_deleted")).join(silver.select("box_id"), "box_id", "left_anti").select(*IMAGE_KEY, "box_id")


def unknown_labels(latest: DataFrame) -> DataFrame:
    named = latest.where(~F.col("is_deleted") & F.col("label_name").isNotNull())
    return named.where(~F.lower("label_name").isin(CLASSES)).select("label_name").distinct()


def chain_breaks(files: DataFrame) -> DataFrame:
    """Event files that do not follow their predecessor: (chain_id, sequence, event_file_id, problem).

    ``files``: chain_id, sequence, event_file_id, parent_event_file_id, after_log_sequence, last_log_sequence.
    """
    chain = Window.partitionBy("chain_id").orderBy("sequence")
    before = lambda c: F.lag(c).over(chain)
    met = files.withColumns({"p_id": before("event_file_id"), "p_sequence": before("sequence"), "p_last": before("last_log_sequence")})
    expected = F.coalesce(F.col("p_sequence") + 1, F.lit(1))
    problem = (
        F.when(F.col("sequence") != expected, "sequence")
        .when(~F.col("parent_event_file_id").eqNullSafe(F.col("p_id")), "parent")
        .when(F.col("p_last").isNotNull() & (F.col("after_log_sequence") != F.col("p_last")), "after")
    )
    return met.select("chain_id", "sequence", "event_file_id", problem.alias("problem")).where("problem is not null")


def changed_event_files(stored: DataFrame, listed: DataFrame) -> DataFrame:
    """Stored files of the listed chain that the listing now lacks or shows otherwise (event_file_id, sha256)."""
    chains = listed.select("chain_id").distinct()
    mine = stored.join(small(chains), "chain_id", "left_semi").select("chain_id", "sequence", F.col("event_file_id").alias("stored_id"), F.col("sha256").alias("stored_sha"))
    both = mine.join(listed.select("chain_id", "sequence", "event_file_id", "sha256"), ["chain_id", "sequence"], "left")
    same = F.struct("stored_id", "stored_sha").eqNullSafe(F.struct(F.col("event_file_id"), F.col("sha256")))
    return both.where(~same).select("chain_id", "sequence", "stored_id", F.when(F.col("event_file_id").isNull(), "gone").otherwise("changed").alias("problem"))


def file_mismatches(found: DataFrame, pins: DataFrame) -> DataFrame:
    """Published files whose size or checksum is not the pinned one, or that are missing: (path, problem)."""
    both = pins.select("path", F.col("size").alias("p_size"), F.col("checksum").alias("p_checksum")).join(found, "path", "left")
    problem = F.when(F.col("size").isNull(), "missing").when(F.col("size") != F.col("p_size"), "size").when(F.col("checksum") != F.col("p_checksum"), "checksum")
    return both.select("path", problem.alias("problem")).where("problem is not null")


def incomplete_vectors(wanted: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Keys of ``wanted`` that have no vector."""
    return wanted.select(key).distinct().join(written.select(key), key, "left_anti")


def first_examples(problems: DataFrame, n: int = 10) -> DataFrame:
    return problems.orderBy(*problems.columns).limit(n)


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df``, failing at run time on a null in one of ``columns``."""

    def sure(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(F.lit(f"null in column {name}")).cast(df.schema[name].dataType)).alias(name)

    return df.select(*[sure(c) if c in columns else F.col(c) for c in df.columns])


def enforce(df: DataFrame, schema: object) -> DataFrame:
    """Columns, order and types of ``schema`` (a StructType or DDL with ``!``), and its not-null columns checked."""
    schema = struct(schema) if isinstance(schema, str) else schema
    if lacking := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"missing columns {lacking}")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return not_null(typed, [f.name for f in schema if not f.nullable])


