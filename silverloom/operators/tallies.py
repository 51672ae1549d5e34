"""Counts and profiles of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edges of the box-size histogram: square roots of the area, in pixels.
SIZE_EDGES = [8, 16, 32, 64, 128, 256, 512]


def class_tally(boxes: DataFrame) -> DataFrame:
    """Boxes and mean area by class."""
    return boxes.groupBy("class_name").agg(F.count("*").alias("num_boxes"), F.avg(F.col("w") * F.col("h")).alias("mean_area"))


def class_role_counts(boxes: DataFrame) -> DataFrame:
    return boxes.groupBy("dataset", "role", "class_name").agg(F.count("*").alias("num_boxes"))


def split_counts(images: DataFrame) -> DataFrame:
    return images.groupBy("dataset", "split").agg(F.count("*").alias("num_images"))


def size_histogram(boxes: DataFrame) -> DataFrame:
    """Boxes by dataset and bucket of the square root of their area: 0 below the first edge."""
    side = F.sqrt(F.col("w") * F.col("h"))
    bucket = sum(((side >= e).cast("int") for e in SIZE_EDGES), F.lit(0))
    return boxes.groupBy("dataset", bucket.alias("bucket")).agg(F.count("*").alias("num_boxes"))


def filled_attributes(boxes: DataFrame) -> DataFrame:
    """How many boxes of a dataset fill each attribute: dataset, attribute, num_boxes."""
    attributes = [c for c in boxes.columns if c.startswith("attr_")]
    wide = boxes.groupBy("dataset").agg(*[F.count(c).alias(c) for c in attributes])
    return wide.unpivot("dataset", attributes, "attribute", "num_boxes")


def category_index(boxes: DataFrame) -> DataFrame:
    """Distinct source classes of each dataset in order, numbered from 0."""
    from pyspark.sql import Window

    names = boxes.select("dataset", "source_class").distinct()
    place = F.row_number().over(Window.partitionBy("dataset").orderBy("source_class")) - 1
    return names.withColumn("category_index", place.cast("int"))


def run_metrics(images: DataFrame, boxes: DataFrame, dropped: DataFrame, event_files: DataFrame, wanted: DataFrame, cache: DataFrame, match: list[str]) -> DataFrame:
    """One row: images, boxes, corrected and added boxes, dropped boxes, event files, and vectors reused and still to make.

    ``event_files`` has a row for each file of the run; ``wanted`` rows have their vector in ``cache`` by ``match`` or not.
    """
    a = images.agg(F.count("*").alias("num_images"))
    b = boxes.agg(
        F.count("*").alias("num_boxes"),
        F.count_if(F.col("is_class_corrected") | F.col("is_geometry_corrected")).alias("num_corrected"),
        F.count_if(F.col("origin") == "studio").alias("num_added"),
    )
    c = dropped.agg(F.count("*").alias("num_dropped"))
    d = event_files.agg(F.count("*").alias("num_event_files"))
    met = wanted.select(*match).join(cache.select(*match, F.lit(1).alias("__held")).dropDuplicates(match), match, "left")
    e = met.agg(F.count("__held").alias("num_reused_vectors"), (F.count("*") - F.count("__held")).alias("num_missing_vectors"))
    return a.join(b, how="cross").join(c, how="cross").join(d, how="cross").join(e, how="cross")  # one row each


def manifest_rows(manifests: DataFrame, column: str = "rows") -> DataFrame:
    """One row: the sum of the row counts that manifests state."""
    return manifests.agg(F.coalesce(F.sum(column), F.lit(0)).alias("num_rows"))
