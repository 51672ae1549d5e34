"""Raw boxes to silver: ids, shared classes, clipping, and new positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.schemas import FLAGS, GRADES, IMAGE_KEY, SILVER_BOXES, class_id


@dataclass(frozen=True)
class Normalized:
    """Silver boxes, and the boxes that were dropped with their reason."""

    boxes: DataFrame
    dropped: DataFrame


def with_classes(boxes: DataFrame, category_map: DataFrame) -> DataFrame:
    """Add class_name and class_id from source_class, ignoring case; unmapped names take the dataset's default.

    ``category_map`` (dataset, source_key, class_name) has a row for each mapped name of a dataset and one with a null
    key, so it is as small as the vocabularies and is broadcast.
    """
    named = category_map.where("source_key is not null").select("dataset", "source_key", F.col("class_name").alias("__mapped"))
    default = category_map.where("source_key is null").select("dataset", F.col("class_name").alias("__default"))
    keyed = boxes.withColumn("source_key", F.lower("source_class"))
    out = keyed.join(F.broadcast(named), ["dataset", "source_key"], "left").join(F.broadcast(default), "dataset", "left")
    out = out.withColumn("class_name", F.coalesce("__mapped", "__default")).withColumn("class_id", class_id(F.col("class_name")))
    return out.drop("source_key", "__mapped", "__default")


def clipped(boxes: DataFrame) -> DataFrame:
    """Corners (xmin, ymin, xmax, ymax) to x, y, w, h within the image; needs width and height."""
    x0, x1 = (X.clip(F.col(c), F.col("width")) for c in ("xmin", "xmax"))
    y0, y1 = (X.clip(F.col(c), F.col("height")) for c in ("ymin", "ymax"))
    return boxes.withColumns({"x": x0, "y": y0, "w": x1 - x0, "h": y1 - y0})


def renumbered(boxes: DataFrame, *order: str, key: tuple[str, ...] = ()) -> DataFrame:
    """box_index from 0 within each image; ``key`` are further columns that are the same for all boxes of an image."""
    place = F.row_number().over(Window.partitionBy(*key, *IMAGE_KEY).orderBy(*order)) - 1
    return boxes.withColumn("box_index", place.cast("int"))


def normalize(raw_boxes: DataFrame, images: DataFrame | None, category_map: DataFrame, key: tuple[str, ...] = ()) -> Normalized:
    """Silver boxes of raw boxes whose image is known.

    Boxes and images meet on the image key, and the window that renumbers uses the same key, so one shuffle of the boxes
    serves both. Without ``images``, the boxes hold width and height; ``key`` names columns that an image shares and by which
    they may be partitioned already, and then nothing is shuffled. The id holds the position in the source, so it survives whatever is dropped.
    """
    sized = raw_boxes if images is None else raw_boxes.join(images.select(*IMAGE_KEY, "width", "height"), IMAGE_KEY)
    placed = with_classes(clipped(sized), category_map).withColumn("box_id", X.box_id())
    fine = X.has_area(F.col("w"), F.col("h"))
    missing = [c for c in [*GRADES, *FLAGS, "confidence"] if c not in raw_boxes.columns]
    placed = placed.withColumns({c: F.lit(None).cast(SILVER_BOXES[c].dataType) for c in missing})
    silver = renumbered(placed.where(fine), "source_box_index", key=key)
    silver = silver.withColumns({"origin": F.lit("source"), "is_class_corrected": F.lit(False), "is_geometry_corrected": F.lit(False)})
    dropped = placed.where(~fine).select(*IMAGE_KEY, "box_id", F.lit("degenerate_box").alias("reason"))
    return Normalized(silver.select(*SILVER_BOXES.names), dropped)


def tally(dropped: DataFrame) -> DataFrame:
    """Dropped boxes by reason."""
    return dropped.groupBy("reason").agg(F.count("*").alias("num_boxes"))
