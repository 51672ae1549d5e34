"""Gold: the union of all datasets' silver, filtered to instances of the wanted classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.schemas import GOLD_BOXES, GOLD_IMAGES, IMAGE_KEY, NOT_INSTANCE


def union_datasets(frames: list[DataFrame]) -> DataFrame:
    """All datasets of one schema as one frame; an empty list is an error."""
    if not frames:
        raise ValueError("gold needs at least one dataset")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def missing_datasets(specs: DataFrame, images: DataFrame) -> DataFrame:
    """Datasets with a specification and no silver."""
    return specs.select("dataset").distinct().join(images.select("dataset").distinct(), "dataset", "left_anti")


def gold_boxes(boxes: DataFrame, specs: DataFrame, class_names: list[str]) -> DataFrame:
    """Boxes of the wanted classes without a flag that says they are no instance, with role and licence columns.

    ``specs`` (dataset, split, role, license, commercial_use, image_root) has a row for each split and is broadcast.
    """
    wanted = boxes.where(F.col("class_name").isin(class_names) & X.is_instance(NOT_INSTANCE))
    out = wanted.join(F.broadcast(specs.select("dataset", "split", "role", "commercial_use")), ["dataset", "split"])
    return out.withColumn("image_id", X.image_id()).select(*GOLD_BOXES.names)


def gold_images(images: DataFrame, boxes: DataFrame, specs: DataFrame) -> DataFrame:
    """Images that hold a gold box; ``boxes`` is the result of :func:`gold_boxes`.

    A join with the distinct keys: a semi join would be pushed below a union of datasets, and a task would then sort the
    boxes once for each of them.
    """
    held = images.join(boxes.select(*IMAGE_KEY).distinct(), IMAGE_KEY)
    out = held.join(F.broadcast(specs), ["dataset", "split"])
    path = F.concat_ws("/", "image_root", "file_name")
    return out.withColumn("image_id", X.image_id()).withColumn("image_path", path).select(*GOLD_IMAGES.names)
