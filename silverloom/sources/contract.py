"""The raw contract that all readers fill: one frame of images and one of boxes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.schemas import FLAGS, GRADES, NOT_INSTANCE, RAW_BOXES, RAW_IMAGES


@dataclass(frozen=True)
class Raw:
    images: DataFrame
    boxes: DataFrame

    def instances(self) -> DataFrame:
        """Boxes of single real instances: no groups, depictions or rejected regions."""
        from silverloom.functions.expr import is_instance

        return self.boxes.where(is_instance(NOT_INSTANCE))


def raw(images: DataFrame, boxes: DataFrame, dataset: str, split: str) -> Raw:
    """Frames in the contract's columns; attributes that a source does not know are null."""
    names = {"dataset": F.lit(dataset), "split": F.lit(split)}
    boxes = boxes.withColumns({c: F.lit(None).cast(RAW_BOXES[c].dataType) for c in [*GRADES, *FLAGS, "confidence"] if c not in boxes.columns})
    typed = lambda df, schema: df.withColumns(names).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return Raw(typed(images, RAW_IMAGES), typed(boxes, RAW_BOXES))


def corners(columns: list[Column]) -> dict[str, Column]:
    return dict(zip(["xmin", "ymin", "xmax", "ymax"], columns, strict=True))


def union(parts: list[Raw]) -> Raw:
    """Several splits or datasets as one."""
    images, boxes = parts[0].images, parts[0].boxes
    for part in parts[1:]:
        images, boxes = images.unionByName(part.images), boxes.unionByName(part.boxes)
    return Raw(images, boxes)


def materialised_splits(declared: list[str], listed: DataFrame) -> list[str]:
    """Declared splits that a listing (column split) really holds, in their order; none is an error."""
    there = {r[0] for r in listed.select("split").where(F.col("split").isin(declared)).distinct().collect()}
    if not there:
        raise LookupError(f"none of the splits {declared} is there")
    return [s for s in declared if s in there]


def with_image_roots(labels: DataFrame, manifests: DataFrame, images_of: dict[str, str]) -> DataFrame:
    """Annotations of a source without images of its own, with the image_root of the source that has them.

    ``labels`` has a column dataset, ``manifests`` dataset and image_root; ``images_of`` names for each dataset the one
    whose images it describes. A dataset whose image source has no manifest is an error.
    """
    known = F.create_map(*[F.lit(x) for pair in images_of.items() for x in pair])
    rooted = labels.withColumn("__of", known[F.col("dataset")])
    roots = manifests.select(F.col("dataset").alias("__of"), "image_root")  # a row for each dataset
    met = rooted.join(F.broadcast(roots), "__of", "left")
    lost = F.raise_error(F.concat(F.lit("no manifest of the images of "), F.col("dataset"))).cast("string")
    return met.withColumn("image_root", F.when(F.col("image_root").isNotNull(), F.col("image_root")).otherwise(lost)).drop("__of")
