"""Readers of annotation JSON: COCO, LVIS, COCO-WholeBody, TextOCR and HierText.

A file is one JSON object, whose large lists and maps are read by several tasks (``json_documents``), each element with a
declared schema, so that the parser skips what is not named (polygons, key points). A path may also be a folder of such
files, each of some of the images. Positions of list entries are the boxes' order, which their ids hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.plans.scratch import small
from silverloom.sources.contract import Raw, corners, raw
from silverloom.sources.json_documents import open_documents

# The part boxes of a whole-body annotation with the flag that says each is there, in order.
PARTS = [("face_box", "face_valid", "face"), ("lefthand_box", "lefthand_valid", "left_hand"), ("righthand_box", "righthand_valid", "right_hand")]
#: Text of a word that cannot be read.
ILLEGIBLE = "."
WORD = "word"

IMAGE_FIELDS = "id:bigint,file_name:string,width:int,height:int,coco_url:string"
PART_FIELDS = ",".join(f"{box}:array<double>,{flag}:boolean" for box, flag, _ in PARTS)


def _coco(spark: SparkSession, path: str, annotation: str, file_name: Column) -> tuple[DataFrame, DataFrame]:
    """Images by position, and annotations with their position, class name and file name."""
    document = open_documents(spark, path)
    images = document.rows("images", IMAGE_FIELDS).select("id", file_name.alias("file_name"), "width", "height")
    categories = document.rows("categories", "id:bigint,name:string").select(F.col("id").alias("category_id"), F.col("name").alias("category")).distinct()
    annotations = document.rows("annotations", f"image_id:bigint,category_id:bigint,bbox:array<double>,{annotation}").drop("file")
    named = annotations.join(small(categories), "category_id", "left")
    unknown = F.raise_error(F.concat(F.lit("no category "), F.col("category_id").cast("string")))
    named = named.withColumn("category", F.when(F.col("category").isNotNull(), F.col("category")).otherwise(unknown.cast("string")))
    return images, named.join(images.select(F.col("id").alias("image_id"), "file_name"), "image_id")


def _placed(boxes: DataFrame, *order: str) -> DataFrame:
    """source_box_index: the place of a box among those of its file name."""
    return boxes.withColumn("source_box_index", F.row_number().over(Window.partitionBy("file_name").orderBy(*order)) - 1)


def url_file_name() -> Column:
    """The folder and file at the end of an image's URL."""
    return F.substring_index("coco_url", "/", -2)


def read_coco(spark: SparkSession, path: str, dataset: str, split: str, file_name: Column | None = None) -> Raw:
    images, found = _coco(spark, path, "iscrowd:int", F.col("file_name") if file_name is None else file_name)
    boxes = found.withColumns(corners(X.xywh_to_xyxy(F.col("bbox")))).withColumn("attr_is_group_of", F.col("iscrowd") != 0)
    return raw(images, _placed(boxes, "pos").withColumn("source_class", F.col("category")), dataset, split)


def read_lvis(spark: SparkSession, path: str, dataset: str, split: str) -> Raw:
    """As COCO without the crowd flag; a split's images lie in several folders, which the URL names."""
    images, found = _coco(spark, path, "id:bigint", url_file_name())
    boxes = found.withColumns(corners(X.xywh_to_xyxy(F.col("bbox"))))
    return raw(images, _placed(boxes, "pos").withColumn("source_class", F.col("category")), dataset, split)


def read_coco_wholebody(spark: SparkSession, path: str, dataset: str, split: str) -> Raw:
    """Each person's box, then the boxes of those parts that are annotated."""
    images, found = _coco(spark, path, f"iscrowd:int,{PART_FIELDS}", url_file_name())
    person = F.struct(F.col("bbox").alias("box"), F.col("category").alias("source_class"), (F.col("iscrowd") != 0).alias("attr_is_group_of"), F.lit(True).alias("there"))
    parts = [
        F.struct(F.col(box).alias("box"), F.lit(name).alias("source_class"), F.lit(None).cast("boolean").alias("attr_is_group_of"), X.is_set(flag).alias("there"))
        for box, flag, name in PARTS
    ]
    each = found.select("file_name", "pos", F.posexplode(F.array(person, *parts)).alias("part", "b")).select("file_name", "pos", "part", "b.*").where("there")
    return raw(images, _placed(each.withColumns(corners(X.xywh_to_xyxy(F.col("box")))), "pos", "part"), dataset, split)


def read_textocr(spark: SparkSession, path: str, dataset: str, split: str) -> Raw:
    """Words and images keyed by id; the entries of a map keep the order of the file."""
    document = open_documents(spark, path)
    images = document.entries("imgs", "width:int,height:int").select(F.concat("key", F.lit(".jpg")).alias("file_name"), "width", "height")
    words = document.entries("anns", "image_id:string,bbox:array<double>,utf8_string:string").select("pos", F.concat("image_id", F.lit(".jpg")).alias("file_name"), "bbox", "utf8_string")
    boxes = words.join(images.select("file_name"), "file_name", "left_semi").withColumns(corners(X.xywh_to_xyxy(F.col("bbox"))))
    boxes = boxes.withColumns({"attr_is_illegible": F.col("utf8_string") == ILLEGIBLE, "source_class": F.lit(WORD)})
    return raw(images, _placed(boxes, "pos"), dataset, split)


def read_hiertext(spark: SparkSession, path: str, dataset: str, split: str) -> Raw:
    """Words of paragraphs and lines as the bounds of their polygons; a file compressed with gzip is streamed by one task."""
    word = "struct<vertices:array<array<double>>,legible:boolean,handwritten:boolean,vertical:boolean>"
    fields = f"image_id:string,image_width:int,image_height:int,paragraphs:array<struct<lines:array<struct<words:array<{word}>>>>>"
    image = open_documents(spark, path).rows("annotations", fields).withColumn("file_name", F.concat("image_id", F.lit(".jpg")))
    images = image.select("file_name", F.col("image_width").alias("width"), F.col("image_height").alias("height"))
    lines = F.flatten(F.transform("paragraphs", lambda p: p.lines))
    words = image.select("file_name", F.posexplode(F.flatten(F.transform(lines, lambda x: x.words))).alias("source_box_index", "w"))
    boxes = words.withColumns(corners(X.polygon_bounds(F.col("w.vertices"))))
    flags = {"attr_is_illegible": ~F.col("w.legible"), "attr_is_handwritten": F.col("w.handwritten"), "attr_is_vertical": F.col("w.vertical")}
    return raw(images, boxes.withColumns(flags).withColumn("source_class", F.lit(WORD)), dataset, split)
