"""Readers of annotation text: Open Images CSV, WIDER FACE blocks and YOLO label files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.plans.scratch import dealt, small
from silverloom.sources.byte_ranges import listed_files, read_whole
from silverloom.sources.contract import Raw, corners, raw

# Columns of a box CSV, and attributes of a block line by position after the four coordinates.
CSV_COLUMNS = "ImageID string, Source string, LabelName string, Confidence double, XMin double, XMax double, YMin double, YMax double, IsOccluded string, IsTruncated string, IsGroupOf string, IsDepiction string, IsInside string"
#: Bytes of a row of a box CSV, few rather than many.
CSV_ROW_BYTES = 100
LINE_ATTRIBUTES = ["attr_blur", "attr_expression", "attr_illumination", "attr_invalid", "attr_occlusion", "attr_pose"]


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a box CSV with their place in the file: splits of the file by their start, rows by their order within."""
    rows = spark.read.schema(CSV_COLUMNS).option("header", True).csv(path)
    return rows.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")).alias("place"))


def scattered_images(rows: DataFrame, key: str = "ImageID") -> DataFrame:
    """Images whose rows do not stand together in the file: (key, runs). ``rows`` needs ``place``."""
    # a run starts where the row before in the file is of another image; the ordering is by file splits
    file = Window.partitionBy(F.col("place.file_path"), F.col("place.file_block_start")).orderBy("place")
    starts = rows.withColumn("starts", ~F.lag(key).over(file).eqNullSafe(F.col(key)))
    edges = rows.groupBy(F.col("place.file_path").alias("file"), F.col("place.file_block_start").alias("block")).agg(F.min_by(key, "place").alias("first"), F.max_by(key, "place").alias("last"))
    # a run that goes over the edge of two splits counted twice; edges are a row for each split of a file
    joined = edges.withColumn("before", F.lag("last").over(Window.partitionBy("file").orderBy("block"))).where(F.col("before") == F.col("first"))
    over = joined.groupBy(F.col("first").alias(key)).agg(F.count("*").alias("over"))
    runs = starts.groupBy(key).agg(F.count_if("starts").alias("runs")).join(over, key, "left")
    return runs.select(key, (F.col("runs") - F.coalesce("over", F.lit(0))).alias("runs")).where("runs > 1")


def read_open_images(spark: SparkSession, path: str, sizes: DataFrame, dataset: str, split: str) -> Raw:
    """Normalised boxes scaled by the size of their image; rows without an image are skipped.

    ``sizes``: file_name, width, height of the images that are there.
    """
    rows = csv_rows(spark, path).withColumn("file_name", X.sharded_file_name(F.col("ImageID"), F.lit(split)))
    size = listed_files(spark, path).agg(F.sum("length")).first()[0] or 0  # a sum
    met = dealt(rows, size // CSV_ROW_BYTES, "file_name").join(sizes.select("file_name", "width", "height"), "file_name")
    met = met.withColumn("source_box_index", F.row_number().over(Window.partitionBy("file_name").orderBy("place")) - 1)
    w, h = F.col("width"), F.col("height")
    boxes = met.withColumns(corners([F.col("XMin") * w, F.col("YMin") * h, F.col("XMax") * w, F.col("YMax") * h]))
    flags = {"attr_is_group_of": F.col("IsGroupOf") == "1", "attr_is_depiction": F.col("IsDepiction") == "1"}
    boxes = boxes.drop("Confidence").withColumns(flags).withColumn("source_class", F.col("LabelName"))
    named = met.select("file_name", "width", "height").distinct()
    return raw(named, boxes, dataset, split)


def _number(text: Column) -> Column:
    return text.cast("double").cast("int")


def read_wider_face(spark: SparkSession, path: str, sizes: DataFrame, dataset: str, split: str) -> Raw:
    """Blocks of a file name, a count, and as many box lines (one line of zeros follows a count of zero).

    A name is a line that is not of numbers, and holds for the lines up to the next one. A file is read in splits, as any
    text: each says how many lines it has and where its last name stands, that is summed and carried over the splits (a row
    for each), and within a split a window numbers the lines and carries names on. So no task holds a file.
    """
    split = ["file", "start"]
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"), F.trim(F.regexp_replace("value", "\r$", "")).alias("line"))
    text = text.where("line <> ''")
    is_name = ~F.col("line").rlike(r"^[-+.\d\s]+$")
    within = Window.partitionBy(*split).orderBy("row")
    numbered = text.withColumn("n", F.row_number().over(within)).withColumn("name", F.when(is_name, F.struct("n", "line")))
    splits = numbered.groupBy(*split).agg(F.count("*").alias("lines"), F.max("name").alias("last"))  # a row for each split of a file
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("lines_before", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    placed = F.when(F.col("last").isNotNull(), F.struct((F.col("last.n") + F.col("lines_before")).alias("n"), F.col("last.line").alias("line")))
    splits = splits.withColumn("carried", F.last(placed, ignorenulls=True).over(before)).select(*split, "lines_before", "carried")
    met = numbered.join(small(splits), split)
    own = F.last("name", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    met = met.withColumn("own", own).withColumn("of", F.when(F.col("own").isNotNull(), F.struct((F.col("own.n") + F.col("lines_before")).alias("n"), F.col("own.line").alias("line"))).otherwise(F.col("carried")))
    lines = met.select("file", "line", F.col("of.line").alias("file_name"), F.col("of.n").alias("name_pos"), (F.col("n") + F.col("lines_before") - F.col("of.n")).alias("k"))
    block = Window.partitionBy("file", "name_pos")
    lines = lines.withColumn("count", _number(F.max(F.when(F.col("k") == 1, F.col("line"))).over(block)))
    lines = lines.where(F.col("k").between(2, F.col("count") + 1)).withColumn("v", F.split("line", r"\s+"))
    at = lambda i: _number(F.get("v", F.lit(i)))
    x, y, w, h = (at(i).cast("double") for i in range(4))
    boxes = lines.withColumns(corners([x, y, x + w, y + h])).withColumns({a: at(4 + i) for i, a in enumerate(LINE_ATTRIBUTES)})
    boxes = boxes.withColumns({"attr_invalid": F.col("attr_invalid") != 0, "source_box_index": F.col("k") - 2, "source_class": F.lit("face")})
    named = text.where(is_name).select(F.col("line").alias("file_name")).join(sizes.select("file_name", "width", "height"), "file_name")
    return raw(named, boxes, dataset, split)


def label_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of label files: stem (path below ``root`` without its suffix), pos, parts."""
    files = read_whole(listed_files(spark, root, "*.txt"))
    path = F.regexp_extract("path", f"{root.rstrip('/').split('/')[-1]}/(.*)$", 1)
    text = F.col("data").cast("string")
    return files.select(X.stem(path).alias("stem"), F.posexplode(F.split(text, "\r?\n")).alias("pos", "line")).select("stem", "pos", F.split(F.trim("line"), r"\s+").alias("parts"))


def read_yolo(spark: SparkSession, label_root: str, sizes: DataFrame, class_names: list[str], dataset: str, split: str, optional: bool = False, subdirs: list[str] | None = None) -> Raw:
    """A label file for each image: lines of class, centre and size, normalised.

    Short lines and unknown classes are skipped before boxes are numbered. A missing label file is an error unless
    ``optional``. ``sizes``: file_name, width, height.
    """
    images = sizes if subdirs is None else sizes.where(F.substring_index("file_name", "/", 1).isin(subdirs))
    images = images.withColumn("stem", X.stem(F.col("file_name")))
    lines = label_lines(spark, label_root)
    if not optional:
        lost = images.join(lines.select("stem"), "stem", "left_anti").select("file_name").take(1)
        if lost:
            raise FileNotFoundError(f"no label file for {lost[0][0]}")
    number = lambda i: F.get("parts", F.lit(i)).cast("double")
    kept = lines.where(F.size("parts") >= 5).withColumn("class_no", number(0).cast("int"))
    kept = kept.where(F.col("class_no").between(0, len(class_names) - 1))
    met = kept.join(images, "stem").withColumn("source_box_index", F.row_number().over(Window.partitionBy("file_name").orderBy("pos")) - 1)
    boxes = met.withColumns(corners(X.cxcywh_to_xyxy(number(1), number(2), number(3), number(4), F.col("width"), F.col("height"))))
    names = F.array(*map(F.lit, class_names))
    return raw(images, boxes.withColumn("source_class", F.get(names, F.col("class_no"))), dataset, split)
