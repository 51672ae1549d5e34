"""Readers by format name, and layers by build."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from silverloom.schemas import TABLES
from silverloom.sources import json_sources, text_sources
from silverloom.sources.contract import Raw

READERS: dict[str, Callable[..., Raw]] = {
    "coco": json_sources.read_coco,
    "lvis": json_sources.read_lvis,
    "coco_wholebody": json_sources.read_coco_wholebody,
    "textocr": json_sources.read_textocr,
    "hiertext": json_sources.read_hiertext,
    "open_images": text_sources.read_open_images,
    "wider_face": text_sources.read_wider_face,
    "yolo": text_sources.read_yolo,
}


def read_source(spark: SparkSession, name: str, **arguments: object) -> Raw:
    """Read one split of a source into the raw contract."""
    if name not in READERS:
        raise LookupError(f"no reader {name}; there are {sorted(READERS)}")
    return READERS[name](spark, **arguments)


def read_table(spark: SparkSession, name: str, *paths: str) -> DataFrame:
    """Parquet folders of one layer table as one frame, by the table's schema and never by inference.

    Folders that write a column as ``dataset=...`` prune on it, each below its own path.
    """
    if not paths:
        raise ValueError("no paths to read")
    schema = TABLES[name].schema
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names) for path in paths])


def read_event_files(spark: SparkSession, schema: object, *paths: str) -> DataFrame:
    """Event files with the path each row came from."""
    return spark.read.schema(schema).parquet(*paths).select("*", "_metadata.file_path")
