"""Table schemas, the class registry and dataset specifications."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The shared vocabulary by class id, and the attributes that a source may know of a box.
CLASSES = ["face", "license_plate", "head", "person", "text", "other"]
UNKNOWN_CLASS = "other"
GRADES = ["attr_blur", "attr_expression", "attr_illumination", "attr_occlusion", "attr_pose"]
FLAGS = ["attr_invalid", "attr_is_group_of", "attr_is_depiction", "attr_is_illegible", "attr_is_handwritten", "attr_is_vertical"]
#: A box with one of these set is no instance of its class and stays out of gold.
NOT_INSTANCE = ["attr_is_group_of", "attr_is_depiction", "attr_invalid"]
ROLES = ["train", "val", "test"]

IMAGE_KEY = ["dataset", "split", "file_name"]


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<float>": T.ArrayType(T.FloatType()),
}


def struct(ddl: str) -> T.StructType:
    """A schema from names and types, where ``!`` after a type marks a column that is never null; needs no session."""
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_ATTRS = ", ".join([*(f"{g} int" for g in GRADES), *(f"{f} boolean" for f in FLAGS)])
_KEPT_ATTRS = ", ".join([*(f"{g} int" for g in GRADES), *(f"{f} boolean" for f in FLAGS if f not in NOT_INSTANCE)])

RAW_IMAGES = struct("dataset string!, split string!, file_name string!, width int!, height int!")
RAW_BOXES = struct(
    "dataset string!, split string!, file_name string!, source_box_index int!, source_class string, xmin double!, ymin double!, xmax double!, ymax double!, confidence double, " + _ATTRS
)
SILVER_IMAGES = RAW_IMAGES
SILVER_BOXES = struct(
    "dataset string!, split string!, file_name string!, box_id string!, box_index int!, class_id int!, class_name string!, source_class string, x double!, y double!, w double!, h double!, confidence double, "
    + _ATTRS
    + ", origin string!, is_class_corrected boolean!, is_geometry_corrected boolean!"
)
EVENTS = struct(
    "dataset string!, split string!, file_name string!, box_id string!, log_sequence bigint!, is_deleted boolean!, label_name string, x double, y double, w double, h double"
)
EMBEDDINGS = struct("dataset string!, split string!, file_name string!, image_id string!, embedding array<float>!")
CROP_EMBEDDINGS = struct(
    "dataset string!, split string!, file_name string!, box_id string!, box_index int!, crop_x int!, crop_y int!, crop_width int!, crop_height int!, embedding array<float>!"
)
GOLD_IMAGES = struct(
    "image_id string!, dataset string!, split string!, role string!, file_name string!, width int!, height int!, image_path string!, license string!, commercial_use boolean!"
)
GOLD_BOXES = struct(
    "box_id string!, image_id string!, dataset string!, split string!, role string!, file_name string!, class_id int!, class_name string!, source_class string, x double!, y double!, w double!, h double!, confidence double, "
    + _KEPT_ATTRS
    + ", origin string!, is_class_corrected boolean!, is_geometry_corrected boolean!, commercial_use boolean!"
)


@dataclass(frozen=True)
class TableSpec:
    """A table's name, schema and key; the key's columns exist and are never null."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]

    def __post_init__(self) -> None:
        for column in self.key:
            if column not in self.schema.names or self.schema[column].nullable:
                raise ValueError(f"{self.name}: key column {column} is missing or nullable")


TABLES = {
    t.name: t
    for t in [
        TableSpec("silver.images", SILVER_IMAGES, ("dataset", "split", "file_name")),
        TableSpec("silver.boxes", SILVER_BOXES, ("box_id",)),
        TableSpec("silver.embeddings", EMBEDDINGS, ("image_id",)),
        TableSpec("silver.crop_embeddings", CROP_EMBEDDINGS, ("box_id",)),
        TableSpec("gold.images", GOLD_IMAGES, ("image_id",)),
        TableSpec("gold.boxes", GOLD_BOXES, ("box_id",)),
    ]
}


@dataclass(frozen=True)
class DatasetSpec:
    """What is known of a dataset besides its files."""

    name: str
    license: str
    commercial_use: bool
    split_roles: dict[str, str]
    category_map: dict[str, str] = field(default_factory=dict)
    default_class: str = UNKNOWN_CLASS
    image_root: str = ""

    def __post_init__(self) -> None:
        unknown = sorted({*self.category_map.values(), self.default_class} - set(CLASSES))
        if unknown:
            raise ValueError(f"{self.name} maps onto unknown classes {unknown}")
        if bad := sorted(set(self.split_roles.values()) - set(ROLES)):
            raise ValueError(f"{self.name} has unknown roles {bad}")


def spec_frames(spark: SparkSession, specs: list[DatasetSpec]) -> tuple[DataFrame, DataFrame]:
    """The specifications as two small frames: (dataset, license, commercial_use, image_root, split, role) and

    (dataset, source_key, class_name), where a null key is the default class.
    """
    splits = [(s.name, s.license, s.commercial_use, s.image_root, split, role) for s in specs for split, role in s.split_roles.items()]
    maps = [(s.name, k.lower(), v) for s in specs for k, v in s.category_map.items()] + [(s.name, None, s.default_class) for s in specs]
    return (
        spark.createDataFrame(splits, "dataset string, license string, commercial_use boolean, image_root string, split string, role string"),
        spark.createDataFrame(maps, "dataset string, source_key string, class_name string"),
    )


def class_id(name: Column) -> Column:
    """The registry's id of a class name; null for any other name."""
    out = F.when(name == CLASSES[0], 0)
    for i, c in enumerate(CLASSES[1:], 1):
        out = out.when(name == c, i)
    return out.cast("int")
