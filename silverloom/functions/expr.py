"""Scalar expressions: ids, geometry, predicates, vectors, paths and checksums. All stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A box side below this is no side.
LEAST_SIDE = 1e-6
#: The least norm that a vector is divided by: the float32 machine epsilon.
LEAST_NORM = 1.1920929e-07


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ids


def uuid_text(text: Column) -> Column:
    """The MD5 of a text in the form of a UUID."""
    return F.regexp_replace(F.md5(text.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


#: What stands before a text that is no id in hex, so that it is longer than the 16 bytes of one.
_TEXT = b"text of no digest"


def packed_id(c: Column | str) -> Column:
    """A text id as bytes for a shuffle: the 16 bytes of a digest as :func:`uuid_text` writes it, other texts as they are."""
    digest = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    text = F.concat(F.lit(_TEXT), col(c).cast("binary"))
    return F.when(col(c).rlike(digest) & (F.length(col(c)) == 36), F.unhex(F.replace(col(c), F.lit("-"), F.lit("")))).otherwise(text)


def unpacked_id(c: Column | str) -> Column:
    """The text of :func:`packed_id`."""
    digits = F.lower(F.hex(col(c)))
    digest = F.concat_ws("-", *[F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    text = F.substring(col(c), len(_TEXT) + 1, 1 << 30).cast("string")
    return F.when(col(c).isNull(), None).when(F.octet_length(col(c)) == 16, digest).otherwise(text)


def image_id(dataset: Column | str = "dataset", split: Column | str = "split", file_name: Column | str = "file_name") -> Column:
    return uuid_text(F.concat_ws("/", dataset, split, file_name))


def box_id(dataset: Column | str = "dataset", split: Column | str = "split", file_name: Column | str = "file_name", index: Column | str = "source_box_index") -> Column:
    """Identifies a box by its position in the source, taken before any box is dropped."""
    return uuid_text(F.concat(F.concat_ws("/", dataset, split, file_name), F.lit("#"), col(index).cast("string")))


def shard32(id_text: Column | str) -> Column:
    """The first 32 bits of an id, unsigned."""
    return F.conv(F.substring(col(id_text), 1, 8), 16, 10).cast("bigint")


def shard_of(id_text: Column | str, num_shards: int) -> Column:
    return shard32(id_text) % F.lit(num_shards)


# geometry


def clip(value: Column, most: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), most.cast("double"))


def has_area(w: Column, h: Column) -> Column:
    return (w >= LEAST_SIDE) & (h >= LEAST_SIDE)


def half_up(x: Column | str) -> Column:
    """Round to whole pixels, halves up."""
    return F.floor(col(x) + 0.5).cast("double")


def crop_start(x: Column | str, w: Column | str) -> Column:
    """The crop's first pixel: halves to even, and never past the box's last pixel."""
    return F.least(F.rint(col(x)), F.ceil(col(x) + col(w)).cast("double") - 1).cast("int")


def crop_side(w: Column | str) -> Column:
    return F.greatest(F.lit(1.0), F.rint(col(w))).cast("int")


def clamp_crop(x: Column, w: Column, size: Column) -> tuple[Column, Column]:
    """First and last-plus-one pixel of a crop within an image side; outside keeps the nearest pixel, w < 0 is the whole."""
    whole = w < 0
    start = F.when(whole, F.lit(0)).otherwise(F.least(F.greatest(x, F.lit(0)), size - 1))
    end = F.when(whole, size).otherwise(F.greatest(F.least(x + w, size), start + 1))
    return start, end


def xywh_to_xyxy(box: Column) -> list[Column]:
    at = lambda i: F.get(box, F.lit(i)).cast("double")
    return [at(0), at(1), at(0) + at(2), at(1) + at(3)]


def cxcywh_to_xyxy(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    """Normalised centre and size to pixel corners."""
    return [(cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height]


def polygon_bounds(vertices: Column) -> list[Column]:
    """Bounding box of an array of [x, y] pairs."""
    xs = F.transform(vertices, lambda v: F.get(v, F.lit(0)).cast("double"))
    ys = F.transform(vertices, lambda v: F.get(v, F.lit(1)).cast("double"))
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


# predicates


def is_set(flag: Column | str) -> Column:
    return F.coalesce(col(flag), F.lit(False))


def is_instance(flags: list[str]) -> Column:
    return ~reduce(lambda a, b: a | b, [is_set(f) for f in flags])


def differs(left: list[Column], right: list[Column]) -> Column:
    """Null-safe inequality of two tuples."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


# vectors


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def l2_normalize(vector: Column) -> Column:
    return F.transform(F.array(F.greatest(norm(vector), F.lit(LEAST_NORM))), lambda n: F.transform(vector, lambda x: (x.cast("double") / n).cast("float")))[0]


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; of unit vectors it is their cosine."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def checked_dim(vector: Column, dim: int) -> Column:
    """The vector, or an error when its length is another one."""
    return F.when(F.size(vector) == dim, vector).otherwise(F.raise_error(F.concat(F.lit(f"expected {dim} components, got "), F.size(vector).cast("string"))))


# paths, URLs and checksums


def is_absolute(path: Column) -> Column:
    return path.rlike(r"^(/|[a-z][a-z0-9+.-]*://)")


def rebase(path: Column, root: Column) -> Column:
    """A relative key under ``root``; absolute paths and URLs stay."""
    return F.when(is_absolute(path), path).otherwise(F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), path))


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]+$", "")


def unpacked_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.(tar\.gz|tgz|zip|tar)$", "")


def sharded_file_name(image: Column, split: Column) -> Column:
    """Training images are kept by the first character of their id, others are not."""
    return F.when(split == "train", F.concat(F.lit("train_"), F.substring(image, 1, 1), F.lit("/"), image, F.lit(".jpg"))).otherwise(F.concat(image, F.lit(".jpg")))


def host_kind(url: Column) -> Column:
    """'local' for a path, else the scheme of the URL."""
    return F.when(url.rlike(r"^[a-z][a-z0-9+.-]*://"), F.regexp_extract(url, r"^([a-z][a-z0-9+.-]*)://", 1)).otherwise(F.lit("local"))


def redact_url(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def md5_base64(content: Column) -> Column:
    return F.base64(F.unhex(F.md5(content)))
