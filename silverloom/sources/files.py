"""Listings of binary files: images and their sizes, checksums, manifests."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.sources.byte_ranges import CHUNK, listed_files, open_file, ranges, spread

IMAGE_SUFFIXES = ["jpg", "jpeg", "png"]
#: Bytes of a file's head that hold its size in nearly every image, and the size of an upload part.
HEAD_BYTES, PART_BYTES = 65_536, 8 << 20


def listed_images(spark: SparkSession, root: str) -> DataFrame:
    """Images below ``root`` by relative path, case-insensitive in the suffix: file_name, path, length. No content is read."""
    named = listed_files(spark, root).withColumn("file_name", F.regexp_extract("path", f"{root.rstrip('/').split('/')[-1]}/(.*)$", 1))
    return named.where(F.lower("path").rlike(rf"\.({'|'.join(IMAGE_SUFFIXES)})$"))


def frame_size(read: Callable[[int, int], bytes]) -> tuple[int, int] | None:
    """Width and height from the header of a PNG or JPEG, or None; ``read`` gives at most so many bytes from a place.

    Segments of a JPEG before its frame are stepped over by their lengths, so what they hold is not read.
    """
    base, held = 0, read(0, HEAD_BYTES)
    if held[:8] == b"\x89PNG\r\n\x1a\n" and len(held) >= 24:
        return struct.unpack(">II", held[16:24])
    if held[:2] != b"\xff\xd8":
        return None
    at = 2
    while True:
        if at + 9 > base + len(held):
            base, held = at, read(at, HEAD_BYTES)
            if len(held) < 9:
                return None
        i = at - base
        if held[i] != 0xFF:
            at += 1
            continue
        marker = held[i + 1]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", held[i + 5 : i + 9])
            return width, height
        at += 2 if marker in (0xFF, 0x01) or 0xD0 <= marker <= 0xD9 else 2 + struct.unpack(">H", held[i + 2 : i + 4])[0]


def image_size(content: bytes) -> tuple[int, int] | None:
    """Width and height of a content that is there as a whole, or None."""
    return frame_size(lambda at, n: content[at : at + n])


def image_sizes(spark: SparkSession, root: str) -> DataFrame:
    """file_name, width, height of the images below ``root``; the pixels are not decoded. Unreadable files have nulls.

    A task opens each of its files and reads ``HEAD_BYTES`` of it, and where a JPEG's frame stands further on, as many
    from there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    sizes.append(frame_size(lambda at, n, file=file: file.read_at(n, at)) or (None, None))
            yield pa.RecordBatch.from_arrays([batch.column("file_name"), *(pa.array([s[i] for s in sizes], pa.int32()) for i in (0, 1))], names=["file_name", "width", "height"])

    return spread(listed_images(spark, root), "path").select("file_name", "path").mapInArrow(run, "file_name string, width int, height int")


def checksums(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``), size, sha256 and md5 (base64) of published files, each streamed by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sha, md5 = hashlib.sha256(), hashlib.md5()
                with open_file(row["path"]) as file:
                    while data := file.read(CHUNK):
                        sha.update(data)
                        md5.update(data)
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "size": row["length"], "sha256": sha.hexdigest(), "md5": base64.b64encode(md5.digest()).decode()}])

    found = spread(listed_files(spark, root), "path").mapInArrow(run, "path string, size long, sha256 string, md5 string")
    return found.withColumn("path", F.regexp_extract("path", f"{root.rstrip('/').split('/')[-1]}/(.*)$", 1))


def multipart_etags(files: DataFrame, part_bytes: int = PART_BYTES, chunk: int = CHUNK) -> DataFrame:
    """(path, etag) of ``files`` (path, length): the MD5 of the parts' MD5s and their number; of one part, its MD5 alone.

    The parts of a file are hashed by several tasks, ``chunk`` bytes at a time, and put together in their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for row in batch.to_pylist():
                md5, at, end = hashlib.md5(), row["start"], row["start"] + row["bytes"]
                with open_file(row["path"]) as file:
                    while at < end:
                        md5.update(file.read_at(min(chunk, end - at), at))
                        at = min(at + chunk, end)
                digests.append(md5.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("range"), pa.array(digests)], names=["path", "range", "md5"])

    parts = spread(ranges(files, part_bytes), "path", "range").mapInArrow(run, "path string, range long, md5 string")
    met = parts.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("range", "md5"))), lambda p: p["md5"]).alias("parts"))
    of_parts = F.concat(F.md5(F.unhex(F.array_join("parts", ""))), F.lit("-"), F.size("parts").cast("string"))
    return met.select("path", F.when(F.size("parts") == 1, F.get("parts", F.lit(0))).otherwise(of_parts).alias("etag"))


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed JSON manifest."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
