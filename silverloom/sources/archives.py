"""Members of zip and tar archives, read by their directories.

A first pass lists members. A zip's directory stands at its end and is streamed from there, also in its 64-bit form; a tar's
headers are met by seeking over the contents; a compressed tar has to be read through. A second pass deals the members of
zips and plain tars over tasks by their place, each of which seeks to its own, so that one large archive is the work of
many. A compressed tar is streamed by one task. No pass holds more than one member and a batch of ``BATCH_BYTES``.
"""

from __future__ import annotations

import posixpath
import struct
import tarfile
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.plans.scratch import small, stored
from silverloom.sources.byte_ranges import CHUNK, listed_files, open_file, spread

#: Contents that are sent on together, and bytes of an archive whose members one task reads.
BATCH_BYTES, TASK_BYTES = 32 << 20, 64 << 20
STORED, DEFLATED, STREAMED = 0, 8, -1
SKIPPED = "__MACOSX/"
# Signatures and layouts of the zip format.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
ENTRY_LAYOUT, LOCAL_BYTES = "<4s4xHH4sIIIHHH2x2x4xI", 30

INDEX = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("modified", pa.int64()), ("method", pa.int32()), ("start", pa.int64()), ("packed", pa.int64()), ("crc", pa.int64())])
MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("modified", pa.int64()), ("content", pa.binary())])


def safe(archive: str, member: str) -> str:
    clean = posixpath.normpath(member)
    if clean.startswith(("/", "../")) or clean == "..":
        raise ValueError(f"{archive}: {member} leaves the archive")
    return clean


def _directory(file: pa.NativeFile) -> tuple[int, int]:
    """Start and bytes of a zip's directory, from the records at the end of the file."""
    length = file.size()
    tail_at = max(0, length - (1 << 16) - 22)
    tail = file.read_at(length - tail_at, tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no zip directory")
    size, start = struct.unpack_from("<II", tail, at + 12)
    if at >= 20 and tail[at - 20 : at - 16] == END64_AT:
        (record_at,) = struct.unpack_from("<Q", tail, at - 12)
        record = file.read_at(56, record_at)
        if record[:4] != END64:
            raise ValueError("no 64-bit zip directory where the file says")
        size, start = struct.unpack_from("<QQ", record, 40)
    return start, size


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and place of an entry; those that do not fit 32 bits stand in its extra field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            place = at + 4
            for k, v in enumerate(values):
                if v == 0xFFFFFFFF:
                    (values[k],) = struct.unpack_from("<Q", extra, place)
                    place += 8
            break
        at += 4 + n
    return values


def _modified(stamp: bytes) -> int:
    time, date = struct.unpack("<HH", stamp)
    year, month, day = 1980 + (date >> 9), (date >> 5) & 15 or 1, date & 31 or 1
    return int(datetime(year, month, day, time >> 11, (time >> 5) & 63, min(2 * (time & 31), 59), tzinfo=UTC).timestamp())


def zip_entries(file: pa.NativeFile) -> Iterator[tuple]:
    """(member, size, modified, method, place of its header, packed size, crc) of each entry, the directory being streamed."""
    start, size = _directory(file)
    held, at, end, head = b"", start, start + size, struct.calcsize(ENTRY_LAYOUT)
    while at < end or held:
        fits = len(held) >= head and len(held) >= head + sum(struct.unpack_from("<HHH", held, 28))
        if not fits:
            if at >= end:
                raise ValueError("the zip directory is cut short")
            data = file.read_at(min(CHUNK, end - at), at)
            held, at = held + data, at + len(data)
            continue
        place = 0
        while len(held) - place >= head:
            sign, flags, method, stamp, crc, packed, whole, n, m, k, offset = struct.unpack_from(ENTRY_LAYOUT, held, place)
            if sign != ENTRY:
                raise ValueError("the zip directory holds something else")
            if len(held) - place < head + n + m + k:
                break
            name = held[place + head : place + head + n].decode("utf-8" if flags & 0x800 else "cp437")
            whole, packed, offset = _wide(held[place + head + n : place + head + n + m], [whole, packed, offset])
            yield name, whole, _modified(stamp), method, offset, packed, crc
            place += head + n + m + k
        held = held[place:]


def _listed(archive: str) -> Iterator[tuple]:
    """Members of one archive in the columns of INDEX after ``archive``; folders and metadata are left out."""
    with open_file(archive) as file:
        if archive.endswith(".zip"):
            for name, *rest in zip_entries(file):
                if not name.endswith("/") and not name.startswith(SKIPPED):
                    yield safe(archive, name), *rest
            return
        plain = archive.endswith(".tar")
        with tarfile.open(fileobj=file, mode="r:" if plain else "r|*") as tar:
            for info in tar:
                if not (info.isfile() or info.isdir()):
                    raise ValueError(f"{archive}: {info.name} is no regular file")
                if info.isfile() and not info.name.startswith(SKIPPED):
                    yield safe(archive, info.name), info.size, int(info.mtime), STORED if plain else STREAMED, info.offset_data, info.size, None
                tar.members = []  # what has been seen is not kept


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight: int | None) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches of some thousands, or of ``BATCH_BYTES`` by the size in column ``weight``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row[weight] if weight is not None else 0
        if len(held) >= 4_096 or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, member, size, modified, method, start, packed, crc, stripped of every member below ``path``.

    Contents are not read. A single folder named like its archive is stripped from ``member``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                yield from _batches(((archive, *m) for m in _listed(archive)), INDEX, None)

    files = listed_files(spark, path).where(F.col("path").rlike(r"\.(zip|tar|tgz|tar\.gz)$"))
    kind = "archive string, member string, size long, modified long, method int, start long, packed long, crc long"
    listed = stored(spread(files, "path").mapInArrow(run, kind), "archive-index")
    folder = F.concat(F.regexp_replace(F.substring_index("archive", "/", -1), r"\.(tar\.gz|tgz|tar|zip)$", ""), F.lit("/"))
    inner = listed.groupBy("archive").agg(F.bool_and(F.col("member").startswith(folder)).alias("inner"))
    member = F.when(F.col("inner"), F.substring(F.col("member"), F.length(folder) + 1, F.length("member"))).otherwise(F.col("member"))
    return listed.join(small(inner), "archive").withColumn("member", member).withColumnRenamed("inner", "stripped")


def _content(file: pa.NativeFile, row: dict) -> bytes:
    """The content of a member that is read by its place."""
    if row["crc"] is None:
        return file.read_at(row["packed"], row["start"])
    local = file.read_at(LOCAL_BYTES, row["start"])
    if local[:4] != LOCAL:
        raise ValueError(f"{row['archive']}: no member at {row['start']}")
    names = sum(struct.unpack_from("<HH", local, 26))
    data = file.read_at(row["packed"], row["start"] + LOCAL_BYTES + names)
    if row["method"] == DEFLATED:
        data = zlib.decompress(data, -15)
    elif row["method"] != STORED:
        raise ValueError(f"{row['archive']}: {row['member']} is packed by method {row['method']}")
    if zlib.crc32(data) != row["crc"] or len(data) != row["size"]:
        raise ValueError(f"{row['archive']}: {row['member']} is damaged")
    return data


def archive_members(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Members of the zip and tar archives below ``path``: archive, member, size, modified (seconds), content.

    Metadata folders are skipped, a single directory named like its archive is stripped. Members that leave the archive
    and tar members that are neither files nor directories are errors, as are damaged ones.
    """

    def by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            name, file = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["archive"] != name:
                        if file:
                            file.close()
                        name, file = row["archive"], open_file(row["archive"])
                    yield row["archive"], row["member"], row["size"], row["modified"], _content(file, row)
            if file:
                file.close()

        yield from _batches(rows(), MEMBERS, 2)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for archive, cut in zip(batch.column("archive").to_pylist(), batch.column("cut").to_pylist(), strict=True):
                    with open_file(archive) as file, tarfile.open(fileobj=file, mode="r|*") as tar:
                        for info in tar:
                            if info.isfile() and not info.name.startswith(SKIPPED):
                                yield archive, safe(archive, info.name)[cut:], info.size, int(info.mtime), tar.extractfile(info).read()
                            tar.members = []

        yield from _batches(rows(), MEMBERS, 2)

    kind = "archive string, member string, size long, modified long, content binary"
    index = archive_index(spark, path)
    placed = index.where(F.col("method") != STREAMED).withColumn("piece", F.floor(F.col("start") / task_bytes))
    placed = spread(placed, "archive", "piece").sortWithinPartitions("archive", "start").mapInArrow(by_place, kind)
    folder = F.regexp_replace(F.substring_index("archive", "/", -1), r"\.(tar\.gz|tgz)$", "")
    cut = F.when(F.bool_and("stripped"), F.length(F.first(folder)) + 1).otherwise(0).cast("int")
    whole = index.where(F.col("method") == STREAMED).groupBy("archive").agg(cut.alias("cut"))
    return placed.unionByName(spread(whole, "archive").mapInArrow(streamed, kind))
