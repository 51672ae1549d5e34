"""Files read by byte ranges, in tasks: through pyarrow's file systems, which know local paths, s3, gs and hdfs.

Spark's ``binaryFile`` makes a file one value of at most 2 GB. Here a listing (path, length) becomes rows of ranges, and
each task opens its file and reads no more than its ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a task reads and hands on at a time.
CHUNK = 4 << 20
#: Rows of a listing that a task hands on at a time.
LISTED_ROWS = 10_000


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and its name there. ``file:/a`` and ``file:///a`` are local, as is a path without a scheme."""
    local = re.sub(r"^file:/*", "/", path)
    return (pafs.LocalFileSystem(), local) if local.startswith("/") else pafs.FileSystem.from_uri(local)


def open_file(path: str) -> pa.NativeFile:
    """A file that can be read at any place."""
    system, name = located(path)
    return system.open_input_file(name)


def create_file(path: str) -> pa.NativeFile:
    """A new file, in a folder that is made where the store has folders."""
    system, name = located(path)
    if isinstance(system, pafs.LocalFileSystem):
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name)


def _entries(path: str) -> list[tuple[str, int, bool]]:
    """(path, length, is a folder) of the file ``path`` or of what stands in that folder; hidden names are left out, as Spark does."""
    system, name = located(path)
    here = system.get_file_info(name)
    if here.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [here] if here.is_file else system.get_file_info(pafs.FileSelector(name))
    before, _, after = (f"file:{name}" if isinstance(system, pafs.LocalFileSystem) else path).partition(name)
    hidden = lambda n: n.startswith(".") or n.startswith("_") and "=" not in n or n.endswith("._COPYING_")
    return [(f"{before}{f.path}{after}", f.size or 0, not f.is_file) for f in found if f is here or not hidden(f.base_name)]


def _batch(rows: list[tuple[str, int, bool]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.bool_()))], names=["path", "length", "folder"])


def listed_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """path and length of the file ``root`` or of those below it, of which no content is read; empty files are left out.

    Folders are listed by tasks, the root by one and those in it by all, so the listing does not pass through the driver.
    A root with wildcards is listed by Spark.
    """
    if re.search(r"[*?\[{]", root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        return (files.option("pathGlobFilter", pattern) if pattern else files).load(root).select("path", "length")

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = _entries(path)
                yield from (_batch(rows[at : at + LISTED_ROWS]) for at in range(0, len(rows), LISTED_ROWS))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, folders = [], []
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                (folders if row[2] else files).append(row)
            while files or folders:
                while folders and len(files) < LISTED_ROWS:
                    for row in _entries(folders.pop()[0]):
                        (folders if row[2] else files).append(row)
                yield _batch([r for r in files[:LISTED_ROWS] if r[1] > 0 and (pattern is None or fnmatchcase(r[0].rsplit("/", 1)[-1], pattern))])
                files = files[LISTED_ROWS:]

    kind = "path string, length long, folder boolean"
    start = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")  # of no known size: what is below it is not small
    return spread(start.mapInArrow(top, kind), "path").mapInArrow(below, kind).select("path", "length")


def ranges(files: DataFrame, size: int) -> DataFrame:
    """A row for each range of at most ``size`` bytes of each file: path, length, range (from 0), start, bytes."""
    last = F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0)).cast("bigint")
    cut = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("range"))
    start = F.col("range") * size
    return cut.withColumns({"start": start, "bytes": F.least(F.lit(size).cast("bigint"), F.col("length") - start)})


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` dealt over the session's tasks by a hash of ``by``: a listing comes from a few tasks, its work should not."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, *by)


def read_ranges(files: DataFrame, size: int = CHUNK) -> DataFrame:
    """path, length, range, start, data: the content of files in ranges of ``size`` bytes, one row of it at a time in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    data = file.read_at(row["bytes"], row["start"])
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("path", "length", "range", "start")} | {"data": data}], schema=schema)

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("range", pa.int64()), ("start", pa.int64()), ("data", pa.binary())])
    return spread(ranges(files, size), "path", "range").mapInArrow(run, "path string, length long, range long, start long, data binary")


def read_heads(files: DataFrame, size: int) -> DataFrame:
    """``files`` with head, the first ``size`` bytes at most; the rest of a file is not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                heads = []
                for path, length in zip(part.column("path").to_pylist(), part.column("length").to_pylist(), strict=True):
                    with open_file(path) as file:
                        heads.append(file.read_at(min(size, length), 0))
                yield part.append_column("head", pa.array(heads, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return spread(files, "path").mapInArrow(run, f"{fields}, head binary")


def read_whole(files: DataFrame) -> DataFrame:
    """path and data of small ``files`` (path), each read as a whole, some ``CHUNK`` bytes of them at a time in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, held, size = [], [], 0
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    held.append(file.read())
                paths.append(path)
                size += len(held[-1])
                if size >= CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(held, pa.binary())], names=["path", "data"])
                    paths, held, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(held, pa.binary())], names=["path", "data"])

    return spread(files.select("path"), "path").mapInArrow(run, "path string, data binary")
