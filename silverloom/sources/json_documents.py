"""Members of one JSON document, read by several tasks.

A published annotation file is one object whose large members (``images``, ``annotations``) are arrays or maps. Cutting it
by bytes needs to know, at each cut, whether it lies in a string and how deep. Two scans of all ranges, in tasks, find out:

1. each range states the parity of its quotes and its change of depth, for a start within a string and for one outside;
   summed up in order, they give the state at each range's start (a row for each range comes to the driver);
2. each range, its state known, states the top-level members that begin in it and how many elements.

An element then belongs to the range that holds the comma or bracket before it, and its position is known. The third pass
reads: a task seeks to its range and yields the text of its elements, going on past the end for the last of them. Which
fields are parsed, and how, is left to ``from_json``.

A document that is compressed cannot be cut: one task streams it. No pass holds more than a chunk and the largest element.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.sources.byte_ranges import CHUNK, listed_files, open_file

#: Least and most bytes of a range.
LEAST_RANGE, RANGE = 64 << 10, 16 << 20
QUOTE, ESCAPE = 34, 92
OPENS, CLOSES, COMMA, COLON = b"[{", b"]}", 44, 58
#: What a byte does outside strings: +1 opens, -1 closes, 2 separates, 3 ends a key, 4 is a quote.
KIND = np.zeros(256, dtype=np.int8)
for _bytes, _kind in ((OPENS, 1), (CLOSES, -1), (b",", 2), (b":", 3), (b'"', 4)):
    for _b in _bytes:
        KIND[_b] = _kind
KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*$')
#: Bytes before a colon within which a top-level key stands.
KEY_BYTES = 4_096

ELEMENTS = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("element", pa.string())])


class Scanner:
    """Structure of a stream of bytes from a known state: events (place, kind, depth after) outside strings, by chunk."""

    def __init__(self, in_string: bool = False, depth: int = 0, escaped: bool = False):
        self.in_string, self.depth, self.escaped = in_string, depth, escaped

    def events(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, dtype=np.uint8)
        at = np.flatnonzero(KIND[raw])
        kind = KIND[raw[at]]
        slashes = np.flatnonzero(raw == ESCAPE)
        if self.escaped or len(slashes):
            at, kind = self._unescaped(raw, at, kind, slashes)
        quotes = np.cumsum(kind == 4) + self.in_string
        outside = (quotes % 2 == 0) & (kind != 4)
        self.in_string = bool(quotes[-1] % 2) if len(quotes) else self.in_string
        at, kind = at[outside], kind[outside]
        depth = self.depth + np.cumsum(np.where(np.abs(kind) == 1, kind, 0), dtype=np.int64)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        return at, kind, depth

    def _unescaped(self, raw: np.ndarray, at: np.ndarray, kind: np.ndarray, slashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Events without the quotes that an odd run of backslashes stands before."""
        starts = np.concatenate([[True], np.diff(slashes) > 1]) if len(slashes) else np.zeros(0, dtype=bool)
        first = slashes[starts]
        lengths = np.diff(np.append(np.flatnonzero(starts), len(slashes)))
        odd = lengths % 2 == 1
        if self.escaped and len(first) and first[0] == 0:  # the run goes on from the chunk before
            odd[0] = ~odd[0]
        behind = (first + lengths)[odd]
        if self.escaped and not (len(first) and first[0] == 0):
            behind = np.append(behind, 0)
        self.escaped = bool((behind == len(raw)).any())
        keep = ~np.isin(at, behind) | (kind != 4)
        return at[keep], kind[keep]


def escaped_at(file: pa.NativeFile, start: int) -> bool:
    """Whether an odd run of backslashes ends just before ``start``."""
    run = 0
    while start > run:
        n = min(4_096, start - run)
        data = file.read_at(n, start - run - n)
        kept = len(data.rstrip(b"\\"))
        run += n - kept
        if kept:
            break
    return run % 2 == 1


@dataclass(frozen=True)
class Range:
    """A piece of a document, and the state at its start."""

    path: str
    start: int
    end: int
    in_string: bool = False
    depth: int = 0


@dataclass(frozen=True)
class Piece:
    """A piece of one member's value: what stands in [start, end) of a document, and the elements before it."""

    path: str
    start: int
    end: int
    in_string: bool
    depth: int
    before: int
    opened: bool


def _chunks(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    while start < end:
        data = file.read_at(min(CHUNK, end - start), start)
        yield data
        start += len(data)


def _each(spark: SparkSession, items: list, tasks: int) -> tuple[DataFrame, object]:
    """A frame of numbers in ``tasks`` partitions, and the broadcast items that they number.

    Spark takes the size of a range to be that of its numbers, and so would broadcast the elements that are read for them;
    of a frame made from an RDD it knows no size, and joins of it are shuffled.
    """
    numbers = spark.sparkContext.parallelize(range(len(items)), max(1, min(tasks, len(items)))).map(lambda k: (k,))
    return spark.createDataFrame(numbers, "id long"), spark.sparkContext.broadcast(items)


def _states(spark: SparkSession, cut: list[Range], tasks: int) -> list[Range]:
    """The ranges with their states; the cuts of a document stand in order."""
    numbers, shared = _each(spark, cut, tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                piece = shared.value[k]
                with open_file(piece.path) as file:
                    escaped = escaped_at(file, piece.start)
                    out, within = Scanner(False, 0, escaped), Scanner(True, 0, escaped)
                    for data in _chunks(file, piece.start, piece.end):
                        out.events(data)
                        within.events(data)
                yield pa.RecordBatch.from_pydict({"id": [k], "flips": [out.in_string], "outside": [out.depth], "within": [within.depth]})

    found = {r.id: r for r in numbers.mapInArrow(run, "id long, flips boolean, outside long, within long").collect()}  # a row for each range
    known, state = [], (None, False, 0)
    for k, piece in enumerate(cut):
        path, in_string, depth = state
        if path != piece.path:
            in_string, depth = False, 0
        known.append(Range(piece.path, piece.start, piece.end, in_string, depth))
        state = (piece.path, in_string != found[k].flips, depth + (found[k].within if in_string else found[k].outside))
    return known


def _members(spark: SparkSession, known: list[Range], tasks: int) -> list[tuple[list[tuple[int, str]], list[int], list[bool]]]:
    """For each range: (place behind the colon, key) of the top-level members that begin in it; and for what stands before,

    between and behind those colons, the commas between elements and whether the value's bracket opens there.
    """
    numbers, shared = _each(spark, known, tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                piece = shared.value[k]
                places, names, commas, opens = [], [], [0], [False]
                with open_file(piece.path) as file:
                    scanner, base = Scanner(piece.in_string, piece.depth, escaped_at(file, piece.start)), piece.start
                    for data in _chunks(file, piece.start, piece.end):
                        at, kind, depth = scanner.events(data)
                        told = ((kind == 3) & (depth == 1)) | ((kind == 2) & (depth == 2)) | ((kind == 1) & (depth == 2))
                        colons = np.flatnonzero(kind[told] == 3)
                        groups = np.split(kind[told], colons)
                        for g, group in enumerate(groups):
                            if g:
                                place = base + int(at[told][colons[g - 1]])
                                before = file.read_at(min(KEY_BYTES, place), place - min(KEY_BYTES, place))
                                places.append(place + 1)
                                names.append(KEY.search(before)[1].decode("utf-8"))
                                commas.append(0)
                                opens.append(False)
                            commas[-1] += int((group == 2).sum())
                            opens[-1] = opens[-1] or bool((group == 1).any())
                        base += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), pa.array([places], pa.list_(pa.int64())), pa.array([names], pa.list_(pa.string())), pa.array([commas], pa.list_(pa.int64())), pa.array([opens], pa.list_(pa.bool_()))],
                    names=["id", "places", "names", "commas", "opens"],
                )

    rows = numbers.mapInArrow(run, "id long, places array<long>, names array<string>, commas array<long>, opens array<boolean>").collect()  # a row for each range
    found = {r.id: r for r in rows}
    return [(list(zip(found[k].places, found[k].names, strict=True)), found[k].commas, found[k].opens) for k in range(len(known))]


@dataclass(frozen=True)
class Documents:
    """Where the top-level members of one or more documents lie: pieces by member, and the documents that must be streamed."""

    spark: SparkSession
    pieces: dict[str, list[Piece]]
    packed: list[str]
    tasks: int

    def elements(self, member: str, at_once: int = 8_192) -> DataFrame:
        """file, pos, element: the text of each element of the member (of a map, ``"key": value``), by its position."""
        pieces = self.pieces.get(member, [])
        cut, shared = _each(self.spark, pieces, self.tasks)
        whole, streamed = _each(self.spark, self.packed, len(self.packed))  # a task streams one

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    piece = shared.value[k]
                    with open_file(piece.path) as file:
                        scanner = Scanner(piece.in_string, piece.depth, escaped_at(file, piece.start))
                        found = _elements(_chunks(file, piece.start, file.size()), scanner, piece.start, piece.end, piece.opened)
                        yield from _batches(piece.path, piece.before, found, at_once)

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    with open_file(streamed.value[k]) as file, gzip.open(file) as text:
                        yield from _batches(streamed.value[k], 0, _member_of(iter(lambda text=text: text.read(CHUNK), b""), member), at_once)

        kind = "file string, pos long, element string"
        parts = ([cut.mapInArrow(read, kind)] if pieces else []) + ([whole.mapInArrow(stream, kind)] if self.packed else [])
        if not parts:
            return self.spark.createDataFrame([], kind)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def rows(self, member: str, schema: str) -> DataFrame:
        """file, pos and the fields of each element of an array, by the DDL of its fields."""
        return self.elements(member).select("file", "pos", F.from_json("element", f"struct<{schema}>").alias("e")).select("file", "pos", "e.*")

    def entries(self, member: str, schema: str) -> DataFrame:
        """file, pos, key and the fields of each value of a map."""
        entry = F.from_json(F.concat(F.lit("{"), "element", F.lit("}")), f"map<string,struct<{schema}>>")
        one = self.elements(member).select("file", "pos", F.map_entries(entry)[0].alias("e"))
        return one.select("file", "pos", F.col("e.key").alias("key"), "e.value.*")


def _batches(path: str, pos: int, found: Iterator[bytes], at_once: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), pa.array(range(pos, pos + len(held)), pa.int64()), pa.array([h.decode("utf-8") for h in held], pa.string())], schema=ELEMENTS)

    for element in found:
        held.append(element)
        size += len(element)
        if len(held) >= at_once or size >= CHUNK:
            yield batch()
            pos, held, size = pos + len(held), [], 0
    if held:
        yield batch()


def _elements(chunks: Iterator[bytes], scanner: Scanner, base: int, end: int, opened: bool) -> Iterator[bytes]:
    """Elements of a value at depth 2 whose comma or bracket lies before ``end``; ``opened`` if its bracket is ahead."""
    held, held_at, open_at = b"", base, None  # bytes since the last separator, and the place behind it
    for data in chunks:
        at, kind, depth = scanner.events(data)
        marks = np.flatnonzero(((kind == 2) & (depth == 2)) | ((kind == 1) & (depth == 2)) | ((kind == -1) & (depth == 1)))
        buffer = held + data
        for m in marks:
            place = base + int(at[m])
            if open_at is not None:
                element = buffer[open_at - held_at : place - held_at].strip()
                if element:
                    yield element
            if kind[m] == -1 or place >= end:
                return
            open_at = place + 1
        base += len(data)
        keep = base if open_at is None else open_at
        held, held_at = buffer[keep - held_at :], keep
        if open_at is None and base >= end:
            return


def _member_of(chunks: Iterator[bytes], member: str) -> Iterator[bytes]:
    """Elements of one top-level member of a document that is streamed from its start."""
    scanner, held, held_at, base, inside, open_at = Scanner(), b"", 0, 0, False, None
    for data in chunks:
        at, kind, depth = scanner.events(data)
        buffer = held + data
        for m in np.flatnonzero(((kind == 3) & (depth == 1)) | ((kind == 2) & (depth <= 2)) | ((kind == 1) & (depth == 2)) | ((kind == -1) & (depth == 1))):
            place = base + int(at[m])
            if kind[m] == 3:
                before = buffer[max(0, place - held_at - KEY_BYTES) : place - held_at]
                inside = KEY.search(before)[1].decode("utf-8") == member
            elif inside and depth[m] == 2:
                if kind[m] == 2 and open_at is not None and (element := buffer[open_at - held_at : place - held_at].strip()):
                    yield element
                open_at = place + 1
            elif inside and kind[m] == -1:
                if open_at is not None and (element := buffer[open_at - held_at : place - held_at].strip()):
                    yield element
                return
        base += len(data)
        keep = open_at if open_at is not None else max(held_at, base - KEY_BYTES)
        held, held_at = buffer[keep - held_at :], keep


def open_documents(spark: SparkSession, path: str, range_bytes: int | None = None) -> Documents:
    """The documents at ``path``, a file or a folder of files, cut into ranges of ``range_bytes`` (by default so that each

    core gets two, within limits), with their members found.
    """
    files = sorted((r.path, r.length) for r in listed_files(spark, path).where(~F.col("path").rlike(r"/[._][^/]*$")).collect())  # a row for each document
    cores = spark.sparkContext.defaultParallelism
    plain = [(p, n) for p, n in files if not p.endswith(".gz")]
    size = range_bytes or min(RANGE, max(LEAST_RANGE, sum(n for _, n in plain) // (2 * cores)))
    cut = [Range(p, start, min(start + size, n)) for p, n in plain for start in range(0, n, size)]
    tasks = max(cores, -(-sum(n for _, n in plain) // RANGE), min(len(cut), 2 * cores))
    pieces: dict[str, list[Piece]] = {}
    if cut:
        known = _states(spark, cut, tasks)
        path_now, name, before = None, None, 0
        for piece, (begun, commas, opens) in zip(known, _members(spark, known, tasks), strict=True):
            if piece.path != path_now:
                path_now, name, before = piece.path, None, 0
            starts = [piece.start, *(p for p, _ in begun)]
            ends = [*(p for p, _ in begun), piece.end]
            for k, (start, end) in enumerate(zip(starts, ends, strict=True)):
                if k:
                    name, before = begun[k - 1][1], 0
                if name is not None and (commas[k] or opens[k]):
                    state = (piece.in_string, piece.depth) if k == 0 else (False, 1)
                    pieces.setdefault(name, []).append(Piece(piece.path, start, end, *state, before, opens[k]))
                    before += commas[k] + opens[k]
    return Documents(spark, pieces, [p for p, _ in files if p.endswith(".gz")], tasks)
