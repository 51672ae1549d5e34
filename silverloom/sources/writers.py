"""Writers of the published annotation formats, for exports and round trips, and of binary files.

Documents of COCO and TextOCR are streamed by the tasks that hold the images with their boxes, each of some of the images,
and need no further shuffle; ``compress`` packs them with gzip. Other formats that are one document are written for each
``chunk`` of images. ``images``: file_name, width, height, chunk; ``boxes``: file_name, source_box_index, source_class,
xmin, ymin, xmax, ymax and flags.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.plans.scratch import dealt
from silverloom.sources.byte_ranges import create_file, spread

#: Images of a document at most, whose lines a task holds.
DOCUMENT_IMAGES = 1 << 16


def xywh() -> Column:
    return F.array("xmin", "ymin", F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))


def _write(lines: DataFrame, path: str, **options: str) -> None:
    """``lines`` (chunk, value) as one text file for each chunk."""
    lines.repartition("chunk").write.options(**options).partitionBy("chunk").text(path)


def _documents(rows: DataFrame, members: list[tuple[str, str]], path: str, head: str, compress: bool) -> None:
    """Documents of ``rows`` (id, image, entry), each an object of ``head`` and two members, (key, brackets) for the entries

    and the images. A task streams its rows into documents of at most ``DOCUMENT_IMAGES`` images, whose lines it holds until
    the entries stand; the rows of an image stand together.
    """
    (entries, entry_marks), (images, image_marks) = members

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, out, last, held, comma = TaskContext.get().partitionId(), 0, None, None, [], ""

        def close() -> None:
            out.write(f'{entry_marks[1]},"{images}": {image_marks[0]}'.encode() + ",\n".join(held).encode() + f"{image_marks[1]}}}".encode())
            out.close()

        for batch in batches:
            for id, image, entry in zip(*(batch.column(c).to_pylist() for c in ("id", "image", "entry")), strict=True):
                if id != last and len(held) >= DOCUMENT_IMAGES:
                    close()
                    out, held = None, []
                if out is None:
                    file = create_file(f"{path}/{task:05d}-{n}.json{'.gz' if compress else ''}")  # which packs what is named so
                    out, comma, n = io.BufferedWriter(file, 1 << 20), "", n + 1
                    out.write(f'{{{head}"{entries}": {entry_marks[0]}'.encode())
                if id != last:
                    held.append(image)
                    last = id
                if entry is not None:
                    out.write(f"{comma}{entry}".encode())
                    comma = ",\n"
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    ordered = rows.sortWithinPartitions("id", "place").select("id", "image", "entry")
    if not ordered.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]:
        with create_file(f"{path}/00000-0.json") as out:
            out.write(f'{{{head}"{entries}": {"".join(entry_marks)},"{images}": {"".join(image_marks)}}}'.encode())


def _with_images(images: DataFrame, boxes: DataFrame, image: Column, entry: Column) -> DataFrame:
    """(id, image, place, entry): the images with their boxes, also those without any. Boxes that hold the image's id meet it by that."""
    key = "id" if "id" in boxes.columns else "file_name"
    met = images.select("id", "file_name", image.alias("image")).join(boxes.drop("id" if key == "file_name" else "file_name"), key, "left")
    return met.select("id", "image", F.col("source_box_index").alias("place"), F.when(F.col("source_box_index").isNotNull(), entry).alias("entry"))


def write_coco(images: DataFrame, boxes: DataFrame, categories: list[str], path: str, more: dict[str, Column] | None = None, compress: bool = False) -> None:
    """COCO and its kin: ``images`` also has id and coco_url; ``more`` are further fields of an annotation."""
    place = F.array_position(F.array(*map(F.lit, categories)), F.col("source_class"))
    fields = {"image_id": F.col("id"), "category_id": place, "bbox": xywh()} | (more or {})
    image = F.to_json(F.struct("id", "file_name", "width", "height", "coco_url"))
    rows = _with_images(images, boxes, image, F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))
    named = json.dumps([{"id": i + 1, "name": c} for i, c in enumerate(categories)])
    _documents(rows, [("annotations", "[]"), ("images", "[]")], path, f'"categories": {named},', compress)


def write_textocr(images: DataFrame, boxes: DataFrame, path: str, text: Column, compress: bool = False) -> None:
    """Maps of images and words by id; an id is the file name without its suffix, and for words its place behind it."""
    name = X.stem(F.col("file_name"))
    line = lambda key, *fields: F.concat(F.lit('"'), key, F.lit('": '), F.to_json(F.struct(*fields)))
    word = line(F.concat_ws("_", name, "source_box_index"), name.alias("image_id"), xywh().alias("bbox"), text.alias("utf8_string"))
    _documents(_with_images(images, boxes, line(name, "width", "height"), word), [("anns", "{}"), ("imgs", "{}")], path, "", compress)


def write_hiertext(images: DataFrame, boxes: DataFrame, path: str, flags: dict[str, Column]) -> None:
    """Pages of one paragraph with a line for each word, compressed with gzip; a word is a polygon of its corners."""
    at = lambda x, y: F.array(x, y)
    polygon = F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"))
    word = F.struct("source_box_index", polygon.alias("vertices"), *[c.alias(n) for n, c in flags.items()])
    words = boxes.groupBy("file_name").agg(F.sort_array(F.collect_list(word)).alias("words"))
    lines = F.transform(F.coalesce("words", F.array().cast(words.schema["words"].dataType)), lambda w: F.struct(F.array(w).alias("words")))
    page = F.struct(X.stem(F.col("file_name")).alias("image_id"), F.col("width").alias("image_width"), F.col("height").alias("image_height"), F.array(F.struct(lines.alias("lines"))).alias("paragraphs"))
    pages = images.join(words, "file_name", "left").groupBy("chunk").agg(F.collect_list(page).alias("annotations"))
    _write(pages.select("chunk", F.to_json(F.struct("annotations")).alias("value")), path, compression="gzip")


def write_open_images(boxes: DataFrame, path: str, num_boxes: int = 0) -> None:
    """A CSV of normalised boxes; the rows of an image stand together. ``boxes`` also has width and height.

    ``num_boxes``, where known, says over how many tasks they have to be dealt.
    """
    share = lambda c, side: (F.col(c) / F.col(side)).alias(c[:2].upper() + c[2:])
    flag = lambda c, name: F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(name)
    none = [F.lit(0).alias(c) for c in ("IsOccluded", "IsTruncated")]
    together = dealt(boxes, num_boxes, "file_name")
    together = boxes.repartition("file_name") if together is boxes else together
    rows = together.sortWithinPartitions("file_name", "source_box_index").select(
        X.stem(F.col("file_name")).alias("ImageID"), F.lit("s").alias("Source"), F.col("source_class").alias("LabelName"), F.lit(1.0).alias("Confidence"),
        share("xmin", "width"), share("xmax", "width"), share("ymin", "height"), share("ymax", "height"), *none,
        flag("attr_is_group_of", "IsGroupOf"), flag("attr_is_depiction", "IsDepiction"), F.lit(0).alias("IsInside"),
    )
    rows.write.option("header", True).csv(path)


def write_wider_face(images: DataFrame, boxes: DataFrame, path: str, grades: list[Column], chunks: bool = False) -> None:
    """Blocks of a name, a count and box lines of whole pixels; an image without boxes has one line of zeros.

    One file in the order of names, or with ``chunks`` a file for each chunk.
    """
    numbers = [F.floor("xmin"), F.floor("ymin"), F.floor(F.col("xmax") - F.col("xmin")), F.floor(F.col("ymax") - F.col("ymin")), *grades]
    line = F.struct("source_box_index", F.concat_ws(" ", *[n.cast("string") for n in numbers]).alias("line"))
    lines = boxes.groupBy("file_name").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    zeros = F.array(F.lit(" ".join(["0"] * 10)))
    block = F.concat_ws("\n", "file_name", F.coalesce(F.size("lines"), F.lit(0)).cast("string"), F.array_join(F.coalesce("lines.line", zeros), "\n"))
    blocks = images.join(lines, "file_name", "left")
    if chunks:
        return _write(blocks.select("chunk", block.alias("value")), path)
    blocks.select("file_name", block.alias("value")).orderBy("file_name").select("value").coalesce(1).write.text(path)


def write_yolo(lines: DataFrame, path: str) -> int:
    """A label file for each image, ``stem`` with .txt below ``path``: ``lines`` (stem, pos, line); returns how many."""
    whole = lines.groupBy("stem").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x.line), "\n").alias("value"))
    named = spread(whole, "stem").select(F.concat("stem", F.lit(".txt")).alias("name"), F.concat("value", F.lit("\n")).cast("binary").alias("content"))
    return write_files(named, path)


def write_files(rows: DataFrame, root: str) -> int:
    """A file below ``root`` for each of ``rows`` (name, content), written by its task; returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with create_file(f"{root}/{name}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return rows.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_zips(rows: DataFrame, root: str) -> int:
    """Zip archives below ``root`` of ``rows`` (archive, member, content), each streamed by one task; returns the members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, file, n = None, None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != name:
                    if file:
                        file.close()
                        out.close()
                    name, out = row["archive"], create_file(f"{root}/{row['archive']}")
                    file = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                file.writestr(zipfile.ZipInfo(row["member"]), row["content"], zipfile.ZIP_DEFLATED)
                n += 1
        if file:
            file.close()
            out.close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    dealt = rows.select("archive", "member", "content").repartition("archive").sortWithinPartitions("archive", "member")
    return dealt.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
