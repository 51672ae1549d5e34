"""One small fixture for each reader."""

import gzip
import json
import random
import struct

import pytest

from silverloom.sources import files, json_sources, text_sources
from silverloom.sources.contract import materialised_splits, union
from silverloom.sources.registry import READERS, read_source


def boxes(raw, *extra):
    rows = raw.boxes.orderBy("file_name", "source_box_index").collect()
    return [(r.file_name, r.source_box_index, r.source_class, r.xmin, r.ymin, r.xmax, r.ymax, *[r[e] for e in extra]) for r in rows]


def images(raw):
    return sorted((r.file_name, r.width, r.height) for r in raw.images.collect())


def dump(path, value):
    path.write_text(json.dumps(value))
    return str(path)


CATEGORIES = [{"id": 7, "name": "person"}, {"id": 9, "name": "dog"}]


def test_coco(spark, tmp_path):
    found = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 20}, {"id": 2, "file_name": "b.jpg", "width": 5, "height": 5}],
        "annotations": [
            {"image_id": 1, "category_id": 7, "bbox": [1, 2, 3.5, 4], "iscrowd": 0, "segmentation": [[1, 2]]},
            {"image_id": 1, "category_id": 9, "bbox": [0, 0, 1, 1], "iscrowd": 1, "segmentation": {"counts": "x"}},
        ],
        "categories": CATEGORIES,
    }
    raw = json_sources.read_coco(spark, dump(tmp_path / "c.json", found), "coco", "val")
    assert images(raw) == [("a.jpg", 10, 20), ("b.jpg", 5, 5)]
    assert boxes(raw, "attr_is_group_of", "attr_blur") == [("a.jpg", 0, "person", 1.0, 2.0, 4.5, 6.0, False, None), ("a.jpg", 1, "dog", 0.0, 0.0, 1.0, 1.0, True, None)]
    assert raw.instances().count() == 1
    found["annotations"][0]["category_id"] = 8
    with pytest.raises(Exception, match="no category 8"):
        json_sources.read_coco(spark, dump(tmp_path / "d.json", found), "coco", "val").boxes.collect()


def test_lvis_and_wholebody(spark, tmp_path):
    image = [{"id": 1, "coco_url": "http://x/train2017/0001.jpg", "width": 10, "height": 20}]
    lvis = {"images": image, "annotations": [{"id": 4, "image_id": 1, "category_id": 7, "bbox": [1, 1, 2, 2]}], "categories": CATEGORIES}
    raw = json_sources.read_lvis(spark, dump(tmp_path / "l.json", lvis), "lvis", "val")
    assert boxes(raw, "attr_is_group_of") == [("train2017/0001.jpg", 0, "person", 1.0, 1.0, 3.0, 3.0, None)]
    person = {"image_id": 1, "category_id": 7, "bbox": [0, 0, 9, 9], "iscrowd": 0, "face_box": [1, 1, 2, 2], "face_valid": False, "lefthand_box": [3, 3, 1, 1], "lefthand_valid": True, "righthand_box": [5, 5, 1, 1], "righthand_valid": True}
    raw = json_sources.read_coco_wholebody(spark, dump(tmp_path / "w.json", {"images": image, "annotations": [person, person | {"face_valid": True}], "categories": CATEGORIES}), "wb", "val")
    assert [b[2] for b in boxes(raw)] == ["person", "left_hand", "right_hand", "person", "face", "left_hand", "right_hand"]
    assert [b[1] for b in boxes(raw)] == list(range(7))


def test_textocr_and_hiertext(spark, tmp_path):
    found = {
        "imgs": {"z1": {"id": "z1", "width": 8, "height": 9, "set": "train", "file_name": "train/z1.jpg"}, "a2": {"id": "a2", "width": 1, "height": 2}},
        "anns": {"z1_2": {"image_id": "z1", "bbox": [1, 1, 2, 2], "utf8_string": "."}, "z1_1": {"image_id": "z1", "bbox": [0, 0, 1, 1], "utf8_string": "hi"}},
        "imgToAnns": {},
    }
    raw = json_sources.read_textocr(spark, dump(tmp_path / "t.json", found), "textocr", "train")
    assert images(raw) == [("a2.jpg", 1, 2), ("z1.jpg", 8, 9)]
    assert boxes(raw, "attr_is_illegible") == [("z1.jpg", 0, "word", 1.0, 1.0, 3.0, 3.0, True), ("z1.jpg", 1, "word", 0.0, 0.0, 1.0, 1.0, False)]
    word = lambda x, legible=True: {"vertices": [[x, 1], [x + 4, 0], [x + 3, 6]], "text": "w", "legible": legible, "handwritten": True, "vertical": False}
    page = {"annotations": [{"image_id": "h", "image_width": 50, "image_height": 40, "paragraphs": [{"lines": [{"words": [word(1), word(10, False)]}]}, {"lines": [{"words": [word(20)]}]}]}, {"image_id": "e", "image_width": 1, "image_height": 1, "paragraphs": []}]}
    path = tmp_path / "val.json.gz"
    path.write_bytes(gzip.compress(json.dumps(page).encode()))
    raw = json_sources.read_hiertext(spark, str(path), "hiertext", "val")
    assert [(b[1], b[3:7], b[7]) for b in boxes(raw, "attr_is_illegible")] == [(0, (1.0, 0.0, 5.0, 6.0), False), (1, (10.0, 0.0, 14.0, 6.0), True), (2, (20.0, 0.0, 24.0, 6.0), False)]
    assert len(images(raw)) == 2


HEADER = "ImageID,Source,LabelName,Confidence,XMin,XMax,YMin,YMax,IsOccluded,IsTruncated,IsGroupOf,IsDepiction,IsInside\n"


def test_open_images(spark, tmp_path):
    rows = "0a,s,/m/face,1,0.1,0.5,0.2,0.4,0,0,1,0,0\n0a,s,/m/car,1,0,1,0,1,0,0,0,1,0\nbb,s,/m/face,1,0,1,0,1,0,0,0,0,0\n0a,s,/m/x,1,0,1,0,1,0,0,0,0,0\n"
    path = tmp_path / "boxes.csv"
    path.write_text(HEADER + rows)
    sizes = spark.createDataFrame([("train_0/0a.jpg", 100, 50)], "file_name string, width int, height int")
    raw = text_sources.read_open_images(spark, str(path), sizes, "oi", "train")
    got = boxes(raw, "attr_is_group_of", "attr_is_depiction")
    assert got[0] == ("train_0/0a.jpg", 0, "/m/face", 10.0, 10.0, 50.0, 20.0, True, False) and len(got) == 3 and got[1][2] == "/m/car"
    assert [tuple(r) for r in text_sources.scattered_images(text_sources.csv_rows(spark, str(path))).collect()] == [("0a", 2)]


def test_wider_face(spark, tmp_path):
    text = "0--P/a b.jpg\n2\n10 20 30 40 1 0 2 0 1 0\n1 2 3 4 0 0 0 1\n1--E/none.jpg\n0\n0 0 0 0 0 0 0 0 0 0\n1--E/zero.jpg\n1\n5 5 0 0 0 0 0 0 0 0\n"
    path = tmp_path / "gt.txt"
    path.write_text(text)
    names = ["0--P/a b.jpg", "1--E/none.jpg", "1--E/zero.jpg"]
    sizes = spark.createDataFrame([(n, 100, 100) for n in names], "file_name string, width int, height int")
    raw = text_sources.read_wider_face(spark, str(path), sizes, "wf", "train")
    assert [i[0] for i in images(raw)] == names
    got = boxes(raw, "attr_blur", "attr_illumination", "attr_invalid", "attr_occlusion")
    assert got == [(names[0], 0, "face", 10.0, 20.0, 40.0, 60.0, 1, 2, False, 1), (names[0], 1, "face", 1.0, 2.0, 4.0, 6.0, 0, 0, True, None), (names[2], 0, "face", 5.0, 5.0, 5.0, 5.0, 0, 0, False, 0)]


def test_wider_face_in_splits(spark, tmp_path):
    """One file cut at any byte gives the boxes of the file as a whole: names and counts are carried over the splits."""
    rnd = random.Random(4)
    blocks = [(f"{i % 7}--g/img {i}.jpg", [[rnd.randrange(90) for _ in range(10)] for _ in range(rnd.choice([0, 1, 2, 30]))]) for i in range(60)]
    lines = []
    for name, rows in blocks:
        lines += [name, str(len(rows)), *(" ".join(map(str, r)) for r in rows or [[0] * 10]), *([""] if rnd.random() < 0.1 else [])]
    (tmp_path / "w.txt").write_text("\n".join(lines) + "\n")
    sizes = spark.createDataFrame([(n, 100, 100) for n, _ in blocks], "file_name string, width int, height int")
    expected = sorted((n, i, float(r[0]), float(r[0] + r[2]), r[4]) for n, rows in blocks for i, r in enumerate(rows))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (10**6, 900, 130):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            raw = text_sources.read_wider_face(spark, str(tmp_path / "w.txt"), sizes, "wf", "train")
            assert sorted((r.file_name, r.source_box_index, r.xmin, r.xmax, r.attr_blur) for r in raw.boxes.collect()) == expected
            assert raw.images.count() == 60
        assert spark.read.text(str(tmp_path / "w.txt")).rdd.getNumPartitions() > 20
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_yolo(spark, tmp_path):
    root = tmp_path / "labels"
    (root / "x").mkdir(parents=True)
    (root / "x" / "a.txt").write_text("0 0.5 0.5 0.2 0.4\n1 0.1\n7 0.5 0.5 1 1\n1 0.25 0.5 0.5 1 extra\n")
    sizes = spark.createDataFrame([("x/a.jpg", 100, 50), ("y/b.png", 10, 10)], "file_name string, width int, height int")
    with pytest.raises(FileNotFoundError, match="y/b.png"):
        text_sources.read_yolo(spark, str(root), sizes, ["face", "plate"], "p", "test")
    raw = text_sources.read_yolo(spark, str(root), sizes, ["face", "plate"], "p", "test", optional=True)
    assert [(b[0], b[1], b[2]) + tuple(round(v, 9) for v in b[3:7]) for b in boxes(raw)] == [("x/a.jpg", 0, "face", 40.0, 15.0, 60.0, 35.0), ("x/a.jpg", 1, "plate", 0.0, 0.0, 50.0, 50.0)]
    assert len(images(raw)) == 2
    only = text_sources.read_yolo(spark, str(root), sizes, ["face", "plate"], "p", "test", subdirs=["x"])
    assert [i[0] for i in images(only)] == ["x/a.jpg"]
    assert union([raw, only]).images.count() == 3
    assert READERS["yolo"] is text_sources.read_yolo
    with pytest.raises(LookupError):
        read_source(spark, "none")
    splits = spark.createDataFrame([("test",), ("extra",)], "split string")
    assert materialised_splits(["train", "test"], splits) == ["test"]


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", w, h) + b"\0" * 9


def jpeg(w, h):
    return b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"\0" * 14 + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, h, w) + b"\0" * 12


def test_image_listing_and_sizes(spark, tmp_path):
    root = tmp_path / "img"
    (root / "s").mkdir(parents=True)
    (root / "s" / "a.PNG").write_bytes(png(30, 20))
    (root / "b.jpeg").write_bytes(jpeg(7, 9))
    (root / "c.txt").write_text("no")
    long = (b"\xff\xe1" + struct.pack(">H", 65_000) + b"\0" * 64_998) * 2  # two long segments before the frame
    (root / "long.jpg").write_bytes(jpeg(0, 0)[:2] + long + jpeg(31, 17)[2:])
    (root / "cut.jpg").write_bytes(jpeg(5, 5)[:12])
    assert sorted(r.file_name for r in files.listed_images(spark, str(root)).collect()) == ["b.jpeg", "cut.jpg", "long.jpg", "s/a.PNG"]
    assert sorted(map(tuple, files.image_sizes(spark, str(root)).collect())) == [("b.jpeg", 7, 9), ("cut.jpg", None, None), ("long.jpg", 31, 17), ("s/a.PNG", 30, 20)]
    found = {r.path: r for r in files.checksums(spark, str(root)).collect()}
    import base64
    import hashlib

    assert found["c.txt"].sha256 == hashlib.sha256(b"no").hexdigest() and found["c.txt"].md5 == base64.b64encode(hashlib.md5(b"no").digest()).decode()
