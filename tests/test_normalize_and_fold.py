"""The normaliser's worked example and the truth table of the fold."""

import pytest
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.operators import checks, corrections, normalize
from silverloom.schemas import EVENTS, RAW_IMAGES, DatasetSpec, TableSpec, spec_frames, struct

SPEC = DatasetSpec("d", "open", True, {"train": "train"}, {"Human face": "face", "Plate": "license_plate"}, "other", "bronze/d")


def raw(spark, rows):
    boxes = spark.createDataFrame(rows, "file_name string, source_box_index int, source_class string, xmin double, ymin double, xmax double, ymax double")
    return boxes.withColumn("dataset", F.lit("d")).withColumn("split", F.lit("train"))


@pytest.fixture
def images(spark):
    return spark.createDataFrame([("d", "train", "a.jpg", 120, 90), ("d", "train", "b.jpg", 72, 48)], RAW_IMAGES)


def test_normalize(spark, images):
    rows = [("a.jpg", 0, "human FACE", 10.0, 10.0, 30.0, 30.0), ("a.jpg", 1, "dog", 5.0, 5.0, 9.0, 9.0), ("a.jpg", 2, "plate", 104.0, 81.0, 133.0, 97.0), ("a.jpg", 3, "Plate", 7.0, 7.0, 7.0, 20.0)]
    out = normalize.normalize(raw(spark, rows), images, spec_frames(spark, [SPEC])[1])
    got = out.boxes.orderBy("box_index").collect()
    assert [r.class_id for r in got] == [0, 5, 1] and [r.box_index for r in got] == [0, 1, 2]
    assert (got[2].x + got[2].w, got[2].y + got[2].h) == (120.0, 90.0)
    assert [tuple(r) for r in normalize.tally(out.dropped).collect()] == [("degenerate_box", 1)]
    assert checks.box_problems(out.boxes, images).count() == 0


def event(box, deleted=False, label="face", geometry=(14.0, 25.0, 28.0, 42.0), seq=1, file=0, name="a.jpg"):
    return ("d", "train", name, box, seq, deleted, label, *(geometry or (None,) * 4), file)


EVENT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS) + ", file_ordinal bigint"


@pytest.mark.parametrize(
    ("deleted", "label", "geometry", "case", "expected"),
    [
        (False, "face", (14.0, 25.0, 28.0, 42.0), "noop", ("face", "f", 13.7, False, False)),
        (False, "Person", (14.0, 25.0, 28.0, 42.0), "relabel", ("person", "f", 13.7, True, False)),
        (False, "Logo", (14.0, 25.0, 28.0, 42.0), "relabel", ("other", "Logo", 13.7, True, False)),
        (False, "Face", (14.0, 25.0, 28.0, 42.0), "relabel", ("face", "f", 13.7, True, False)),
        (False, "face", (17.0, 25.0, 28.0, 42.0), "move", ("face", "f", 17.0, False, True)),
        (False, "text", (17.0, 25.0, 28.0, 42.0), "both", ("text", "f", 17.0, True, True)),
        (True, None, None, "delete", None),
        (False, "face", (210.0, 25.0, 28.0, 42.0), "move", None),
        (False, None, None, "noop", ("face", "f", 13.7, False, False)),
    ],
)
def test_fold_truth_table(spark, images, deleted, label, geometry, case, expected):
    source = raw(spark, [("a.jpg", 0, "f", 13.7, 24.5, 42.0, 66.2)])
    spec = DatasetSpec("d", "open", True, {"train": "train"}, {"f": "face"})
    silver = normalize.normalize(source, images, spec_frames(spark, [spec])[1]).boxes
    box = silver.first().box_id
    events = spark.createDataFrame([event(box, deleted, label, geometry)], EVENT_DDL)
    latest = corrections.latest_events(events)
    assert corrections.fold_cases(silver, images, latest).first().fold_case == case
    got = [(r.class_name, r.source_class, r.x, r.is_class_corrected, r.is_geometry_corrected) for r in corrections.fold_events(silver, images, latest).boxes.collect()]
    assert got == ([] if expected is None else [expected])


def test_fold_adds_and_orders(spark, images):
    silver = normalize.normalize(raw(spark, [("a.jpg", 0, "f", 1.0, 1.0, 9.0, 9.0)]), images, spec_frames(spark, [SPEC])[1]).boxes
    rows = [
        event("n1", label="Logo", seq=5), event("n2", label="text", seq=6), event("n1", label="head", seq=9, file=1),
        event("n3", label=None, seq=7), event("n4", geometry=(300.0, 0.0, 5.0, 5.0), seq=8), event("n5", True, None, None, seq=3), event("n6", seq=1, name="none.jpg"),
        event("n2", label="person", seq=99, file=0), event("n2", label="text", seq=2, file=1),
    ]
    latest = corrections.latest_events(spark.createDataFrame(rows, EVENT_DDL))
    out = corrections.fold_events(silver, images, latest)
    got = [(r.box_index, r.box_id if r.origin == "studio" else "source", r.class_name, r.origin) for r in out.boxes.orderBy("box_index").collect()]
    assert got == [(0, "source", "other", "source"), (1, "n1", "head", "studio"), (2, "n2", "text", "studio")]
    assert {tuple(r) for r in normalize.tally(out.dropped).collect()} == {("incomplete_addition", 1), ("degenerate_box", 1)}
    assert {r.box_id for r in checks.orphan_events(latest, silver).collect()} == {"n1", "n2", "n3", "n4", "n6"}


def test_crops_and_rounding(spark):
    rows = [(7.3, 8.7, 4.5, 0.3), (4.5, 5.5, 0.7, 2.5), (63.8, 20.0, 0.2, 1.6), (31.62, 47.9, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "x double, y double, w double, h double")
    got = [tuple(r) for r in df.select(X.crop_start("x", "w"), X.crop_start("y", "h"), X.crop_side("w"), X.crop_side("h")).collect()]
    assert got == [(7, 8, 4, 1), (4, 6, 1, 2), (63, 20, 1, 2), (32, 47, 1, 1)]
    assert [tuple(r) for r in spark.range(1).select(X.half_up(F.lit(0.5)), X.half_up(F.lit(1.5)), X.half_up(F.lit(-0.5))).collect()] == [(1.0, 2.0, 0.0)]
    start, end = X.clamp_crop(F.col("a"), F.col("b"), F.lit(100))
    df = spark.createDataFrame([(-5, 10), (120, 10), (95, 10), (3, -1)], "a int, b int")
    assert [tuple(r) for r in df.select(start, end).collect()] == [(0, 5), (99, 100), (95, 100), (0, 100)]


def test_ids(spark):
    row = spark.range(1).select(X.image_id(F.lit("d"), F.lit("s"), F.lit("f")), X.box_id(F.lit("d"), F.lit("s"), F.lit("f"), F.lit(3)), X.shard32(F.lit("ffffffff-0")), X.shard_of(F.lit("0000000b-0"), 4)).first()
    import hashlib
    import uuid

    assert row[0] == str(uuid.UUID(hashlib.md5(b"d/s/f").hexdigest())) and row[1] == str(uuid.UUID(hashlib.md5(b"d/s/f#3").hexdigest()))
    assert row[2] == 2**32 - 1 and row[3] == 3


def test_specs_and_schema_checks(spark):
    with pytest.raises(ValueError, match="unknown classes"):
        DatasetSpec("x", "l", True, {}, {"a": "nothing"})
    with pytest.raises(ValueError, match="nullable"):
        TableSpec("t", struct("a int"), ("a",))
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    assert checks.enforce(df, "s string, n bigint!").schema.simpleString() == "struct<s:string,n:bigint>"
    with pytest.raises(Exception, match="null in column s"):
        checks.enforce(df, "s string!").collect()


def test_chain_checks(spark):
    ddl = "chain_id string, sequence int, event_file_id string, parent_event_file_id string, after_log_sequence bigint, last_log_sequence bigint, sha256 string"
    good = [("a", 1, "f1", None, 0, 10, "s1"), ("a", 2, "f2", "f1", 10, 15, "s2")]
    files = spark.createDataFrame(good, ddl)
    assert checks.chain_breaks(files).count() == 0
    bad = spark.createDataFrame([*good, ("a", 3, "f3", "f1", 15, 16, "s3"), ("a", 5, "f5", "f3", 16, 17, "s5"), ("b", 1, "g", None, 3, 4, "t"), ("b", 2, "h", "g", 5, 6, "u")], ddl)
    assert {(r.event_file_id, r.problem) for r in checks.chain_breaks(bad).collect()} == {("f3", "parent"), ("f5", "sequence"), ("h", "after")}
    listed = spark.createDataFrame([("a", 1, "f1", None, 0, 10, "other")], ddl)
    assert {(r.stored_id, r.problem) for r in checks.changed_event_files(files, listed).collect()} == {("f1", "changed"), ("f2", "gone")}


def test_the_fold_moves_the_boxes_once(spark, images, tmp_path):
    """With no broadcast there is one exchange of boxes and events together, one of the images, and none after the joins."""
    boxes = normalize.normalize(raw(spark, [("a.jpg", 0, "f", 1.0, 1.0, 9.0, 9.0)]), images, spec_frames(spark, [SPEC])[1]).boxes
    boxes.write.parquet(str(tmp_path / "silver"))
    silver = spark.read.schema(boxes.schema).parquet(str(tmp_path / "silver"))
    rows = [("d", "s", "a.jpg", f"x{k}", k, k, False, "face", 1.0, 2.0, 30.0, 40.0) for k in range(4)]
    events = spark.createDataFrame(rows, "dataset string, split string, file_name string, box_id string, file_ordinal bigint, log_sequence bigint, is_deleted boolean, label_name string, x double, y double, w double, h double")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = corrections.fold_events(silver, images, corrections.latest_events(events)).boxes._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange ") == 3  # events by box, boxes and events by image, images by image
