"""Plans that decide how a job grows: what is broadcast, and what a task or an exchange holds."""

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import Window

from silverloom.operators import gold
from silverloom.plans.star_tables import GOLD_CLASSES, StarTables
from silverloom.sources.byte_ranges import listed_files
from silverloom.sources.json_documents import open_documents

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan()


def test_elements_of_a_document_have_no_small_size(spark, tmp_path):
    """Elements are not taken to be as small as the numbers of the ranges that they are read from, which Spark would broadcast."""
    (tmp_path / "d.json").write_text('{"images": [{"id": 1}, {"id": 2}], "annotations": [{"image_id": 1}, {"image_id": 2}, {"image_id": 1}]}')
    document = open_documents(spark, str(tmp_path / "d.json"))
    images, annotations = document.rows("images", "id:bigint").select("id"), document.rows("annotations", "image_id:bigint")
    assert plan(images).stats().sizeInBytes() > 1e12
    met = annotations.join(images, F.col("image_id") == F.col("id"))
    assert sorted(r.image_id for r in met.collect()) == [1, 1, 2]
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().sparkPlan().toString()


def test_gold_images_of_a_union_meet_the_boxes_once(spark):
    t = StarTables(spark, SF)
    names = [f"ds{i}" for i in range(1, 6)]
    images = gold.union_datasets([t.images.where(F.col("dataset") == n) for n in names])
    boxes = t.gold_boxes.where("class_name = 'face'")
    found = gold.gold_images(images.unionByName(images), boxes, t.specs)
    keys = {tuple(r) for r in boxes.select("dataset", "split", "file_name").collect()}
    expected = sorted(tuple(r) for r in t.images.select("dataset", "split", "file_name").collect() if tuple(r) in keys)
    assert sorted((r.dataset, r.split, r.file_name) for r in found.collect()) == sorted(expected * 2)
    joins = plan(gold.gold_images(images, boxes, t.specs)).toString().count("Join LeftSemi")
    assert joins == 0 and GOLD_CLASSES


def test_events_read_only_boxes_that_they_can_name(spark):
    t = StarTables(spark, SF)
    quarter = t.table("events").count() // 4
    assert f"{quarter:012d}.jpg" in plan(t.events).toString()


def test_wider_face_blocks_go_to_several_files(spark, monkeypatch):
    """The blocks of many images are written by several tasks, and read back as those of one file."""
    from silverloom import round_trips
    from silverloom.queries import QUERIES

    rows = lambda: sorted(map(str, (r.asDict() for r in QUERIES["wider_face_boxes"](spark, SF).collect())))
    whole = rows()
    monkeypatch.setattr(round_trips, "FILE_ORDERS", 300)
    frame = QUERIES["wider_face_boxes"](spark, SF)
    assert len(frame.inputFiles()) > 3 and rows() == whole


def test_files_are_listed_by_tasks(spark, tmp_path):
    """a listing does not pass through the driver, and names what Spark's own does."""
    for name in ("a.jpg", "x/b.jpg", "x/y/c.txt", "k=1/_z=1/d.jpg", "_hidden/e.jpg", ".f.jpg", "x/_g.jpg", "with space/h%20.jpg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "x" / "empty.jpg").touch()
    for pattern in (None, "*.jpg"):
        theirs = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        theirs = (theirs.option("pathGlobFilter", pattern) if pattern else theirs).load(str(tmp_path)).select("path", "length")
        found = listed_files(spark, str(tmp_path), pattern)
        assert found.inputFiles() == [] and plan(found).stats().sizeInBytes() > 1e12
        assert sorted(found.collect()) == sorted(r for r in theirs.collect() if r.length)
    assert [r.length for r in listed_files(spark, str(tmp_path / "a.jpg")).collect()] == [5]
    assert listed_files(spark, f"{tmp_path}/x/*.jpg").count() == 1


def test_written_files_have_no_folder_each(spark, monkeypatch):
    """many files share a folder and are written by their tasks; Spark would commit and list a folder for each."""
    from silverloom import round_trips
    from silverloom.queries import QUERIES

    made = []
    monkeypatch.setattr(round_trips, "_path", lambda t, label, path=round_trips._path: made.append(path(t, label)) or made[-1])
    for name in ("published_files", "yolo_boxes"):
        rows = QUERIES[name](spark, "/root/testdata/sf0.01").count()
        found = [r.path for r in listed_files(spark, made[-1], "*.txt").collect()]
        assert rows and len(found) == 100 and len({p.rsplit("/", 1)[0] for p in found}) == 64


def test_boxes_of_large_tables_are_dealt_over_more_tasks(spark, monkeypatch):
    """the tasks of a shuffle grow with the rows, so that what one of them sorts does not."""
    from silverloom import round_trips  # noqa: F401  registers its queries
    from silverloom.plans import scratch
    from silverloom.queries import QUERIES

    rows = lambda: sorted(map(str, (r.asDict() for r in QUERIES["box_csv_rows"](spark, SF).collect())))
    whole, n = rows(), spark.read.parquet(f"{SF}/lineitem.parquet").count()
    monkeypatch.setattr(scratch, "TASK_ROWS", 500)
    assert "hashpartitioning(l_orderkey#" in (said := StarTables(spark, SF).raw_boxes._jdf.queryExecution().executedPlan().toString())
    assert f", {-(-n // 500)})" in said and rows() == whole


def test_similar_vectors_meet_as_blocks(spark):
    """pairs are scored by products of blocks and give what pair by pair gives, with ties, odd vectors and copies."""
    from silverloom.functions import expr as X
    from silverloom.operators import vectors

    rnd = np.random.default_rng(10)
    made = [(i, v.tolist()) for i, v in enumerate(rnd.standard_normal((3_000, 8)))]
    made += [(i + 3_000, made[i % 7][1]) for i in range(200)] + [(4_000, None), (4_001, []), (4_002, [float("nan")] * 8), (4_003, [1.0, None] * 4), (4_004, [0.0] * 8), (4_005, [1.0, 2.0]), (None, [1.0] * 8)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<float>")
    for frame, asked in ((table.where("vec_id < 4000"), "vec_id % 50 = 0"), (table, "vec_id % 500 = 0 or vec_id >= 4000")):
        v = frame.select("vec_id", X.l2_normalize(F.col("embedding")).alias("v"))
        q = v.where(asked).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
        score = v.join(q, F.col("vec_id") != F.col("query_id")).select("query_id", F.col("vec_id").alias("id"), X.dot(F.col("v"), F.col("q")).alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        expected = score.withColumn("rank", rank).where("rank <= 12").orderBy("query_id", "rank").collect()
        found = vectors.similar(frame, frame.where(asked), 12, "vec_id", block_queries=5)
        assert str(found.orderBy("query_id", "rank").select("query_id", "id", "score", "rank").collect()) == str(expected)
    assert "Join" not in plan(vectors.similar(table.where("vec_id < 4000"), table.where("vec_id < 100"), 5, "vec_id")).toString()


def test_digests_are_sums_of_whole_hashes(spark):
    """the sums of halves are those of the 60-bit numbers."""
    from silverloom.operators import query

    table = spark.range(500).select((F.col("id") % 3).alias("part"), "id")
    said = {r.part: r.digest for r in query.row_digests(table, ["part"]).collect()}
    shas = table.select("part", F.sha2(F.to_json(F.struct("id", "part")), 256).alias("sha")).collect()
    for part, digest in said.items():
        mine = [r.sha for r in shas if r.part == part]
        assert digest == "-".join(str(sum(int(s[15 * i : 15 * i + 15], 16) for s in mine)) for i in range(4))
    assert "decimal(38,0)" not in plan(query.row_digests(table, ["part"])).toString()


def test_documents_are_streamed_by_the_tasks_that_hold_their_images(spark, tmp_path, monkeypatch):
    """no task writes all of an export, no shuffle precedes it but that of the boxes, and it is packed."""
    import gzip
    import json

    from silverloom import round_trips
    from silverloom.queries import QUERIES
    from silverloom.sources import writers

    made, met = [], []
    monkeypatch.setattr(round_trips, "_path", lambda t, label, path=round_trips._path: made.append(path(t, label)) or made[-1])
    monkeypatch.setattr(writers, "_with_images", lambda *given, f=writers._with_images: met.append(f(*given)) or met[-1])
    for name, member in (("coco_boxes", "annotations"), ("wholebody_boxes", "annotations"), ("textocr_words", "anns")):
        monkeypatch.setattr(writers, "DOCUMENT_IMAGES", 1 << 16)
        rows = lambda: sorted(map(str, (r.asDict() for r in QUERIES[name](spark, SF).collect())))  # noqa: E731, B023
        whole = rows()
        monkeypatch.setattr(writers, "DOCUMENT_IMAGES", 50)
        assert rows() == whole
        files = [r.path.removeprefix("file:") for r in listed_files(spark, made[-1]).collect()]
        said = [json.loads(gzip.open(f).read()) for f in files]
        assert len(said) > 10 and all(f.endswith(".json.gz") for f in files) and all(len(d[{"anns": "imgs"}.get(member, "images")]) <= 50 for d in said)
        assert sum(len(d[member]) for d in said) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            frame = writers._with_images(round_trips._images(t := StarTables(spark, SF)), round_trips._image_boxes(t), F.lit(""), F.col("source_class"))
            assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3  # line items, and images for each join
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_document_without_images_is_whole(spark, tmp_path):
    from silverloom.sources import json_sources, writers

    images = spark.createDataFrame([], "id long, file_name string, width int, height int, coco_url string")
    boxes = spark.createDataFrame([], "file_name string, source_box_index int, source_class string, xmin double, ymin double, xmax double, ymax double")
    writers.write_coco(images, boxes, ["a"], str(tmp_path / "d"))
    raw = json_sources.read_coco(spark, str(tmp_path / "d"), "d", "s")
    assert raw.images.collect() == raw.boxes.collect() == []


def test_ids_are_packed_and_come_back(spark):
    """F4 to F9: digests go through a shuffle as 16 bytes; any other text, also one as long or as short, comes back too."""
    from silverloom.functions import expr as X

    texts = ["0123abcd-0000-ffff-89ab-0123456789ab", "0123ABCD-0000-ffff-89ab-0123456789ab", "0123abcd-0000-ffff-89ab-0123456789ab\n", "", "b00003", "x" * 16, "ä" * 8, "0123456789abcdef", None]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("p", X.packed_id("t"))
    rows = table.select("i", "t", "p", X.unpacked_id("p").alias("back")).orderBy("i").collect()
    assert [r.back for r in rows] == texts and len(rows[0].p) == 16 and len({bytes(r.p) for r in rows[:-1]}) == len(texts) - 1
    assert all(len(r.p) > 16 for r in rows[1:-1])


def test_normalised_boxes_stay_where_their_places_were_found(spark):
    """F4 to F9: boxes are shuffled once by order until they are folded, and a merge once by id, not again for what was edited."""
    from silverloom.operators import sync

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    ids = spark.createDataFrame([("a", "i")], "box_id string, image_id string")
    boxes = ids.selectExpr("*", "'face' as label", "1 as x", "1 as y", "1 as w", "1 as h")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        said = StarTables(spark, SF).normalized.boxes._jdf.queryExecution().executedPlan().toString()
        merge = sync.merged_boxes(boxes, ids, boxes, ids.select("box_id"))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert said.count("Exchange hashpartitioning") == 2  # line items and orders
    assert "Exchange hashpartitioning(box_id" not in merge.split("FullOuter")[0]  # what has met is not dealt by id again
