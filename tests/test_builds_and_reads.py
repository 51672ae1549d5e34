"""Builds, releases, vectors, the store merge and streams, end to end on small frames."""

import dataclasses
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from silverloom import schemas
from silverloom.operators import query, sync, vectors
from silverloom.plans import builds, pipelines
from silverloom.plans.builds import Layer, Releases, Store, VectorCache, build_id
from silverloom.plans.delta_store import DeltaStore
from silverloom.plans.pages import KeyedTable
from silverloom.schemas import EVENTS, RAW_BOXES, RAW_IMAGES, DatasetSpec
from silverloom.sources.contract import raw as as_raw
from silverloom.streaming import events as streams


def spec(name):
    return DatasetSpec(name, "open", name == "d1", {"train": "train", "holdout": "val"}, {"f": "face", "t": "text"}, "other", f"bronze/{name}")


def source(spark, name, n=4):
    parts = []
    for split in ("train", "holdout"):
        images = spark.createDataFrame([(f"{split}{i}.jpg", 100, 80) for i in range(n)], "file_name string, width int, height int")
        rows = [(f"{split}{i}.jpg", k, "ftx"[(i + k) % 3], 5.0 + k, 6.0, 40.5, 50.0 + i) for i in range(n) for k in range(3)]
        boxes = spark.createDataFrame(rows, "file_name string, source_box_index int, source_class string, xmin double, ymin double, xmax double, ymax double")
        parts.append(as_raw(images, boxes, name, split))
    from silverloom.sources.contract import union

    return union(parts)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    silver = {}
    for name in ("d1", "d2"):
        silver[name] = Layer(spark, str(root / "silver" / name))
        pipelines.build_silver(silver[name], source(spark, name), spec(name), None, ["bronze-1"])
    layer = Layer(spark, str(root / "gold"))
    manifest = pipelines.build_gold(layer, silver, [spec("d1"), spec("d2")], ["face", "text"])
    return root, silver, layer, manifest


def test_builds(spark, lake):
    root, silver, layer, manifest = lake
    assert layer.current() == manifest and manifest["rows"]["gold.images"] == 16
    again = pipelines.build_gold(layer, silver, [spec("d1"), spec("d2")], ["face", "text"])
    assert again == manifest
    store = Store(spark, str(root / "gold"))
    for k in range(3):
        store.write_json(f"builds/x{k}/_build.json", {"build_id": f"x{k}"})
        layer.publish(f"x{k}", {"k": k})
    assert store.names("builds") == ["x1", "x2"]
    layer.publish("x1", {"k": 1})
    with pytest.raises(LookupError, match="no build"):
        layer.read("gold.boxes", manifest["build_id"])
    pipelines.build_gold(layer, silver, [spec("d1"), spec("d2")], ["face", "text"])
    assert layer.current()["build_id"] == manifest["build_id"]
    with pytest.raises(ValueError, match="at least one"):
        pipelines.build_gold(layer, silver, [], ["face"])
    with pytest.raises(LookupError, match="d3"):
        pipelines.build_gold(layer, silver, [spec("d3")], ["face"])
    assert build_id("1", ["a", "b"]) != build_id("1", ["ab"]) != build_id("2", ["ab"]) and len(build_id("1", [])) == 32
    metadata = pipelines.gold_metadata(spark, layer.current(), {"d1": "m"}).collect()
    assert [(r.dataset, r.embedding_model) for r in metadata] == [("d1", "m"), ("d2", None)]


def test_a_split_without_rows_reads_as_no_rows(spark, lake, tmp_path):
    """The manifest lists a split that has images but no boxes, and reading it gives an empty frame of the schema."""
    layer, whole = Layer(spark, str(tmp_path / "s")), source(spark, "d1")
    bare = type(whole)(whole.images, whole.boxes.where("split = 'train'"))
    manifest = pipelines.build_silver(layer, bare, spec("d1"), None, ["a"])
    assert manifest["splits"] == ["holdout", "train"] and layer.read("silver.images").where("split = 'holdout'").count() == 4
    empty = layer.read("silver.boxes").where("split = 'holdout'")
    assert empty.count() == 0 and empty.columns == layer.read("silver.boxes").columns


def test_bad_build_is_discarded(spark, lake, tmp_path):
    layer = Layer(spark, str(tmp_path / "s"))
    pipelines.build_silver(layer, source(spark, "d1"), spec("d1"), None, ["a"])
    good = layer.current()["build_id"]
    twice = source(spark, "d1")
    double = type(twice)(twice.images, twice.boxes.unionByName(twice.boxes))
    with pytest.raises(ValueError, match="repeated box id"):
        pipelines.build_silver(layer, double, spec("d1"), None, ["b"])
    assert layer.current()["build_id"] == good and Store(spark, str(tmp_path / "s")).names("builds") == [good]


def test_reads(spark, lake):
    _, _, layer, _ = lake
    images, boxes = layer.read("gold.images"), layer.read("gold.boxes")
    plan = query.select_rows(boxes, query.Selection(dataset=("d1",), role=("train",)))._jdf.queryExecution().toString()
    assert "dataset" in plan.split("PartitionFilters: [")[1].split("]")[0]
    everything = sorted(r.image_id for r in images.collect())
    got, after = [], None
    while True:
        ids = query.page(images, "image_id", after, 5)
        rows = [r.image_id for r in ids.collect()]
        got += rows
        after = query.next_after(ids, "image_id", 5)
        if after is None:
            break
    assert got == everything
    shards = [query.select_rows(images, query.Selection(shard=k, num_shards=3)).count() for k in range(3)]
    assert sum(shards) == len(everything)
    assert query.select_rows(boxes, query.Selection(class_name=("face",))).count() + query.select_rows(boxes, query.Selection(class_name=("text",))).count() == boxes.count()
    with pytest.raises(ValueError, match="belong together"):
        query.Selection(shard=1)
    with pytest.raises(ValueError, match="not below"):
        query.Selection(shard=3, num_shards=3)
    with pytest.raises(ValueError, match="unknown parameters"):
        query.Selection.of(color="red")
    with pytest.raises(ValueError, match="limit"):
        query.page(images, "image_id", limit=0)
    with pytest.raises(ValueError, match="release"):
        query.resolve_release(query.Selection(), "images", [])
    with pytest.raises(ValueError, match="draft only"):
        query.resolve_release(query.Selection(release=1), "embeddings", [1])
    with pytest.raises(LookupError):
        query.resolve_release(query.Selection(release=2), "images", [1])
    assert query.resolve_release(query.Selection(role=("train",)), "images", []) is None


def test_releases(spark, lake, tmp_path):
    _, _, layer, manifest = lake
    images, boxes = layer.read("gold.images"), layer.read("gold.boxes")
    releases = Releases(spark, str(tmp_path / "releases"))
    assert releases.freeze(images, boxes, "g") == 1 and releases.numbers() == [1]
    assert releases.changed(1) == []
    with pytest.raises(ValueError, match="equal to release 1"):
        releases.freeze(images.repartition(3), boxes, "g")
    assert releases.freeze(images.where("dataset = 'd1'"), boxes.where("dataset = 'd1'"), "g") == 2
    view = query.release_view(images, releases.read(2, "gold.images"))
    assert view.count() == 12
    with pytest.raises(ValueError, match="no evaluation split"):
        releases.freeze(images.where("role = 'train'"), boxes, "g")
    cut = releases.read(1, "gold.boxes").where("w < 35").collect()
    builds.write_table(spark.createDataFrame(cut, boxes.schema), "gold.boxes", str(tmp_path / "releases" / "0001" / "gold.boxes"))
    assert releases.changed(1) == ["gold.boxes"]
    assert query.difference(images, images.where("dataset = 'd1'")).select("side").distinct().first().side == "left"


def test_vectors(spark, lake, tmp_path):
    _, _, layer, _ = lake
    images = layer.read("gold.images").select("dataset", "split", "file_name", "image_id")
    cache = VectorCache(spark, str(tmp_path / "cache"), "m", "1", ["image_id"])
    made = vectors.hash_embedder(16)
    first = pipelines.embed_missing(images.orderBy("image_id").limit(5), cache, made, "silver.embeddings", str(tmp_path / "v1"), "image_id")
    assert first == {"written": 5, "embedded": 5, "reused": 0}
    second = pipelines.embed_missing(images, cache, made, "silver.embeddings", str(tmp_path / "v2"), "image_id")
    assert second["reused"] == 5 and second["written"] == images.count()
    assert VectorCache(spark, str(tmp_path / "cache"), "m", "2", ["image_id"]).read().count() == 0
    rows = spark.read.parquet(str(tmp_path / "v2")).collect()
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in rows)
    near = vectors.similar(spark.read.parquet(str(tmp_path / "v2")), spark.read.parquet(str(tmp_path / "v2")).limit(2), 3, "image_id")
    assert near.count() == 6


def test_a_stopped_embedding_keeps_its_closed_parts(spark, tmp_path):
    """Every part that was closed before the embedder failed is there, and the next run makes only the rest."""
    rows = spark.createDataFrame([("d", "s", f"f{i}", sync.event_file_id(i, "x" * 12), f"{i * 40503 % 65536:04x}-{i}") for i in range(300)], "dataset string, split string, file_name string, other string, image_id string")
    wanted = rows.drop("other")
    made = vectors.hash_embedder(8)

    parts = lambda: len(list((tmp_path / "cache").rglob("*.parquet")))

    def failing(items):
        if parts() >= 3:
            raise RuntimeError("stopped")
        return made(items)

    cache = VectorCache(spark, str(tmp_path / "cache"), "m", "1", ["image_id"])
    with pytest.raises(Exception, match="stopped"):
        pipelines.embed_missing(wanted, cache, failing, "silver.embeddings", str(tmp_path / "v"), "image_id", part_rows=40, at_once=1)
    kept = cache.read().count()
    assert parts() >= 3 and 0 < kept < 300
    held = [pd.read_parquet(f)["image_id"].sort_values().tolist() for f in (tmp_path / "cache").rglob("*.parquet")]
    assert all(len(p) <= 40 for p in held)
    everything = sorted(r.image_id for r in wanted.collect())
    assert all(everything[everything.index(p[0]) : everything.index(p[0]) + len(p)] == p for p in held)  # a part is a range of keys
    done = pipelines.embed_missing(wanted, cache, made, "silver.embeddings", str(tmp_path / "v"), "image_id", part_rows=40)
    assert done == {"written": 300, "embedded": 300 - kept, "reused": kept}
    assert cache.read().count() == 300


def test_every_missing_row_is_embedded_once(spark, tmp_path):
    """One stream over files that are read once each: an embedder that counts its items sees every row once."""
    wanted = spark.range(500).selectExpr("'d' as dataset", "'s' as split", "concat('f', id) as file_name", "md5(cast(id as string)) as image_id")
    seen = tmp_path / "seen"
    seen.mkdir()
    made = vectors.hash_embedder(4)

    def counted(items):
        (seen / uuid.uuid4().hex).write_text("\n".join(items["image_id"]))
        return made(items)

    cache = VectorCache(spark, str(tmp_path / "cache"), "m", "1", ["image_id"])
    done = pipelines.embed_missing(wanted, cache, counted, "silver.embeddings", str(tmp_path / "v"), "image_id", part_rows=50, at_once=2)
    calls = [line for f in seen.iterdir() for line in f.read_text().split("\n")]
    assert done["embedded"] == 500 and sorted(calls) == sorted(r.image_id for r in wanted.collect())


def changed_spec(**changes):
    return dataclasses.replace(spec("d1"), **changes)


def test_a_build_is_named_by_all_that_it_is_made_from(spark, tmp_path, monkeypatch):
    """Each input of silver changed alone gives another build and the rows that follow from it."""
    layer, raw = Layer(spark, str(tmp_path / "s")), source(spark, "d1", 2)
    event = lambda label: spark.createDataFrame([("d1", "train", "train0.jpg", str(boxes[0].box_id), 0, 1, False, label, 1.0, 2.0, 30.0, 40.0)], "dataset string, split string, file_name string, box_id string, file_ordinal bigint, log_sequence bigint, is_deleted boolean, label_name string, x double, y double, w double, h double")
    classes = lambda: sorted(r.class_name for r in layer.read("silver.boxes").collect())
    ids = [pipelines.build_silver(layer, raw, spec("d1"), None, ["a"])["build_id"]]
    boxes = layer.read("silver.boxes").where("file_name = 'train0.jpg'").orderBy("box_index").collect()
    first = classes()
    assert pipelines.build_silver(layer, raw, spec("d1"), None, ["a"])["build_id"] == ids[0]
    for changed in (changed_spec(category_map={"f": "head", "t": "text"}), changed_spec(default_class="person"), changed_spec(split_roles={"train": "val", "holdout": "test"}), changed_spec(license="closed"), changed_spec(image_root="elsewhere")):
        ids.append(pipelines.build_silver(layer, raw, changed, None, ["a"])["build_id"])
    pipelines.build_silver(layer, raw, changed_spec(category_map={"f": "head", "t": "text"}), None, ["a"])
    assert "head" in classes() and "face" not in classes() and "face" in first
    with pytest.raises(ValueError, match="list of their files"):
        pipelines.build_silver(layer, raw, spec("d1"), event("person"), ["a"])
    for label, files in (("person", ["e1"]), ("head", ["e1", "e2"])):
        manifest = pipelines.build_silver(layer, raw, spec("d1"), event(label), ["a"], files)
        ids.append(manifest["build_id"])
        assert (manifest["event_files"], manifest["last_event"]) == (len(files), files[-1])
        assert layer.read("silver.boxes").where(F.col("box_id") == boxes[0].box_id).first().class_name == label
    ids.append(pipelines.build_silver(layer, raw, spec("d1"), None, ["b"])["build_id"])
    monkeypatch.setattr(schemas, "CLASSES", [*schemas.CLASSES, "more"])
    ids.append(pipelines.build_silver(layer, raw, spec("d1"), None, ["a"])["build_id"])
    assert len(set(ids)) == len(ids) == 10


def test_gold_is_named_by_licence_root_and_roles(spark, tmp_path):
    """Gold built again after its dataset's licence, image root or roles changed has the new ones in its rows."""
    silver, layer = {"d1": Layer(spark, str(tmp_path / "s"))}, Layer(spark, str(tmp_path / "g"))
    pipelines.build_silver(silver["d1"], source(spark, "d1", 2), spec("d1"), None, ["a"])
    ids = set()
    for changes in ({}, {"license": "closed", "commercial_use": False}, {"image_root": "moved"}, {"split_roles": {"train": "val", "holdout": "test"}}):
        ids.add(pipelines.build_gold(layer, silver, [changed_spec(**changes)], ["face", "text"])["build_id"])
        row = layer.read("gold.images").where("split = 'train'").first()
        now = changed_spec(**changes)
        assert (row.license, row.commercial_use, row.role) == (now.license, now.commercial_use, now.split_roles["train"]) and row.image_path.startswith(now.image_root)
    ids.add(pipelines.build_gold(layer, silver, [spec("d1")], ["face"])["build_id"])
    pipelines.build_silver(silver["d1"], source(spark, "d1", 2), changed_spec(default_class="head"), None, ["a"])
    ids.add(pipelines.build_gold(layer, silver, [spec("d1")], ["face", "text"])["build_id"])
    assert len(ids) == 6


def test_other_models_are_removed(spark, tmp_path):
    wanted = spark.createDataFrame([("d", "s", f"f{i}", f"{i:02x}") for i in range(20)], "dataset string, split string, file_name string, image_id string")
    path, made = str(tmp_path / "cache"), vectors.hash_embedder(4)
    for model, version in (("a/b", "1"), ("a/b", "2"), ("m", "2")):
        VectorCache(spark, path, model, version, ["image_id"]).append(vectors.embed(wanted, made))
    cache = VectorCache(spark, path, "m", "2", ["image_id"])
    assert pipelines.embed_missing(wanted, cache, made, "silver.embeddings", str(tmp_path / "v"), "image_id")["embedded"] == 0
    assert Store(spark, path).names("model=m") == ["version=2"] and cache.read().count() == 20
    assert VectorCache(spark, path, "a/b", "1", ["image_id"]).read().count() == 0


def test_vectors_are_sorted_in_small_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    wanted = spark.range(5_000).selectExpr("'d' as dataset", "if(id % 2 = 0, 'a', 'b') as split", "concat('f', id) as file_name", "md5(cast(id as string)) as image_id")
    cache = VectorCache(spark, str(tmp_path / "cache"), "m", "1", ["image_id"])
    pipelines.embed_missing(wanted, cache, vectors.hash_embedder(8), "silver.embeddings", str(tmp_path / "v"), "image_id")
    for split in "ab":
        ranges = []
        for name in glob.glob(str(tmp_path / "v" / "dataset=d" / f"split={split}" / "*.parquet")):
            file = pq.ParquetFile(name)
            assert all(file.metadata.row_group(i).num_rows <= 1_024 for i in range(file.metadata.num_row_groups))
            ids = file.read(["image_id"])["image_id"].to_pylist()
            assert ids == sorted(ids)
            ranges.append((ids[0], ids[-1]))
        assert all(a[1] < b[0] for a, b in zip(sorted(ranges), sorted(ranges)[1:], strict=False))


def test_incomplete_vectors_are_discarded(spark, tmp_path):
    wanted = spark.createDataFrame([("d", "s", "f", "01"), ("d", "s", "g", "01")], "dataset string, split string, file_name string, image_id string")
    cache = VectorCache(spark, str(tmp_path / "cache"), "m", "1", ["image_id"])

    class Lossy(VectorCache):
        def read(self):
            return super().read().limit(0)

    with pytest.raises(ValueError, match="rows wanted"):
        pipelines.embed_missing(wanted, Lossy(spark, cache.path, "m", "1", ["image_id"]), vectors.hash_embedder(4), "silver.embeddings", str(tmp_path / "v"), "image_id")
    assert not Store(spark, str(tmp_path / "v")).exists("")


def test_pointers_are_never_lost(spark, tmp_path):
    """A store that was stopped between the steps of a replacement has the new pointer beside the place of the old one."""
    store = Store(spark, str(tmp_path))
    store.write_json("current.json", {"build_id": "a"})
    store.write_json("current.json", {"build_id": "b"})
    assert store.read_json("current.json") == {"build_id": "b"} and not store.exists("current.json.staged")
    store.rename("current.json", "current.json.staged")
    assert store.holds_json("current.json") and store.read_json("current.json") == {"build_id": "b"}
    for number in (9_999, 10_000):
        store.write_json(f"{number}/_build.json", {"release": number})
    assert Releases(spark, str(tmp_path)).numbers() == [9_999, 10_000]


def test_similar_answers_every_query(spark):
    """Queries beyond one block are answered as well, and blocks give what one broadcast gives."""
    rnd = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rnd.standard_normal((40, 3)))], "vec_id long, embedding array<double>")
    many = spark.createDataFrame([(100 + i, v.tolist()) for i, v in enumerate(rnd.standard_normal((4_200, 3)))], "vec_id long, embedding array<double>")
    assert vectors.similar(rows, many, 1, "vec_id").select("query_id").distinct().count() == 4_200
    said = lambda n: sorted((r.query_id, r.rank, r.id, r.score) for r in vectors.similar(rows, rows.where("vec_id % 2 = 0"), 3, "vec_id", block_queries=n).collect())
    assert said(3) == said(100) and len(said(3)) == 60


def test_merge_is_idempotent(spark, lake):
    _, _, layer, _ = lake
    images, staged = layer.read("gold.images"), sync.staged_boxes(layer.read("gold.boxes")).drop("confidence")
    held = staged.limit(0)
    none = spark.createDataFrame([], "box_id string")
    once = sync.merged_boxes(staged, images, held, none)
    assert once.count() == staged.count()
    assert sync.changed_boxes(staged, staged, none).count() == 0 and sync.new_boxes(staged, staged, none).count() == 0
    first = staged.orderBy("box_id").first().box_id
    lagging = staged.withColumn("x", F.when(F.col("box_id") == first, F.col("x") + 1).otherwise(F.col("x")))
    changed = sync.changed_boxes(staged, lagging, none).collect()
    assert [(r.box_id, r.is_moved) for r in changed] == [(first, True)]
    edited = spark.createDataFrame([(first,)], "box_id string")
    assert sync.changed_boxes(staged, lagging, edited).count() == 0
    assert sync.new_boxes(staged, staged.where(F.col("box_id") != first), edited).count() == 0
    gone = sync.removed_boxes(staged.where(F.col("box_id") != first), images, staged, none)
    assert [r.box_id for r in gone.collect()] == [first]
    for later in (none, edited):  # the one join agrees with the deltas, applied one after another
        old = lagging.where(F.col("image_id") != images.first().image_id).unionByName(staged.limit(3).withColumn("box_id", F.concat("box_id", F.lit("x"))))
        changed, new, gone = sync.changed_boxes(staged, old, later), sync.new_boxes(staged, old, later), sync.removed_boxes(staged, images, old, later)
        left = old.join(gone.select("box_id"), "box_id", "left_anti").join(changed.select("box_id"), "box_id", "left_anti")
        expected = left.select(*old.columns).unionByName(changed.select(*old.columns)).unionByName(new.select(*old.columns))
        merged = sync.merged_boxes(staged, images, old, later)
        assert sorted(map(str, merged.collect())) == sorted(map(str, expected.collect()))
        counts = {r.fate: r.num_rows for r in sync.fates(staged, images, old, later).collect()}
        assert (counts.get("new", 0), counts.get("updated", 0), counts.get("removed", 0)) == (new.count(), changed.count(), gone.count())
        assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 3
    assert sync.image_upserts(images, spark.createDataFrame([], "image_id string, path string"), "s3://b").where("action = 'insert'").count() == images.count()
    manifest = spark.createDataFrame([("a", 7)], "chain_id string, log_sequence bigint")
    assert sync.gold_marker(manifest, "a").first()[0] == 7 and sync.gold_marker(manifest, "b").first()[0] == 0


def test_shard_plan_keeps_what_is_stored(spark):
    rows = [("a", "train", i) for i in range(5)] + [("b", "train", i) for i in range(30)] + [("b", "val", i) for i in range(4)]
    images = spark.createDataFrame(rows, "dataset string, split string, i int")
    plan = sync.shard_plan(images, 12)
    assert sorted(r.name for r in plan.collect()) == ["a", "b.train.1-of-3", "b.train.2-of-3", "b.train.3-of-3", "b.val"]
    more = spark.createDataFrame([*rows, ("b", "test", 1), *[("a", "val", i) for i in range(40)]], "dataset string, split string, i int")
    grown = sync.shard_plan(more, 12, plan)
    assert sorted(r.name for r in grown.collect()) == ["a", "b.test", "b.train.1-of-3", "b.train.2-of-3", "b.train.3-of-3", "b.val"]


def test_streams(spark, tmp_path):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS) + ", file_ordinal bigint"
    rows = lambda f, seqs: [("d", "s", "f", f"b{q % 3}", q, q % 4 == 0, "face", 1.0, 1.0, 1.0, 1.0, f) for q in seqs]
    inbox = tmp_path / "inbox"
    schema = spark.createDataFrame(rows(0, [1]), ddl).schema
    spark.createDataFrame(rows(1, range(6)), ddl).coalesce(1).write.parquet(str(inbox / "1"))
    stream = lambda: streams.event_stream(spark, str(inbox / "*"), schema)
    state, mark = str(tmp_path / "state"), str(tmp_path / "mark")
    streams.latest_state(stream(), state, mark).awaitTermination()
    spark.createDataFrame(rows(0, range(50, 60)), ddl).coalesce(1).write.parquet(str(inbox / "0"))
    spark.createDataFrame(rows(2, range(2)), ddl).coalesce(1).write.parquet(str(inbox / "2"))
    streams.latest_state(stream(), state, mark).awaitTermination()
    keyed = spark.read.parquet(state).schema
    got = {(r.box_id, r.file_ordinal, r.log_sequence) for r in streams.read_state(spark, state, keyed).collect()}
    assert got == {("b0", 2, 0), ("b1", 2, 1), ("b2", 1, 5)}
    streams.ingest(stream(), str(tmp_path / "bronze"), str(tmp_path / "mark2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 18
    edits = spark.createDataFrame([(5, "b1", "i"), (7, "b9", "i")], "sequence bigint, sample_id string, image_id string")
    edits.coalesce(1).write.parquet(str(tmp_path / "log"))
    boxes = spark.createDataFrame([("b1", "i", "face", 1, 2, 3, 4)], "sample_id string, image_id string, label string, x int, y int, w int, h int")
    loaded = spark.createDataFrame([("i", "d", "s", "f")], "image_id string, dataset string, split string, file_name string")
    log = spark.readStream.schema(edits.schema).parquet(str(tmp_path / "log"))
    streams.publish(log, boxes, loaded, boxes.select("sample_id").limit(0), str(tmp_path / "out"), str(tmp_path / "mark3")).awaitTermination()
    cut = spark.read.parquet(str(tmp_path / "out" / "*")).orderBy("log_sequence").collect()
    assert [(r.box_id, r.is_deleted, r.label_name) for r in cut] == [("b1", False, "face"), ("b9", True, None)]


def test_raw_schemas(spark):
    assert RAW_IMAGES.names[:3] == RAW_BOXES.names[:3] == ["dataset", "split", "file_name"]


def test_a_page_opens_few_files(spark, tmp_path):
    """Pages by the zone map: the same rows as a sort of everything, two files at most, also behind a filter of groups."""
    rows = spark.range(4_000).selectExpr("md5(cast(id as string)) as image_id", "concat('d', id % 3) as dataset", "if(id % 4 = 0, 'a', 'b') as split", "if(id % 4 = 0, 'val', 'train') as role", "id % 3 = 0 as commercial_use", "id", "if(id % 500 = 7, 'face', 'text') as class_name")
    table = KeyedTable.write(rows, str(tmp_path / "t"), "image_id", file_rows=150, files=5)
    everything = sorted((r.image_id, r.dataset, r.role, r.class_name) for r in rows.collect())
    files = len(list((tmp_path / "t" / "rows").glob("*.parquet")))
    assert files >= 25
    for selection in (query.Selection(release="draft"), query.Selection(dataset=("d1",), role=("train",))):
        wanted = [r[0] for r in everything if (selection.dataset is None or r[1] in selection.dataset) and (selection.role is None or r[2] in selection.role)]
        for after in (None, wanted[0], wanted[333], wanted[-1]):
            got = table.page(selection, after, 20)
            assert [r.image_id for r in got.collect()] == [w for w in wanted if after is None or w > after][:20]
            assert len(got.inputFiles()) <= 2
    rare = query.Selection(class_name=("face",), release="draft")
    assert [r.image_id for r in table.page(rare, None, 5).collect()] == [r[0] for r in everything if r[3] == "face"][:5]
    assert table.page(query.Selection(dataset=("none",)), None, 5).collect() == []
    places = sorted((r.place, r.image_id) for r in table.numbered().collect())
    assert places == list(enumerate(r[0] for r in everything))
    plan = table.numbered()._jdf.queryExecution().executedPlan().toString()
    # the one exchange by a key is of the map, whose files are grouped; the rows stay where they are
    assert plan.count("Exchange hashpartitioning(file_path") == plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange rangepartitioning" not in plan
    with pytest.raises(ValueError, match="limit"):
        table.page(rare, None, 0)


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    """The state is Spark's: after many boxes, a batch of few events writes few rows, and late events lose to it."""
    columns = [f for f in EVENTS.names if f != "is_deleted"]
    def events(boxes, ordinal, deleted=False):  # noqa: E306
        rows = spark.createDataFrame([(f"b{i}", i) for i in boxes], "box_id string, log_sequence bigint")
        made = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(EVENTS[c].dataType).alias(c) for c in columns], F.lit(deleted).alias("is_deleted"), F.lit(ordinal).cast("bigint").alias("file_ordinal"))
        return made

    inbox, state, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    schema = events([0], 0).schema
    wrote = []
    for part in (events(range(2_000), 5), events([3, 4, 5_000], 7, True), events([3, 7], 2)):
        part.coalesce(1).write.mode("append").parquet(inbox)
        streams.latest_state(streams.event_stream(spark, inbox, schema), state, mark).awaitTermination()
        wrote.append(spark.read.parquet(state).count() - sum(wrote))
    assert wrote == [2_000, 3, 2]
    got = {r.box_id: (r.file_ordinal, r.is_deleted) for r in streams.read_state(spark, state, schema).collect()}
    assert len(got) == 2_001 and got["b3"] == got["b4"] == got["b5000"] == (7, True) and got["b7"] == (5, False)


def test_a_merge_writes_what_it_changes(spark, tmp_path, monkeypatch):
    """A merge of 1 % of the boxes writes a small delta; reads, repeats, a stop and compaction give the full merge's rows."""
    rows = lambda ids, x=1, label="face": spark.createDataFrame([(f"b{i:05d}", f"i{i % 50}", label, x, 2, 3, 4) for i in ids], "box_id string, image_id string, label string, x int, y int, w int, h int")
    images = spark.createDataFrame([(f"i{k}",) for k in range(50)], "image_id string")
    later = spark.createDataFrame([("b00003",), ("b00011",)], "box_id string")
    held = rows(range(5_000))
    store = DeltaStore(spark, str(tmp_path / "store"))
    with pytest.raises(LookupError):
        store.read()
    store.create(held)
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / "store" / name).rglob("*.parquet"))
    content = lambda df: sorted(map(tuple, df.select(*held.columns).collect()))
    staged = rows([*range(20, 4_985), *range(5_000, 5_010)]).unionByName(rows(range(0, 20), 9))
    expected = content(sync.merged_boxes(staged, images, held, later))
    counts = store.merge(staged, images, later)
    assert counts == {"new": 10, "updated": 18, "removed": 15, "left": 4_967} and content(store.read()) == expected
    assert size("delta-1") < 0.05 * size("base-0") + 4_000
    before = store.store.read_json("store.json")
    assert store.merge(staged, images, later).get("updated", 0) == 0 and store.store.read_json("store.json") == before
    second = rows(range(0, 4_000), 5, "head")
    merged = content(sync.merged_boxes(second, images, store.read(), later))
    with monkeypatch.context() as m:
        m.setattr(store.store, "write_json", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            store.merge(second, images, later)
    assert content(store.read()) == expected
    store.merge(second, images, later, most_deltas=1)
    assert content(store.read()) == merged and store.store.read_json("store.json") == {"base": 2, "deltas": []}
    assert not store.store.exists("delta-1") and not store.store.exists("base-0")
