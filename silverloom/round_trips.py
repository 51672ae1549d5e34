"""Registered queries that write the given tables in a published format or layout and read them back."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.operators import checks, corrections, gold, query, sync, tallies, vectors
from silverloom.plans import builds, pipelines
from silverloom.plans.pages import KeyedTable
from silverloom.plans.scratch import dealt, scratch_dir, stored
from silverloom.plans.star_tables import CATEGORY_MAP, GOLD_CLASSES, StarTables, specs
from silverloom.queries import SILVER, _image_cache, _store, registered
from silverloom.schemas import spec_frames
from silverloom.sources import archives, byte_ranges, contract, files, json_sources, registry, text_sources, writers
from silverloom.streaming import events as streams

#: Orders whose images share one document of a format that is one document.
CHUNK_ORDERS = 4_096
#: Orders whose blocks share one file of a format of lines, so that no task writes all of them.
FILE_ORDERS = 1 << 18
SOURCE_CLASSES = ["AF", "AO", "NF", "NO", "RF", "RO"]
CORNERS = ["xmin", "ymin", "xmax", "ymax"]


def _path(t: StarTables, label: str) -> str:
    return f"{scratch_dir(t.spark)}/{label}-{uuid.uuid4().hex}"


def _images(t: StarTables) -> DataFrame:
    url = F.concat(F.lit("http://images.example/"), F.col("split"), F.lit("/"), F.col("file_name"))
    return t.images.withColumns({"id": F.col("o_orderkey"), "coco_url": url, "chunk": F.floor(F.col("o_orderkey") / CHUNK_ORDERS)})


def _image_boxes(t: StarTables) -> DataFrame:
    """Raw boxes with the id of their image, which they meet by that without another shuffle."""
    return t.sized_boxes.drop("dataset", "split", "width", "height").withColumnRenamed("o_orderkey", "id")


def _boxes(raw: contract.Raw, *more: str) -> DataFrame:
    return raw.boxes.select("file_name", "source_box_index", "source_class", *CORNERS, *more)


# the corners of a box that was written as corner and sides
READ_BACK = "xmin, ymin, xmin+((xmin+bw)-xmin) as xmax, ymin+((ymin+bh)-ymin) as ymax"
FLOORED = "floor(xmin) as xmin, floor(ymin) as ymin, floor(xmin)+floor((xmin+bw)-xmin) as xmax, floor(ymin)+floor((ymin+bh)-ymin) as ymax"


@registered(f"select file_name, i as source_box_index, source_class, {READ_BACK}, attr_is_group_of from bx", "bx")
def coco_boxes(t: StarTables) -> DataFrame:
    path = _path(t, "coco")
    writers.write_coco(_images(t), _image_boxes(t), SOURCE_CLASSES, path, {"iscrowd": F.col("attr_is_group_of").cast("int")}, compress=True)
    return _boxes(registry.read_source(t.spark, "coco", path=path, dataset="d", split="s"), "attr_is_group_of")


@registered("select file_name, width, height, i as num_boxes from (select im.file_name, any_value(im.width) as width, any_value(im.height) as height, count(l_orderkey) as i from im left join lineitem on l_orderkey=o_orderkey group by im.file_name)", "im")
def coco_images(t: StarTables) -> DataFrame:
    """Images of a file with their boxes, also those without any."""
    path = _path(t, "coco")
    writers.write_coco(_images(t), _image_boxes(t), SOURCE_CLASSES, path, {"iscrowd": F.lit(0)})
    raw = json_sources.read_coco(t.spark, path, "d", "s")
    counts = raw.boxes.groupBy("file_name").agg(F.count("*").alias("num_boxes"))
    return raw.images.join(counts, "file_name", "left").select("file_name", "width", "height", F.coalesce("num_boxes", F.lit(0)).alias("num_boxes"))


@registered("select dataset, count(*) as num_boxes from bx where not (attr_is_group_of or attr_is_depiction) group by dataset", "bx")
def instance_counts(t: StarTables) -> DataFrame:
    """Boxes without those of groups and depictions, by dataset, through the raw contract."""
    parts = []
    for name in ("ds1", "ds2", "ds3", "ds4", "ds5"):
        mine = F.col("dataset") == name
        parts.append(contract.raw(t.images.where(mine).drop("dataset", "split"), t.raw_boxes.where(mine).drop("dataset", "split"), name, "all"))
    return contract.union(parts).instances().groupBy("dataset").agg(F.count("*").alias("num_boxes"))


@registered(f"select split||'/'||file_name as file_name, i as source_box_index, source_class, {READ_BACK} from bx", "bx")
def lvis_boxes(t: StarTables) -> DataFrame:
    path = _path(t, "lvis")
    writers.write_coco(_images(t), _image_boxes(t), SOURCE_CLASSES, path)
    return _boxes(registry.read_source(t.spark, "lvis", path=path, dataset="d", split="s"))


@registered(
    """select split||'/'||file_name as file_name, cast(row_number() over(partition by file_name order by i, part)-1 as int) as source_box_index, name as source_class, px as xmin, py as ymin, px+pw as xmax, py+ph as ymax from (
    select *, 0 as part, source_class as name, xmin as px, ymin as py, (xmin+bw)-xmin as pw, (ymin+bh)-ymin as ph from bx
    union all select *, 1, 'face', xmin, ymin, 1.5, 2.0 from bx where attr_is_group_of union all select *, 2, 'left_hand', ymin, xmin, 3.0, 4.25 from bx where attr_is_depiction
    union all select *, 3, 'right_hand', 1.0, 2.0, 5.0, 6.0 from bx where i%2=0)""",
    "bx",
)
def wholebody_boxes(t: StarTables) -> DataFrame:
    """The person's box and those of its parts that are valid."""
    path = _path(t, "wholebody")
    box = lambda *v: F.array(*[F.col(x) if isinstance(x, str) else F.lit(x) for x in v])
    more = {
        "iscrowd": F.lit(0), "face_box": box("xmin", "ymin", 1.5, 2.0), "face_valid": F.col("attr_is_group_of"),
        "lefthand_box": box("ymin", "xmin", 3.0, 4.25), "lefthand_valid": F.col("attr_is_depiction"),
        "righthand_box": box(1.0, 2.0, 5.0, 6.0), "righthand_valid": F.when(F.col("source_box_index") % 2 == 0, True),
    }
    writers.write_coco(_images(t), _image_boxes(t), SOURCE_CLASSES, path, more, compress=True)
    return _boxes(registry.read_source(t.spark, "coco_wholebody", path=path, dataset="d", split="s"))


@registered(f"select file_name, i as source_box_index, 'word' as source_class, {READ_BACK}, attr_is_group_of as attr_is_illegible from bx", "bx")
def textocr_words(t: StarTables) -> DataFrame:
    path = _path(t, "textocr")
    writers.write_textocr(_images(t), _image_boxes(t), path, F.when(F.col("attr_is_group_of"), ".").otherwise(F.col("source_class")), compress=True)
    return _boxes(registry.read_source(t.spark, "textocr", path=path, dataset="d", split="s"), "attr_is_illegible")


@registered(
    """select file_name, i as source_box_index, 'word' as source_class, xmin, ymin, xmin+bw as xmax, ymin+bh as ymax, not attr_is_group_of as attr_is_illegible, attr_is_depiction as attr_is_handwritten, i%2=0 as attr_is_vertical from bx
    where bw>=0 and bh>=0""",
    "bx",
)
def hiertext_words(t: StarTables) -> DataFrame:
    path = _path(t, "hiertext")
    flags = {"legible": F.col("attr_is_group_of"), "handwritten": F.col("attr_is_depiction"), "vertical": F.col("source_box_index") % 2 == 0}
    writers.write_hiertext(_images(t), t.raw_boxes, path, flags)
    return _boxes(registry.read_source(t.spark, "hiertext", path=path, dataset="d", split="s"), "attr_is_illegible", "attr_is_handwritten", "attr_is_vertical")


@registered(
    """select case when split='train' then 'train_'||substr(file_name,1,1)||'/' else '' end||file_name as file_name, i as source_box_index, source_class, (xmin/width)*width as xmin, (ymin/height)*height as ymin,
    ((xmin+bw)/width)*width as xmax, ((ymin+bh)/height)*height as ymax, attr_is_group_of, attr_is_depiction from bx where o_orderkey%9<>0""",
    "bx",
)
def box_csv_rows(t: StarTables) -> DataFrame:
    """Normalised boxes of a CSV, scaled by the images that are there; every ninth is not."""
    n = t.table("lineitem").count()
    sized = stored(dealt(t.raw_boxes, n, "file_name").join(t.images.select("file_name", "width", "height"), "file_name"), "sized")
    there = t.images.where("o_orderkey % 9 <> 0")
    parts = []
    for split in ("train", "val", "test"):
        path = _path(t, "open-images")
        writers.write_open_images(sized.where(F.col("split") == split), path, n)
        named = there.where(F.col("split") == split).withColumn("file_name", X.sharded_file_name(X.stem(F.col("file_name")), F.lit(split)))
        parts.append(registry.read_source(t.spark, "open_images", path=path, sizes=named, dataset="d", split=split))
    return _boxes(contract.union(parts), "attr_is_group_of", "attr_is_depiction")


@registered("select 0::bigint as num_scattered, count(distinct o_orderkey) as num_images from bx", "bx")
def contiguous_images(t: StarTables) -> DataFrame:
    """The rows of an image stand together in a box CSV."""
    path = _path(t, "csv")
    writers.write_open_images(t.raw_boxes.join(t.images.select("file_name", "width", "height"), "file_name"), path)
    rows = text_sources.csv_rows(t.spark, path)
    scattered = text_sources.scattered_images(rows).agg(F.count("*").alias("num_scattered"))
    return scattered.join(rows.agg(F.countDistinct("ImageID").alias("num_images")), how="cross")  # a row each


@registered(
    f"""select file_name, i as source_box_index, 'face' as source_class, {FLOORED}, i%3 as attr_blur, cast(attr_is_group_of as int) as attr_expression, 0 as attr_illumination, attr_is_depiction as attr_invalid, 2 as attr_occlusion, cast(null as int) as attr_pose from bx""",
    "bx",
)
def wider_face_boxes(t: StarTables) -> DataFrame:
    """Blocks of lines whose last grade is left out."""
    path = _path(t, "wider")
    grades = [F.col("source_box_index") % 3, F.col("attr_is_group_of").cast("int"), F.lit(0), F.col("attr_is_depiction").cast("int"), F.lit(2)]
    images = _images(t).withColumn("chunk", F.floor(F.col("o_orderkey") / FILE_ORDERS))
    writers.write_wider_face(images, t.raw_boxes, path, grades, chunks=True)
    raw = registry.read_source(t.spark, "wider_face", path=path, sizes=t.images, dataset="d", split="s")
    return _boxes(raw, "attr_blur", "attr_expression", "attr_illumination", "attr_invalid", "attr_occlusion", "attr_pose")


YOLO_NAMES = ["c0", "c1", "c2", "c3", "c4"]


@registered(
    """select 'p'||l_suppkey||'.png' as file_name, cast(row_number() over(partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity)-1 as int) as source_box_index, 'c'||(l_linenumber-1) as source_class,
    (l_quantity/64-l_linenumber/16/2)*w as xmin, ((l_partkey%64)/64-((l_suppkey%8+1)/32)/2)*480 as ymin, (l_quantity/64+l_linenumber/16/2)*w as xmax, ((l_partkey%64)/64+((l_suppkey%8+1)/32)/2)*480 as ymax
    from (select *, 640+l_suppkey%64 as w from lineitem) where l_linenumber<=5 and l_tax<0.08 and l_suppkey in (select s_suppkey from supplier)"""
)
def yolo_boxes(t: StarTables) -> DataFrame:
    """A label file for each supplier, with its line items; some lines are short or of unknown classes."""
    path = _path(t, "yolo")
    number = lambda c: c.cast("double").cast("string")
    whole = F.concat_ws(" ", (F.col("l_linenumber") - 1).cast("string"), number(F.col("l_quantity") / 64), number((F.col("l_partkey") % 64) / 64), number(F.col("l_linenumber") / 16), number((F.col("l_suppkey") % 8 + 1) / 32))
    line = F.when(F.col("l_tax") >= 0.08, F.lit("1 0.5 0.5")).otherwise(whole)
    stem = lambda key: F.concat((key % 64).cast("string"), F.lit("/p"), key.cast("string"))
    lines = t.table("lineitem").select(stem(F.col("l_suppkey")).alias("stem"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("pos"), line.alias("line"))
    writers.write_yolo(lines, path)
    sizes = t.table("supplier").select(F.concat(stem(F.col("s_suppkey")), F.lit(".png")).alias("file_name"), (640 + F.col("s_suppkey") % 64).cast("int").alias("width"), F.lit(480).alias("height"))
    raw = registry.read_source(t.spark, "yolo", label_root=path, sizes=sizes, class_names=YOLO_NAMES, dataset="d", split="s", optional=True)
    return _boxes(raw).withColumn("file_name", F.substring_index("file_name", "/", -1))


# layers and manifests


def _layer(t: StarTables) -> str:
    """Normalised boxes of each dataset under a folder of their own."""
    path = _path(t, "silver")
    boxes = stored(t.normalized.boxes, "normalized")
    for name in ("ds1", "ds2", "ds3", "ds4", "ds5"):
        builds.write_table(boxes.where(F.col("dataset") == name), "silver.boxes", f"{path}/{name}")
    return path


@registered("select dataset, split, count(*) as num_boxes, max(box_index) as last_index from ba where dataset in ('ds1','ds3','ds5') group by all", "ba")
def layer_scan(t: StarTables) -> DataFrame:
    """Several folders of a layer as one frame of one schema."""
    path = _layer(t)
    boxes = registry.read_table(t.spark, "silver.boxes", *[f"{path}/{n}" for n in ("ds1", "ds3", "ds5")])
    return boxes.groupBy("dataset", "split").agg(F.count("*").alias("num_boxes"), F.max("box_index").alias("last_index"))


@registered("select file_ordinal, count(*) as num_events, count(distinct log_sequence) as num_sequences from ev group by all", "ev")
def event_file_rows(t: StarTables) -> DataFrame:
    """Event files with the file that each row came from."""
    path = _path(t, "event-files")
    t.events.repartition("file_ordinal").write.partitionBy("file_ordinal").parquet(path)
    read = registry.read_event_files(t.spark, t.events.drop("file_ordinal").schema, path)
    ordinal = F.regexp_extract("file_path", r"file_ordinal=(\d+)", 1).cast("bigint")
    return read.groupBy(ordinal.alias("file_ordinal")).agg(F.count("*").alias("num_events"), F.countDistinct("log_sequence").alias("num_sequences"))


@registered("select box_id, file_ordinal, log_sequence from ev where file_ordinal<=(select max(file_ordinal) from ev)*3//4", "ev")
def events_until_marker(t: StarTables) -> DataFrame:
    """The events up to the file that a build was made with."""
    events = stored(t.events, "events").withColumn("event_file_id", F.concat(F.lit("f"), F.col("file_ordinal").cast("string")))
    listed = events.select("event_file_id", "file_ordinal").distinct()
    last = listed.agg(F.max("file_ordinal")).first()[0] * 3 // 4
    return corrections.events_until(events.drop("file_ordinal"), listed, f"f{last}").select("box_id", "file_ordinal", "log_sequence")


@registered(
    """select dataset, case when dataset in ('ds1','ds2') then 'open' else 'research' end as license, count(distinct split) as num_splits, count(*) as num_images, (select count(*) from im) as all_images from im group by dataset""",
    "im",
)
def bronze_manifests(t: StarTables) -> DataFrame:
    """Manifests of what was linked, written and read back by their schema, and the sum of their row counts."""
    read = files.read_manifest(t.spark, f"{_bronze(t).root}/*/manifest.json", builds.BRONZE_SCHEMA)
    rows = F.aggregate(F.map_values("rows"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    each = read.select("dataset", "license", F.size("rows").cast("bigint").alias("num_splits"), rows.alias("num_images"))
    return each.join(tallies.manifest_rows(each, "num_images").withColumnRenamed("num_rows", "all_images"), how="cross")  # a row of sums


def _bronze(t: StarTables) -> builds.Store:
    """Manifests of what was linked for each dataset, with the rows of its splits."""
    store = builds.Store(t.spark, _path(t, "bronze"))
    counts = tallies.split_counts(t.images).collect()  # a row for each split
    for spec in specs():
        builds.write_bronze_manifest(store, spec, {r["split"]: r["num_images"] for r in counts if r["dataset"] == spec.name})
    return store


def _event_files(events: DataFrame) -> dict[str, list[str]]:
    """The event files of each dataset in order, named by their ordinal."""
    rows = events.select("dataset", "file_ordinal").distinct().collect()  # a row for each file and dataset
    return {n: [f"f{o}" for o in sorted(r.file_ordinal for r in rows if r.dataset == n)] for n in {r.dataset for r in rows}}


@registered("select dataset,split,file_name,box_id,box_index,class_id,class_name,source_class,x,y,w,h,origin,is_class_corrected,is_geometry_corrected from fo", "fo")
def silver_build(t: StarTables) -> DataFrame:
    """Each dataset's silver through the whole job: normalised, folded, checked, published, and read by its pointer."""
    bronze, events, out = _bronze(t), stored(t.events, "events"), []
    raw_boxes, files = stored(t.raw_boxes, "raw"), _event_files(events)
    for spec in specs():
        layer, mine = builds.Layer(t.spark, _path(t, "layer")), F.col("dataset") == spec.name
        raw = contract.Raw(t.images.where(mine), raw_boxes.where(mine))
        pipelines.build_silver(layer, raw, spec, events.where(mine), [builds.manifest_digest(bronze, spec.name)], files.get(spec.name, []))
        out.append(layer.read("silver.boxes"))
    return gold.union_datasets(out).select(*SILVER)


@registered(
    """select build, dataset, license, license='open' as commercial_use, class_name, count(*) as num_boxes from (
      select 1 as build, dataset, case when dataset in ('ds1','ds2') then 'open' else 'research' end as license, class_name from fo where dataset<>'ds4' and not (coalesce(attr_is_group_of,false) or coalesce(attr_is_depiction,false))
      union all select 1, dataset, 'research', class_name from ba where dataset='ds4' and not (attr_is_group_of or attr_is_depiction)
      union all select 2, dataset, case when dataset='ds2' then 'open' when dataset='ds1' then 'closed' else 'research' end, class_name from fo where dataset not in ('ds3','ds4') and not (coalesce(attr_is_group_of,false) or coalesce(attr_is_depiction,false))
      union all select 2, dataset, 'research', class_name from ba where dataset='ds3' and not (attr_is_group_of or attr_is_depiction)
      union all select 2, dataset, 'research', case when source_class='AF' then 'head' else class_name end from ba where dataset='ds4' and not (attr_is_group_of or attr_is_depiction))
    where class_name in ('face','license_plate','head','person','text') group by all""",
    "fo",
)
def rebuilt_layers(t: StarTables) -> DataFrame:
    """Silver of all datasets and gold of them, built twice in the same folders. The second time the licence of ds1 is

    another, ds3 comes without its edits, and ds4 with another category map; the rest is found built.
    """
    bronze, events = _bronze(t), stored(t.events, "events")
    raw_boxes, files = stored(t.raw_boxes, "raw"), _event_files(events)
    layers = {s.name: builds.Layer(t.spark, _path(t, "layer")) for s in specs()}
    golden, out = builds.Layer(t.spark, _path(t, "gold")), []
    second = {"ds1": {"license": "closed", "commercial_use": False}, "ds4": {"category_map": CATEGORY_MAP | {"AF": "head"}}}
    for build, changes, bare in ((1, {}, {"ds4"}), (2, second, {"ds3", "ds4"})):
        chosen = [dataclasses.replace(s, **changes.get(s.name, {})) for s in specs()]
        for spec in chosen:
            mine, edited = F.col("dataset") == spec.name, spec.name not in bare
            raw = contract.Raw(t.images.where(mine), raw_boxes.where(mine))
            pipelines.build_silver(layers[spec.name], raw, spec, events.where(mine) if edited else None, [builds.manifest_digest(bronze, spec.name)], files.get(spec.name, []) if edited else None)
        pipelines.build_gold(golden, layers, chosen, GOLD_CLASSES)
        licensed = golden.read("gold.images").select("image_id", "license")
        rows = golden.read("gold.boxes").join(licensed, "image_id")
        out.append(rows.groupBy("dataset", "license", "commercial_use", "class_name").agg(F.count("*").alias("num_boxes")).withColumn("build", F.lit(build)))
        if build == 1:
            out[0] = stored(out[0], "first-build")  # its folders may go when the second is published
    return out[0].unionByName(out[1])


@registered(
    """select dataset, role, count(*) as num_images, (select count(*) from gb where gb.dataset=gi.dataset and gb.role=gi.role) as num_boxes from gi group by dataset, role""",
    "gi",
)
def gold_build(t: StarTables) -> DataFrame:
    """The union of all datasets through the whole job, read by the current pointer."""
    layer = _gold(t)
    images, boxes = layer.read("gold.images"), layer.read("gold.boxes")
    counts = boxes.groupBy("dataset", "role").agg(F.count("*").alias("num_boxes"))
    return images.groupBy("dataset", "role").agg(F.count("*").alias("num_images")).join(counts, ["dataset", "role"], "left")


def _gold(t: StarTables) -> builds.Layer:
    """Gold built of silver layers whose manifests name their last event and, where images have vectors, the model."""
    silver, boxes = {}, stored(t.folded.boxes, "folded")
    last = {r.dataset: r.n for r in t.events.groupBy("dataset").agg(F.max("file_ordinal").alias("n")).collect()}  # a row for each dataset
    for spec in specs():
        layer = silver[spec.name] = builds.Layer(t.spark, _path(t, "layer"))
        mine = F.col("dataset") == spec.name
        tables = {"silver.images": t.images.where(mine), "silver.boxes": boxes.where(mine)}
        about = {"dataset": spec.name, "splits": sorted(spec.split_roles), "last_event": f"f{last[spec.name]}", "embedding_model": "m" if spec.commercial_use else None}
        layer.build(builds.build_id("1", [spec.name]), lambda tables=tables: tables, about)
    layer = builds.Layer(t.spark, _path(t, "gold"))
    pipelines.build_gold(layer, silver, specs(), GOLD_CLASSES)
    return layer


@registered("select dataset, split, count(*) as num_images, false as is_changed from gi where role in ('val','test') group by all union all select 'cut', 'cut', 0, true", "gi")
def frozen_release(t: StarTables) -> DataFrame:
    """A release of the evaluation rows, read by its number; one whose rows were cut is told from it."""
    t = t.with_stored_gold()
    releases = builds.Releases(t.spark, _path(t, "releases"))
    number = releases.freeze(t.gold_images, t.gold_boxes, "gold-1")
    rows = releases.read(number, "gold.images").groupBy("dataset", "split").agg(F.count("*").alias("num_images"))
    second = releases.freeze(t.gold_images.where("dataset <> 'ds5'"), t.gold_boxes.where("dataset <> 'ds5'"), "gold-2")
    cut = stored(releases.read(second, "gold.images").where("dataset <> 'ds4'"), "cut")
    builds.write_table(cut, "gold.images", releases.store.path(f"{second:04d}/gold.images"))
    told = t.spark.createDataFrame([("cut", "cut", 0, releases.changed(second) == ["gold.images"])], "dataset string, split string, num_images bigint, is_changed boolean")
    return rows.withColumn("is_changed", F.lit(bool(releases.changed(number)))).unionByName(told)


@registered(
    """select dataset, substr(sha256('["1", ["'||dataset||'"]]'),1,32) as silver_build, 'f'||max(file_ordinal) as last_event, case when dataset in ('ds1','ds2') then 'm' end as embedding_model from ev group by dataset""",
    "ev",
)
def gold_metadata(t: StarTables) -> DataFrame:
    """A row for each dataset of the published gold manifest, with its silver build, last event and model."""
    return pipelines.gold_metadata(t.spark, _gold(t).current())


@registered("select box_id, 16 as dim, count(*) over () as num_rows from gb", "gb")
def sorted_vectors(t: StarTables) -> DataFrame:
    """Vectors of all crops through the cache, written in the order of their ids."""
    t = t.with_stored_gold()
    wanted = vectors.with_crops(t.gold_boxes).withColumn("box_index", F.lit(0))
    wanted = wanted.select("dataset", "split", "file_name", "box_id", "box_index", *vectors.CROP)
    path = _path(t, "vectors")
    cache = builds.VectorCache(t.spark, _path(t, "cache"), "m", "1", ["box_id", *vectors.CROP])
    made = pipelines.embed_missing(wanted, cache, vectors.hash_embedder(16), "silver.crop_embeddings", path, "box_id")
    rows = registry.read_table(t.spark, "silver.crop_embeddings", path)
    return rows.select("box_id", F.size(X.checked_dim(F.col("embedding"), 16)).alias("dim"), F.lit(made["written"]).cast("bigint").alias("num_rows"))


# published files


@registered("select s_suppkey, cast(octet_length(encode(c))  as bigint) as size, sha256(c) as sha256, to_base64(unhex(md5(c))) as md5 from (select s_suppkey, s_name||'/'||s_nationkey||chr(10) as c from supplier)")
def published_files(t: StarTables) -> DataFrame:
    """Sizes and checksums of written files."""
    path, key = _path(t, "published"), F.col("s_suppkey")
    name = F.concat((key % 64).cast("string"), F.lit("/s_suppkey="), key.cast("string"), F.lit(".txt"))
    content = F.concat(F.concat_ws("/", "s_name", F.col("s_nationkey").cast("string")), F.lit("\n")).cast("binary")
    writers.write_files(byte_ranges.spread(t.table("supplier"), "s_suppkey").select(name.alias("name"), content.alias("content")), path)
    found = files.checksums(t.spark, path).where(F.col("path").endswith(".txt"))
    return found.select(F.regexp_extract("path", r"s_suppkey=(\d+)", 1).cast("bigint").alias("s_suppkey"), "size", "sha256", "md5")


@registered("select o_orderkey, case when o_orderkey%13=0 then 'missing' when o_orderkey%7=0 then 'size' when o_orderkey%11=0 then 'checksum' end as problem from orders where o_orderkey%13=0 or o_orderkey%7=0 or o_orderkey%11=0")
def file_mismatches(t: StarTables) -> DataFrame:
    """Files that are not as they were pinned."""
    orders = t.table("orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("path"), F.col("o_custkey").cast("bigint").alias("size"), X.sha256_hex(F.col("o_orderpriority").cast("binary")).alias("checksum"))
    found = orders.where("o_orderkey % 13 <> 0").withColumns({"size": F.when(F.col("o_orderkey") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")), "checksum": F.when(F.col("o_orderkey") % 11 == 0, "0").otherwise(F.col("checksum"))})
    return checks.file_mismatches(found.drop("o_orderkey"), orders.drop("o_orderkey")).select(F.col("path").cast("bigint").alias("o_orderkey"), "problem")


@registered(
    """select k as file, case when count(*)=1 then md5(unhex(any_value(h))) else md5(unhex(string_agg(md5(unhex(substr(h, i*131072+1, 131072))), '' order by i)))||'-'||count(*) end as etag
    from (select k, h, unnest(range(greatest(1, cast(ceil(length(h)/131072.0) as bigint)))) as i from (
      select doc_id//256 as k, hex(encode(string_agg(coalesce(text,''), chr(10) order by doc_id, text))) as h from documents group by 1)) group by k"""
)
def multipart_etags(t: StarTables) -> DataFrame:
    """Etags of files that hold the documents' texts, 256 to a file, in parts of 64 KB that are read by 16 KB."""
    path, text = _path(t, "texts"), F.coalesce("text", F.lit(""))
    whole = t.table("documents").groupBy(F.floor(F.col("doc_id") / 256).alias("k")).agg(F.sort_array(F.collect_list(F.struct("doc_id", text.alias("text")))).alias("d"))
    joined = F.array_join(F.transform("d", lambda d: d["text"]), "\n").cast("binary")
    writers.write_files(whole.select(F.concat(F.col("k").cast("string"), F.lit(".txt")).alias("name"), joined.alias("content")), path)
    found = files.multipart_etags(byte_ranges.listed_files(t.spark, path), 64 << 10, 16 << 10)
    return found.select(F.regexp_extract("path", r"/(\d+)\.txt$", 1).cast("bigint").alias("file"), "etag")


@registered("select c_custkey, 320+c_custkey%705 as width, 240+c_nationkey as height from customer")
def image_sizes(t: StarTables) -> DataFrame:
    """Sizes from the headers of written images: PNG, and JPEG, some with segments before their frame that are longer than a head."""
    path, key = _path(t, "images"), F.col("c_custkey")
    wide = lambda c, n: F.lpad(F.hex(c.cast("bigint")), n, "0")
    width, height = 320 + key % 705, F.lit(240) + F.col("c_nationkey")
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), wide(width, 8), wide(height, 8), F.lit("0802000000"))
    segment = F.lit("FFE1FFFF" + "00" * 65_533)
    jpeg = F.concat(F.lit("FFD8"), F.when(key % 50 == 1, F.concat(segment, segment)).otherwise(""), F.lit("FFC0001108"), wide(height, 4), wide(width, 4), F.lit("03" + "00" * 9))
    name = F.concat((key % 64).cast("string"), F.lit("/"), key.cast("string"), F.when(key % 2 == 0, ".png").otherwise(".jpg"))
    dealt = byte_ranges.spread(t.table("customer"), "c_custkey")  # before the contents are made, so that those are not shuffled
    writers.write_files(dealt.select(name.alias("name"), F.unhex(F.when(key % 2 == 0, png).otherwise(jpeg)).alias("content")), path)
    sizes = files.image_sizes(t.spark, path)
    return sizes.select(F.regexp_extract("file_name", r"/(\d+)\.", 1).cast("bigint").alias("c_custkey"), "width", "height")


@registered("select 'docs-'||(doc_id//512)||'.zip' as archive, 'd'||doc_id||'.txt' as member, cast(octet_length(encode(coalesce(text,''))) as bigint) as size, md5(coalesce(text,'')) as digest from documents")
def archive_rows(t: StarTables) -> DataFrame:
    """Members of zip archives that hold the documents' texts, read by their places."""
    path, folder = _path(t, "archives"), F.concat(F.lit("docs-"), F.floor(F.col("doc_id") / 512).cast("string"))
    member = F.concat(folder, F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = t.table("documents").select(F.concat(folder, F.lit(".zip")).alias("archive"), member.alias("member"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    writers.write_zips(rows, path)
    found = archives.archive_members(t.spark, path, task_bytes=256 << 10)
    return found.select(F.substring_index("archive", "/", -1).alias("archive"), "member", "size", F.md5("content").alias("digest"))


@registered(
    r"""select page_id, case when url ~ '^[a-z][a-z0-9+.-]*://.*' then split_part(url,'://',1) else 'local' end as host_kind, regexp_replace(url,'[?#].*$','') as redacted, regexp_replace(url,'^[a-z]+://','')||'/a.b' as unpacked,
    case when url ~ '^(/|[a-z][a-z0-9+.-]*://).*' then url else 's3://r/'||url end as rebased from pages"""
)
def url_parts(t: StarTables) -> DataFrame:
    """The kind of host of each URL, the URL without its query, an archive's unpacked path, and a path under a root."""
    url = F.col("url")
    bare = F.regexp_replace(url, "^[a-z]+://", "")
    return t.table("pages").select(
        "page_id", X.host_kind(url).alias("host_kind"), X.redact_url(F.concat(X.redact_url(url), F.lit("?key=1#x"))).alias("redacted"),
        X.unpacked_path(F.concat(bare, F.lit("/a.b"), F.element_at(F.array(F.lit(".zip"), F.lit(".tar.gz"), F.lit(".tgz")), (F.col("page_id") % 3 + 1).cast("int")))).alias("unpacked"),
        X.rebase(url, F.lit("s3://r/")).alias("rebased"),
    )


# events: chains, streams, markers


def _chain(t: StarTables, upto: float) -> DataFrame:
    """Event files of two chains, a file for each ordinal, up to a share of them."""
    n = t.table("events").count()
    ordinal = F.floor(F.col("event_id") * 20 / n).cast("bigint")
    made = t.table("events").groupBy(ordinal.alias("file_ordinal")).agg(F.count("*").alias("n")).where(F.col("file_ordinal") < 20 * upto)
    made = made.withColumns({"chain_id": F.when(F.col("file_ordinal") < 10, "a").otherwise("b"), "sequence": (F.col("file_ordinal") % 10 + 1).cast("int")})
    chain = Window.partitionBy("chain_id").orderBy("sequence")
    name = F.concat(F.lpad(F.col("sequence").cast("string"), 6, "0"), F.lit("-"), F.substring(F.md5(F.concat_ws("/", "chain_id", F.col("n").cast("string")).cast("binary")), 1, 12))
    made = made.withColumns({"event_file_id": name, "last_log_sequence": F.sum("n").over(chain), "sha256": F.sha2(name, 256)})
    return made.withColumns({"parent_event_file_id": F.lag("event_file_id").over(chain), "after_log_sequence": F.coalesce(F.lag("last_log_sequence").over(chain), F.lit(0))})


@registered("select case when o<10 then 'a' else 'b' end as chain_id, cast(o%10+1 as int) as sequence, n as num_events from (select cast(floor(event_id*20/(select count(*) from events)) as bigint) as o, count(*) as n from events group by 1) where o>=12")
def new_event_files(t: StarTables) -> DataFrame:
    """Listed event files after those that are stored."""
    listed = stored(_chain(t, 1.0), "listed")
    return pipelines.new_event_files(listed.where("file_ordinal < 12"), listed).select("chain_id", "sequence", F.col("n").alias("num_events"))


@registered("select case when o<10 then 'a' else 'b' end as chain_id, cast(o%10+1 as int) as sequence, case when o>=18 then 'gone' else 'changed' end as problem from (select distinct cast(floor(event_id*20/(select count(*) from events)) as bigint) as o from events) where o>=18 or o%5=2")
def changed_event_files(t: StarTables) -> DataFrame:
    """Stored event files that the listing shows otherwise or no longer."""
    held = stored(_chain(t, 1.0), "held")
    sha = F.when(F.col("file_ordinal") % 5 == 2, "other").otherwise(F.col("sha256"))
    found = checks.changed_event_files(held, held.where("file_ordinal < 18").withColumn("sha256", sha))
    return found.select("chain_id", "sequence", "problem")


@registered("select 'a' as chain_id, max(log_sequence) as log_sequence from ev where file_ordinal<10 union all select 'b', max(log_sequence) from ev where file_ordinal>=10 union all select 'c', 0", "ev")
def gold_markers(t: StarTables) -> DataFrame:
    """The last event that gold holds of each chain, 0 for one that it does not know."""
    held = t.events.groupBy(F.when(F.col("file_ordinal") < 10, "a").otherwise("b").alias("chain_id")).agg(F.max("log_sequence").alias("log_sequence"))
    held = stored(held, "markers")
    marks = [sync.gold_marker(held, c).select(F.lit(c).alias("chain_id"), "log_sequence") for c in ("a", "b", "c")]
    return marks[0].unionByName(marks[1]).unionByName(marks[2])


@registered("select file_ordinal, count(*) as num_events from ev group by file_ordinal", "ev")
def ingested_events(t: StarTables) -> DataFrame:
    """New event files streamed into bronze in two runs; the second takes only those that came since."""
    events, inbox, target, mark = stored(t.events, "events"), _path(t, "inbox"), _path(t, "bronze"), _path(t, "mark")
    for part in ("file_ordinal < 13", "file_ordinal >= 13"):
        events.where(part).write.mode("append").parquet(inbox)
        streams.ingest(streams.event_stream(t.spark, inbox, events.schema), target, mark).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(target).groupBy("file_ordinal").agg(F.count("*").alias("num_events"))


@registered("select dataset,split,file_name,box_id,file_ordinal,log_sequence,is_deleted,label_name,x,y,w,h from la", "la")
def late_events(t: StarTables) -> DataFrame:
    """The state of a stream whose files come in reverse: an edit that commits late is never skipped, nor does it win."""
    events, inbox, folder = stored(t.events, "events"), _path(t, "inbox"), _path(t, "stream")
    for part in ("file_ordinal >= 14", "file_ordinal between 6 and 13", "file_ordinal < 6"):
        events.where(part).write.mode("append").parquet(inbox)
        streams.latest_state(streams.event_stream(t.spark, inbox, events.schema), f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return streams.read_state(t.spark, f"{folder}/state", events.schema)


@registered(
    """select dataset,split,file_name,box_id,log_sequence,b_deleted as is_deleted,label_name,x,y,w,h from (select l.box_id, l.log_sequence, fo.box_id is null as b_deleted, fo.class_name as label_name, fo.x, fo.y, fo.w, fo.h,
    coalesce(fo.dataset,im.dataset) as dataset, coalesce(fo.split,im.split) as split, coalesce(fo.file_name,im.file_name) as file_name
    from (select box_id, max(log_sequence) as log_sequence, arg_max(file_name, log_sequence) as log_file from ev where file_ordinal>=10 group by box_id) l
    left join fo using (box_id) left join im on im.file_name=coalesce(fo.file_name,l.log_file)) where file_name is not null""",
    "fo",
    "ev",
)
def published_stream(t: StarTables) -> DataFrame:
    """The store's log as a stream, published as one batch: everything after the last published sequence."""
    log = stored(t.events.where("file_ordinal >= 10").select(F.col("log_sequence").alias("sequence"), F.col("box_id").alias("sample_id"), X.image_id().alias("image_id")), "log")
    boxes = stored(t.folded.boxes.select(F.col("box_id").alias("sample_id"), X.image_id().alias("image_id"), F.col("class_name").alias("label"), *"xywh"), "folded")
    loaded = t.images.select(X.image_id().alias("image_id"), "dataset", "split", "file_name")
    source = t.spark.readStream.schema(log.schema).parquet(log.inputFiles()[0].rsplit("/", 1)[0])
    target = _path(t, "published")
    streams.publish(source, boxes, loaded, boxes.select("sample_id").limit(0), target, _path(t, "mark")).awaitTermination()
    return t.spark.read.parquet(f"{target}/*")


# reads and the store


@registered("select image_id, row_number() over(order by image_id) - 1 as place from gi", "gi")
def drained_pages(t: StarTables) -> DataFrame:
    """All of gold by key, every row once with its number over all pages, in one job over the stored table."""
    return KeyedTable.write(t.gold_images, _path(t, "paged"), "image_id").numbered().select("image_id", "place")


@registered("select image_id, len(embedding) as dim from (select image_id from gi order by image_id limit 500) join (select md5(dataset||'/'||split||'/'||file_name)::uuid::varchar as image_id, embedding from im join embeddings on vec_id=o_orderkey) using (image_id)", "gi")
def page_vectors(t: StarTables) -> DataFrame:
    """The vectors of a page of ids."""
    ids = query.page(t.gold_images.select("image_id"), "image_id", limit=500)
    return query.with_vectors(ids, _image_cache(t), ["image_id"]).select("image_id", F.size("embedding").cast("bigint").alias("dim"))


@registered("select la.dataset,la.split,la.file_name,la.box_id from la anti join ba using (box_id) where not is_deleted order by dataset,split,file_name,box_id limit 10", "la", "ba")
def first_orphans(t: StarTables) -> DataFrame:
    """The first ten of a list of problems."""
    return checks.first_examples(checks.orphan_events(t.latest, t.normalized.boxes))


@registered("select gi.image_id from gi anti join cached using (image_id)", "gi", "cached")
def incomplete_vectors(t: StarTables) -> DataFrame:
    """Keys that were to have a vector and have none."""
    return checks.incomplete_vectors(t.gold_images, _image_cache(t), "image_id")


@registered(
    """select what, left_over.box_id as sample_id from (select he.box_id from he anti join (select he.box_id from he semi join gk using (image_id) anti join st using (box_id) anti join lt using (box_id)) as removed using (box_id)) as left_over
    join (select unnest(['samples','vectors']) as what) on what='samples' or cast(('0x'||substr(left_over.box_id,1,4)) as bigint)%2=0""",
    "he",
    "lt",
    "gk",
    lean=True,
)
def cascaded_deletes(t: StarTables) -> DataFrame:
    """Samples and vectors of the store without those of removed boxes."""
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    samples = held.select(F.col("box_id").alias("sample_id"))
    having = samples.where(F.conv(F.substring("sample_id", 1, 4), 16, 10).cast("bigint") % 2 == 0)
    left = sync.cascade(sync.removed_boxes(staged, t.gold_images, held, later), samples, having)
    return left[0].withColumn("what", F.lit("samples")).unionByName(left[1].withColumn("what", F.lit("vectors")))


@registered(
    """select st.box_id as sample_id, 'm' as model, 1 as version from st semi join he using (box_id) anti join lt using (box_id)
    union all select he.box_id, 'm', 0 from he semi join lt using (box_id) union all select he.box_id, 'm', 0 from he anti join lt using (box_id) anti join st using (box_id)""",
    "he",
    "lt",
)
def loaded_vectors(t: StarTables) -> DataFrame:
    """Vectors of gold loaded into the store: those of existing boxes that nobody edited since replace the old ones."""
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    tagged = lambda df, version: df.select(F.col("box_id").alias("sample_id"), F.lit("m").alias("model"), F.lit(version).alias("version"))
    return sync.vector_upserts(tagged(staged, 1), tagged(held, 0), held.select(F.col("box_id").alias("sample_id")), later)


@registered("select image_id, count(*) as num_labels from gb group by image_id having count(*)>=3", "gb")
def annotated_elsewhere(t: StarTables) -> DataFrame:
    """A source of annotations alone, whose images are under the root of another source's manifest."""
    path = _path(t, "bronze")
    store = builds.Store(t.spark, path)
    for spec in specs():
        builds.write_bronze_manifest(store, spec, {})
    manifests = files.read_manifest(t.spark, f"{path}/*/manifest.json", builds.BRONZE_SCHEMA)
    t = t.with_stored_gold()
    labels = t.gold_boxes.groupBy("image_id", "dataset").agg(F.count("*").alias("num_labels")).where("num_labels >= 3")
    rooted = contract.with_image_roots(labels, manifests, {f"ds{i}": f"ds{i}" for i in range(1, 6)})
    images = t.gold_images.select("image_id", "image_path", "file_name")
    return rooted.join(images, "image_id").where(F.col("image_path") == F.concat_ws("/", "image_root", "file_name")).select("image_id", "num_labels")


@registered(
    """select box_id, cast(case when cw<0 then 0 else least(greatest(cx,0),width-1) end as int) as first, cast(case when cw<0 then width else greatest(least(cx+cw,width), least(greatest(cx,0),width-1)+1) end as int) as last
    from (select box_id, width, cast(floor(xmin) as int) as cx, case when i%5=0 then -1 else cast(floor((xmin+bw)-xmin) as int) end as cw from cl)""",
    "cl",
)
def clamped_crops(t: StarTables) -> DataFrame:
    """Crops clamped to their image; a negative width is the whole."""
    width = F.when(F.col("source_box_index") % 5 == 0, -1).otherwise(F.floor(F.col("xmax") - F.col("xmin")).cast("int"))
    met = t.raw_boxes.join(t.images.select("file_name", "width"), "file_name")
    first, last = X.clamp_crop(F.floor("xmin").cast("int"), width, F.col("width"))
    return met.select(X.box_id().alias("box_id"), first.cast("int").alias("first"), last.cast("int").alias("last"))


@registered("select dataset, split from (select distinct dataset, split from im where split in ('train','test'))", "im")
def materialised_splits(t: StarTables) -> DataFrame:
    """Declared splits that are really there, for each dataset."""
    frame = spec_frames(t.spark, specs())[0].select("dataset", "split")
    listed = stored(t.images.where("split <> 'val'").select("dataset", "split").distinct(), "splits")
    out = [(d, s) for d in sorted({r[0] for r in frame.collect()}) for s in contract.materialised_splits(["train", "val", "test"], listed.where(F.col("dataset") == d))]  # a row for each split
    return t.spark.createDataFrame(out, "dataset string, split string")


@registered("select dataset, count(*) as num_boxes from ba group by dataset", "ba")
def dataset_union(t: StarTables) -> DataFrame:
    """Silver of every dataset as one."""
    parts = [t.normalized.boxes.where(F.col("dataset") == s.name) for s in specs()]
    return gold.union_datasets(parts).groupBy("dataset").agg(F.count("*").alias("num_boxes"))
