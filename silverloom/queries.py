"""Registered queries of the engine, and for each the SQL that says the same over the given tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.operators import checks, corrections, gold, normalize, query, sync, tallies, vectors
from silverloom.plans.delta_store import DeltaStore
from silverloom.plans.pages import KeyedTable
from silverloom.plans.scratch import scratch_dir, stored
from silverloom.plans.star_tables import StarTables
from silverloom.streaming import events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Common table expressions of the mapping; each query takes what it needs by name.
CTE = {
    "im": """select concat('ds',substr(o_orderpriority,1,1)) as dataset,
        case o_orderstatus when 'F' then 'train' when 'O' then 'val' else 'test' end as split,
        concat(lpad(cast(o_orderkey as varchar),12,'0'),'.jpg') as file_name,
        cast(320+o_orderkey%705 as int) as width, cast(240+o_custkey%561 as int) as height, o_orderkey from orders""",
    "bx": """select im.*, cast(row_number() over(partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate)-1 as int) as i,
        concat(l_returnflag,l_linestatus) as source_class, l_extendedprice/200-20 as xmin, l_quantity*8-12 as ymin,
        cast(l_partkey%200 as double)/2 as bw, cast(l_suppkey%90 as double)+0.5 as bh,
        l_discount >= 0.09 as attr_is_group_of, l_tax >= 0.08 as attr_is_depiction
        from lineitem join im on l_orderkey=o_orderkey""",
    "cl": """select *, md5(dataset||'/'||split||'/'||file_name||'#'||i)::uuid::varchar as box_id,
        least(greatest(xmin,0),width) as x, least(greatest(ymin,0),height) as y,
        least(greatest(xmin+bw,0),width)-least(greatest(xmin,0),width) as w, least(greatest(ymin+bh,0),height)-least(greatest(ymin,0),height) as h,
        case source_class when 'AF' then 'face' when 'AO' then 'license_plate' when 'NF' then 'head' when 'NO' then 'person' when 'RF' then 'text' else 'other' end as class_name
        from bx""",
    "ba": """select *, cast(row_number() over(partition by dataset,split,file_name order by i)-1 as int) as box_index from cl where w>=1e-6 and h>=1e-6""",
    "n": "select count(*) as n from events",
    "ev0": """select e.*, event_id % cast(floor(n/4) as bigint) as ok, cast(cast(floor(event_id/cast(floor(n/4) as bigint)) as bigint)%2 as int) as i,
        cast(floor(event_id*20/n) as bigint) as file_ordinal, event_id % cast(floor(n/2) as bigint) + 1 as log_sequence from events e cross join n""",
    "ev": """select im.dataset,im.split,im.file_name,
        case when event_type='signup' and value>20 then md5('drawn/'||event_id)::uuid::varchar else md5(im.dataset||'/'||im.split||'/'||im.file_name||'#'||ev0.i)::uuid::varchar end as box_id,
        file_ordinal, log_sequence, event_type='error' as is_deleted,
        case when event_type='error' then null when event_type='click' then 'Person' when event_type='signup' then 'Logo'
          when event_type='purchase' and event_id%2=0 then 'text' else coalesce(b.class_name,'face') end as label_name,
        case when event_type='error' then null when event_type='purchase' then floor(coalesce(b.x,5)+0.5)+7 else floor(coalesce(b.x,5)+0.5) end as x,
        case when event_type<>'error' then floor(coalesce(b.y,5)+0.5) end as y, case when event_type<>'error' then floor(coalesce(b.w,20)+0.5) end as w,
        case when event_type<>'error' then floor(coalesce(b.h,20)+0.5) end as h
        from ev0 join im on im.o_orderkey=ok left join ba b on b.o_orderkey=ok and b.i=ev0.i""",
    "la": """select * exclude(rn, r1, r2), r1 as first_ordinal, r2 as first_sequence from (select *, row_number() over w as rn,
        first_value(file_ordinal) over f as r1, first_value(log_sequence) over f as r2 from ev
        window w as (partition by box_id order by file_ordinal desc, log_sequence desc),
        f as (partition by box_id order by file_ordinal, log_sequence rows between unbounded preceding and unbounded following)) t where rn=1""",
    "met": """select b.*, e.is_deleted as e_deleted, e.label_name as e_label, e.x as ex, e.y as ey, e.w as ew, e.h as eh,
        e.label_name is not null and e.label_name <> b.class_name as relabel,
        e.x is not null and not (floor(b.x+0.5)=e.x and floor(b.y+0.5)=e.y and floor(b.w+0.5)=e.w and floor(b.h+0.5)=e.h) as move
        from ba b left join la e using (box_id)""",
    "mo": """select *, case when move then least(greatest(ex,0),width) else x end as fx, case when move then least(greatest(ey,0),height) else y end as fy,
        case when move then least(greatest(ex+ew,0),width)-least(greatest(ex,0),width) else w end as fw,
        case when move then least(greatest(ey+eh,0),height)-least(greatest(ey,0),height) else h end as fh from met""",
    "ad": """select e.*, im.width, im.height, label_name is not null and x is not null as complete,
        least(greatest(x,0),width) as fx, least(greatest(y,0),height) as fy, least(greatest(x+w,0),width)-least(greatest(x,0),width) as fw,
        least(greatest(y+h,0),height)-least(greatest(y,0),height) as fh
        from la e join im using (dataset,split,file_name) where not is_deleted and not exists (select 1 from ba where ba.box_id=e.box_id and ba.file_name=e.file_name)""",
    "fo0": """select dataset,split,file_name,box_id, case when relabel then case when lower(e_label) in ('face','license_plate','head','person','text','other') then lower(e_label) else 'other' end else class_name end as class_name,
        case when relabel and lower(e_label) not in ('face','license_plate','head','person','text','other') then e_label else source_class end as source_class,
        fx as x, fy as y, fw as w, fh as h, attr_is_group_of, attr_is_depiction, 'source' as origin, relabel as is_class_corrected, move as is_geometry_corrected, false as added, box_index as place, 0 as f1, 0 as f2
        from mo where not coalesce(e_deleted,false) and fw>=1e-6 and fh>=1e-6
        union all select dataset,split,file_name,box_id, case when lower(label_name) in ('face','license_plate','head','person','text','other') then lower(label_name) else 'other' end, label_name,
        fx,fy,fw,fh,null,null,'studio',false,false,true,0,first_ordinal,first_sequence from ad where complete and fw>=1e-6 and fh>=1e-6""",
    "fo": """select *, cast(row_number() over(partition by dataset,split,file_name order by added,place,f1,f2)-1 as int) as box_index,
        cast(case class_name when 'face' then 0 when 'license_plate' then 1 when 'head' then 2 when 'person' then 3 when 'text' then 4 when 'other' then 5 end as int) as class_id from fo0""",
    "gb": """select box_id, md5(dataset||'/'||split||'/'||file_name)::uuid::varchar as image_id, dataset, split, split as role, file_name, class_id, class_name, source_class, x, y, w, h,
        origin, is_class_corrected, is_geometry_corrected, dataset in ('ds1','ds2') as commercial_use
        from fo where class_name in ('face','license_plate','head','person','text') and not (coalesce(attr_is_group_of,false) or coalesce(attr_is_depiction,false))""",
    "gi": """select md5(dataset||'/'||split||'/'||file_name)::uuid::varchar as image_id, dataset, split, split as role, file_name, width, height,
        'bronze/'||dataset||'/'||file_name as image_path, case when dataset in ('ds1','ds2') then 'open' else 'research' end as license, dataset in ('ds1','ds2') as commercial_use
        from im where (dataset,split,file_name) in (select (dataset,split,file_name) from gb)""",
    # the keys of gi: images that hold a gold box
    "gk": "select distinct image_id, dataset from gb",
    "st": "select box_id, image_id, class_name as label, floor(x+0.5) as x, floor(y+0.5) as y, floor(w+0.5) as w, floor(h+0.5) as h from gb",
    # a store that lags behind: every seventh box is missing, some are relabelled or moved, and some are left over
    "he": """select box_id, image_id, case when k%5=0 then 'other' else label end as label, case when k%3=0 then x+2 else x end as x, y, w, h
        from (select *, cast(('0x'||substr(box_id,1,7)) as bigint) as k from st) where k%7<>0
        union all select md5('left/'||box_id)::uuid::varchar, image_id, label, x, y, w, h from (select *, cast(('0x'||substr(box_id,1,7)) as bigint) as k from st) where k%11=0""",
    "cached": "select distinct md5(dataset||'/'||split||'/'||file_name)::uuid::varchar as image_id from im join embeddings on vec_id=o_orderkey",
    "lt": "select distinct box_id from ev where file_ordinal >= 10 and log_sequence > 500",
}
CTE_NEEDS = {"bx": ["im"], "cl": ["bx"], "ba": ["cl"], "ev0": ["n"], "ev": ["ev0", "ba"], "la": ["ev"], "met": ["ba", "la"], "mo": ["met"], "ad": ["la", "im", "ba"], "fo0": ["mo", "ad"], "fo": ["fo0"], "gb": ["fo"], "gi": ["gb"], "gk": ["gb"], "st": ["gb"], "he": ["st"], "cached": ["im"], "lt": ["ev"]}


def with_ctes(sql: str, *names: str, lean: bool = False) -> str:
    """``sql`` after the common table expressions of these names and of all that they need.

    ``lean`` leaves those that are read once to be planned with what reads them.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in CTE_NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    reads = lambda n: len(re.findall(rf"\b(?:from|join|in)\s+{n}\b", " ".join([sql, *(CTE[o] for o in ordered)])))
    kind = lambda n: "" if lean and reads(n) < 2 else "materialized "
    return "with " + ",\n".join(f"{n} as {kind(n)}({CTE[n]})" for n in ordered) + "\n" + sql if ordered else sql


def registered(sql: str | None = None, *ctes: str, lean: bool = False) -> Callable:
    """Register a function of (StarTables) under its name, with its SQL."""

    def add(f: Callable[[StarTables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(StarTables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = with_ctes(sql, *ctes, lean=lean)
        return f

    return add


SILVER = ["dataset", "split", "file_name", "box_id", "box_index", "class_id", "class_name", "source_class", *"xywh", "origin", "is_class_corrected", "is_geometry_corrected"]
GOLD = ["box_id", "image_id", "dataset", "split", "role", "file_name", "class_id", "class_name", "source_class", *"xywh", "origin", "is_class_corrected", "is_geometry_corrected", "commercial_use"]

# normalisation and corrections


@registered(
    """select dataset,split,file_name,box_id,box_index,cast(case class_name when 'face' then 0 when 'license_plate' then 1 when 'head' then 2 when 'person' then 3 when 'text' then 4 else 5 end as int) as class_id,
    class_name,source_class,x,y,w,h,'source' as origin,false as is_class_corrected,false as is_geometry_corrected from ba""",
    "ba",
)
def normalize_boxes(t: StarTables) -> DataFrame:
    return t.normalized.boxes.select(*SILVER)


@registered("select 'degenerate_box' as reason, count(*) as num_boxes from cl where not (w>=1e-6 and h>=1e-6)", "cl")
def dropped_reasons(t: StarTables) -> DataFrame:
    return normalize.tally(t.normalized.dropped)


@registered(
    """select box_id, problem from (select box_id, case when o_orderkey%17=0 then 'no image row' when count(*) over (partition by box_id)>1 then 'repeated box id' when class_name='other' and i%2=0 then 'unknown class'
    when bw<=0 or bh<=0 then 'no area' when xmin<-1e-6 or ymin<-1e-6 then 'starts outside the image' when xmin+bw>width+1e-6 or ymin+bh>height+1e-6 then 'ends outside the image' end as problem
    from (select * from cl union all select * from cl where i=0 and dataset='ds4')) where problem is not null""",
    "cl",
)
def box_problems(t: StarTables) -> DataFrame:
    """Raw boxes as they would be without clipping; every seventeenth image is lost, and the first boxes of ds4 are there twice."""
    raw = normalize.with_classes(t.raw_boxes, t.category_map).withColumn("box_id", X.box_id())
    name = F.when((F.col("class_name") == "other") & (F.col("source_box_index") % 2 == 0), "unmapped").otherwise(F.col("class_name"))
    boxes = raw.withColumns({"class_name": name, "x": F.col("xmin"), "y": F.col("ymin"), "w": F.col("xmax") - F.col("xmin"), "h": F.col("ymax") - F.col("ymin")})
    twice = boxes.where("source_box_index = 0 and dataset = 'ds4'")
    return checks.box_problems(boxes.unionByName(twice), t.images.where("o_orderkey % 17 <> 0"))


@registered("select dataset,split,file_name,box_id,file_ordinal,log_sequence,is_deleted,label_name,x,y,w,h from la", "la")
def latest_events(t: StarTables) -> DataFrame:
    return t.latest.drop("first_seen")


@registered("select dataset,split,file_name,box_id,box_index,class_id,class_name,source_class,x,y,w,h,origin,is_class_corrected,is_geometry_corrected from fo", "fo")
def fold_edits(t: StarTables) -> DataFrame:
    return t.folded.boxes.select(*SILVER)


@registered(
    """select reason, count(*) as num_boxes from (select case when coalesce(e_deleted,false) then 'studio_deleted' else 'degenerate_box' end as reason from mo
    where coalesce(e_deleted,false) or not (fw>=1e-6 and fh>=1e-6) union all select case when not complete then 'incomplete_addition' else 'degenerate_box' end from ad where not (complete and fw>=1e-6 and fh>=1e-6)) group by reason""",
    "mo",
    "ad",
)
def fold_dropped_reasons(t: StarTables) -> DataFrame:
    return normalize.tally(t.folded.dropped)


@registered(
    """select case when is_deleted then case when b.box_id is not null then 'delete' else 'ignored' end when b.box_id is null then 'add'
    when label_name is not null and label_name<>class_name and e.x is not null and not (floor(b.x+0.5)=e.x and floor(b.y+0.5)=e.y and floor(b.w+0.5)=e.w and floor(b.h+0.5)=e.h) then 'both'
    when label_name is not null and label_name<>class_name then 'relabel'
    when e.x is not null and not (floor(b.x+0.5)=e.x and floor(b.y+0.5)=e.y and floor(b.w+0.5)=e.w and floor(b.h+0.5)=e.h) then 'move' else 'noop' end as fold_case, count(*) as num_events
    from la e left join ba b using (box_id) group by 1""",
    "la",
    "ba",
)
def fold_cases(t: StarTables) -> DataFrame:
    return corrections.fold_cases(t.normalized.boxes, t.images, t.latest).groupBy("fold_case").agg(F.count("*").alias("num_events"))


@registered("select la.dataset,la.split,la.file_name,la.box_id from la anti join ba using (box_id) where not is_deleted", "la", "ba")
def orphan_events(t: StarTables) -> DataFrame:
    return checks.orphan_events(t.latest, t.normalized.boxes)


@registered("select distinct label_name from la where not is_deleted and label_name is not null and lower(label_name) not in ('face','license_plate','head','person','text','other')", "la")
def unknown_labels(t: StarTables) -> DataFrame:
    return checks.unknown_labels(t.latest)


# gold


@registered("select box_id,image_id,dataset,split,role,file_name,class_id,class_name,source_class,x,y,w,h,origin,is_class_corrected,is_geometry_corrected,commercial_use from gb", "gb")
def gold_boxes(t: StarTables) -> DataFrame:
    return t.gold_boxes.select(*GOLD)


@registered("select * from gi", "gi")
def gold_images(t: StarTables) -> DataFrame:
    return t.gold_images


@registered(
    """select id, problem from (select image_id as id, 'repeated image id' as problem from (select image_id from gk union all select image_id from gk where dataset='ds1') group by image_id having count(*)>1
    union all select box_id, 'box without image' from gb anti join (select image_id from gk where dataset<>'ds2') as kept using (image_id) where dataset='ds2')""",
    "gk",
    lean=True,
)
def gold_key_problems(t: StarTables) -> DataFrame:
    """Gold with images of ds1 repeated and those of ds2 lost."""
    t = t.with_stored_gold()
    images = t.gold_images
    seeded = images.where("dataset <> 'ds2'").unionByName(images.where("dataset = 'ds1'"))
    return checks.gold_key_problems(seeded, t.gold_boxes)


@registered("select class_name, count(*) as num_boxes, round(avg(w*h),4) as mean_area from gb group by class_name", "gb")
def class_tally(t: StarTables) -> DataFrame:
    return tallies.class_tally(t.gold_boxes).withColumn("mean_area", F.round("mean_area", 4))


@registered("select dataset, role, class_name, count(*) as num_boxes from gb group by all", "gb")
def class_role_counts(t: StarTables) -> DataFrame:
    return tallies.class_role_counts(t.gold_boxes)


@registered(
    "select dataset, cast((s>=8)::int+(s>=16)::int+(s>=32)::int+(s>=64)::int+(s>=128)::int+(s>=256)::int+(s>=512)::int as int) as bucket, count(*) as num_boxes from (select dataset, sqrt(w*h) as s from fo) group by all",
    "fo",
)
def layer_size_histogram(t: StarTables) -> DataFrame:
    return tallies.size_histogram(t.folded.boxes)


@registered(
    """select dataset, attribute, case attribute when 'attr_is_group_of' then g when 'attr_is_depiction' then d else 0 end as num_boxes
    from (select dataset, count(attr_is_group_of) as g, count(attr_is_depiction) as d from fo group by dataset) cross join
    (select unnest(['attr_blur','attr_expression','attr_illumination','attr_occlusion','attr_pose','attr_invalid','attr_is_group_of','attr_is_depiction','attr_is_illegible','attr_is_handwritten','attr_is_vertical']) as attribute)""",
    "fo",
)
def layer_filled_attributes(t: StarTables) -> DataFrame:
    return tallies.filled_attributes(t.folded.boxes)


@registered("select dataset, split, count(*) as num_images from gi group by all", "gi")
def split_counts(t: StarTables) -> DataFrame:
    return tallies.split_counts(t.gold_images)


@registered("select dataset, source_class, cast(row_number() over(partition by dataset order by source_class)-1 as int) as category_index from (select distinct dataset, source_class from ba)", "ba")
def category_index(t: StarTables) -> DataFrame:
    return tallies.category_index(t.normalized.boxes)


@registered(
    """select (select count(*) from im) as num_images, count(*) as num_boxes, count(*) filter(where is_class_corrected or is_geometry_corrected) as num_corrected, count(*) filter(where origin='studio') as num_added,
    (select count(*) from mo where coalesce(e_deleted,false) or not (fw>=1e-6 and fh>=1e-6)) + (select count(*) from ad where not (complete and fw>=1e-6 and fh>=1e-6)) as num_dropped,
    (select count(distinct file_ordinal) from ev) as num_event_files, (select count(*) from gi where image_id in (select image_id from cached)) as num_reused_vectors,
    (select count(*) from gi where image_id not in (select image_id from cached)) as num_missing_vectors from fo""",
    "gi",
    "cached",
)
def run_metrics(t: StarTables) -> DataFrame:
    files = t.events.select("file_ordinal").distinct()
    return tallies.run_metrics(t.images, t.folded.boxes, t.folded.dropped, files, t.gold_images, _image_cache(t), ["image_id"])


# reads of gold


@registered("select * from gi where role='train' and commercial_use order by image_id limit 100", "gi")
def gold_page(t: StarTables) -> DataFrame:
    """A page of gold's images, stored by key, from the files that can hold it."""
    table = KeyedTable.write(t.gold_images, f"{scratch_dir(t.spark)}/paged-{uuid.uuid4().hex}", "image_id")
    return table.page(query.Selection(role=("train",), commercial_use=True), limit=100)


@registered("select box_id,image_id,class_name,x,y,w,h from gb where class_name in ('face','text') and box_id > '80000000-0000-0000-0000-000000000000' order by box_id limit 250", "gb")
def gold_page_after(t: StarTables) -> DataFrame:
    """A later page of gold's boxes of some classes, stored by key."""
    table = KeyedTable.write(t.gold_boxes, f"{scratch_dir(t.spark)}/paged-{uuid.uuid4().hex}", "box_id")
    chosen = query.Selection(class_name=("face", "text"), release="draft")
    return table.page(chosen, "80000000-0000-0000-0000-000000000000", 250).select("box_id", "image_id", "class_name", *"xywh")


@registered("select image_id, dataset, split, file_name from gi where cast('0x'||substr(image_id,1,8) as bigint) % 5 = 3", "gi")
def gold_shard(t: StarTables) -> DataFrame:
    chosen = query.select_rows(t.gold_images, query.Selection(shard=3, num_shards=5, release="draft"))
    return chosen.select("image_id", "dataset", "split", "file_name")


@registered("select count(*) as num_rows from gi where dataset in ('ds1','ds3') and split='val' and image_id in (select image_id from gb where class_name='person')", "gi")
def gold_count(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    chosen = query.select_rows(t.gold_images, query.Selection(dataset=("ds1", "ds3"), split=("val",), release="draft"))
    return query.images_of_classes(chosen, t.gold_boxes, ("person",)).agg(F.count("*").alias("num_rows"))


@registered("select image_id, dataset, split, role from gi where role in ('val','test')", "gi")
def release_rows(t: StarTables) -> DataFrame:
    return query.eval_rows(t.gold_images).select("image_id", "dataset", "split", "role")


@registered("select image_id, dataset, role from gi where role='train' union all select image_id, dataset, role from gi where role in ('val','test') and dataset<>'ds5'", "gi")
def release_union(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    frozen = query.eval_rows(t.gold_images.where("dataset <> 'ds5'"))
    return query.release_view(t.gold_images, frozen).select("image_id", "dataset", "role")


@registered(
    "select image_id, side from (select image_id, 'left' as side from gi where role<>'train' and dataset='ds5' union all select image_id, 'right' from gi where role<>'train' and dataset='ds1')",
    "gi",
)
def release_diff(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    rows = query.eval_rows(t.gold_images).select("image_id", "dataset")
    return query.difference(rows.where("dataset <> 'ds1'"), rows.where("dataset <> 'ds5'")).select("image_id", "side")


# vectors


@registered(
    """select box_id, cast(least(round_even(x,0), ceil(x+w)-1) as int) as crop_x, cast(least(round_even(y,0), ceil(y+h)-1) as int) as crop_y,
    cast(greatest(1, round_even(w,0)) as int) as crop_width, cast(greatest(1, round_even(h,0)) as int) as crop_height from gb""",
    "gb",
)
def crop_grid(t: StarTables) -> DataFrame:
    return vectors.with_crops(t.gold_boxes).select("box_id", *vectors.CROP)


def _image_cache(t: StarTables) -> DataFrame:
    """Vectors of the images whose order key is a vector id."""
    keyed = t.images.withColumn("image_id", X.image_id())
    cached = t.table("embeddings").select(F.col("vec_id").alias("o_orderkey"), "embedding")
    return cached.join(keyed, "o_orderkey").select("image_id", "embedding")


@registered("select gi.image_id from gi anti join cached using (image_id)", "gi", "cached")
def missing_vectors(t: StarTables) -> DataFrame:
    return vectors.missing(t.gold_images.select("image_id"), _image_cache(t), ["image_id"])


@registered("select image_id, round(cast(embedding[1] as double),6) as first_component, len(embedding) as dim from gi join (select dataset,split,file_name,embedding from im join embeddings on vec_id=o_orderkey) using (dataset,split,file_name)", "gi")
def served_vectors(t: StarTables) -> DataFrame:
    got = vectors.served(t.gold_images.select("image_id"), _image_cache(t), ["image_id"])
    return got.select("image_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("first_component"), F.size("embedding").cast("bigint").alias("dim"))


@registered(
    """with old as (select box_id, cast(least(round_even(x,0), ceil(x+w)-1) as int) as crop_x, cast(least(round_even(y,0), ceil(y+h)-1) as int) as crop_y,
    cast(greatest(1, round_even(w,0)) as int) as crop_width, cast(greatest(1, round_even(h,0)) as int) as crop_height from ba), new as (select box_id, class_name, cast(least(round_even(x,0), ceil(x+w)-1) as int) as crop_x, cast(least(round_even(y,0), ceil(y+h)-1) as int) as crop_y,
    cast(greatest(1, round_even(w,0)) as int) as crop_width, cast(greatest(1, round_even(h,0)) as int) as crop_height from gb)
    select new.box_id, new.class_name from new where (box_id,crop_x,crop_y,crop_width,crop_height) not in (select (box_id,crop_x,crop_y,crop_width,crop_height) from old)""".replace("with old", "select * from (with old", 1) + ")",
    "gb",
)
def moved_box_gets_none(t: StarTables) -> DataFrame:
    """Gold boxes whose crop is not the one that the cache, made from the source's boxes, has a vector of."""
    cache = vectors.with_crops(t.normalized.boxes).select("box_id", *vectors.CROP)
    return vectors.missing(vectors.with_crops(t.gold_boxes), cache, ["box_id", *vectors.CROP]).select("box_id", "class_name")


@registered(
    "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double)*cast(x as double)))),4) as norm, round(cast(embedding[1] as double)/sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double)*cast(x as double)))),4) as first_component from embeddings"
)
def normalized_vectors(t: StarTables) -> DataFrame:
    rows = t.table("embeddings").select("vec_id", "embedding", X.l2_normalize(F.col("embedding")).alias("unit"))
    return rows.select("vec_id", F.round(X.norm(F.col("embedding")), 4).alias("norm"), F.round(F.col("unit")[0].cast("double"), 4).alias("first_component"))


@registered(
    """select query_id, id, rank from (select q.vec_id as query_id, e.vec_id as id, cast(row_number() over(partition by q.vec_id order by list_sum(list_transform(list_zip(q.embedding,e.embedding), lambda z: cast(z[1] as double)*cast(z[2] as double))) desc, e.vec_id) as int) as rank
    from embeddings e join embeddings q on q.vec_id<>e.vec_id where q.vec_id%100=0) where rank<=10"""
)
def similar_vectors(t: StarTables) -> DataFrame:
    table = t.table("embeddings")
    return vectors.similar(table, table.where("vec_id % 100 = 0"), 10, "vec_id").select("query_id", "id", "rank")


# the merge into a curation store, and what it publishes


def _store(t: StarTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged boxes, the boxes of a store that lags behind, and boxes edited after gold."""
    staged = sync.staged_boxes(t.gold_boxes).drop("confidence")
    keyed = staged.withColumn("k", F.conv(F.substring("box_id", 1, 7), 16, 10).cast("bigint"))
    label = F.when(F.col("k") % 5 == 0, "other").otherwise(F.col("label"))
    x = F.when(F.col("k") % 3 == 0, F.col("x") + 2).otherwise(F.col("x"))
    held = keyed.where("k % 7 <> 0").withColumns({"label": label, "x": x}).drop("k")
    left = keyed.where("k % 11 = 0").withColumn("box_id", X.uuid_text(F.concat(F.lit("left/"), "box_id"))).drop("k")
    edits = t.events.where("file_ordinal >= 10").select(F.col("log_sequence").alias("sequence"), F.col("box_id").alias("sample_id"))
    return staged, held.unionByName(left), sync.later_edits(edits, 500)


@registered(
    """select st.*, (he.x,he.y,he.w,he.h) is distinct from (st.x,st.y,st.w,st.h) as is_moved from st join he using (box_id)
    anti join lt using (box_id) where (he.label,he.x,he.y,he.w,he.h) is distinct from (st.label,st.x,st.y,st.w,st.h)""",
    "he",
    "lt",
)
def changed_boxes(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    return sync.changed_boxes(*_store(t))


@registered("select st.* from st anti join he using (box_id) anti join lt using (box_id)", "he", "lt")
def new_boxes(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    return sync.new_boxes(*_store(t))


@registered("select he.box_id, he.image_id from he semi join gi using (image_id) anti join st using (box_id) anti join lt using (box_id)", "he", "lt", "gi")
def removed_boxes(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    return sync.removed_boxes(staged, t.gold_images, held, later)


@registered(
    """select st.* from st anti join lt using (box_id) anti join he using (box_id)
    union all select st.* from st semi join he using (box_id) anti join lt using (box_id)
    union all select he.* from he semi join lt using (box_id)
    union all select he.* from he anti join lt using (box_id) anti join st using (box_id) anti join gk using (image_id)""",
    "he",
    "lt",
    "gk",
    lean=True,
)
def merged_boxes(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    return sync.merged_boxes(staged, t.gold_images, held, later)


@registered(
    """select st.* from st anti join lt using (box_id) anti join he using (box_id)
    union all select st.* from st semi join he using (box_id) anti join lt using (box_id)
    union all select he.* from he semi join lt using (box_id)
    union all select he.* from he anti join lt using (box_id) anti join st using (box_id) anti join gk using (image_id)""",
    "he",
    "lt",
    "gk",
    lean=True,
)
def store_after_merge(t: StarTables) -> DataFrame:
    """The store after a merge that wrote a delta, read as base and delta; then once more after its compaction."""
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    store = DeltaStore(t.spark, f"{scratch_dir(t.spark)}/store-{uuid.uuid4().hex}")
    store.create(held)
    store.merge(staged, t.gold_images, later)
    say = lambda boxes: query.row_digests(boxes.withColumn("part", F.lit(0)), ["part"]).collect()
    merged = say(store.read())
    store.compact()
    if merged != say(store.read()):
        raise ValueError("compaction changed boxes")
    return store.read()


@registered("select image_id, 'role/'||role as tag from gi union all select image_id, 'split/'||split from gi where dataset<>'ds1'", "gi")
def image_tags(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    held = t.gold_images.where("dataset = 'ds1'").select("image_id", F.concat(F.lit("split/"), "split").alias("tag"))
    return sync.image_tags(t.gold_images, held)


@registered(
    """select image_id, 's3://lake/'||image_path as path, case when dataset='ds1' then 'update' else 'insert' end as action from gi where dataset<>'ds2'""",
    "gi",
)
def image_upserts(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    path = F.when(F.col("dataset") == "ds1", F.concat(F.lit("/old/"), "image_path")).otherwise(F.concat(F.lit("s3://lake/"), "image_path"))
    held = t.gold_images.where("dataset in ('ds1', 'ds2')").select("image_id", path.alias("path"))
    return sync.image_upserts(t.gold_images, held, "s3://lake/").select("image_id", "path", "action")


@registered(
    "select gk.image_id as sample_id from gk anti join cached using (image_id) union all select box_id from gb",
    "gk",
    "cached",
    lean=True,
)
def lacks_vectors(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    held = _image_cache(t).select(F.col("image_id").alias("sample_id"), F.lit("m1").alias("model"))
    return sync.samples_without_vectors(t.gold_images, t.gold_boxes, held, "m1")


@registered(
    """select dataset,split,file_name,box_id,log_sequence,b_deleted as is_deleted,label_name,x,y,w,h from (select l.box_id, l.log_sequence, fo.box_id is null as b_deleted, fo.class_name as label_name, fo.x, fo.y, fo.w, fo.h,
    coalesce(fo.dataset,im.dataset) as dataset, coalesce(fo.split,im.split) as split, coalesce(fo.file_name,im.file_name) as file_name
    from (select box_id, max(log_sequence) as log_sequence, arg_max(file_name, log_sequence) filter(where log_sequence%3<>0) as log_file from ev where file_ordinal>=10 and log_sequence>(select max(log_sequence)//10 from ev where file_ordinal>=10) group by box_id) l
    left join fo using (box_id) left join im on im.file_name=coalesce(fo.file_name,l.log_file)) where file_name is not null""",
    "fo",
    "ev",
)
def publish_events(t: StarTables) -> DataFrame:
    """Events of the second chain as the log of the store, from a tenth of it, the last that was published, to its head.

    The log names an image in two of three entries.
    """
    named = F.when(F.col("log_sequence") % 3 != 0, X.image_id())
    edits = t.events.where("file_ordinal >= 10").select(F.col("log_sequence").alias("sequence"), F.col("box_id").alias("sample_id"), named.alias("image_id"))
    boxes = t.folded.boxes.select(F.col("box_id").alias("sample_id"), X.image_id().alias("image_id"), F.col("class_name").alias("label"), *"xywh")
    loaded = t.images.select(X.image_id().alias("image_id"), "dataset", "split", "file_name")
    head = edits.agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
    return sync.published_events(edits, boxes, loaded, boxes.select("sample_id").limit(0), head // 10, head)


def _event_files(t: StarTables) -> DataFrame:
    """Daily files of the event table in two chains, with some links that do not fit."""
    day = F.date_trunc("day", "ts")
    files = t.table("events").groupBy(day.alias("day")).agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("n"))
    order = Window.orderBy("day")  # a row for each day
    files = files.withColumn("place", F.row_number().over(order)).withColumn("chain_id", F.when(F.col("place") <= 20, "a").otherwise("b"))
    chain = Window.partitionBy("chain_id").orderBy("day")
    files = files.withColumn("sequence", F.row_number().over(chain)).withColumn("last_log_sequence", F.sum("n").over(chain))
    files = files.withColumn("event_file_id", F.concat(F.lpad(F.col("sequence").cast("string"), 6, "0"), F.lit("-"), F.substring(F.md5(F.col("low").cast("string").cast("binary")), 1, 12)))
    parent = F.lag("event_file_id").over(chain)
    after = F.coalesce(F.lag("last_log_sequence").over(chain), F.lit(0))
    return files.withColumns({"parent_event_file_id": F.when(F.col("place") % 13 == 5, "lost").otherwise(parent), "after_log_sequence": F.when(F.col("place") % 7 == 3, after + 1).otherwise(after)})


@registered(
    """with f0 as (select date_trunc('day', ts) as day, min(event_id) as low, max(event_id) as high, count(*) as n from events group by 1),
    f1 as (select *, row_number() over(order by day) as place from f0), f2 as (select *, case when place<=20 then 'a' else 'b' end as chain_id from f1),
    f3 as (select *, row_number() over(partition by chain_id order by day) as sequence, sum(n) over(partition by chain_id order by day) as last_log_sequence from f2),
    f4 as (select *, lpad(cast(sequence as varchar),6,'0')||'-'||substr(md5(cast(low as varchar)),1,12) as event_file_id from f3),
    f5 as (select *, lag(event_file_id) over c as p_id, lag(last_log_sequence) over c as p_last from f4 window c as (partition by chain_id order by day)),
    f6 as (select *, case when place%13=5 then 'lost' else p_id end as parent, coalesce(p_last,0) + case when place%7=3 then 1 else 0 end as after from f5)
    select chain_id, cast(sequence as int) as sequence, event_file_id, case when parent is distinct from p_id then 'parent' else 'after' end as problem from f6
    where parent is distinct from p_id or (p_last is not null and after<>p_last)"""
)
def event_chain_breaks(t: StarTables) -> DataFrame:
    return checks.chain_breaks(_event_files(t))


@registered(
    """with c as (select dataset, split, count(*) as n from gi group by all), t as (select dataset, sum(n) as total from c group by dataset)
    select dataset as name, dataset, cast(null as varchar) as split, cast(null as int) as shard, cast(null as int) as num_shards from t where total<=1500
    union all select case when s=1 then dataset||'.'||split else dataset||'.'||split||'.'||(k+1)||'-of-'||s end, dataset, split, case when s>1 then k end, case when s>1 then s end
    from (select dataset, split, cast(ceil(n/1500.0) as int) as s, cast(unnest(range(cast(ceil(n/1500.0) as bigint))) as int) as k from c join t using (dataset) where total>1500)""".replace("with c as", "select * from (with c as", 1) + ")",
    "gi",
)
def shard_plan(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    return sync.shard_plan(t.gold_images, 1500)


@registered("select image_id from gi where dataset<>'ds1'", "gi")
def uncovered_images(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    return sync.coverage(t.gold_images, t.gold_images.where("dataset = 'ds1'"))


@registered(
    """select 'images' as what, count(*) as num_rows from gi where dataset<>'ds2' union all
    select 'new_boxes', count(*) from st anti join he using (box_id) anti join lt using (box_id) union all
    select 'updated_boxes', count(*) from st join he using (box_id) anti join lt using (box_id) where (he.label,he.x,he.y,he.w,he.h) is distinct from (st.label,st.x,st.y,st.w,st.h) union all
    select 'removed_boxes', count(*) from he semi join gi using (image_id) anti join st using (box_id) anti join lt using (box_id)""",
    "he",
    "lt",
    "gi",
)
def merge_report(t: StarTables) -> DataFrame:
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    images = t.gold_images.where("dataset = 'ds2'").select("image_id", F.concat(F.lit("s3://lake/"), "image_path").alias("path"))
    upserts = sync.image_upserts(t.gold_images, images, "s3://lake")
    return sync.report(upserts, sync.fates(staged, t.gold_images, held, later))


@registered(
    """select he.box_id as sample_id from he
    anti join (select st.box_id from st join he using (box_id) anti join lt using (box_id) where (he.x,he.y,he.w,he.h) is distinct from (st.x,st.y,st.w,st.h)) as moved using (box_id)
    anti join (select he.box_id from he semi join gk using (image_id) anti join st using (box_id) anti join lt using (box_id)) as removed using (box_id)""",
    "he",
    "lt",
    "gk",
    lean=True,
)
def kept_vectors(t: StarTables) -> DataFrame:
    """Samples of the store that keep their vector through the merge."""
    t = t.with_stored_gold()
    staged, held, later = _store(t)
    removed = sync.removed_boxes(staged, t.gold_images, held, later)
    return sync.kept_vectors(held.select(F.col("box_id").alias("sample_id")), sync.changed_boxes(staged, held, later), removed)


@registered("select file_name from im where o_orderkey%10=0", "im")
def missing_images(t: StarTables) -> DataFrame:
    return checks.missing_files(t.images, t.images.where("o_orderkey % 10 <> 0"), "file_name")


@registered(
    "select box_id, log_sequence, file_ordinal from ev where file_ordinal>=10 and log_sequence>(select max(log_sequence)//10 from ev where file_ordinal>=10) and log_sequence<=(select max(log_sequence)*9//10 from ev where file_ordinal>=10)",
    "ev",
)
def log_slice(t: StarTables) -> DataFrame:
    """The log from a tenth to nine tenths of its head, in its order."""
    log = t.events.where("file_ordinal >= 10")
    head = log.agg(F.coalesce(F.max("log_sequence"), F.lit(0))).first()[0]
    part = log.where((F.col("log_sequence") > head // 10) & (F.col("log_sequence") <= head * 9 // 10))
    return part.select("box_id", "log_sequence", "file_ordinal").orderBy("log_sequence", "box_id")


@registered("select distinct dataset from im where dataset in ('ds4','ds5')", "im")
def missing_datasets(t: StarTables) -> DataFrame:
    return gold.missing_datasets(t.specs, t.images.where("dataset not in ('ds4', 'ds5')"))


@registered(
    """select gi.image_id, cast(16 as int) as dim from gi anti join cached using (image_id)""",
    "gi",
    "cached",
)
def embed_missing(t: StarTables) -> DataFrame:
    """Images without a cached vector get one from the embedder that needs no model."""
    wanted = vectors.missing(t.gold_images.select("image_id", "file_name"), _image_cache(t), ["image_id"])
    return vectors.embed(wanted, vectors.hash_embedder(16)).select("image_id", F.size("embedding").alias("dim"))


@registered("select dataset,split,file_name,box_id,file_ordinal,log_sequence,is_deleted,label_name,x,y,w,h from la", "la")
def streaming_latest(t: StarTables) -> DataFrame:
    """The events as a stream of files: the latest of each box, batch by batch."""
    files = stored(t.events.repartition(6, "file_ordinal"), "event-files")
    folder = f"{scratch_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    source = events.event_stream(t.spark, files.inputFiles()[0].rsplit("/", 1)[0], files.schema, files_per_batch=2)
    events.latest_state(source, f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return events.read_state(t.spark, f"{folder}/state", files.schema)
