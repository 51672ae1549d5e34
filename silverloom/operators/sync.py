"""The merge of a gold slice into a curation store, and the events that the store publishes.

The store is a set of frames: ``boxes`` (box_id, image_id, label, x, y, w, h, confidence), ``images`` (image_id, dataset,
split, file_name, width, height, path), ``tags`` (image_id, tag), ``coverage`` (image_id), ``vectors`` (sample_id, model,
embedding) and ``edits`` (sequence, sample_id, image_id). Every delta is a frame; applying them twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from silverloom.functions import expr as X

GEOMETRY = ["x", "y", "w", "h"]
#: Edited boxes whose ids are few enough to broadcast.
BROADCAST_ROWS = 1_000_000


def staged_boxes(gold_boxes: DataFrame) -> DataFrame:
    """Gold boxes as the store holds them: whole pixels, halves up."""
    return gold_boxes.select("box_id", "image_id", F.col("class_name").alias("label"), *[X.half_up(c).alias(c) for c in GEOMETRY], "confidence")


def gold_marker(manifest: DataFrame, chain_id: str) -> DataFrame:
    """The last event that gold holds of this chain, else 0: one row (log_sequence)."""
    mine = F.when(F.col("chain_id") == chain_id, F.col("log_sequence")).otherwise(0)
    return manifest.agg(F.coalesce(F.max(mine), F.lit(0)).alias("log_sequence"))


def later_edits(edits: DataFrame, gold_sequence: int) -> DataFrame:
    """Samples that a curator edited after the last event that gold holds; the lake leaves them alone."""
    return edits.where(F.col("sequence") > gold_sequence).select(F.col("sample_id").alias("box_id")).distinct()


def image_upserts(images: DataFrame, held: DataFrame, image_base: str) -> DataFrame:
    """New images, and images whose path changed: the row and its action."""
    path = X.rebase(F.col("image_path"), F.lit(image_base))
    staged = images.select("image_id", "dataset", "split", "file_name", "width", "height", path.alias("path"))
    met = staged.join(held.select("image_id", F.col("path").alias("held_path")), "image_id", "left")
    action = F.when(F.col("held_path").isNull(), "insert").when(F.col("held_path") != F.col("path"), "update")
    return met.withColumn("action", action).where("action is not null").drop("held_path")


def image_tags(images: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(image_id, tag) of role and split that the store lacks; an explode instead of a join on one of two names."""
    tags = images.select("image_id", F.explode(F.array(F.concat(F.lit("role/"), "role"), F.concat(F.lit("split/"), "split"))).alias("tag"))
    return tags if held is None else tags.join(held, ["image_id", "tag"], "left_anti")


def coverage(images: DataFrame, held: DataFrame) -> DataFrame:
    """Images that the store does not yet know to be covered, with or without boxes."""
    return images.select("image_id").join(held.select("image_id"), "image_id", "left_anti")


def changed_boxes(staged: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """Staged boxes that the store holds with another label or geometry, with is_moved."""
    old = held.select("box_id", F.col("label").alias("old_label"), *[F.col(c).alias(f"old_{c}") for c in GEOMETRY])
    met = staged.join(later, "box_id", "left_anti").join(old, "box_id")
    moved = X.differs([F.col(c).alias(c) for c in GEOMETRY], [F.col(f"old_{c}").alias(c) for c in GEOMETRY])
    met = met.withColumn("is_moved", moved)
    return met.where(F.col("is_moved") | ~F.col("label").eqNullSafe(F.col("old_label"))).select(*staged.columns, "is_moved")


def new_boxes(staged: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """Staged boxes that the store lacks; one that a curator deleted after gold stays deleted."""
    return staged.join(later, "box_id", "left_anti").join(held.select("box_id"), "box_id", "left_anti")


def removed_boxes(staged: DataFrame, images: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """Held boxes on an image of the slice that gold does not hold and nobody edited since."""
    mine = held.join(images.select("image_id"), "image_id", "left_semi")
    return mine.join(staged.select("box_id"), "box_id", "left_anti").join(later, "box_id", "left_anti").select("box_id", "image_id")


def met(staged: DataFrame, images: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """Every box of gold or of the store once: its ``fate``, and its ``row`` (a struct): gold's of those that are new or

    updated, the store's of those that are removed or left (as the store has it); none where it is skipped (gold's alone,
    and edited since).
    """
    texts = {c for c in ("box_id", "image_id") if held.schema[c].dataType == StringType()}
    packed = lambda c: (X.packed_id(c) if c in texts else F.col(c)).alias(c)
    unpacked = lambda c, of: X.unpacked_id(of) if c in texts else of
    columns = [c for c in held.columns if c != "box_id"]
    row = lambda df, name: df.select(packed("box_id"), F.struct(*[packed(c) for c in columns]).alias(name))
    edits = later.select(packed("box_id"), F.lit(True).alias("edited"))
    # both sides are told of edits before they meet: a full join has no partitions to go on with
    told = row(held, "held").withColumn("is_edit", F.lit(False)).unionByName(edits.where("box_id is not null").select("box_id", F.lit(True).alias("is_edit")), allowMissingColumns=True)
    told = told.withColumn("edited_held", F.max("is_edit").over(Window.partitionBy("box_id"))).where(~F.col("is_edit")).drop("is_edit")
    both = row(staged, "staged").join(edits, "box_id", "left").join(told, "box_id", "full")
    edited, differs = X.is_set("edited") | X.is_set("edited_held"), X.differs([F.col(f"staged.{c}") for c in ["label", *GEOMETRY]], [F.col(f"held.{c}") for c in ["label", *GEOMETRY]])
    fate = (
        F.when(F.col("held").isNull(), F.when(edited, "skipped").otherwise("new"))
        .when(F.col("staged").isNull(), F.when(edited, "left").otherwise("gone"))
        .otherwise(F.when(~edited & differs, "updated").otherwise("left"))
    )
    cases = both.select("box_id", "staged", "held", fate.alias("fate"))
    row = F.when(F.col("fate").isin("new", "updated"), F.col("staged")).when(F.col("fate").isin("left", "gone"), F.col("held"))
    cases = cases.select("box_id", row.alias("row"), "fate", F.when(F.col("fate") == "gone", F.col("held.image_id")).alias("image"))
    mine = images.select(packed("image_id").alias("mine")).distinct()
    met = cases.join(mine, F.col("image") == F.col("mine"), "left")  # one row of a box goes, not both
    whole = F.struct(*[unpacked(c, F.col("box_id") if c == "box_id" else F.col("row")[c]).alias(c) for c in held.columns])
    return met.select(unpacked("box_id", F.col("box_id")).alias("box_id"), F.when(F.col("row").isNotNull(), whole).alias("row"), F.when(F.col("fate") != "gone", F.col("fate")).when(F.col("mine").isNull(), "left").otherwise("removed").alias("fate"))


def merged_boxes(staged: DataFrame, images: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """The store's boxes after the merge, changed, new and removed ones applied: one join of gold with the store."""
    cases = met(staged, images, held, later)
    return cases.where("fate in ('new', 'updated', 'left')").select("row.*")


def fates(staged: DataFrame, images: DataFrame, held: DataFrame, later: DataFrame) -> DataFrame:
    """(fate, num_rows): how many boxes a merge adds, updates, removes, leaves and skips, of one join."""
    return met(staged, images, held, later).groupBy("fate").agg(F.count("*").alias("num_rows"))


def kept_vectors(vectors: DataFrame, changed: DataFrame, removed: DataFrame) -> DataFrame:
    """Vectors without those of moved and removed boxes."""
    gone = changed.where("is_moved").select(F.col("box_id").alias("sample_id")).unionByName(removed.select(F.col("box_id").alias("sample_id")))
    return vectors.join(gone, "sample_id", "left_anti")


def cascade(removed: DataFrame, *tables: DataFrame, key: str = "sample_id") -> list[DataFrame]:
    """Each table without the rows of removed boxes."""
    gone = removed.select(F.col("box_id").alias(key))
    return [t.join(gone, key, "left_anti") for t in tables]


def samples_without_vectors(images: DataFrame, boxes: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """Image and box ids that have no vector of the model."""
    ids = images.select(F.col("image_id").alias("sample_id")).unionByName(boxes.select(F.col("box_id").alias("sample_id")))
    return ids.join(vectors.where(F.col("model") == model).select("sample_id"), "sample_id", "left_anti")


def lacks_vectors(images: DataFrame, boxes: DataFrame, vectors: DataFrame, model: str) -> bool:
    return not samples_without_vectors(images, boxes, vectors, model).isEmpty()


def vector_upserts(loaded: DataFrame, held: DataFrame, samples: DataFrame, later: DataFrame) -> DataFrame:
    """The vectors after a load: loaded ones of existing, not later edited samples replace those held."""
    fine = loaded.join(samples.select("sample_id"), "sample_id", "left_semi").join(later.select(F.col("box_id").alias("sample_id")), "sample_id", "left_anti")
    return held.join(fine.select("sample_id", "model"), ["sample_id", "model"], "left_anti").unionByName(fine.select(*held.columns))


def report(upserts: DataFrame, fates: DataFrame) -> DataFrame:
    """Counts of what a merge does: what, num_rows."""
    kinds = ["new", "updated", "removed"]
    counts = fates.agg(*[F.coalesce(F.sum(F.when(F.col("fate") == k, F.col("num_rows"))), F.lit(0)).alias(f"{k}_boxes") for k in kinds])
    boxes = counts.unpivot([], [f"{k}_boxes" for k in kinds], "what", "num_rows")
    return upserts.agg(F.count("*").alias("num_rows")).select(F.lit("images").alias("what"), "num_rows").unionByName(boxes)


def published_events(edits: DataFrame, boxes: DataFrame, loaded: DataFrame, others: DataFrame, after: int, last: int) -> DataFrame:
    """One event for each box that the log names in (after, last]: the box as it is now, or a tombstone.

    ``boxes``: sample_id, image_id, label, x, y, w, h as they are; ``loaded``: image_id, dataset, split, file_name;
    ``others``: sample_id of annotations that are no boxes. The image is the box's, else the last one that the log names.
    """
    part = edits.where((F.col("sequence") > after) & (F.col("sequence") <= last))
    named = F.max_by("image_id", F.when(F.col("image_id").isNotNull(), F.col("sequence")))
    logged = part.groupBy("sample_id").agg(F.max("sequence").alias("log_sequence"), named.alias("log_image"))
    met = logged.join(boxes.withColumnRenamed("image_id", "box_image"), "sample_id", "left").join(others.select("sample_id", F.lit(True).alias("other")), "sample_id", "left")
    met = met.where(F.col("box_image").isNotNull() | F.col("other").isNull())
    met = met.withColumn("image_id", F.coalesce("box_image", "log_image")).join(loaded, "image_id")
    geometry = [F.col(c).cast("double").alias(c) for c in GEOMETRY]
    return met.select("dataset", "split", "file_name", F.col("sample_id").alias("box_id"), "log_sequence", F.col("box_image").isNull().alias("is_deleted"), F.col("label").alias("label_name"), *geometry)


def event_file_id(sequence: int, sha256: str) -> str:
    return f"{sequence:06d}-{sha256[:12]}"


def shard_plan(images: DataFrame, max_images: int, stored: DataFrame | None = None) -> DataFrame:
    """Slices of at most about ``max_images`` images: name, dataset, split, shard, num_shards.

    A dataset within the limit is one slice; else each split is, and a split over the limit is cut into shards. A stored
    plan never changes; only splits that it lacks are added, and none to a dataset that it holds whole.
    """
    counts = images.groupBy("dataset", "split").agg(F.count("*").alias("n"))
    totals = counts.groupBy("dataset").agg(F.sum("n").alias("total"))
    whole = totals.where(F.col("total") <= max_images)
    none = lambda name, kind="int": F.lit(None).cast(kind).alias(name)
    one = whole.select(F.col("dataset").alias("name"), "dataset", none("split", "string"), none("shard"), none("num_shards"))
    parts = counts.join(whole, "dataset", "left_anti").withColumn("num_shards", F.ceil(F.col("n") / max_images).cast("int"))
    if stored is not None:
        parts = counts.withColumn("num_shards", F.ceil(F.col("n") / max_images).cast("int")).join(whole.join(stored, "dataset", "left_anti"), "dataset", "left_anti")
        parts = parts.join(stored.where("split is null").select("dataset"), "dataset", "left_anti").join(stored.select("dataset", "split"), ["dataset", "split"], "left_anti")
        one = one.join(stored.select("dataset"), "dataset", "left_anti").select("name", "dataset", "split", "shard", "num_shards")
    base = F.concat_ws(".", "dataset", "split")
    cut = parts.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("num_shards") - 1)))
    single = F.col("num_shards") == 1
    name = F.when(single, base).otherwise(F.concat(base, F.lit("."), (F.col("k") + 1).cast("string"), F.lit("-of-"), F.col("num_shards").cast("string")))
    cut = cut.select(name.alias("name"), "dataset", "split", F.when(~single, F.col("k")).alias("shard"), F.when(~single, F.col("num_shards")).alias("num_shards"))
    planned = one.unionByName(cut)
    return planned if stored is None else stored.unionByName(planned)
