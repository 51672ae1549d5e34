"""Curator events: the latest per box, and the fold of them over the source's boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.functions import expr as X
from silverloom.operators.normalize import Normalized, clipped, renumbered
from silverloom.plans.scratch import small
from silverloom.schemas import CLASSES, IMAGE_KEY, SILVER_BOXES, UNKNOWN_CLASS, class_id

#: The order of events: files in the order of bronze, rows in the order of the log within a file.
ORDER = ["file_ordinal", "log_sequence"]


def latest_events(events: DataFrame) -> DataFrame:
    """The last event of each box, and where its first one stood (first_seen).

    A later file wins over a larger sequence of an earlier file, which may be of another chain. The maximum of a struct
    combines on the map side, so many events of one box cost no more than a row for each task.
    """
    order = F.struct(*ORDER)
    rest = [c for c in events.columns if c != "box_id"]
    out = events.groupBy("box_id").agg(F.max_by(F.struct(*rest), order).alias("last"), F.min(order).alias("first_seen"))
    return out.select("box_id", *[F.col("last")[c].alias(c) for c in rest], "first_seen")


def events_until(events: DataFrame, files: DataFrame, last_event_file: str | None) -> DataFrame:
    """Events of the files up to the one named, with the file's ordinal; ``files``: event_file_id, file_ordinal.

    The ordinal is that of the manifest; a marker that it does not list is an error.
    """
    wanted = files
    if last_event_file is not None:
        marks = [r[0] for r in files.where(F.col("event_file_id") == last_event_file).select("file_ordinal").take(1)]
        if not marks:
            raise LookupError(f"no event file {last_event_file}")
        wanted = files.where(F.col("file_ordinal") <= marks[0])
    return events.join(small(wanted.select("event_file_id", "file_ordinal")), "event_file_id")


def resolved_label(label: Column, source_class: Column) -> tuple[Column, Column]:
    """Class name and source class of a curator's label: a known one keeps what the source said, any other replaces it."""
    known = F.lower(label).isin(CLASSES)
    return F.when(known, F.lower(label)).otherwise(F.lit(UNKNOWN_CLASS)), F.when(known, source_class).otherwise(label)


def fold_events(silver: DataFrame, images: DataFrame, latest: DataFrame) -> Normalized:
    """Silver boxes with the latest events folded in, and what that drops.

    Events of a box of the source correct it: a tombstone drops it, a label other than its class relabels it, and a box
    other than its whole-pixel rounding moves it (an equal one keeps the source's fractions). Live events of other boxes
    are additions to the image they name, after the source's boxes and in the order of their first events. A moved or
    added box that has no area within its image is dropped, as is an addition without a label or a box.

    Boxes and events go as one frame through one exchange, on the image key. A box meets its event in a window of its id
    within the image, then the size of the image, and then the window that renumbers, all on that partitioning. An event
    thus applies within the image that it names, which its box's id is made from.
    """
    of_box = [c for c in SILVER_BOXES.names if c not in (*IMAGE_KEY, "box_id")]
    of_event = ["is_deleted", "label_name", *"xywh", "first_seen"]
    place = "struct<file_ordinal:bigint,log_sequence:bigint>"
    event = latest.select(*IMAGE_KEY, X.packed_id("box_id").alias("box_id"), F.struct(*[F.col(c).cast(place).alias(c) if c == "first_seen" else F.col(c) for c in of_event]).alias("e"))
    box = silver.select(*IMAGE_KEY, X.packed_id("box_id").alias("box_id"), F.struct(*of_box).alias("s"))
    both = box.unionByName(event, allowMissingColumns=True).repartition(*IMAGE_KEY)
    same_id = Window.partitionBy(*IMAGE_KEY, "box_id")
    both = both.withColumns({"event": F.max("e").over(same_id), "held": F.max(F.col("s").isNotNull()).over(same_id)})
    given = F.col("s").isNotNull()  # an event's own row stays only where no box of the source has its id
    both = both.where(given | (~F.col("held") & ~F.col("e.is_deleted")))
    met = both.withColumn("box_id", X.unpacked_id("box_id")).join(images.select(*IMAGE_KEY, "width", "height"), IMAGE_KEY)

    e = {c: F.col("event")[c] for c in of_event}
    s = {c: F.col("s")[c] for c in of_box}
    same = [X.half_up(s[c]) == e[c] for c in "xywh"]
    is_set = lambda c: F.coalesce(c, F.lit(False))
    met = met.select(
        "*", given.alias("given"), (given & is_set(e["is_deleted"])).alias("deleted"), (given & is_set(e["label_name"] != s["class_name"])).alias("relabelled"),
        (given & e["x"].isNotNull() & ~is_set(same[0] & same[1] & same[2] & same[3])).alias("moved"), (given | (e["label_name"].isNotNull() & e["x"].isNotNull())).alias("complete"),
        e["x"].alias("xmin"), e["y"].alias("ymin"), (e["x"] + e["w"]).alias("xmax"), (e["y"] + e["h"]).alias("ymax"),
    )
    drawn = F.col("moved") | ~F.col("given")
    new = clipped(met).withColumn("lost", drawn & ~is_set(X.has_area(F.col("w"), F.col("h"))))
    stays = ~F.col("deleted") & ~F.col("lost") & F.col("complete")
    name, source_class = resolved_label(e["label_name"], F.when(F.col("given"), s["source_class"]).otherwise(e["label_name"]))
    named = F.col("relabelled") | ~F.col("given")
    columns = {c: s[c] for c in of_box} | {c: F.when(drawn, F.col(c)).otherwise(s[c]) for c in "xywh"}
    columns |= {
        "class_name": F.when(named, name).otherwise(s["class_name"]),
        "source_class": F.when(named, source_class).otherwise(s["source_class"]),
        "origin": F.when(F.col("given"), s["origin"]).otherwise(F.lit("studio")),
        "is_class_corrected": is_set(s["is_class_corrected"]) | F.col("relabelled"),
        "is_geometry_corrected": is_set(s["is_geometry_corrected"]) | F.col("moved"),
    }
    order = [(~F.col("given")).alias("is_added"), F.when(F.col("given"), s["box_index"]).otherwise(0).alias("source_place"), F.when(~F.col("given"), e["first_seen"]).alias("first_seen")]
    kept = new.where(stays).select(*IMAGE_KEY, "box_id", *[c.alias(n) for n, c in columns.items() if n not in ("box_index", "class_id")], *order)
    boxes = renumbered(kept.withColumn("class_id", class_id(F.col("class_name"))), "is_added", "source_place", "first_seen").select(*SILVER_BOXES.names)
    reason = F.when(F.col("deleted"), "studio_deleted").when(~F.col("complete"), "incomplete_addition").otherwise("degenerate_box")
    return Normalized(boxes, new.where(~stays).select(*IMAGE_KEY, "box_id", reason.alias("reason")))


def fold_cases(silver: DataFrame, images: DataFrame, latest: DataFrame) -> DataFrame:
    """What each latest event does: noop, relabel, move, both, delete, add or ignored."""
    held = silver.select("box_id", "class_name", *[F.col(c).alias(f"s_{c}") for c in "xywh"])
    met = latest.join(held, "box_id", "left").join(images.select(*IMAGE_KEY, F.lit(True).alias("has_image")), IMAGE_KEY, "left")
    relabel = F.col("label_name").isNotNull() & (F.col("label_name") != F.col("class_name"))
    same = [X.half_up(f"s_{c}") == F.col(c) for c in "xywh"]
    move = F.col("x").isNotNull() & ~F.coalesce(same[0] & same[1] & same[2] & same[3], F.lit(False))
    known = F.col("class_name").isNotNull()
    case = (
        F.when(F.col("is_deleted"), F.when(known, "delete").otherwise("ignored"))
        .when(~known, F.when(F.col("has_image"), "add").otherwise("ignored"))
        .when(relabel & move, "both").when(relabel, "relabel").when(move, "move").otherwise("noop")
    )
    return met.select("box_id", case.alias("fold_case"))
