"""Streams of edit events: new files into bronze, the latest state of each box, and published event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverloom.operators import corrections, sync
from silverloom.schemas import EVENTS

def event_stream(spark: SparkSession, path: str, schema: object = None, files_per_batch: int = 1_000) -> DataFrame:
    """Event files as a stream, each file once. No watermark: an edit that commits late is still an edit."""
    return spark.readStream.schema(schema or EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append new event files to bronze and stop; the checkpoint knows which are done."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(target)


def latest_of(events: DataFrame) -> DataFrame:
    """The latest event of each box, in any order of arrival: a maximum commutes. For a stream it is the keyed state.

    Tombstones stay, else an older event that comes late would bring a box back.
    """
    rest = [c for c in events.columns if c != "box_id"]
    last = events.groupBy("box_id").agg(F.max_by(F.struct(*rest), F.struct(*corrections.ORDER)).alias("last"))
    return last.select("box_id", *[F.col("last")[c].alias(c) for c in rest])


def latest_state(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest event of each box in the stream's state store, and write the boxes that a batch touched.

    The state is partitioned by box and kept by Spark beside the checkpoint, so neither a batch's work nor its writes grow
    with it. A batch is a folder of its own name, so one that is run again after a failure gives the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:09d}")

    return latest_of(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_state(spark: SparkSession, path: str, schema: object) -> DataFrame:
    """The latest event of each box from what the batches wrote; a box is there once for each batch that touched it."""
    written = spark.read.schema(schema).option("basePath", path).parquet(path)
    return latest_of(written.drop("batch")).select(*[f.name for f in schema if f.name != "batch"])


def publish(edit_stream: DataFrame, boxes: DataFrame, loaded: DataFrame, others: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Cut the event files of each micro-batch of the edit log: the batch's range of sequences, published as it is now.

    A batch is a folder; a large one has several files, each a range of sequences in order, so that no task writes all.
    """

    def cut(batch: DataFrame, batch_id: int) -> None:
        ends = batch.agg(F.min("sequence"), F.max("sequence")).first()
        if ends[0] is not None:
            events = sync.published_events(batch, boxes, loaded, others, ends[0] - 1, ends[1])
            events.repartitionByRange("log_sequence", "box_id").sortWithinPartitions("log_sequence", "box_id").write.mode("overwrite").parquet(f"{target}/{batch_id:06d}")

    return edit_stream.writeStream.foreachBatch(cut).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
