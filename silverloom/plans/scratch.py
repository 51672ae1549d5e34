"""Frames written once and read often within a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that one task of a shuffle is to sort at most, some 100 MB of boxes.
TASK_ROWS = 1 << 19
#: How tables are packed: ids are digests in hex, which snappy leaves as long as they are.
PACKED = "zstd"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a new one where that is unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder. What reads it several times computes it once, and a lost executor loses

    none of it.
    """
    path = f"{scratch_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; beyond that a join shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def dealt(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df``, of ``rows`` rows, dealt by ``key`` over so many tasks that none has many more than ``TASK_ROWS``; left as it

    is where the session's number of partitions does that.
    """
    tasks = -(-rows // TASK_ROWS)
    return df if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(tasks, *key)
