"""Tables in the order of their key, with a map of what each file holds, for pages that open few files.

Rows are dealt into ranges of the key and sorted, so files follow each other. The zone map has a row for each file and
(dataset, split): least and greatest key, rows, and the file's rows before it in all. A page is read from the files that
can hold it, and a row's number is its file's start and its place in the file, so numbering moves no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.operators import query
from silverloom.plans.builds import ROW_GROUP
from silverloom.plans.scratch import small

#: Rows of a file at most.
FILE_ROWS = 1 << 20
GROUPS = ["dataset", "split", "role", "commercial_use"]


class KeyedTable:
    """A stored table by its key, which has no nulls and no repeats."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    @classmethod
    def write(cls, rows: DataFrame, path: str, key: str, file_rows: int = FILE_ROWS, files: int | None = None) -> KeyedTable:
        """Store ``rows`` in the order of ``key``, in files of at most ``file_rows``, and then the map of its files."""
        dealt = rows.repartitionByRange(*([files] if files else []), key).sortWithinPartitions(key)
        dealt.write.option("maxRecordsPerFile", file_rows).option("parquet.block.row.count.limit", ROW_GROUP).parquet(f"{path}/rows")
        table = cls(rows.sparkSession, path, key)
        groups = [c for c in GROUPS if c in rows.columns]
        held = table.read("_metadata.file_path").groupBy("file_path", *groups).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("num_rows"))
        held.coalesce(1).write.parquet(f"{path}/zones")  # a row for each file and group
        return table

    def read(self, *metadata: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").select("*", *metadata)

    def zones(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/zones")

    def files(self, selection: query.Selection, after: str | None, most: int | None) -> list[tuple[str, str, int]]:
        """(file, low, rows that the selection may take) of the first ``most`` files after the key ``after``, in order."""
        groups = query.Selection(dataset=selection.dataset, split=selection.split, role=selection.role, commercial_use=selection.commercial_use)
        found = query.select_rows(self.zones(), groups)
        found = found if after is None else found.where(F.col("high") > F.lit(after))
        held = found.groupBy("file_path").agg(F.min("low").alias("low"), F.sum("num_rows").alias("n"))
        ordered = held.orderBy("low")
        return [(r.file_path, r.low, r.n) for r in (ordered if most is None else ordered.limit(most)).collect()]

    def page(self, selection: query.Selection, after: str | None = None, limit: int = query.DEFAULT_LIMIT, extra: Column | None = None) -> DataFrame:
        """The next ``limit`` rows of the selection by key, read from the files that the map names.

        Where the map counts all that the selection asks, those files are known beforehand. A filter on classes or shards,
        or ``extra``, is not counted: the page then takes twice as many files each time, until it is full or all are read.
        """
        query.checked_limit(limit)
        counted = selection.class_name is None and selection.num_shards is None and extra is None
        # where all is counted each file holds a row of the selection, though the first may hold it before ``after``
        files = self.files(selection, after, limit + 1 if counted else None)
        most, rows = 0, 0
        for _, low, n in files:
            if rows >= limit:
                break
            most += 1
            rows += n if after is None or low > after else 0
        while True:
            chosen = self.spark.read.schema(self.read().schema).parquet(*[f for f, *_ in files[:most]]) if files else self.read().limit(0)
            chosen = query.select_rows(chosen, selection)
            out = query.page(chosen if extra is None else chosen.where(extra), self.key, after, limit)
            if counted or most >= len(files) or out.count() >= limit:
                return out
            most *= 2

    def numbered(self) -> DataFrame:
        """All rows with ``place``, their number from 0 by key: the rows of the files before, and the place in the file."""
        files = self.zones().groupBy("file_path").agg(F.min("low").alias("low"), F.sum("num_rows").alias("n"))
        before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
        starts = files.select("file_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
        rows = self.read("_metadata.file_path", "_metadata.row_index").join(small(starts), "file_path")
        return rows.withColumn("place", F.col("__start") + F.col("row_index")).drop("file_path", "row_index", "__start")
