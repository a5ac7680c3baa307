"""WIN-7, SNK-9, JOIN-5: rows numbered in the order of their id, as one written run that lookups read in part.

The run is cut and sorted by ranges of the id and written once; a row's position is the number of rows in the files
before its own plus its place there. The index has a row for each file. Positions follow from what is written, so
they are the same whatever task was run again, and a lookup opens the files that hold its positions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import shared_folder


class Positions:
    """The run in a folder: ``rows`` (its files) and ``index`` (first position, rows, file)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def write(cls, rows: DataFrame, id: str, path: str | None = None, *, files: int | None = None) -> Positions:
        """Of rows whose id is not null; equal ids get positions of their own. ``files``: parts of the run, else as Spark cuts it."""
        spark = rows.sparkSession
        out = cls(spark, path or f"{shared_folder(spark)}/positions-{uuid.uuid4().hex}")
        given = rows.where(F.col(id).isNotNull())
        cut = given.repartitionByRange(files, id) if files else given.repartitionByRange(id)
        cut.sortWithinPartitions(id).write.parquet(f"{out.path}/rows")
        written = spark.read.schema(rows.schema).parquet(f"{out.path}/rows")
        part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
        counts = written.select(part.alias("part"), F.col("_metadata.file_path").alias("file")).groupBy("part", "file").agg(F.count(F.lit(1)).alias("n"))
        before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
        counts.select(F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n", "file").write.parquet(f"{out.path}/index")
        return out

    def index(self) -> DataFrame:
        return self.spark.read.schema("first long, n long, file string").parquet(f"{self.path}/index")

    def _rows(self, *files: str) -> DataFrame:
        read = self.spark.read.parquet(*(files or (f"{self.path}/rows",)))
        return read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_nth"))

    def read(self) -> DataFrame:
        """All rows with pos, from 0."""
        index = F.broadcast(self.index().select(F.col("file").alias("_file"), "first"))  # a row for each file
        rows = self._rows().join(index, "_file")
        return rows.select((F.col("first") + F.col("_nth")).alias("pos"), *[f"`{c}`" for c in rows.columns if c not in ("_file", "_nth", "first")])

    def files_of(self, positions: DataFrame) -> list[str]:
        """The files that hold positions of ``positions.pos``."""
        index = self.index()
        inside = (F.col("pos") >= F.col("first")) & (F.col("pos") < F.col("first") + F.col("n"))
        found = positions.select(F.col("pos").cast("long").alias("pos")).join(F.broadcast(index), inside).select("file").distinct()
        return sorted(r[0] for r in found.collect())  # of the index's files

    def at(self, positions: DataFrame) -> DataFrame:
        """The rows at ``positions.pos``, with pos; positions that there are not have no row, repeated ones one each."""
        files = self.files_of(positions)
        if not files:
            return positions.select(F.col("pos").cast("long").alias("pos")).join(self.read().where("false"), "pos")
        index = F.broadcast(self.index().select(F.col("file").alias("_file"), "first"))
        rows = self._rows(*files).join(index, "_file")
        rows = rows.select((F.col("first") + F.col("_nth")).alias("pos"), *[f"`{c}`" for c in rows.columns if c not in ("_file", "_nth", "first")])
        return positions.select(F.col("pos").cast("long").alias("pos")).join(rows, "pos")
