"""SRC-4: a feed that shows more with every batch, as a stream that ends when it shows nothing new.

A streaming source reads one batch after another, its offset is the number of the next one. The links seen are the state
of a streaming deduplication, so a run that is started again from its checkpoint repeats no batch and forgets no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: The links that a category's feed shows after so many batches.
Show = Callable[[str, int], list[str]]


def feed_source(show: Show, name: str) -> type[DataSource]:
    """A streaming source of that name: (batch, link, found). A batch has a row for each link and one without a link."""

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options: dict):
            self.category = options.get("category", "")

        def initialOffset(self) -> dict:
            return {"batch": 1}

        def _rows(self, batch: int) -> Iterator[tuple]:
            links = sorted(set(show(self.category, batch)))
            return iter([(batch, None, len(links)), *((batch, link, len(links)) for link in links)])

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            return self._rows(start["batch"]), {"batch": start["batch"] + 1}

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            return (row for batch in range(start["batch"], end["batch"]) for row in self._rows(batch))

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "batch int, link string, found int"

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: ANN001
            return Reader(dict(self.options))

    return Source


def _told(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch int, link string, found int").parquet(f"{path}/batches")


def batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch, found, new, links): what each batch showed and what of it was new."""
    links = F.sort_array(F.collect_list("link"))  # nulls, the rows without a link, are not collected
    return _told(spark, path).groupBy("batch").agg(F.max("found").alias("found"), F.count("link").alias("new"), links.alias("links"))


def ended(spark: SparkSession, path: str, most: int, stale: int) -> bool:
    """Whether ``most`` batches are read or the last ``stale`` showed nothing new."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batches")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return most <= 0
    last = batches(spark, path).orderBy(F.desc("batch")).select("batch", "new").limit(stale).collect()
    return bool(last) and (last[0].batch >= most or len(last) == stale and not any(r.new for r in last))


def read_feed(spark: SparkSession, name: str, category: str, path: str, *, most: int = 30, stale: int = 2) -> DataFrame:
    """Reads a registered feed until it has shown nothing new for ``stale`` batches, or ``most`` batches; see :func:`batches`.

    ``path``: a shared folder of this feed, with what was read and the stream's checkpoint. One batch is asked for at a
    time, none after the end; a call after a broken one goes on where that stopped.
    """
    rows = spark.readStream.format(name).option("category", category).load()
    fresh = rows.withColumn("key", F.coalesce("link", F.concat(F.lit("#"), "batch"))).dropDuplicates(["key"]).drop("key")

    def keep(df: DataFrame, number: int) -> None:  # a batch that is run again replaces its own files
        df.write.mode("overwrite").parquet(f"{path}/batches/run={number}")

    while not ended(spark, path, most, stale):
        query = fresh.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return batches(spark, path)
