"""Incremental runs (an extension): files that arrive become lifecycle steps; windowed counts with late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lifecycle import step
from ..sources.lake import Lake


def stream_into_state(spark: SparkSession, source: str, schema: T.StructType, lake: Lake, checkpoint: str, *, id: str = "entity_id"):
    """Every micro-batch of Parquet files is a partial run: rows are upserted, nothing ages. Returns the query.

    A batch that is tried again writes the same run again, from the state before it.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        run = f"{number:012d}"
        before = lake.previous("serving", "stream", run)
        state = lake.read("serving", "stream", before) if before else None
        lake.write(step(state, batch, run, run, full_run=False, id=id).drop("change"), "serving", "stream", run)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by window and key; rows later than the watermark are left out, as state has to end."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
