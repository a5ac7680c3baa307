"""Readers of raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of an envelope that may hold the items, in order.
ENVELOPES = ("results", "places", "candidates", "data", "items")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: (line, ok): every non-blank line and whether it is JSON; a broken line is no error."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "line")
    return lines.withColumn("ok", F.try_parse_json("line").isNotNull())


def line_counts(lines: DataFrame) -> DataFrame:
    """AGG-15: lines and parseable lines."""
    return lines.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("parseable"))


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: (item): the JSON text of each item of files that hold a list, an envelope or a single item."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    at = lambda p: F.try_variant_get("v", p, "array<variant>")
    single = F.when(F.coalesce(F.try_variant_get("v", "$.place_id", "string"), F.try_variant_get("v", "$.id", "string")).isNotNull(), F.array("v"))
    items = F.coalesce(at("$"), *[at(f"$.{k}") for k in ENVELOPES], single)
    return whole.select(F.explode(items).alias("item")).select(F.to_json("item").alias("item"))


def read_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC-8: the file of the last name that matches, as texts."""
    files = spark.read.format("binaryFile").load(pattern).select("path").orderBy(F.desc("path")).limit(1).collect()  # names only
    if not files:
        raise FileNotFoundError(pattern)
    return spark.read.csv(files[0][0], header=True, multiLine=True, escape='"')


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11."""
    return spark.read.json(path, multiLine=True)
