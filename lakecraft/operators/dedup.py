"""Deterministic dedup by windows with a total order, range filter, order, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import token
from ..schemas import SOURCES

FIRST_DATE, LAST_DATE = "2020-01-01", "2027-12-31"


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """DED-1, WIN-1: of the rows with equal keys the first in a total order; null keys are equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def longest_of(df: DataFrame, keys: list[Column | str], text: str, ties: list[Column]) -> DataFrame:
    """DED-2, DED-3: of the rows with equal keys the one with the longest text; missing texts count as empty."""
    return keep_first(df, keys, [F.coalesce(F.length(text), F.lit(0)).desc(), *ties])


def in_range(mask: Column, date: Column, first: str = FIRST_DATE, last: str = LAST_DATE) -> Column:
    """FIL-1: false for masked rows with an ISO date outside the range; other dates and nulls pass."""
    outside = date.rlike(r"^\d{4}-\d{2}-\d{2}") & ((F.substring(date, 1, 10) < first) | (F.substring(date, 1, 10) > last))
    return ~(mask & F.coalesce(outside, F.lit(False)))


def dedup_catalog(df: DataFrame) -> DataFrame:
    """DED-1..3 and FIL-1: by entity id, source order first; then shop events by meaning (longest description) and by title and date.

    Rows of other sources keep their own id as key, so one window serves all and nothing is split and joined.
    """
    rank = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("fuente"))
    ties = [F.col("url_origen").asc_nulls_last(), F.col("titulo").asc_nulls_last(), F.col("descripcion").asc_nulls_last(), F.col("poi_id")]
    shop = F.coalesce((F.lower("entity_type") == "event") & (F.lower("fuente") == "joinnus"), F.lit(False))
    key = lambda *cs: F.when(shop, F.concat_ws("||", *[token(c) for c in cs])).otherwise(F.col("entity_id"))
    df = keep_first(df, ["entity_id"], [rank, *ties])
    df = longest_of(df, [shop, key("titulo", "fecha_inicio", "hora_inicio", "lugar", "tipo")], "descripcion", [*ties, F.col("entity_id")])
    df = df.where(in_range(shop, F.col("fecha_inicio")))
    return longest_of(df, [shop, key("titulo", "fecha_inicio")], "descripcion", [*ties, F.col("entity_id")])


def in_order(df: DataFrame) -> DataFrame:
    """SRT-1: by first day, missing last."""
    return df.orderBy(F.col("fecha_inicio").asc_nulls_last(), "entity_id")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """SMP-1: ``n`` rows in the order of a hash of the key and the seed; the same rows on every run."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.orderBy(h, key).limit(n)


def first_n(df: DataFrame, order: list[Column | str], n: int = 200) -> DataFrame:
    """WIN-6, SRT-3: the first rows of an order; 0 or less means all."""
    return df.orderBy(*order).limit(n) if n > 0 else df.orderBy(*order)


def new_per_batch(df: DataFrame, link: str = "link", batch: str = "batch") -> DataFrame:
    """WIN-5: for each batch how many links it shows first, and how many batches without a new one end with it."""
    seen = df.groupBy(link).agg(F.min(batch).alias("first"))
    fresh = seen.groupBy(F.col("first").alias(batch)).agg(F.count(F.lit(1)).alias("fresh"))
    counts = df.select(batch).distinct().join(fresh, batch, "left").na.fill(0, ["fresh"])
    w = Window.orderBy(batch)  # a row for each batch
    island = F.sum((F.col("fresh") > 0).cast("int")).over(w)
    counts = counts.withColumn("island", island)
    return counts.withColumn("stale", F.sum((F.col("fresh") == 0).cast("int")).over(Window.partitionBy("island").orderBy(batch))).drop("island")


def filter_or_all(df: DataFrame, condition: Column) -> DataFrame:
    """FIL-4: the rows that meet a condition, all where none does; the flag is one row, so its broadcast is bounded."""
    met = F.coalesce(condition, F.lit(False))
    any_ = df.agg(F.coalesce(F.bool_or(met), F.lit(False)).alias("_any"))
    return df.join(F.broadcast(any_), met | ~F.col("_any"), "inner").drop("_any")


def in_order_distinct(c: Column | str) -> Column:
    """DED-7: an array's distinct values in the order of their first appearance."""
    return F.array_distinct(c)
