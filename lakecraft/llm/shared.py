"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is absent and Spark runs on one machine, as in tests, a local folder is made and set.
    """
    found = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} has to name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lakecraft-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialise(df: DataFrame, name: str, *, arrow_rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors.

    ``arrow_rows``: rows of a batch that goes to Python while this is written, for rows that may be long.
    """
    spark, path, schema = df.sparkSession, scratch(df.sparkSession, name), df.schema
    before = spark.conf.get(ARROW_ROWS)
    if arrow_rows:
        spark.conf.set(ARROW_ROWS, min(arrow_rows, int(before)))
    try:
        df.write.parquet(path)
    finally:
        if arrow_rows:
            spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(schema).parquet(path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition function that returns what it has freed to the system when it ends: its worker is used again."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return wrapped


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a URI or plain path, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def make_dir(uri: str) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column, nulls as empty; no copy where there is no null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.string()), False
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(at) == 0:
        return flat[:0], np.zeros(1, np.int64)
    return flat[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that cover a string column, with at most ``most`` bytes of text each or one row."""
    _, at = text_buffers(column)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, len(column))
        i = j


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others may have any name; a null text counts as empty."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c == "text" else F.col(c) for c in columns])


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` that keeps all columns, whatever their names (those with dots too)."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def cores(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)

