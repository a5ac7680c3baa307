"""SNK-10, SNK-11, SNK-5: a serving state in hash buckets of its ids, of which a run rewrites those that it meets.

Each run writes its buckets to a folder of its own; one pointer file then names the folder of every bucket. It is
published by a rename, so readers see the state before a run or after it and a run that dies leaves the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Rewritten:
    """What a run did: the buckets that it wrote, of how many; the rows in them."""

    buckets: list[int]
    of: int
    rows: DataFrame


class BucketStore:
    """``buckets`` is fixed by the first run; it bounds the pointer's size and what of the state a small batch rewrites."""

    def __init__(self, spark: SparkSession, root: str, id: str = "entity_id", buckets: int = 256):
        self.spark, self.root, self.id = spark, root.rstrip("/"), id
        self.buckets = (self._pointer() or {}).get("of", buckets)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _pointer(self) -> dict | None:
        fs, p = self._fs(f"{self.root}/_state.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, told: dict) -> None:
        jvm = self.spark._jvm
        fs, new = self._fs(f"{self.root}/_state-{uuid.uuid4().hex}.json")
        out = fs.create(new, True)
        try:
            out.write(bytearray(json.dumps(told).encode()))
        finally:
            out.close()
        options = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(new, self._fs(f"{self.root}/_state.json")[1], options)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.id).cast("string")), F.lit(self.buckets)).cast("int")

    def run_id(self) -> str | None:
        """The run whose state is visible."""
        told = self._pointer()
        return told and told["run_id"]

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The visible state, or some buckets of it; null columns for what a bucket's run did not know. None before the first run."""
        told = self._pointer()
        if told is None:
            return None
        schema = T.StructType.fromJson(told["schema"])
        paths = [f"{self.root}/{path}" for b, path in told["paths"].items() if only is None or int(b) in set(only)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def apply(self, batch: DataFrame, run_id: str, step: Callable[[DataFrame | None, DataFrame], DataFrame], *, full_run: bool = False) -> Rewritten:
        """Writes the buckets that ``batch`` has ids of, all on a full run, as ``step(their state, batch)`` gives them, and publishes.

        ``batch`` is read twice; rows without an id have no bucket. A row's ``change`` stays as its last rewrite left it.
        """
        told = self._pointer() or {"paths": {}}
        met = [r[0] for r in batch.where(F.col(self.id).isNotNull()).select(self.bucket().alias("b")).distinct().collect()]  # ``buckets`` rows at most
        due = sorted(set(met) | {int(b) for b in told["paths"]}) if full_run else sorted(met)
        old = self.read(due)
        new = step(old, batch)
        folder = f"run={run_id}-{uuid.uuid4().hex}"
        new.withColumn("_bucket", self.bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        fs, p = self._fs(f"{self.root}/{folder}")
        written = sorted(int(name.split("=")[1]) for s in fs.listStatus(p) if (name := s.getPath().getName()).startswith("_bucket="))
        paths = {b: path for b, path in told["paths"].items() if int(b) not in set(due)} | {str(b): f"{folder}/_bucket={b}" for b in written}
        fields = {f.name: f for f in (*T.StructType.fromJson(told["schema"]), *new.schema)} if "schema" in told else {f.name: f for f in new.schema}
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])
        self._publish({"run_id": run_id, "of": self.buckets, "paths": paths, "schema": schema.jsonValue()})
        return Rewritten(due, self.buckets, self.read(due))

    def purge(self) -> list[str]:
        """Removes the folders that the visible state has no bucket in; not while another run writes."""
        told = self._pointer() or {"paths": {}}
        used = {path.split("/")[0] for path in told["paths"].values()}
        fs, p = self._fs(self.root)
        gone = [s.getPath() for s in fs.listStatus(p) if (name := s.getPath().getName()).startswith("run=") and name not in used] if fs.exists(p) else []
        for path in gone:
            fs.delete(path, True)
        return [path.getName() for path in gone]
