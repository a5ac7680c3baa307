"""The lake: layout by layer, dataset and run; manifests; the pointer to the latest run.

Paths are Hadoop URIs; small files are read and written through Spark's own file system, so any store works.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIMENSION, VERSION


@dataclass
class BronzeEntry:
    name: str
    payload_path: str | None
    ingest_ts: str
    scraper_version: str = VERSION
    row_count_estimate: int | None = None
    http_status: int | None = None
    url: str | None = None
    notes: str | None = None


@dataclass
class BronzeManifest:
    run_id: str
    created_at: str
    sources: list[BronzeEntry] = field(default_factory=list)
    layer: str = "bronze"
    schema_version: str = VERSION


@dataclass
class SilverManifest:
    run_id: str
    created_at: str
    parquet_path: str
    row_count: int
    sources: dict[str, int] = field(default_factory=dict)
    dq_checks: dict = field(default_factory=dict)
    layer: str = "silver"
    schema_version: str = VERSION


@dataclass
class GoldManifest:
    run_id: str
    created_at: str
    catalog_path: str
    catalog_count: int
    vectors_path: str | None = None
    vector_count: int = 0
    embedding_dim: int = DIMENSION
    model_name: str | None = None
    layer: str = "gold"
    schema_version: str = VERSION


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def bronze(self, source: str, run_id: str) -> str:
        return f"{self.root}/bronze/source={source}/run_id={run_id}/events.jsonl"

    def dataset(self, layer: str, name: str, run_id: str) -> str:
        return f"{self.root}/{layer}/{name}/run_id={run_id}"

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def write_text(self, path: str, text: str) -> None:
        fs, p = self._fs(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        fs, p = self._fs(path)  # names with an underscore are hidden from Spark's readers
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_bronze(self, df: DataFrame, source: str, run_id: str, ingest_ts: str, notes: str | None = None) -> BronzeEntry:
        """SNK-1, JSON-4: rows as JSON lines; a number that is not finite is null, dates are ISO texts."""
        path = self.bronze(source, run_id)
        plain = df.select(*[F.when(~F.isnan(f"`{f.name}`") & (F.abs(f"`{f.name}`") < float("inf")), F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`") for f in df.schema])
        plain.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
        return BronzeEntry(source, path, ingest_ts, row_count_estimate=self.spark.read.text(path).count(), notes=notes)

    def write(self, df: DataFrame, layer: str, name: str, run_id: str) -> str:
        """SNK-2..4: a run's Parquet; writing again replaces that run only."""
        path = self.dataset(layer, name, run_id)
        df.write.mode("overwrite").parquet(path)
        return path

    def read(self, layer: str, name: str, run_id: str, schema=None) -> DataFrame:
        """SRC-10."""
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.dataset(layer, name, run_id))

    def write_manifest(self, manifest: BronzeManifest | SilverManifest | GoldManifest) -> str:
        """SNK-5: the manifest first, the pointer second."""
        path = f"{self.root}/{manifest.layer}/_manifest_{manifest.run_id}.json"
        self.write_text(path, json.dumps(asdict(manifest), ensure_ascii=False))
        self.write_text(f"{self.root}/{manifest.layer}/_latest.json", json.dumps({"run_id": manifest.run_id}))
        return path

    def manifest(self, layer: str, run_id: str) -> dict:
        return json.loads(self.read_text(f"{self.root}/{layer}/_manifest_{run_id}.json"))

    def latest(self, layer: str) -> str | None:
        """SRC-14."""
        path = f"{self.root}/{layer}/_latest.json"
        return json.loads(self.read_text(path))["run_id"] if self.exists(path) else None

    def runs(self, layer: str, name: str) -> list[str]:
        """SRC-13: run ids, always as text, in order."""
        fs, p = self._fs(f"{self.root}/{layer}/{name}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(m[1] for n in names if (m := re.fullmatch(r"run_id=([0-9_]+)", n)))

    def previous(self, layer: str, name: str, run_id: str) -> str | None:
        """WIN-3: the run before."""
        return max((r for r in self.runs(layer, name) if r < run_id), default=None)

    def purge(self, layer: str, name: str, keep: int) -> list[str]:
        """Retention: all but the last ``keep`` runs go."""
        gone = self.runs(layer, name)[: -keep if keep else None]
        for r in gone:
            fs, p = self._fs(self.dataset(layer, name, r))
            fs.delete(p, True)
        return gone
