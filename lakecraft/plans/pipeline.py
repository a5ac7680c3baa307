"""ORC-1, ORC-2: bronze, silver, gold; sources and providers are plug points."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import missing_to_null
from ..operators import lifecycle, quality
from ..operators.dedup import hash_sample, in_order
from ..operators.enrich import Geocoder, Model, enrich, geocode
from ..operators.normalize import conform, documents_of, metadata, normalize_all, poi_catalog
from ..operators.providers import Pace
from ..operators.vectors import Encoder, embed, query_text
from ..schemas import GOLD_CATALOG, GOLD_VECTORS, SILVER, SOURCES
from ..sources.lake import BronzeEntry, BronzeManifest, GoldManifest, Lake, SilverManifest
from ..sources.readers import line_counts, read_jsonl
from ..sources.serving import BucketStore

Source = Callable[[SparkSession], DataFrame]


@dataclass
class Run:
    run_id: str
    run_ts: str
    sources: dict[str, Source]
    encoder: Encoder | None = None
    geocoder: Geocoder | None = None
    cache: DataFrame | None = None
    model: Model | None = None
    most_enriched: int = 200
    pace: Pace = Pace()
    dry_run: bool = False
    policy: str = "hard"
    most_missed: int = 2
    reports: dict[str, quality.Report] = field(default_factory=dict)


def bronze(lake: Lake, run: Run) -> dict[str, DataFrame]:
    """Raw rows by source as bronze has them: a source is asked once, written, and read back with its schema.

    A source that fails leaves a note and no rows, the others go on. DQ-1 compares payloads and manifest.
    """
    frames, lines, manifest = {}, {}, BronzeManifest(run.run_id, run.run_ts)
    for name, source in run.sources.items():
        try:
            df = source(lake.spark)
            entry = lake.write_bronze(df, name, run.run_id, run.run_ts)
            told = line_counts(read_jsonl(lake.spark, entry.payload_path)).first()
            lines[name] = (told.total, told.parseable)
            frames[name] = lake.spark.read.schema(df.schema).json(entry.payload_path)
        except Exception as e:  # noqa: BLE001  whatever a source raises concerns that source alone
            entry = BronzeEntry(name, None, run.run_ts, notes=f"{type(e).__name__}: {e}"[:300])
        manifest.sources.append(entry)
    lake.write_manifest(manifest)
    run.reports["bronze"] = quality.check_bronze(lines, {e.name: e.row_count_estimate for e in manifest.sources}, SOURCES)
    return frames


def _geocoded(lake: Lake, run: Run, rows: DataFrame) -> DataFrame:
    """Rows with coordinates; answers, cache and rejected rows are written, the next run begins with this run's cache.

    A run that is started again under its id asks for the addresses that have no coordinates yet.
    """

    before = lake.previous("silver", "geocode_cache", run.run_id)
    known = run.cache if run.cache is not None else lake.read("silver", "geocode_cache", before) if before else lake.spark.createDataFrame([], "address string, lat double, lng double")
    out, cache, rejected = geocode(rows, known, run.geocoder, pace=run.pace, path=lake.dataset("silver", "geocode_answers", run.run_id))
    lake.write(cache, "silver", "geocode_cache", run.run_id)
    lake.write(rejected, "silver", "geocode_rejected", run.run_id)
    return out


def silver(lake: Lake, run: Run, frames: dict[str, DataFrame]) -> DataFrame:
    rows = normalize_all(run.run_ts, **frames)
    if run.cache is not None or run.geocoder is not None:
        # Written first: the addresses that the provider is asked for and the rows come from one evaluation.
        lake.write(rows, "silver", "normalized", run.run_id)
        rows = _geocoded(lake, run, lake.read("silver", "normalized", run.run_id, rows.schema))
    path = lake.write(conform(in_order(rows), SILVER), "silver", "eventos_estandar", run.run_id)
    df = lake.read("silver", "eventos_estandar", run.run_id, SILVER)
    before = lake.previous("silver", "eventos_estandar", run.run_id)
    report = quality.check_silver(df, previous=lake.manifest("silver", before)["sources"] if before else None)
    run.reports["silver"] = report
    export(lake, run, df)
    lake.write_manifest(SilverManifest(run.run_id, run.run_ts, path, report.metrics["rows"], {k: v for k, v in report.metrics.get("sources", {}).items() if k}, {"verdict": report.verdict}))
    return df


def export(lake: Lake, run: Run, df: DataFrame) -> None:
    """SNK-6: the rows as CSV (UTF-8 with a byte-order mark) and JSON lines, their counts, and the run's snapshot of the CSV.

    The latest run's CSV is replaced with every run, snapshots stay.
    """
    folder, latest = lake.dataset("silver", "export", run.run_id), f"{lake.root}/silver/export/latest"
    flat = df.withColumn("tags", F.array_join("tags", ", ")) if "tags" in df.columns else df
    flat = flat.withColumnRenamed(flat.columns[0], f"\ufeff{flat.columns[0]}")
    for path in (f"{folder}/csv", f"{latest}/csv"):
        flat.write.mode("overwrite").csv(path, header=True, escape='"')
    df.write.mode("overwrite").json(f"{folder}/json", ignoreNullFields=False)
    stats(df).write.mode("overwrite").json(f"{folder}/stats")


def validate_export(lake: Lake, run_id: str, expected: tuple[str, ...] = ()) -> quality.Report:
    """DQ-5 over a run's exported files and the stats of that run and the one before."""
    spark, folder = lake.spark, lake.dataset("silver", "export", run_id)
    csv = spark.read.csv(f"{folder}/csv", header=True, escape='"', multiLine=True) if lake.exists(f"{folder}/csv") else None
    json_ = spark.read.json(f"{folder}/json") if lake.exists(f"{folder}/json") else None
    stats_of = lambda r: spark.read.schema("column string, value string, n long").json(f"{lake.dataset('silver', 'export', r)}/stats")
    before = lake.previous("silver", "export", run_id)
    return quality.check_export(csv, json_, stats_of(run_id), stats_of(before) if before else None, expected=expected)


def validate_embeddings(lake: Lake, run_id: str, encoder: Encoder | None = None) -> quality.Report:
    """DQ-6 over a run's vectors, metadata and contract; rows are asked for by the text that tells equal titles apart."""
    told = json.loads(lake.read_text(f"{lake.root}/gold/_contract_{run_id}.json"))
    meta, vectors = lake.read("gold", "metadata", run_id), lake.read("gold", "vectors", run_id)
    queries = own_queries(_texts_for_queries(meta), encoder, query=query_text()) if encoder else None
    return quality.check_embeddings(vectors, meta, told, queries=queries)


def _texts_for_queries(meta: DataFrame) -> DataFrame:
    lacking = [c for c in ("hora_inicio", "categoria_google", "distrito") if c not in meta.columns]
    return meta.withColumns({c: F.lit(None).cast("string") for c in lacking})


def own_queries(df: DataFrame, encoder: Encoder, sample: int = 300, query: Column | None = None) -> DataFrame:
    """VEC-7: (query_id, embedding) of a seeded sample of the rows with a title, each asked for by its title.

    ``query``: another text, as :func:`~lakecraft.operators.vectors.query_text`, which tells equal titles apart.
    """
    asked = df.where(missing_to_null("titulo").isNotNull()).withColumn("query", F.col("titulo") if query is None else query)
    asked = hash_sample(asked.select("entity_id", "query"), "entity_id", sample)
    return embed(asked, encoder, text="query").select(F.col("entity_id").alias("query_id"), "embedding")


def contract(lake: Lake, run: Run, encoder: Encoder) -> str:
    """SNK-8: what the vectors of a run are, beside them."""
    told = {"run_id": run.run_id, "embedding_model": encoder.name, "embedding_dim": encoder.dimension, "embedding_similarity": "cosine", "normalize_embeddings": True, "generated_at_utc": run.run_ts}
    path = f"{lake.root}/gold/_contract_{run.run_id}.json"
    lake.write_text(path, json.dumps(told, ensure_ascii=False))
    return path


def gold(lake: Lake, run: Run, df: DataFrame) -> DataFrame | None:
    """Catalog, vectors, metadata, export and the serving states, of which the catalog's is returned; a rehearsal writes no state."""
    if run.model is not None:
        told = enrich(df, run.model, most=run.most_enriched, pace=run.pace, path=lake.dataset("gold", "model_answers", run.run_id))
        lake.write(told, "gold", "enriched", run.run_id)
        df = lake.read("gold", "enriched", run.run_id, df.schema)
    catalog = lake.write(conform(df, GOLD_CATALOG), "gold", "catalog_eventos", run.run_id)
    manifest = GoldManifest(run.run_id, run.run_ts, catalog, lake.read("gold", "catalog_eventos", run.run_id).count())
    vectors, queries = None, None
    if run.encoder is not None:
        manifest.vectors_path = lake.write(conform(embed(df, run.encoder), GOLD_VECTORS), "gold", "vectors", run.run_id)
        lake.write(metadata(df), "gold", "metadata", run.run_id)
        contract(lake, run, run.encoder)
        vectors, queries = lake.read("gold", "vectors", run.run_id), own_queries(df, run.encoder)
        manifest.vector_count, manifest.model_name, manifest.embedding_dim = vectors.count(), run.encoder.name, run.encoder.dimension
        if manifest.vector_count != manifest.catalog_count:
            raise ValueError(f"{manifest.vector_count} vectors for {manifest.catalog_count} rows")
    run.reports["gold"] = quality.check_gold(vectors, declared=manifest.vector_count, declared_dimension=manifest.embedding_dim, dimension=manifest.embedding_dim, queries=queries)
    poi_catalog(df, vectors).write.mode("overwrite").json(f"{lake.dataset('gold', 'poi_catalog', run.run_id)}")
    lake.write_manifest(manifest)
    if run.dry_run:
        return None
    full = lifecycle.is_full_run(list(run.sources), SOURCES, run.dry_run)
    rules = {"full_run": full, "policy": run.policy, "most_missed": run.most_missed}
    served = serving(lake, "catalog")
    served.apply(documents_of(df).drop("fecha_run", "scraped_at"), run.run_id, lambda old, new: lifecycle.step(old, new, run.run_id, run.run_ts, **rules), full_run=full)
    if vectors is not None:
        serving(lake, "vectors").apply(vectors, run.run_id, lambda old, new: lifecycle.vector_step(old, new, df, run.run_id, run.run_ts, **rules), full_run=full)
    return served.read()


def serving(lake: Lake, name: str) -> BucketStore:
    """SNK-10, SNK-11: the state that is served, ``catalog`` or ``vectors``; a run rewrites the buckets that it meets."""
    return BucketStore(lake.spark, f"{lake.root}/serving/{name}")


def run_all(lake: Lake, run: Run, stage: str = "all") -> DataFrame | None:
    """``stage``: all, or up to bronze or silver."""
    frames = bronze(lake, run)
    if stage == "bronze":
        return None
    df = silver(lake, run, frames)
    if stage == "silver" or not df.take(1):
        return df
    return gold(lake, run, df)


def stats(df: DataFrame) -> DataFrame:
    """SNK-6: the four independent value counts in one pass."""
    keys = ["entity_type", "fuente", "tipo", "precio"]
    sets = df.groupingSets([[F.col(k)] for k in keys], *keys).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    name = F.element_at(F.array(*map(F.lit, keys)), F.array_position(F.array(*[F.lit(15 - (1 << (3 - i))) for i in range(4)]), F.col("g").cast("int")).cast("int"))
    return sets.select(name.alias("column"), F.coalesce(*keys).alias("value"), "n").where("value is not null")
