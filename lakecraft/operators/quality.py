"""Quality rules of the layers: one-pass profiles, then verdicts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import missing_to_null
from ..schemas import CRITICAL, DIMENSION, REQUIRED, SOURCES, VERSION
from ..sources.scratch import written
from .dedup import hash_sample
from .vectors import first_pairs, near_duplicate_count, nearest_other, self_recall, vector_profile


@dataclass
class Report:
    """DQ-4: FAIL with a failure, else WARN with a warning, else PASS."""

    metrics: dict = field(default_factory=dict)
    failures: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def verdict(self) -> str:
        return "FAIL" if self.failures else "WARN" if self.warnings else "PASS"

    @property
    def exit_code(self) -> int:
        return int(self.verdict == "FAIL")


def value_counts(df: DataFrame, column: str, nulls: bool = False) -> DataFrame:
    """AGG-1, AGG-2."""
    return (df if nulls else df.where(F.col(column).isNotNull())).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def null_ratios(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-4: one row, all columns in one pass."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """AGG-3: rows less distinct values, so every null counts."""
    return df.agg((F.count(F.lit(1)) - F.countDistinct(column)).alias("duplicates"))


def coverage_drop(previous: DataFrame, current: DataFrame, key: str = "fuente") -> DataFrame:
    """JOIN-6: (key, before, now, drop) for every key of the previous run."""
    now = current.select(key, F.col("n").alias("now"))
    return previous.select(key, F.col("n").alias("before")).join(now, key, "left").na.fill(0, ["now"]).withColumn("drop", F.when(F.col("before") > 0, (F.col("before") - F.col("now")) / F.col("before")).otherwise(0.0))


def missing_sources(df: DataFrame, expected: tuple[str, ...] = SOURCES, column: str = "fuente") -> DataFrame:
    """JOIN-11: expected values that no row has."""
    return df.sparkSession.createDataFrame([(e,) for e in expected], f"{column} string").join(df.select(column).distinct(), column, "left_anti")


def check_bronze(lines: dict[str, tuple[int, int] | None], declared: dict[str, int | None], expected: tuple[str, ...]) -> Report:
    """DQ-1: by source (lines, parseable lines), or None without a payload, and the manifest's row counts."""
    r = Report()
    for source in expected:
        if source not in declared:
            r.warnings.append(f"{source} is not in the manifest")
            continue
        if (got := lines.get(source)) is None:
            r.failures.append(f"{source} has no payload")
            continue
        total, good = got
        if good < total:
            r.warnings.append(f"{source}: {total - good} lines don't parse")
        if declared[source] is not None and declared[source] != total:
            r.warnings.append(f"{source}: {total} lines, the manifest says {declared[source]}")
        r.metrics[source] = total
    return r


def check_silver(df: DataFrame, *, previous: dict[str, int] | None = None, expected: tuple[str, ...] = SOURCES, most_null: float = 0.30, most_drop: float = 0.70, required: tuple[str, ...] = REQUIRED, critical: tuple[str, ...] = CRITICAL) -> Report:
    """DQ-2, DQ-5: version, columns, duplicates, nulls, sources, coverage; one aggregation and one count by source."""
    r = Report()
    if lacking := [c for c in required if c not in df.columns]:
        r.failures.append(f"missing columns: {', '.join(lacking)}")
    there = [c for c in critical if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(F.col(c).isNull().cast("int")).alias(c) for c in there]
    if "entity_id" in df.columns:
        aggs.append((F.count(F.lit(1)) - F.countDistinct("entity_id")).alias("_dup"))
    if "schema_version" in df.columns:
        aggs.append(F.count_if(~F.col("schema_version").eqNullSafe(F.lit(VERSION))).alias("_old"))
    row = df.agg(*aggs).first().asDict()
    r.metrics |= {"rows": row["_n"], "null_ratios": {c: row[c] for c in there}, "duplicates": row.get("_dup")}
    if not row["_n"]:
        r.failures.append("no rows")
        return r
    if row.get("_dup"):
        r.failures.append(f"{row['_dup']} duplicated ids")
    if row.get("_old"):
        r.warnings.append(f"{row['_old']} rows of another schema version")
    r.warnings += [f"{c}: {row[c]:.2f} null" for c in there if row[c] > most_null]
    if "fuente" in df.columns:
        counts = {x[0]: x[1] for x in value_counts(df, "fuente", nulls=True).collect()}
        r.metrics["sources"] = counts
        r.warnings += [f"no rows of {s}" for s in expected if s not in counts]
        for source, before in (previous or {}).items():
            if before > 0 and (before - counts.get(source, 0)) / before >= most_drop:
                r.warnings.append(f"{source} fell from {before} to {counts.get(source, 0)}")
    return r


def check_gold(
    vectors: DataFrame | None,
    *,
    declared: int | None,
    dimension: int = DIMENSION,
    declared_dimension: int | None = None,
    queries: DataFrame | None = None,
    theta: float = 0.95,
    tolerance: float = 1e-3,
    least_unit: float = 0.95,
    least_recall: float = 0.90,
    k: int = 5,
    sample: int = 300,
) -> Report:
    """DQ-3: width, schema version, finite cells, norms, near duplicates, self recall on a seeded sample of queries.

    ``declared``, ``declared_dimension``: what the run's manifest says. Vectors that the manifest says there are none of
    are a warning if they are missing, missing ones and an empty file else are failures.
    """
    r = Report()
    if vectors is None:
        (r.warnings if declared == 0 else r.failures).append("no vectors")
        return r
    p = vector_profile(vectors, dimension, tolerance).first()
    r.metrics |= p.asDict()
    if not p.n:
        r.failures.append("no rows of vectors")
        return r
    if "schema_version" in vectors.columns and vectors.where(~F.col("schema_version").eqNullSafe(F.lit(VERSION))).take(1):
        r.warnings.append("rows of another schema version")
    if p.wrong_dim:
        r.failures.append(f"{p.wrong_dim} vectors have another width than {dimension}")
    elif declared_dimension is not None and declared_dimension != dimension:
        r.warnings.append(f"the manifest says width {declared_dimension}, the vectors have {dimension}")
    if p.finite_ratio is not None and p.finite_ratio < 1:
        r.failures.append(f"{1 - p.finite_ratio:.2%} of cells aren't finite")
    if r.failures:
        return r
    if p.unit_rate < least_unit:
        r.warnings.append(f"{p.unit_rate:.2f} of vectors have unit length")
    nearest = written(nearest_other(vectors), "nearest")
    top = nearest.agg(F.avg("score").alias("mean"), F.median("score").alias("median"), F.percentile("score", 0.95).alias("p95")).first()
    near = near_duplicate_count(vectors, theta, nearest=nearest).first()
    r.metrics |= {"near_duplicates": near.pairs, "near_duplicate_ratio": near.ratio} | {f"top1_{c}": top[c] for c in ("mean", "median", "p95")}
    if queries is not None:
        got = self_recall(vectors, hash_sample(queries, "query_id", sample), k).first()
        r.metrics |= {"recall_at_1": got.recall_at_1, "recall_at_k": got.recall_at_k}
        if got.recall_at_k is not None and got.recall_at_k < least_recall:
            r.warnings.append(f"recall@{k} is {got.recall_at_k:.2f}")
    return r


# The columns that an exported file has to have.
EXPORTED = ("entity_id", "entity_type", "titulo", "fuente", "texto_embedding", "url_origen")


def check_export(csv: DataFrame | None, json: DataFrame | None, stats: DataFrame, previous: DataFrame | None = None, *, expected: tuple[str, ...] = (), most_null: float = 0.30, most_drop: float = 0.70) -> Report:
    """DQ-5: the exported CSV and JSON, and the counts by source of two runs' stats (column, value, n).

    A missing or empty file, a missing column and repeated ids are failures; nulls, sources without rows and a source
    that fell by ``most_drop`` or more are warnings. A value of blanks only in the CSV is null.
    """
    r = Report()
    for name, df in (("CSV", csv), ("JSON", json)):
        if df is None or not df.take(1):
            r.failures.append(f"no rows in the {name}")
    if r.failures:
        return r
    csv = csv.withColumnRenamed(csv.columns[0], csv.columns[0].lstrip("\ufeff"))
    if lacking := [c for c in EXPORTED if c not in csv.columns]:
        r.failures.append(f"missing columns: {', '.join(lacking)}")
        return r
    critical = [c for c in EXPORTED if c in CRITICAL]
    row = csv.agg(F.count(F.lit(1)).alias("_n"), (F.count(F.lit(1)) - F.countDistinct("entity_id")).alias("_dup"), *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in critical]).first().asDict()
    r.metrics |= {"rows": row["_n"], "duplicates": row["_dup"], "null_ratios": {c: row[c] for c in critical}}
    if row["_dup"]:
        r.failures.append(f"{row['_dup']} duplicated ids")
    r.warnings += [f"{c}: {row[c]:.2f} null" for c in critical if row[c] > most_null]
    sources = {x.fuente: x.n for x in value_counts(csv, "fuente", nulls=True).collect()}
    r.metrics["sources"] = sources
    r.warnings += [f"no rows of {s}" for s in expected if not sources.get(s)]
    if previous is not None:
        by_source = lambda df: df.where("column = 'fuente'").select(F.col("value").alias("fuente"), "n")
        drops = coverage_drop(by_source(previous), csv.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"))).where("drop > 0").orderBy("fuente").collect()  # sources
        r.metrics["drops"] = {x.fuente: round(x["drop"], 4) for x in drops}
        r.warnings += [f"{x.fuente} fell from {x.before} to {x.now}" for x in drops if x["drop"] >= most_drop]
    return r


def check_embeddings(vectors: DataFrame, metadata: DataFrame, contract: dict, *, queries: DataFrame | None = None, theta: float = 0.95, tolerance: float = 1e-3, k: int = 5, sample: int = 300, examples: int = 10) -> Report:
    """DQ-6: vectors against their metadata and contract.

    No vectors or unequal widths, another number of metadata rows, cells that are not finite and another width than the
    contract's are failures; too few unit vectors and a low self recall are warnings. Metrics name the first near pairs.
    """
    r = Report()
    width = vectors.agg(F.max(F.size("embedding")).alias("d")).first().d
    p = vector_profile(vectors, width or 0, tolerance).first()
    r.metrics |= p.asDict() | {"dimension": width, "metadata": metadata.count()}
    if not p.n or p.wrong_dim or not width:
        r.failures.append("the vectors have no common width")
        return r
    if r.metrics["metadata"] != p.n:
        r.failures.append(f"{r.metrics['metadata']} rows of metadata for {p.n} vectors")
    if p.finite_ratio < 1:
        r.failures.append(f"{1 - p.finite_ratio:.2%} of cells aren't finite")
    if contract.get("embedding_dim") is not None and int(contract["embedding_dim"]) != width:
        r.failures.append(f"the contract says width {contract['embedding_dim']}, the vectors have {width}")
    if p.unit_rate < 0.95:
        r.warnings.append(f"{p.unit_rate:.2f} of vectors have unit length")
    if p.finite_ratio < 1:
        return r
    near = near_duplicate_count(vectors, theta).first()
    named = metadata.select("entity_id", *[c for c in ("titulo", "fuente") if c in metadata.columns])
    pairs = first_pairs(vectors, theta, examples)
    side = lambda x: named.select(*[F.col(c).alias(f"{c}_{x}") for c in named.columns])
    told = pairs.join(side("a"), F.col("id_a") == F.col("entity_id_a"), "left").join(side("b"), F.col("id_b") == F.col("entity_id_b"), "left").orderBy("id_a", "id_b")
    r.metrics |= {"near_duplicates": near.pairs, "near_duplicate_ratio": near.ratio, "examples": [x.asDict() for x in told.collect()]}  # ``examples`` rows
    if queries is not None:
        got = self_recall(vectors, hash_sample(queries, "query_id", sample), k).first()
        r.metrics |= {"recall_at_1": got.recall_at_1, "recall_at_k": got.recall_at_k}
        if got.recall_at_k is not None and got.recall_at_k < 0.90:
            r.warnings.append(f"recall@{k} is {got.recall_at_k:.2f}")
    return r


def blank_ratio(df: DataFrame, column: str) -> DataFrame:
    """FIL-8: the share of rows whose text is missing."""
    return df.agg(F.avg(missing_to_null(column).isNull().cast("int")).alias("ratio"))
