from pyspark.sql import functions as F

from lakecraft.operators import quality
from lakecraft.operators.dedup import in_order
from lakecraft.operators.vectors import HashingEncoder
from lakecraft.plans import pipeline
from lakecraft.sources.lake import Lake


def exported(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, entity_type string, titulo string, fuente string, texto_embedding string, url_origen string")


def test_export_verdicts(spark):
    rows = [(str(k), "event", f"t{k}", "bnp" if k < 8 else "mali", "x", "u") for k in range(10)]
    csv = exported(spark, rows)
    marked = csv.withColumnRenamed("entity_id", "﻿entity_id")
    stats = spark.createDataFrame([("fuente", "bnp", 8), ("fuente", "mali", 2)], "column string, value string, n long")
    check = quality.check_export
    assert check(marked, csv, stats, expected=("bnp", "mali")).verdict == "PASS"
    assert check(None, csv, stats).verdict == check(csv, csv.where("false"), stats).verdict == check(csv.drop("url_origen"), csv, stats).verdict == "FAIL"
    assert check(exported(spark, rows + rows[:1]), csv, stats).verdict == "FAIL"
    assert check(csv, csv, stats, expected=("joinnus",)).warnings == ["no rows of joinnus"]
    assert check(csv.withColumn("titulo", F.when(F.col("entity_id") < "5", F.col("titulo"))), csv, stats).verdict == "WARN"
    before = spark.createDataFrame([("fuente", "bnp", 9), ("fuente", "mali", 7), ("tipo", "bnp", 900)], "column string, value string, n long")
    told = check(csv, csv, stats, before)
    assert told.metrics["drops"] == {"bnp": 0.1111, "mali": 0.7143} and told.warnings == ["mali fell from 7 to 2"]


def test_embedding_verdicts(spark):
    df = spark.createDataFrame([(str(k), [1.0, 0.0] if k < 2 else [0.0, 1.0]) for k in range(3)], "entity_id string, embedding array<float>")
    meta = spark.createDataFrame([(str(k), f"t{k}", "bnp") for k in range(3)], "entity_id string, titulo string, fuente string")
    check = quality.check_embeddings
    told = check(df, meta, {"embedding_dim": 2})
    assert told.verdict == "PASS" and told.metrics["near_duplicates"] == 1
    assert [(e["id_a"], e["titulo_b"]) for e in told.metrics["examples"]] == [("0", "t1")]
    assert check(df, meta, {"embedding_dim": 3}).verdict == check(df, meta.limit(2), {}).verdict == check(df.where("false"), meta, {}).verdict == "FAIL"
    assert check(df.withColumn("embedding", F.expr("array(float('nan'), float(1))")), meta, {}).verdict == "FAIL"
    assert check(df.withColumn("embedding", F.transform("embedding", lambda x: (x * 2).cast("float"))), meta, {}).verdict == "WARN"


def test_gold_verdicts(spark):
    df = spark.createDataFrame([("1", [1.0, 0.0]), ("2", [0.0, 1.0])], "entity_id string, embedding array<float>")
    check = lambda v, **more: quality.check_gold(v, declared=2, dimension=2, **more).verdict
    assert check(df) == "PASS" and check(df.where("false")) == check(None) == "FAIL" and quality.check_gold(None, declared=0).verdict == "WARN"
    assert check(df, declared_dimension=3) == "WARN" and check(df.withColumn("schema_version", F.lit("0"))) == "WARN"
    silver = quality.check_silver(spark.createDataFrame([("1", "0")], "entity_id string, schema_version string"), required=("entity_id",), critical=(), expected=())
    assert silver.verdict == "WARN"


def test_validators_over_a_run(spark, tmp_path):
    def source(session):
        return session.createDataFrame([(f"https://b.example/{k}", f"Taller {k}", 'con "comas", y\nsaltos') for k in range(6)], "url string, titulo string, descripcion string")

    lake = Lake(spark, f"file://{tmp_path}/lake")
    run = pipeline.Run("20260425_052340", "2026-04-25 05:23:46", {"bnp": source}, encoder=HashingEncoder())
    pipeline.run_all(lake, run)
    told = pipeline.validate_export(lake, run.run_id, ("bnp",))
    assert told.verdict == "PASS" and told.metrics["rows"] == 6
    first = next((tmp_path / "lake/silver/export/latest/csv").glob("part-*")).read_bytes()
    assert first.startswith(b"\xef\xbb\xbfentity_id,")
    report = pipeline.validate_embeddings(lake, run.run_id, HashingEncoder())
    assert not report.failures and report.metrics["dimension"] == 384 and report.metrics["recall_at_k"] is not None


def test_final_order(spark):
    """SRT-1: by first day, rows without one last, equal days by id."""
    rows = spark.createDataFrame([("c", None), ("b", "2026-02-01"), ("a", None), ("d", "2026-01-01"), ("a2", "2026-02-01")], "entity_id string, fecha_inicio string").repartition(3)
    assert [r.entity_id for r in in_order(rows).collect()] == ["d", "a2", "b", "a", "c"]
