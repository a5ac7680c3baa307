import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.operators import pruning, vectors


def clustered(n, d, groups, seed=0, spread=0.03):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1)[:, None]


def frame(spark, x):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "entity_id int, embedding array<double>")


def pairs_of(x, theta):
    s = x @ x.T
    i, j = np.nonzero(np.triu(s >= theta, 1))
    return {(int(a), int(b)) for a, b in zip(i, j, strict=True)}


def test_cells_that_cannot_matter_are_not_formed(spark):
    x = clustered(1200, 24, 12)
    df = frame(spark, x)
    got = vectors.near_duplicate_pairs(df, 0.95, block=100).collect()
    assert {(r.id_a, r.id_b) for r in got} == pairs_of(x, 0.95)
    assert all(abs(r.score - x[r.id_a] @ x[r.id_b]) < 1e-12 for r in got)
    _, pairs = vectors.cell_pairs(df, 0.95, block=100)
    report = {r.kind: r for r in vectors.pair_report(pairs).collect()}
    assert report["skipped"].row_share > 0.8 and abs(sum(r.row_share for r in report.values()) - 1) < 1e-9
    count = vectors.near_duplicate_count(df, 0.95, block=100).first()
    assert count.pairs == len(got)


def test_equal_vectors_are_counted(spark):
    """3,000 equal vectors, 600 nearly so: counted without their four million pairs as rows."""
    x = np.concatenate((np.tile(np.eye(8)[0], (3000, 1)), clustered(600, 8, 1, spread=0.001), clustered(50, 8, 50, spread=0)))
    df = frame(spark, x)
    s = x @ x.T
    want = int((np.triu(s >= 0.9, 1)).sum())
    assert vectors.near_duplicate_count(df, 0.9, block=64).first().pairs == want
    placed, pairs = vectors.cell_pairs(df, 0.9, block=64, collapse=True)
    assert placed.count() <= 651
    whole = pairs.where("kind = 'whole'").agg(F.sum("n")).first()[0]
    assert whole > 0.5 * 600 * 599 / 2


@pytest.mark.parametrize("block", [40, 5000])
def test_bounds_hold_for_any_vectors(spark, block):
    """Lengths other than one, zero vectors, opposite ones, thresholds of any sign."""
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(size=(150, 5)), np.zeros((3, 5)), -rng.normal(size=(50, 5)) * 3, 1e-6 * rng.normal(size=(20, 5))))
    df = frame(spark, x)
    for theta in (4.0, 0.0, -1.0):
        assert {(r.id_a, r.id_b) for r in vectors.near_duplicate_pairs(df, theta, block=block).collect()} == pairs_of(x, theta)
        assert vectors.near_duplicate_count(df, theta, block=block).first().pairs == len(pairs_of(x, theta))
    pivots = pruning.pivots_of(df, "entity_id", len(x), block)
    placed = pruning.in_cells(df, pivots, "cells")
    cells = pruning.Cells.of(placed, len(pivots))
    least, most = pruning.bounds(pivots, cells, cells)
    cell = np.array([r.cell for r in placed.orderBy("entity_id").collect()])
    s = x @ x.T
    assert (s <= most[cell][:, cell]).all() and (s >= least[cell][:, cell]).all()


@pytest.mark.parametrize("without_self", [False, True])
def test_top_k_by_bounds(spark, without_self):
    x = clustered(900, 24, 9, seed=3)
    x[600:640] = x[600]  # ties
    df = frame(spark, x)
    asked = df.where("entity_id % 3 = 0").withColumnRenamed("entity_id", "query_id")
    found, report = vectors.top_k_by_bounds(df, asked, 4, block=60, without_self=without_self)
    s = x @ x.T
    for r in found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "entity_id", "score"))).alias("l")).collect():
        own = [(-s[r.query_id, k], k) for k in range(900) if not (without_self and k == r.query_id)]
        own = sorted((round(a, 12), b) for a, b in own)[:4]
        assert [(round(-e.score, 12), e.entity_id) for e in r.l] == own
    told = report.agg(F.sum("products").alias("p"), F.max("whole").alias("w")).first()
    assert found.select("query_id").distinct().count() == 300 and told.p < 0.5 * told.w


def test_few_rows(spark):
    df = frame(spark, np.eye(3)[:1])
    asked = df.withColumnRenamed("entity_id", "query_id")
    assert vectors.top_k_by_bounds(df, asked, 5)[0].select("entity_id", "rank").collect() == [(0, 1)]
    assert vectors.top_k_by_bounds(df, asked, 5, without_self=True)[0].count() == 0
    assert vectors.top_k_by_bounds(df.where("false"), asked, 5)[0].count() == 0
    assert vectors.nearest_other(df).collect() == [(0, None)]
    for empty in (df.where("false"), df.withColumn("embedding", F.lit(None).cast("array<double>"))):
        assert vectors.near_duplicate_pairs(empty).count() == 0 and vectors.near_duplicate_count(empty).first().pairs == 0 and vectors.nearest_other(empty).count() == 0
