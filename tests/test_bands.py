"""Cells that meet in bands: each row is sent once for each band, not once for each cell, and nothing is lost."""

import numpy as np
import pytest

from lakecraft.operators import pruning, quality, vectors
from lakecraft.plans.queries import QUERIES

N = 700


@pytest.fixture
def random(spark, monkeypatch):
    """Vectors of which bounds tell nothing, with copies, in bands of 90; a tile of two cells is an error."""
    monkeypatch.setattr(pruning, "LEAST_BAND", 90)
    x = np.random.default_rng(5).normal(size=(N, 8))
    x[650:] = x[3]
    return x, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "entity_id int, embedding array<double>")


def no_tiles(*_):
    raise AssertionError("one tile for each pair of cells")


def test_nearest_other_in_bands(spark, random, monkeypatch):
    x, df = random
    monkeypatch.setattr(pruning, "tiles", no_tiles)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    got = {r.entity_id: r.score for r in vectors.nearest_other(df, block=20).collect()}
    assert sorted(got) == list(range(N)) and max(abs(got[k] - s[k].max()) for k in got) < 1e-9
    twice = vectors.nearest_other(df.where("entity_id < 5").unionByName(df.where("entity_id < 5")), block=20)  # an id is no other row than itself
    want = (x[:5] @ x[:5].T - np.diag([np.inf] * 5)).max(axis=1)
    assert {r.entity_id: round(r.score, 9) for r in twice.collect()} == {k: round(float(v), 9) for k, v in enumerate(want)}


def test_equal_rounded_scores_go_by_id(spark, tmp_path):
    """The SQL's ORDER BY names its output column, the rounded score."""
    rows = [(0, [1.0, 0.0], 1)] + [(k, [0.5 + k * 1e-7, 0.5], 1) for k in range(1, 31)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [r.vec_id for r in QUERIES["q_topk"](spark, str(tmp_path)).collect()] == list(range(10))
    assert [r.vec_id for r in QUERIES["q_topk_prefiltered"](spark, str(tmp_path)).collect()] == list(range(30))


def test_pairs_in_bands(spark, random, monkeypatch):
    x, df = random
    monkeypatch.setattr(pruning, "tiles", no_tiles)
    s = x @ x.T
    want = {(int(i), int(j)) for i, j in np.argwhere(np.triu(s >= 9.0, 1))}
    got = vectors.near_duplicate_pairs(df, 9.0, block=20).collect()
    assert len(got) == len(want) and {(r.id_a, r.id_b) for r in got} == want
    placed = vectors.cell_pairs(df, 9.0, block=20)[0]
    cells = pruning.Cells.of(placed, int(placed.agg({"cell": "max"}).first()[0]) + 1)
    bands = pruning.Bands.cut(cells, 20)
    sent, tiles = pruning.band_tiles(placed, bands, "entity_id", np.ones((len(cells.n),) * 2, bool))
    b = len(bands.cells)
    assert tiles == b * (b + 1) // 2 and sent.count() == N * b and (cells.n > 0).sum() > 5 * b


def test_check_gold_in_bands(spark, random, monkeypatch):
    x, df = random
    monkeypatch.setattr(pruning, "tiles", no_tiles)
    s = x @ x.T
    m = quality.check_gold(df, declared=N, dimension=8, theta=9.0).metrics
    assert m["near_duplicates"] == int(np.triu(s >= 9.0, 1).sum())
    np.fill_diagonal(s, -np.inf)
    assert abs(m["top1_mean"] - s.max(axis=1).mean()) < 1e-9


def test_top_k_takes_two_rounds(spark, random):
    x, df = random
    found, report = vectors.top_k_by_bounds(df, df.withColumnRenamed("entity_id", "query_id"), 3, block=20)
    s = np.round(x @ x.T, 9)
    got = {(r.query_id, r["rank"]): r.entity_id for r in found.collect()}
    assert got == {(q, k + 1): int(c) for q in range(N) for k, c in enumerate(np.lexsort((np.arange(N), -s[q]))[:3])}
    assert report.count() == 2


def test_first_pairs_in_bands(spark, random, monkeypatch):
    x, df = random
    monkeypatch.setattr(pruning, "tiles", no_tiles)
    s = x @ x.T
    want = sorted((int(i), int(j)) for i, j in np.argwhere(np.triu(s >= 9.0, 1)))[:7]
    assert [(r.id_a, r.id_b) for r in vectors.first_pairs(df, 9.0, 7, block=20).collect()] == want


@pytest.mark.parametrize("theta", [9.0, -30.0])
def test_counts_in_bands(spark, random, monkeypatch, theta):
    x, df = random
    monkeypatch.setattr(pruning, "tiles", no_tiles)
    want = int(np.triu(x @ x.T >= theta, 1).sum())
    assert vectors.near_duplicate_count(df, theta, block=20).first().pairs == want
