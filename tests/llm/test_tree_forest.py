import math

import numpy as np
import pytest

from lakecraft.llm.treeforest import near_duplicate_embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node long, ball string, n_links int"


def brute(rows, threshold=0.93):
    """All pairs of rows, then labels handed along the links until nothing changes."""
    x, usable = [], []
    for k, (_, vector, label, *_) in enumerate(rows):
        v = np.array([np.nan if c is None else c for c in vector or [0.0]], np.float32).astype(np.float64)
        if label is not None and v.size and np.isfinite(v).all() and v.any():
            usable.append(k)
        x.append(v)
    links = {k: set() for k in range(len(rows))}
    groups = {}
    for k in usable:
        groups.setdefault((rows[k][2], len(x[k])), []).append(k)
    for ks in groups.values():
        u = np.stack([x[k] / np.abs(x[k]).max() for k in ks])
        u /= np.linalg.norm(u, axis=1)[:, None]
        for a, b in zip(*np.nonzero(u @ u.T >= threshold), strict=True):
            if a != b:
                links[ks[a]].add(ks[b])
    ids = [math.inf if r[0] is None else r[0] for r in rows]
    low, moved = list(ids), True
    while moved:
        new = [min([low[k], *(low[j] for j in links[k])]) for k in links]
        moved, low = new != low, new
    return sorted(((r[0], len(links[k]), None if low[k] == math.inf else low[k], r[0] == (None if low[k] == math.inf else low[k])) for k, r in enumerate(rows)), key=str)


def rows_of(spark, rows, **sizes):
    got = near_duplicate_embeddings(spark.createDataFrame(rows, SCHEMA), **sizes).collect()
    return sorted(map(tuple, got), key=str)


def near(base, cosine, rng):
    """A vector at just this cosine from a unit vector."""
    r = rng.normal(size=len(base))
    r -= (r @ base) * base
    return cosine * base + math.sqrt(1 - cosine * cosine) * r / np.linalg.norm(r)


def planted(n, d, pairs, crowd, seed=0):
    """Random unit vectors, pairs just above the threshold, and a crowd of near copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(pairs):
        x[2 * k + 1] = near(x[2 * k], 0.9301 + 0.01 * rng.random(), rng)
    for k in range(crowd):
        x[n - 1 - k] = near(x[n - crowd - 1], 0.99 + 0.009 * rng.random(), rng)
    order = rng.permutation(n)
    return [(int(order[k]), x[k].tolist(), 1, k, "clash", -1) for k in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, 1, 0, "", 0), (2, [0.0, 0.0], 1, 0, "", 0), (3, [math.nan, 1.0], 1, 0, "", 0), (4, [None, 1.0], 1, 0, "", 0), (5, [math.inf, 1.0], 1, 0, "", 0), (6, [1.0, 1.0], None, 0, "", 0), (7, [], 1, 0, "", 0), (8, [1e38, 1e38], 1, 0, "", 0), (9, [1e-38, 1e-38], 1, 0, "", 0)],
        [(None, [1.0, 0.0], 1, 0, "", 0), (None, [1.0, 0.01], 1, 0, "", 0), (None, [0.0, 1.0], 1, 0, "", 0), (4, [0.0, 1.0], 1, 0, "", 0), (4, [0.0, 1.0], 1, 0, "", 0), (3, [0.0, 1.0, 0.0], 1, 0, "", 0), (2, [0.0, 1.0], 2, 0, "", 0)],
        [(i, [1.0, i / 40], i % 2, 0, "", 0) for i in range(80)],  # chains
    ],
)
def test_against_brute_force(spark, rows):
    assert rows_of(spark, rows) == brute(rows)


@pytest.mark.parametrize("sizes", [{"leaf": 128, "sample": 400, "block": 64}, {"leaf": 200, "sample": 2000, "block": 2048}])
def test_forest_against_brute_force(spark, sizes):
    rows = planted(1500, 32, 250, 500)
    rows += [(5000 + i, rows[7][1], 1, 0, "", 0) for i in range(300)] + rows[:40]  # copies, and rows repeated whole
    got, want = rows_of(spark, rows, **sizes), brute(rows)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= all_
    assert found >= 0.999 * all_
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.99 * len(want)


def test_recall_at_the_threshold(spark):
    """Pairs alone at the threshold itself, in a forest several rounds deep."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(3000):
        x[2 * k + 1] = near(x[2 * k], 0.93005, rng)
    rows = [(k, x[k].tolist(), 1, 0, "", 0) for k in range(6000)]
    got = rows_of(spark, rows, leaf=64, sample=256)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in brute(rows))


def test_crowd_beyond_one_ball(spark):
    """Rows of one crowd too wide for a ball: leaves that no split divides, compared block against block."""
    rng = np.random.default_rng(4)
    base = np.eye(16)[0]
    rows = [(k, near(base, 0.955 + 0.02 * rng.random(), rng).tolist(), 1, 0, "", 0) for k in range(700)]
    got, want = rows_of(spark, rows, leaf=100, sample=700, block=90), brute(rows)
    assert all(a[1] <= b[1] and a[2:] == b[2:] for a, b in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.999 * sum(r[1] for r in want)
