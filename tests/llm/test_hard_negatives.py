import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.llm.hardneg import hard_negatives, sliced_products

SCHEMA = "vec_id long, embedding array<float>, label int, width int, r int, positive_score string"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    """All anchors against all rows."""
    known = {}
    for id, vector, label, *_ in rows:
        if id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        x = [math.floor(256 * float(np.float32(v))) for v in vector]
        if all(abs(256 * v) < 1 << 24 for v in vector):
            known[id] = min(known.get(id, (str(label), x)), (str(label), x))
    out = []
    for a, (kind, x) in known.items():
        if a % 50:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), b, other) for b, (other, y) in known.items() if b != a and len(y) == len(x))
        for p, b, _ in [s for s in scores if s[2] == kind][:positives]:
            fits = [s for s in scores if s[2] != kind and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(a, b, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fits)]
    return sorted(out)


def vectors(n, d=8, labels=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, x[i].tolist(), int(rng.integers(labels)), 1, 2, "clash") for i in range(n)]


def crowd(n):
    """A third of all rows nearly the same vector, with several labels; many equal scores."""
    rows = vectors(n, d=4, seed=2)
    base = rows[1][1]
    return [(i, [*base[:3], base[3] + (i % 3) / 512] if i % 3 == 1 else v, k, *rest) for i, v, k, *rest in rows]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(0, [1.0, 0.0], 1, 1, 1, ""), (50, None, 1, 1, 1, ""), (None, [1.0, 0.0], 1, 1, 1, ""), (3, [1.0, None], 1, 1, 1, ""), (4, [math.nan, 1.0], 1, 1, 1, ""), (5, [math.inf, 1.0], 2, 1, 1, ""), (6, [1.0, 0.5], None, 1, 1, "")],
        [(0, [], 1, 1, 1, ""), (1, [], 1, 1, 1, ""), (2, [], 2, 1, 1, ""), (50, [1.0], 1, 1, 1, ""), (51, [2.0], 1, 1, 1, ""), (52, [1.0], 2, 1, 1, ""), (53, [60_000.0], 1, 1, 1, ""), (54, [1e30], 1, 1, 1, "")],
        [(0, [1.0, 1.0], 1, 1, 1, "")] * 3 + [(i, [1.0, i % 2 / 2], i % 3, 1, 1, "") for i in range(1, 60)],  # repeated rows, ties
        vectors(400),
        crowd(300),
    ],
)
@pytest.mark.parametrize("sizes", [{}, {"row_block": 40, "anchor_block": 2, "step": 7}])
def test_against_brute_force(spark, rows, sizes):
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize(("largest", "width"), [(256, 64), (3, 5), ((1 << 24) - 1, 16), (1, 1), (256, 0)])
def test_products_in_windows(largest, width):
    rng = np.random.default_rng(width)
    rows, anchors = rng.integers(-largest, largest, (300, width)), rng.integers(-largest, largest, (20, width))
    every = rows @ anchors.T
    low, high = (np.quantile(every, q, axis=0).astype(np.int64) for q in (0.8, 0.97))
    none = np.full(20, 1 << 62)
    for a, b in ((low, high), (low, low), (-none, none), (none, -none)):
        want = np.nonzero((every >= a) & (every <= b))
        assert sorted(zip(*sliced_products(rows, anchors, a, b), strict=True)) == sorted(zip(*want, every[want], strict=True))
