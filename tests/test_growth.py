"""What is sent grows with the rows, and screening in single precision loses nothing."""

import numpy as np
import pytest

from lakecraft.operators import pruning, quality, vectors


def frame(spark, x, kind="double"):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"entity_id int, embedding array<{kind}>")


def ordered(x):
    """All products, each summed from the first component on."""
    return sum((np.outer(x[:, k], x[:, k]) for k in range(1, x.shape[1])), np.outer(x[:, 0], x[:, 0]))


@pytest.mark.parametrize("n", [300, 1200])
def test_a_row_is_sent_as_often_in_a_larger_table(spark, monkeypatch, n):
    monkeypatch.setattr(pruning, "LEAST_BAND", 20)
    df = frame(spark, np.random.default_rng(2).normal(size=(n, 8)))
    placed, _ = vectors.cell_pairs(df, 9.0, block=20)
    cells = pruning.Cells.of(placed, int(placed.agg({"cell": "max"}).first()[0]) + 1)
    sent, _ = pruning.band_tiles(placed, pruning.Bands.cut(cells, 20), "entity_id", np.ones((len(cells.n),) * 2, bool))
    assert sent.count() <= 9 * n


@pytest.mark.parametrize(("kind", "scale"), [("float", 1.0), ("double", 1.0), ("double", 1e20), ("double", 1e-20)])
def test_pairs_next_to_the_threshold(spark, kind, scale):
    """Scores that differ from the threshold by less than single precision can tell."""
    x = np.random.default_rng(3).normal(size=(200, 64)) * scale
    x = x.astype(np.float32).astype(np.float64) if kind == "float" else x
    s = ordered(x)
    i, j = np.triu_indices(200, 1)
    theta = float(np.sort(s[i, j])[-500])
    got = {(r.id_a, r.id_b): r.score for r in vectors.near_duplicate_pairs(frame(spark, x, kind), theta, block=50).collect()}
    assert got == {(int(a), int(b)): s[a, b] for a, b in zip(i, j, strict=True) if s[a, b] >= theta} and len(got) == 500


def test_first_pairs_without_all_pairs(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(900, 8))
    s = ordered(x)

    def no_bands(*_):
        raise AssertionError("all rows meet all")

    monkeypatch.setattr(pruning, "band_tiles", no_bands)
    want = [(int(i), int(j)) for i, j in np.argwhere(np.triu(s >= 9.0, 1))][:30]  # by row, then column
    got = vectors.first_pairs(frame(spark, x), 9.0, 30, block=200).collect()
    assert [(r.id_a, r.id_b) for r in got] == want and [r.score for r in got] == [s[p] for p in want]


@pytest.mark.parametrize("head", [1, 3, 40])
def test_first_pairs_behind_the_head(spark, head):
    """Few pairs, rows without an id or a vector, two rows of one id."""
    x = np.random.default_rng(5).normal(size=(60, 8))
    ids = [*range(57), 2, 2, None]
    s = ordered(x)
    rows = [(k, v.tolist()) for k, v in zip(ids, x, strict=True)] + [(5, None)]
    want = sorted((ids[i], ids[j], s[i, j]) for i, j in np.argwhere(s >= 5.0) if ids[i] is not None and ids[j] is not None and ids[i] < ids[j])
    got = vectors.first_pairs(spark.createDataFrame(rows, "entity_id int, embedding array<double>"), 5.0, 1000, block=20, head=head).collect()
    assert 3 < len(want) < 1000 and sorted(tuple(r) for r in got) == want and [r.id_a for r in got] == [w[0] for w in want]


def test_recall_of_many_queries_counts_ranks(spark, monkeypatch):
    """More queries than are collected: no cell is sent to each cell that it meets, no ranking is made."""

    def no_tiles(*_):
        raise AssertionError("one tile for each pair of cells")

    monkeypatch.setattr(pruning, "tiles", no_tiles)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4200, 6)).astype(np.float32).astype(np.float64)
    x[4000:] = x[:200]  # equal scores go by the id
    asked = x + 0.6 * rng.normal(size=x.shape)
    s = sum(np.outer(asked[:, k], x[:, k]) for k in range(6))
    own = np.diag(s)[:, None]
    rank = 1 + (s > own).sum(axis=1) + ((s == own) & (np.arange(4200)[None, :] < np.arange(4200)[:, None])).sum(axis=1)
    queries = frame(spark, asked).withColumnRenamed("entity_id", "query_id")
    for df in (frame(spark, x, "float"), frame(spark, x)):
        got = vectors.self_recall(df, queries, 5).first()
        assert (got.n, round(got.recall_at_1, 9), round(got.recall_at_k, 9)) == (4200, round((rank == 1).mean(), 9), round((rank <= 5).mean(), 9))


def test_ranks_of_own_rows(spark, monkeypatch):
    """Cells that are passed over, a query without a row, one without a vector; the same by either way."""
    monkeypatch.setattr(pruning, "LEAST_BAND", 90)
    x = np.random.default_rng(7).normal(size=(700, 8)) * np.linspace(0.1, 3, 700)[:, None]
    df = frame(spark, x)
    queries = df.withColumnRenamed("entity_id", "query_id").where("query_id % 3 = 0")
    queries = queries.unionByName(spark.createDataFrame([(1000, x[0].tolist()), (1, None)], "query_id int, embedding array<double>"))
    want = {r.query_id: r["rank"] for r in vectors.top_k(df, queries, 5).where("query_id = entity_id").collect()}
    assert {r.query_id: r["rank"] for r in vectors.own_ranks(df, queries, 5, block=20).collect()} == want and len(want) > 50
    assert vectors.self_recall(df, queries, 5, few=10).collect() == vectors.self_recall(df, queries, 5).collect()


def test_counts_take_the_scores_of_pairs(spark, monkeypatch):
    """A pair whose score is the threshold itself counts, however a matrix product rounds; in as many tiles as in a smaller table."""
    monkeypatch.setattr(pruning, "LEAST_BAND", 20)
    x = np.random.default_rng(8).normal(size=(1200, 64))
    s = ordered(x)
    i, j = np.triu_indices(1200, 1)
    below = np.flatnonzero((x @ x.T)[i, j] < s[i, j])
    theta = float(np.sort(s[i, j][below])[-100])
    tiles, band_tiles = [], pruning.band_tiles
    monkeypatch.setattr(pruning, "band_tiles", lambda *a: tiles.append(band_tiles(*a)) or tiles[-1])
    assert vectors.near_duplicate_count(frame(spark, x), theta, block=20).first().pairs == int((s[i, j] >= theta).sum())
    assert tiles[0][1] <= 9 * 10 // 2


def test_check_gold_in_as_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(pruning, "LEAST_BAND", 20)
    x = np.random.default_rng(9).normal(size=(1200, 8))
    tiles, band_tiles, cut = [], pruning.band_tiles, pruning.Bands.cut
    monkeypatch.setattr(pruning, "band_tiles", lambda *a: tiles.append(band_tiles(*a)) or tiles[-1])
    monkeypatch.setattr(pruning.Bands, "cut", lambda cells, block, *a: cut(cells, 20, *a))
    m = quality.check_gold(frame(spark, x), declared=1200, dimension=8, theta=9.0).metrics
    s = ordered(x)
    assert m["near_duplicates"] == int(np.triu(s >= 9.0, 1).sum())
    np.fill_diagonal(s, -np.inf)
    assert abs(m["top1_mean"] - s.max(axis=1).mean()) < 1e-9
    assert [n <= 9 * 10 // 2 for _, n in tiles] == [True, True]


@pytest.mark.parametrize(("kind", "scale"), [("float", 1.0), ("double", 1.0), ("double", 1e20), ("double", 1e-20)])
def test_nearest_rows_closer_than_single_precision(spark, kind, scale, monkeypatch):
    """Rows that differ by less than single precision can tell, copies, a repeated id; in bands, too."""
    monkeypatch.setattr(pruning, "LEAST_BAND", 60)
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 64))
    x[100:200] = x[:100] * (1 + 1e-9 * rng.normal(size=(100, 1)))
    x[280:] = x[5]
    x = x * scale
    x = x.astype(np.float32).astype(np.float64) if kind == "float" else x
    ids = [*range(299), 7]
    s = ordered(x)
    s[np.equal.outer(ids, ids)] = -np.inf
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in zip(ids, x, strict=True)], f"entity_id int, embedding array<{kind}>")
    want = {k: s[k].max() for k in range(299)}
    want[7] = max(want[7], s[299].max())
    got = {r.entity_id: r.score for r in vectors.nearest_other(rows, block=20).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-12 * abs(want[k]) for k in want)


def test_check_gold_sends_rows_once_for_both(spark, monkeypatch):
    """Near duplicates are looked for among rows whose nearest other is near: not all rows meet all a second time."""
    x = np.random.default_rng(11).normal(size=(900, 8))
    x[890:] = x[:10]  # copies
    x /= np.linalg.norm(x, axis=1)[:, None]
    met, band_tiles = [], pruning.band_tiles
    monkeypatch.setattr(pruning, "band_tiles", lambda rows, *a: met.append(rows.count()) or band_tiles(rows, *a))
    s = ordered(x)
    i, j = np.triu_indices(900, 1)
    theta = float(np.sort(s[i, j])[-40])  # the threshold is a pair's score
    m = quality.check_gold(frame(spark, x), declared=900, dimension=8, theta=theta).metrics
    assert m["near_duplicates"] == int((s[i, j] >= theta).sum()) and m["near_duplicate_ratio"] == m["near_duplicates"] / (900 * 899 / 2)
    assert met[0] == 900 and met[1] <= 80
    assert quality.check_gold(frame(spark, x[:800]), declared=800, dimension=8, theta=1.5).metrics["near_duplicates"] == 0


def test_near_rows_of_repeated_and_missing_ids(spark):
    """Rows of one id are no other rows to each other, yet pairs."""
    x = np.eye(6)[[0, 0, 1, 1, 2, 3, 4, 4, 4]]
    ids = [1, 1, 2, 3, 4, 5, None, None, 6]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in zip(ids, x, strict=True)] + [(9, None)], "entity_id int, embedding array<double>")
    got = vectors.near_duplicate_count(df, 0.9, nearest=vectors.nearest_other(df)).first()
    assert got == vectors.near_duplicate_count(df, 0.9).first() and got.pairs == 5
