import pytest
from pyspark.sql import functions as F

from lakecraft.operators import lifecycle
from lakecraft.sources.serving import BucketStore


def step_of(run_id, full_run=False, most_missed=2):
    return lambda old, new: lifecycle.step(old, new, run_id, f"2026-01-0{run_id[-1]}", full_run=full_run, most_missed=most_missed)


def files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def rows(spark, ids, value):
    return spark.createDataFrame([(f"e{i}", value) for i in ids], "entity_id string, titulo string")


def test_a_small_batch_rewrites_the_buckets_that_it_meets(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/state", buckets=64)
    assert store.read() is None and store.run_id() is None
    first = store.apply(rows(spark, range(500), "a"), "r1", step_of("r1"))
    assert len(first.buckets) > 60 and store.read().count() == 500
    before = files(tmp_path)
    batch = rows(spark, [3, 4, 1000], "b")
    told = store.apply(batch, "r2", step_of("r2"))
    assert len(told.buckets) <= 3 and told.of == 64
    new = set(files(tmp_path)) - set(before)
    assert 1 <= len(new) <= 3 and all(files(tmp_path)[p] == t for p, t in before.items())
    # The same as a step over the whole state.
    whole = lifecycle.step(lifecycle.step(None, rows(spark, range(500), "a"), "r1", "2026-01-01", full_run=False), batch, "r2", "2026-01-02", full_run=False)
    columns = [c for c in whole.columns if c != "change"]
    assert sorted(map(str, store.read().select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
    assert {r.entity_id: r.change for r in told.rows.where("last_seen_run_id = 'r2'").collect()} == {"e3": "modified", "e4": "modified", "e1000": "inserted"}
    assert BucketStore(spark, f"file://{tmp_path}/state", buckets=7).buckets == 64  # what the first run fixed


def test_a_run_that_dies_leaves_the_state_before(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/state", buckets=8)
    store.apply(rows(spark, range(50), "a"), "r1", step_of("r1"))
    seen = sorted(map(str, store.read().collect()))

    def dies(old, new):
        return step_of("r2")(old, new).withColumn("titulo", F.when(F.col("entity_id") == "e7", F.raise_error(F.lit("killed"))).otherwise(F.col("titulo")))

    with pytest.raises(Exception, match="killed"):
        store.apply(rows(spark, range(30), "b"), "r2", dies)
    assert store.run_id() == "r1" and sorted(map(str, store.read().collect())) == seen
    store.apply(rows(spark, range(30), "b"), "r3", step_of("r3"))
    assert store.read().where("titulo = 'b'").count() == 30
    assert not any("r3" in g for g in store.purge())
    assert store.read().count() == 50


def test_a_full_run_ages_all_buckets(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/state", buckets=8)
    store.apply(rows(spark, range(50), "a"), "r1", step_of("r1", True), full_run=True)
    store.apply(rows(spark, [1], "b"), "r2", step_of("r2", True), full_run=True)
    assert store.read().where("is_active").count() == 1 and store.read().count() == 50
    store.apply(rows(spark, [1], "b"), "r3", step_of("r3", True), full_run=True)
    assert [r.entity_id for r in store.read().collect()] == ["e1"]
    store.apply(rows(spark, [], "b"), "r4", step_of("r4", True, 1), full_run=True)
    assert store.read().count() == 0 and store.run_id() == "r4"
    store.apply(rows(spark, [5], "c").withColumn("extra", F.lit(1)).unionByName(spark.createDataFrame([(None, "x", 2)], "entity_id string, titulo string, extra int")), "r5", step_of("r5"))
    assert [(r.entity_id, r.extra) for r in store.read().collect()] == [("e5", 1)]
