import hashlib
from collections import defaultdict

import numpy as np
import pytest

from lakecraft.llm.exactdedup import CountingQuotientFilter, exact_dedup, on_repeated_slots, repeated_fingerprints

SCHEMA = "doc_id long, text string, fingerprint string, keep_id string"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, "x", None), (2, "", None, "y"), (3, "a", None, None)],
        [(1, "a", "", ""), (1, "a", "", ""), (None, "a", "", ""), (None, "b", "", ""), (5, "A", "", ""), (6, "é" * 70_000, "", ""), (7, "é" * 70_000, "", "")],
        [(i, f"t{i % 7}", "", "") for i in range(200)] + [(i, "hot", "", "") for i in range(200, 300)],
    ],
)
def test_against_brute_force(spark, rows):
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA), segment_bits=3, flush=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 400, dtype=np.int64).astype(np.uint64) >> np.uint64(3)
    a, b = np.sort(values[:300]), np.sort(values[100:])
    one = CountingQuotientFilter.of_sorted(a, np.full(300, 200), 0, 0, 10)
    two = CountingQuotientFilter.from_bytes(CountingQuotientFilter.of_sorted(b, np.full(300, 300), 0, 0, 12).to_bytes(), 0, 0)
    merged = one.merged(two)
    want = {int(v): 0 for v in values}
    for v in a:
        want[int(v)] += 200
    for v in b:
        want[int(v)] += 300
    assert dict(zip(map(int, merged.fingerprints()), map(int, merged.counts), strict=True)) == want
    assert (np.diff(merged.fingerprints().astype(object)) > 0).all()


def test_load_near_one_and_lookups():
    """A filter sized by its entries: short runs, bytes an entry as at load one, lookups of what is there and what is not."""
    rng = np.random.default_rng(2)
    for n, segment_bits, segment in ((1, 8, 7), (4096, 8, 3), (50_000, 4, 15)):
        own = rng.integers(0, 1 << (64 - segment_bits - 1), n, dtype=np.int64).astype(np.uint64) * np.uint64(2) | np.uint64(segment) << np.uint64(64 - segment_bits)
        values = np.unique(own)
        filter_ = CountingQuotientFilter.of_sorted(values, np.arange(1, len(values) + 1), segment, segment_bits)
        assert 0.5 <= len(values) / len(filter_.runs) <= 1
        assert filter_.runs.max() <= 12
        raw = filter_.to_bytes()
        remainder = 64 - filter_.quotient_bits
        large = 8 * (filter_.counts >= 255).sum()
        assert len(raw) - large <= len(values) * (remainder / 8 + 1 + 0.125 + 2 * (0.125 + 4 / 64)) + 40
        back = CountingQuotientFilter.from_bytes(raw, segment, segment_bits)
        for k in rng.integers(0, len(values), 200):
            assert back.count_of(int(values[k])) == k + 1
            assert back.count_of(int(values[k]) ^ 1) == 0


def test_no_exchange_of_single_texts(spark):
    """With broadcasts of tables off, texts still meet the repeated fingerprints' slots before any exchange."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"single {i}") for i in range(3000)] + [(5000 + i, "twice") for i in range(2)], "doc_id long, text string")
    rows = docs.withColumn("fingerprint", F.xxhash64("text"))
    repeated = repeated_fingerprints(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        near = on_repeated_slots(rows, repeated)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert 2 <= near.count() <= 20
        assert exact_dedup(docs).where("group_size > 1").count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
