import random
from collections import Counter

import pytest

from lakecraft.llm import mixing
from lakecraft.llm.mixing import in_mixed_order, mix_sources, one_period, phases


@pytest.mark.parametrize("seed", range(6))
def test_pfair_windows_and_lag(seed):
    rng = random.Random(seed)
    quanta = {f"s{i}": rng.randrange(1, 30) for i in range(rng.randrange(1, 9))}
    period = sum(quanta.values())
    places = one_period(quanta)
    assert sorted(p for v in places.values() for p in v) == list(range(period))
    for s, v in places.items():
        for j, slot in enumerate(v):
            assert j * period // quanta[s] <= slot < -(-(j + 1) * period // quanta[s])
        for t in range(period + 1):
            assert abs(sum(p < t for p in v) - t * quanta[s] / period) < 1


def brute(blocks, quanta):
    """Slot by slot: renewed weights whenever a source runs out."""
    left, order = dict(blocks), []
    while left := {s: n for s, n in left.items() if n}:
        own = {s: quanta[s] for s in left}
        period, places, t = sum(own.values()), one_period(own), 0
        by_slot = {p: s for s, v in places.items() for p in v}
        while all(left.values()):
            s = by_slot[t % period]
            order.append(s)
            left[s] -= 1
            t += 1
    return order


def rows_of(sizes):
    return [(k * 1000 + i, s, "x") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 50, "b": 7, "c": 300}, {"a": 1}, {None: 9, "z": 100}, {}])
def test_against_brute_force(spark, sizes):
    rows = rows_of(sizes)
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, source string, slot string"), block_rows=4, quanta=40).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    blocks = {s or "": -(-n // 4) for s, n in sizes.items()}
    total = sum(n**0.5 for n in sizes.values())
    order = brute(blocks, {s or "": max(1, round(n**0.5 / total * 40)) for s, n in sizes.items()})
    slots = {}
    for r in got:
        assert r.block == r.number // 4
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    assert [slots[t][0] for t in range(len(order))] == order
    for s in blocks:
        assert sorted(r.number for r in got if r.source == s) == list(range(sizes.get(s, sizes.get(None))))


def test_stop_ends_with_the_first_source_that_runs_out():
    plan = phases({"a": 10, "b": 100}, {"a": 1, "b": 1}, "stop")
    assert len(plan) == 1 and plan[0].blocks["a"] == 10


def test_order_of_rows(spark):
    rows = [*rows_of({"a": 30, "b": 90}), (None, None, None), (7000, "a", "again"), (7000, "a", "again")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, row string")
    got = in_mixed_order(frame, partitions=3, block_rows=2).collect()
    assert Counter(map(tuple, got)) == Counter(rows)
    slot = {(r.doc_id, r.source): r.slot for r in mix_sources(frame, block_rows=2).collect()}
    at = [slot[r.doc_id, r.source or ""] for r in got if r.doc_id != 7000]  # its two rows may stand in two blocks
    assert at == sorted(at)


def test_weights_without_a_source_and_rows_without_ids(spark):
    rows = [(None, "a", f"text {i}") for i in range(3000)] + [(i, "b", None) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mix_sources(frame, weights={"elsewhere": 1.0}, quanta=10, block_rows=4).collect()
    assert len(got) == len(rows) and len({(r.source, r.number) for r in got}) == len(rows)
    first = [r.source for r in sorted(got, key=lambda r: (r.slot, r.number)) if r.slot < 20]
    assert first.count("a") == first.count("b"), "no weight for a source that there is: equal shares"


@pytest.mark.parametrize("seed", range(8))
def test_phases_against_brute_force(seed):
    rng = random.Random(seed)
    quanta = {f"s{i}": rng.choice([1, 1, 1, 2, 5, 40]) for i in range(rng.randrange(1, 30))}
    blocks = {s: rng.choice([0, 1, 1, 2, 9, 300]) for s in quanta}
    order = {}
    for p in phases(blocks, quanta):
        for s, n in p.blocks.items():
            for j in range(n):
                turn, nth = divmod(j, len(p.places[s]))
                slot = p.start + turn * p.period + p.places[s][nth]
                assert p.start <= slot < p.start + p.slots and order.setdefault(slot, s) == s
    assert [order[t] for t in range(len(order))] == brute(blocks, quanta)


def test_a_written_schedule_gives_the_same_places(spark, monkeypatch):
    frame = spark.createDataFrame([*rows_of({"a": 50, "b": 3000, "c": 7}), (None, None, None)], "doc_id long, source string, text string")
    options = {"block_rows": 1, "quanta": 40}
    places = lambda: sorted(map(tuple, mix_sources(frame, **options).collect()), key=str)
    broadcast = places()
    monkeypatch.setattr(mixing, "MOST_ENTRIES", 10)
    monkeypatch.setattr(mixing, "RANGE", 16)
    assert places() == broadcast and len(broadcast) == frame.count()


def test_more_sources_than_quanta(spark):
    sizes = {f"s{i:04d}": 1 + i % 3 for i in range(4000)}
    rows = [(i, s, "x") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_rows=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    assert sorted(r.slot for r in got) == list(range(len(rows)))
