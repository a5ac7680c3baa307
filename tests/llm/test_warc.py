import hashlib
import random

import pytest

from lakecraft.llm import warc
from lakecraft.llm.warc import LoserTree, warc_round_trip, write_warc


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(50), i) for i in range(rng.randrange(0, 20))) for _ in range(k)]
    assert [x[0] for x in LoserTree([iter(r) for r in runs], key=lambda x: x)] == sorted(x[0] for r in runs for x in r)


ROWS = [
    (3, "http://www.A.example.com:80/x#f", "h" * 100, ""),
    (1, None, "h" * 100, ""),
    (2, "https://b.example.org", "h" * 99, ""),
    (4, "https://b.example.org", "h" * 99, ""),
    (5, "u\r\nX: y", None, ""),
    (None, "http://c", "h" * 100, ""),
    (None, "http://c", "é" * 60, ""),
    (7, "http://c", "é" * 60, ""),
    (8, "http://c", "\r\n\r\nWARC/1.1\r\n" * 9_000, ""),
    (1, None, "h" * 100, ""),
]


def brute(rows):
    out = []
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == raw and p is not None]
        first = min(same, default=None)
        again = len(raw) >= 100 and first is not None and page_id != first
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


BIG = [(2**63 - 1, "http://a", "h" * 100), (-(2**63), "http://a", "h" * 100), (10**15, "http://a", None)]


@pytest.mark.parametrize("rows", [[], ROWS, [(*r, "") for r in BIG], [(i, f"http://h{i % 5}.net/{i}", "same page " * 20, "") for i in range(300)]])
def test_round_trip(spark, rows):
    got = warc_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("fan_in", [4, 64])
def test_index_is_globally_ordered(spark, monkeypatch, fan_in):
    monkeypatch.setattr(warc, "MERGE_ROWS", 60)
    rows = [((i * 37) % 500, f"http://h{i % 11}.net/{i % 3}", "x") for i in range(500)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    index = [tuple(r) for r in write_warc(frame, fan_in=fan_in, run_rows=12, block_rows=5).collect()]  # some 45 runs
    assert len(index) == 500 and len({r[3:5] for r in index}) == 500
    assert [r[:3] for r in index] == sorted(r[:3] for r in index)


def test_equal_keys_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "MERGE_ROWS", 50)
    frame = spark.createDataFrame([(None, "http://one.net/", "x")] * 600, "page_id long, url string, html string").repartition(4)
    index = write_warc(frame, run_rows=40, block_rows=8)
    sizes = [len(p) for p in index.rdd.glom().collect()]
    assert sum(sizes) == 600 and max(sizes) < 200


def test_a_merge_holds_one_block_of_each_run(tmp_path, monkeypatch):
    """However long the slices are: blocks are read only as the tree asks for rows."""
    day = warc.datetime(2024, 1, 1, tzinfo=warc.UTC)
    runs = []
    for k in range(7):
        rows = sorted(((f"k{(i * 7 + k) % 50:02d}", day, i * 7 + k, "a", i, 1) for i in range(400)), key=warc._order)
        runs.append([(b[1], b[2]) for b in warc.write_run(iter(rows), str(k), f"{tmp_path}/{k}.run", 16)])
    read = [0]
    rows_of = warc._rows
    monkeypatch.setattr(warc, "_rows", lambda batch: read.__setitem__(0, read[0] + batch.num_rows) or rows_of(batch))
    got = []
    for row in LoserTree([warc.read_run(blocks, None, None) for blocks in runs]):
        got.append(row)
        assert read[0] - len(got) <= 7 * 16
    assert len(got) == 2800 and got == sorted(got, key=warc._order)
    low, high = warc._order(got[1000]), warc._order(got[1500])
    assert list(LoserTree([warc.read_run(blocks, low, high) for blocks in runs])) == got[1000:1500]
