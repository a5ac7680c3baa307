from datetime import datetime, timedelta

import pytest

from lakecraft.llm.urlfilter import url_filter

T = datetime(2024, 1, 1)
ENTRIES = [
    ("example.com", "block", "ads", T),
    ("example.com", "remove", None, T + timedelta(10)),
    ("good.example.com", "allow", "ok", T + timedelta(2)),
    ("x.org/en", "block", "part", T),
    ("x.org", "allow", "a", T + timedelta(5)),
    ("x.org", "block", "b", T + timedelta(5)),
    (None, "block", "n", T),
    ("y.net", "block", "n", None),
    ("y.net", "unknown", "n", T),
]
CAPTURES = [
    (1, "http://a.example.com/", T, "block", "example.com"),
    (2, "https://User@EXAMPLE.com:443/q?x", T + timedelta(9, 86399), "block", "example.com"),
    (3, "http://example.com", T + timedelta(10), "none", None),
    (4, "http://www.good.example.com/z", T + timedelta(3), "allow", "good.example.com"),
    (5, "http://www.good.example.com/z", T + timedelta(1), "block", "example.com"),
    (6, "http://x.org/en/5", T + timedelta(9), "block", "x.org/en"),
    (7, "http://x.org/english", T + timedelta(9), "block", "x.org"),
    (8, "http://notexample.com/", T, "none", None),
    (9, None, T, "none", None),
    (10, "nonsense", T, "none", None),
    (None, "http://a.example.com/", T, "block", "example.com"),
    (11, "http://a.example.com/", None, "none", None),
    (12, "http://y.net/", T + timedelta(1), "none", None),
    (1, "http://a.example.com/", T, "block", "example.com"),
    (13, "http://a.example.com/", T - timedelta(0, 1), "none", None),
]


@pytest.mark.parametrize("captures", [CAPTURES, []])
def test_verdicts(spark, captures):
    frame = spark.createDataFrame([(p, u, t, "x") for p, u, t, *_ in captures], "page_id long, url string, fetched_at timestamp, rule string")
    got = url_filter(frame, spark.createDataFrame(ENTRIES, "rule string, action string, category string, listed_at timestamp")).collect()
    assert sorted(((r.page_id, r.verdict, r.rule) for r in got), key=str) == sorted(((p, v, r) for p, _, _, v, r in captures), key=str)


def test_empty_list(spark):
    frame = spark.createDataFrame([(1, "http://a.b", T)], "page_id long, url string, fetched_at timestamp")
    assert url_filter(frame, spark.createDataFrame([], "rule string, action string, category string, listed_at timestamp")).first().verdict == "none"


def test_deep_paths_single_labels_and_case(spark):
    entries = [("Deep.org/a/b/c/d/e", "block", "deep", T), ("zip", "block", "domain", T), ("case.org/Ads", "block", "case", T), ("localhost", "block", "own", T)]
    captures = [(1, "http://deep.org/a/b/c/d/e/f", "block"), (2, "http://deep.org/a/b/c/d", "none"), (3, "http://www.file.ZIP/x", "block"), (4, "http://CASE.org/Ads/x", "block"), (5, "http://case.org/ads/x", "none"), (6, "http://localhost/x", "block"), (7, "http://zip.org/", "none")]
    frame = spark.createDataFrame([(p, u, T) for p, u, _ in captures], "page_id long, url string, fetched_at timestamp")
    got = url_filter(frame, spark.createDataFrame(entries, "rule string, action string, category string, listed_at timestamp")).collect()
    assert {(r.page_id, r.verdict) for r in got} == {(p, v) for p, _, v in captures}
    assert {r.rule for r in got} == {None, "deep.org/a/b/c/d/e", "zip", "case.org/Ads", "localhost"}


def test_slashes_and_long_urls(spark):
    entries = [("z.org/en/", "block", "a", T), ("w.org//a//b", "block", "b", T), ("/ads", "block", "n", T), ("q.org/", "block", "q", T), ("", "block", "n", T)]
    captures = [(1, "http://z.org/en", "block"), (2, "http://z.org/en/x", "block"), (3, "http://z.org/e", "none"), (4, "http://w.org/a//b/c", "block"), (5, "http://q.org", "block"), (6, "http://z.org/en/" + "x/" * 20_000, "block"), (7, "http://sub.q.org/x", "block")]
    frame = spark.createDataFrame([(p, u, T) for p, u, _ in captures], "page_id long, url string, fetched_at timestamp")
    got = url_filter(frame, spark.createDataFrame(entries, "rule string, action string, category string, listed_at timestamp")).collect()
    assert {(r.page_id, r.verdict) for r in got} == {(p, v) for p, _, v in captures}
