import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from lakecraft.sources import feed, paged

ANSWERS = [
    ({"data": {"total_pages": 7}}, 7),
    ({"last_page": 4}, 4),
    ({"meta": {"total": 41}}, 3),
    ({"totalPages": 2, "pagination": {"Page-Count": 5}}, 5),
    ({"pages": 0, "total_pages": 3}, 3),
    ({"pages": "9", "count": 20}, 1),
    ({"total": 10, "data": {"totalCount": 61}}, 4),
    ({"pages": 2.9, "total": 900}, 2),
    ({"data": [1, 2], "meta": []}, None),
    ({"pages": -1}, None),
    ([1], None),
    (None, None),
]


def test_page_counts(spark):
    rows = spark.createDataFrame([(k, json.dumps(a)) for k, (a, _) in enumerate(ANSWERS)] + [(99, "broken"), (100, None)], "k int, answer string")
    got = {r.k: r.n for r in rows.select("k", paged.page_count("answer", 20).alias("n")).collect()}
    for k, (answer, want) in enumerate(ANSWERS):
        assert paged.pages_of(answer, 20) == want
        assert got[k] == want, answer
    assert got[99] is None and got[100] is None


def test_items():
    assert paged.items_of({"results": [{"a": 1}, 2]}) == [{"a": 1}]
    assert paged.items_of({"data": {"hits": [{"_source": {"a": 1}}, {"b": 2}, 3]}}) == [{"a": 1}, {"b": 2}]
    assert paged.items_of({"data": {"x": 1}, "list": [{"c": 3}]}) == [{"c": 3}]
    assert paged.items_of([]) == paged.items_of(None) == paged.items_of({}) == []


def api(folder, pages, /, **envelope):
    """A fake API over lists of items; each request leaves a file, as tasks ask from other processes."""

    def fetch(category, page, size):
        open(os.path.join(folder, f"{page}-{uuid.uuid4().hex}"), "w").close()
        status, items = pages[page - 1] if page <= len(pages) else (200, [])
        if status is None:
            raise OSError("no route")
        return status, {"data": {"items": [{"id": f"{category}{i}"} for i in items]}, **envelope}

    return fetch


@pytest.mark.parametrize(
    ("pages", "envelope", "asked", "kept"),
    [
        ([(200, [1, 2]), (200, [3, 4]), (200, [5])], {"total_pages": 3}, 3, [1, 2, 3, 4, 5]),  # told: pages are partitions
        ([(200, [1, 2]), (200, [3, 4]), (200, [5]), (200, [6])], {}, 3, [1, 2, 3, 4, 5]),  # not told: a short page ends it
        ([(200, [1, 2]), (200, [3, 4])], {}, 3, [1, 2, 3, 4]),  # an empty page ends it
        ([(200, [1, 2]), (500, []), (200, [5, 6])], {}, 2, [1, 2]),  # a refused one too
        ([(200, [1, 2]), (None, []), (200, [5, 6])], {"meta": {"total": 6}}, 3, [1, 2]),  # what follows a failed page is not kept
        ([(200, [1, 2]), (200, []), (200, [5, 6])], {"pages": 3}, 3, [1, 2]),
        ([(403, [1])], {"pages": 9}, 1, []),
        ([(200, [])], {}, 1, []),
        ([(200, [k, k]) for k in range(9)], {"pages": 9}, 4, [0, 0, 1, 1, 2, 2, 3, 3]),  # the limit
        ([(200, [k, k]) for k in range(9)], {}, 4, [0, 0, 1, 1, 2, 2, 3, 3]),
    ],
)
def test_paged_source(spark, tmp_path, pages, envelope, asked, kept):
    name = f"api_{uuid.uuid4().hex}"
    spark.dataSource.register(paged.paged_source(api(str(tmp_path), pages, **envelope), name))
    paged.read_pages(spark, name, "c", size=2, most=4).write.parquet(f"{tmp_path}.pages")
    assert len(os.listdir(tmp_path)) == asked  # each page once
    got = paged.until_stop(spark.read.parquet(f"{tmp_path}.pages")).select(F.get_json_object("item", "$.id")).collect()
    assert sorted(r[0] for r in got) == sorted(f"c{k}" for k in kept)


SHOWN = [["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["c", "d"], ["d"], [], ["e"]]


def test_feed_ends_after_two_stale_batches(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def show(category, batch):
        (asked / f"{batch}-{uuid.uuid4().hex}").touch()
        return SHOWN[batch - 1]

    spark.dataSource.register(feed.feed_source(show, "feed_a"))
    path = f"file://{tmp_path}/feed"
    first = feed.read_feed(spark, "feed_a", "teatro", path, most=3)  # as if stopped there
    assert [(r.batch, r.found, r.new, r.links) for r in first.orderBy("batch").collect()] == [(1, 2, 2, ["a", "b"]), (2, 3, 1, ["c"]), (3, 3, 0, [])]
    rest = feed.read_feed(spark, "feed_a", "teatro", path)
    assert [(r.batch, r.new) for r in rest.orderBy("batch").collect()] == [(1, 2), (2, 1), (3, 0), (4, 1), (5, 0), (6, 0)]
    assert feed.read_feed(spark, "feed_a", "teatro", path).count() == 6
    batches = [int(p.name.split("-")[0]) for p in asked.iterdir()]
    assert set(batches) == {1, 2, 3, 4, 5, 6}  # none after the end
    # The rule of the batches' new links, told by the operator over tables.
    from lakecraft.operators.dedup import new_per_batch

    table = spark.createDataFrame([(b + 1, link) for b, links in enumerate(SHOWN) for link in links], "batch int, url string")
    told = {r.batch: r.fresh for r in new_per_batch(table, "url", "batch").collect() if r.batch <= 6}
    assert told == {r.batch: r.new for r in rest.collect() if r.found}
