"""SRC-3: an API that answers in pages, as a data source with an injected fetcher.

The first answer tells how many pages there are; then pages are partitions, each asked for by the task that reads it. An
answer that tells nothing leaves one partition that walks on until a page is empty, short or refused.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: (status, parsed answer) of a category's page; what it raises counts as status 0.
Fetch = Callable[[str, int, int], tuple[int, object]]

# Where an answer may hold its items, its counts, and the names of these, in order.
ITEMS = ("data", "items", "results", "activities", "events", "list", "hits")
CONTAINERS = ("data", "meta", "pagination")
PAGES = ("pages", "total_pages", "totalpages", "page_count", "pagecount", "last_page", "lastpage")
TOTALS = ("total", "total_items", "totalitems", "total_count", "totalcount", "count")


def items_of(answer: object) -> list[dict]:
    """The items of an answer: a list under a known key, or in an object under one; there ``_source`` unwraps an item."""
    given = answer if isinstance(answer, dict) else {}
    for key in ITEMS:
        value = given.get(key)
        if isinstance(value, list):
            return [x for x in value if isinstance(x, dict)]
        nested = next((value[k] for k in ITEMS if isinstance(value.get(k), list)), None) if isinstance(value, dict) else None
        if nested is not None:
            return [x["_source"] if isinstance(x.get("_source"), dict) else x for x in nested if isinstance(x, dict)]
    return []


def pages_of(answer: object, size: int) -> int | None:
    """How many pages an answer says there are: the largest page count of its containers, else of their totals over ``size``."""
    if not isinstance(answer, dict):
        return None
    boxes = [answer, *(answer[k] for k in CONTAINERS if isinstance(answer.get(k), dict))]

    def largest(names: tuple[str, ...]) -> float | None:
        found = []
        for box in boxes:
            plain = {str(k).lower().replace("-", "_"): v for k, v in box.items()}
            found += [v for n in names if isinstance(v := plain.get(n), int | float) and v > 0][:1]
        return max(map(int, found), default=None)

    pages = largest(PAGES)
    if pages is not None:
        return pages
    total = largest(TOTALS)
    return math.ceil(total / size) if total is not None and size > 0 else None


def page_count(response: Column | str, size: int) -> Column:
    """As :func:`pages_of`, for a column of JSON texts; built-in expressions only."""
    v = F.try_parse_json(response)
    boxes = [F.map_entries(F.try_variant_get(v, p, "map<string,variant>")) for p in ("$", *(f"$.{c}" for c in CONTAINERS))]

    def first(box: Column, names: tuple[str, ...]) -> Column:
        plain = lambda e: F.replace(F.lower(e["key"]), F.lit("-"), F.lit("_"))
        numeric = lambda x: F.when(F.regexp_like(F.schema_of_variant(x), F.lit("^(BIGINT|DOUBLE|DECIMAL)")), F.try_variant_get(x, "$", "double"))
        values = [numeric(_last(box, name, plain)) for name in names]
        return F.coalesce(*[F.when(x > 0, F.floor(x)) for x in values])

    pages, totals = (F.greatest(*[first(b, names) for b in boxes], F.lit(None).cast("long")) for names in (PAGES, TOTALS))
    return F.coalesce(pages, F.ceil(totals / size)).cast("int")


def _last(box: Column, name: str, plain: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(box, lambda e: plain(e) == name), F.lit(-1))["value"]


@dataclass
class _Pages(InputPartition):
    first: int
    last: int
    answer: str | None = None  # of the first page, which planning has asked for
    walk: bool = False


def paged_source(fetch: Fetch, name: str) -> type[DataSource]:
    """A data source of that name over ``fetch``; register it with ``spark.dataSource.register``.

    Options: category, size (items of a page), most (pages at most). Rows: category, page, status, items (JSON texts).
    """

    def ask(category: str, page: int, size: int) -> tuple[int, object]:
        try:
            return fetch(category, page, size)
        except Exception:  # noqa: BLE001  a page that cannot be had is a row with status 0
            return 0, None

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.category, self.size, self.most = options.get("category", ""), int(options.get("size", 20)), int(options.get("most", 100))

        def partitions(self) -> list[InputPartition]:
            status, answer = ask(self.category, 1, self.size)
            told = json.dumps({"status": status, "answer": answer})
            pages = pages_of(answer, self.size) if status == 200 else 1
            if pages is None:
                return [_Pages(1, self.most, told, walk=True)]
            return [_Pages(p, p, told if p == 1 else None) for p in range(1, max(1, min(pages, self.most)) + 1)]

        def read(self, part: _Pages) -> Iterator[tuple]:
            for page in range(part.first, part.last + 1):
                if page == 1 and part.answer:
                    told = json.loads(part.answer)
                    status, answer = told["status"], told["answer"]
                else:
                    status, answer = ask(self.category, page, self.size)
                items = items_of(answer) if status == 200 else []
                if part.walk and page > 1 and not items:
                    return
                yield self.category, page, status, [json.dumps(x, ensure_ascii=False) for x in items]
                if part.walk and len(items) < self.size:
                    return

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "category string, page int, status int, items array<string>"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return Reader(dict(self.options))

    return Source


def read_pages(spark: SparkSession, name: str, category: str, *, size: int = 20, most: int = 100) -> DataFrame:
    return spark.read.format(name).options(category=category, size=size, most=most).load()


def until_stop(pages: DataFrame) -> DataFrame:
    """(category, page, item) of the pages before a category's first refused or empty one. ``pages`` are written first if asking again costs."""
    bad = pages.where((F.col("status") != 200) | (F.size("items") == 0)).groupBy("category").agg(F.min("page").alias("stop"))
    good = pages.join(bad, "category", "left").where(F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    return good.select("category", "page", F.explode("items").alias("item"))
