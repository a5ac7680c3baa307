"""How often a page's parts are worked out, and by how many tasks, as plans tell."""

import pytest
from pyspark.sql import functions as F

from lakecraft.functions import markup as m
from lakecraft.operators import pages
from lakecraft.plans import page_queries  # noqa: F401  they register their queries
from lakecraft.plans.queries import QUERIES


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(1, 9).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1, 9).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("t").alias("p_type")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["q_listing_pages", "q_library_page", "q_event_page"])
def test_pages_are_read_by_many_tasks(spark, tables, name):
    df = QUERIES[name](spark, tables)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("Repartition") :]
    assert "<!--" not in dealt.split("Relation", 1)[0], "a page is parsed before the rows are dealt out"
    assert df.count() == 8


def test_an_element_is_looked_up_once(spark):
    page = spark.createDataFrame([("<p class='a'>x &amp; <b>y</b></p>",)], "html string").withColumn("_page", m.parse("html"))
    for text in (m.whole_text, m.joined_text):
        df = page.select(text("_page", m.first("_page", "p.a")).alias("t"))
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
        assert plan.count(".elements") == 1
    assert page.select(m.whole_text("_page", m.first("_page", "p")), m.whole_text("_page", m.first("_page", "h1"))).first()[:] == ("x & y", None)


def test_cards_of_pages_without_any(spark):
    rows = spark.createDataFrame([(1, "<p>none</p>"), (2, None), (3, "<a class='thumblink' href='u'><h4>t</h4></a>")], "k int, html string")
    assert [tuple(r) for r in pages.museum_cards(rows, "k").collect()] == [(3, "u", "t", None)]
