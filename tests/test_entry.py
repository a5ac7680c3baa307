import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakecraft.plans import catalog_queries, page_queries  # noqa: F401  they register their queries
from lakecraft.plans.queries import QUERIES, SQL
from lakecraft.streaming.ingest import stream_into_state, windowed_counts

SF = "/root/testdata/sf0.001"


def plain(v):
    return repr(round(v, 5) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    df = QUERIES[name](spark, SF)
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    want = sorted(tuple(plain(v) for v in r) for r in found.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == want


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    if os.path.isdir(SF):
        assert contract.entry(spark).count() > 0


def test_stream_upserts(spark, tmp_path):
    from lakecraft.sources.lake import Lake

    lake = Lake(spark, f"file://{tmp_path}/lake")
    for k, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)]]):
        frame = spark.createDataFrame(rows, "entity_id string, v int")
        frame.write.mode("append").parquet(f"{tmp_path}/in")
        stream_into_state(spark, f"{tmp_path}/in", frame.schema, lake, f"{tmp_path}/ck").awaitTermination()
    got = {r.entity_id: (r.v, r.is_active) for r in lake.read("serving", "stream", lake.runs("serving", "stream")[-1]).collect()}
    assert got == {"a": (2, True), "b": (1, True)}
    if os.path.isdir(SF):
        events = spark.read.parquet(f"{SF}/events.parquet")
        assert windowed_counts(events).agg({"n": "sum"}).first()[0] == events.count()
