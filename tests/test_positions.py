import random

from pyspark.sql import functions as F

from lakecraft.sources.positions import Positions


def test_positions_and_the_files_read(spark, tmp_path):
    ids = [f"p{k:05d}" for k in range(3000)] + ["p00007"] * 3
    random.Random(1).shuffle(ids)
    rows = spark.createDataFrame([(i, k) for k, i in enumerate(ids)] + [(None, -1)], "poi_id string, n int").repartition(9)
    index = Positions.write(rows, "poi_id", f"file://{tmp_path}/index", files=20)
    got = [(r.pos, r.poi_id) for r in index.read().orderBy("pos").collect()]
    assert [p for p, _ in got] == list(range(3003)) and [i for _, i in got] == sorted(ids)
    assert index.index().count() == 20
    asked = spark.createDataFrame([(5,), (6,), (5,), (2900,), (9999,), (-1,), (None,)], "pos long")
    assert len(index.files_of(asked)) == 2
    found = index.at(asked)
    assert sorted((r.pos, r.poi_id) for r in found.collect()) == [(5, got[5][1]), (5, got[5][1]), (6, got[6][1]), (2900, got[2900][1])]
    read = {f.rsplit("/", 1)[1] for f in found.inputFiles() if "/rows/" in f}
    assert len(read) == 2, "the other files are not opened"
    # Another reader, and the same after every task has run again.
    again = Positions(spark, f"file://{tmp_path}/index")
    assert sorted(map(tuple, again.read().select("pos", "poi_id", "n").collect())) == sorted(map(tuple, index.read().select("pos", "poi_id", "n").collect()))
    assert again.at(asked.where("pos > 5000")).count() == 0


def test_empty(spark):
    rows = spark.createDataFrame([(None, 1)], "poi_id string, n int")
    index = Positions.write(rows, "poi_id")
    assert index.read().count() == 0 and index.at(spark.range(3).select(F.col("id").alias("pos"))).count() == 0
