import random
import zlib

import numpy as np

import corpus_pipeline
from tests.llm.test_token_ids import ids_of


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    item = text(30)
    docs = [(i, text(40), "en", f"s{i % 3}", 1) for i in range(240)]
    docs = [(i, t + " blockhead", lang, s, n) if i % 6 == 0 else (i, t, lang, s, n) for i, t, lang, s, n in docs]
    docs += [(1000, docs[1][1], "en", "s0", 1), (1001, docs[2][1] + " more", "en", "s1", 1), (1002, text(9) + " " + item, "en", "s2", 1), (1003, None, None, None, None)]
    labels = [(i, 1, int(i % 6 == 0)) for i in range(240)]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = {i: t for i, t, *_ in docs if not (t or "").endswith("blockhead") and i not in (1000, 1001, 1002)}
    got = corpus_pipeline.run(spark, f"{folder}").orderBy("position").collect()
    assert {r.doc_id for r in got} == set(want)
    at = 0
    for r in got:
        ids = ids_of(want[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r.doc_id for r in got] != sorted(want), "the mixture's order is kept"


def test_clashing_names_and_dots(spark, tmp_path):
    names = ["row", "h", "group", "file", "nth", "_metadata", "node", "kept", "a.b"]
    plain = spark.createDataFrame([(i, f"text number {i} of some words", "en", f"s{i % 2}", 1, *"x" * 9) for i in range(30)] + [(None, None, None, None, None, *[None] * 9)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, str(tmp_path)).columns == plain.columns
    mixed = corpus_pipeline.mixing(spark, docs, str(tmp_path)).collect()
    corpus_pipeline.materialise(corpus_pipeline.mixing(spark, docs, str(tmp_path)), "clash").write.parquet(f"{tmp_path}/mixed.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in mixed] and len(got) == 31


def test_stages_keep_the_columns(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.mixing(spark, frame, "").columns == frame.columns
    assert corpus_pipeline.token_ids(spark, frame, "").count() == 0


def test_long_texts_and_repeated_rows(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(50_000)}" for _ in range(n))
    item, long = text(30), text(60_000)
    docs = [(i, text(40), "en", "s", 1) for i in range(20)]
    docs += [docs[3], docs[3]]  # rows repeated whole share their fate
    docs += [(100, long, "en", "s", 1), (101, long + " more", "en", "t", 1), (102, text(50_000) + " " + item, "en", "t", 1), (103, docs[3][1], "en", "t", 1), (104, "", "en", None, 1), (None, text(20), None, None, None)]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = [d for d in docs if d[0] not in (101, 102, 103)]
    got = corpus_pipeline.run(spark, folder).collect()
    of = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((d[0], *of(ids_of(d[1]))) for d in left), key=key)
