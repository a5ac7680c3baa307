import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.operators import enrich
from lakecraft.operators.providers import NOTHING, Pace, ask

VALUE = T.StructType([T.StructField("n", T.LongType())])


def counting(folder, broken):
    """A provider that leaves a file for each request, raises for the keys in ``broken`` and knows none that begin with ``none``."""

    def provider(request):
        (folder / f"{request['k']}~{uuid.uuid4().hex}").touch()
        if request["k"] in broken:
            raise OSError(f"no route to {request['k']}")
        return None if request["k"].startswith("none") else {"n": len(request["k"])}

    return provider


def asked(folder):
    names = [p.name.split("~")[0] for p in folder.iterdir()]
    return {k: names.count(k) for k in names}


@pytest.fixture
def folder(tmp_path):
    out = tmp_path / "asked"
    out.mkdir()
    return out


def test_outcomes(spark, folder):
    rows = spark.createDataFrame([("a",), ("bb",), ("a",), ("none",), ("down",), (None,), ("",)], "k string")
    path = f"file://{folder.parent}/kept"
    got = ask(rows, "k", counting(folder, {"down"}), VALUE, Pace(attempts=3), path=path)
    assert sorted(map(tuple, got.collect())) == [("", 0, None, 1), ("a", 1, None, 1), ("bb", 2, None, 1), ("down", None, "OSError: no route to down", 3), ("none", None, NOTHING, 1)]
    assert asked(folder) == {"a": 1, "bb": 1, "none": 1, "down": 3, "": 1}
    # Again: only what has no value is asked for; what is found then counts.
    again = ask(rows, "k", counting(folder, set()), VALUE, Pace(attempts=3), path=path)
    assert {r.k: (r.n, r.error) for r in again.collect()} == {"": (0, None), "a": (1, None), "bb": (2, None), "down": (4, None), "none": (None, NOTHING)}
    assert asked(folder) == {"a": 1, "bb": 1, "none": 2, "down": 4, "": 1}
    assert ask(rows.where("false"), "k", counting(folder, set()), VALUE, path=f"{path}-none").count() == 0


def test_a_broken_run_goes_on(spark, folder):
    """A run that ends within a wave has kept the waves before it."""
    rows = spark.range(60).select(F.concat(F.lit("k"), "id").alias("k"))
    path = f"file://{folder.parent}/kept"

    def dies(request):
        (folder / f"{request['k']}~{uuid.uuid4().hex}").touch()
        if len(list(folder.iterdir())) > 30:
            raise SystemExit("killed")  # not an error of the provider: the task ends
        return {"n": 1}

    with pytest.raises(Exception):  # noqa: B017, PT011
        ask(rows, "k", dies, VALUE, Pace(tasks=1, wave=10), path=path)
    found = {r.k for r in spark.read.schema("k string, n long, error string, attempts int").parquet(path).collect()}
    before = asked(folder)
    assert 0 < len(found) < 60
    got = ask(rows, "k", counting(folder, set()), VALUE, Pace(wave=10), path=path)
    assert got.where("error is null").count() == 60
    after = asked(folder)
    assert all(after[k] == before[k] for k in found) and all(after[k] == before.get(k, 0) + 1 for k in set(after) - found)


def test_pace(spark, folder):
    rows = spark.range(12).select(F.col("id").cast("string").alias("k"))
    began = time.monotonic()
    ask(rows, "k", counting(folder, set()), VALUE, Pace(tasks=2, seconds=0.1)).collect()
    assert time.monotonic() - began >= 12 * 0.1 * 0.5  # hashed over two tasks, each waits 0.2 s between its requests


def test_a_geocoder_that_raises_costs_one_row(spark):
    rows = spark.createDataFrame([("p1", "event", "calle 1", None, None), ("p2", "event", "calle 2", None, None), ("p3", "event", "calle 2", None, None), ("p4", "event", None, "Sala", None), (None, "event", "calle 3", None, None)], "poi_id string, entity_type string, direccion string, lugar string, lat double").withColumns({"lng": F.lit(None).cast("double"), "entity_id": F.coalesce("poi_id", F.lit("e5"))})

    def provider(address):
        if address == "calle 2":
            raise RuntimeError("HTTP 429")
        return (1.0, 2.0) if address == "calle 1" else None

    cache = spark.createDataFrame([], "address string, lat double, lng double")
    out, new, rejected = enrich.geocode(rows, cache, provider, pace=Pace(attempts=2))
    assert {r.entity_id: r.lat for r in out.collect()} == {"p1": 1.0, "p2": None, "p3": None, "p4": None, "e5": None}
    assert [tuple(r) for r in new.collect()] == [("calle 1", 1.0, 2.0)]
    assert sorted(map(tuple, rejected.collect())) == [("e5", "calle 3", NOTHING), ("p2", "calle 2", "RuntimeError: HTTP 429"), ("p3", "calle 2", "RuntimeError: HTTP 429"), ("p4", "Sala, Lima, Perú", NOTHING)]


ANSWERS = {
    '{"tags": [" a ", "", "b", 3, null], "summary": " s "}': (["a", "b", "3"], "s"),
    '{"tags": [], "summary": ""}': (None, None),
    '{"tags": "a, b", "summary": null}': (None, None),
    '```json\n{"tags": ["a"]}\n```': (None, None),
    '{"tags": ["a"]} and more': (None, None),
    '[{"tags": ["a"]}]': (None, None),
    " {\"summary\": \"only\"}\n": (None, "only"),
    "": (None, None),
}


def test_strict_answers(spark):
    rows = spark.createDataFrame([(k, a) for k, a in enumerate([*ANSWERS, None])], "k int, answer string")
    told = rows.select("k", *[c.alias(n) for n, c in enrich.parsed_answer("answer").items()]).orderBy("k").collect()
    assert [(r.ai_tags, r.ai_summary) for r in told] == [*ANSWERS.values(), (None, None)]
    many = spark.range(1).select(F.lit('{"tags": [' + ",".join(f'"t{k}"' for k in range(30)) + "]}").alias("answer"))
    assert len(many.select(enrich.parsed_answer("answer")["ai_tags"]).first()[0]) == 20


class Model:
    def text(self, event):
        if event["titulo"] == "down":
            raise OSError("down")
        return '{"tags": ["%s", "x"], "summary": "de %s en %s"}' % (event["tipo"], event["titulo"], event["lugar"])

    def caption(self, image_url):
        if image_url == "broken":
            raise OSError("no image")
        return f" foto {image_url} "


def test_enrichment(spark):
    rows = [("1", "2026-01-01", "uno", "teatro", "Sala", "i.png", "texto 1"), ("2", "2026-01-02", "dos", None, None, "broken", "texto 2"), ("3", "2026-01-03", "down", "x", "y", "i.png", "texto 3"), ("4", None, "tarde", "x", "y", None, None), ("5", None, "nunca", "x", "y", None, "texto 5")]
    df = spark.createDataFrame(rows, "entity_id string, fecha_inicio string, titulo string, tipo string, lugar string, imagen_url string, texto_embedding string")
    got = {r.entity_id: r.texto_embedding for r in enrich.enrich(df, Model(), most=4).collect()}
    assert got == {"1": "texto 1 | Imagen: foto i.png | Resumen: de uno en Sala | AI_Tags: teatro, x", "2": "texto 2 | Resumen: de dos en | AI_Tags: x", "3": "texto 3", "4": "Resumen: de tarde en y | AI_Tags: x, x", "5": "texto 5"}
    assert enrich.enrich(df, Model()).columns == df.columns and enrich.enrich(df.where("false"), Model()).count() == 0


def test_enrichment_in_the_pipeline(spark, tmp_path):
    from lakecraft.operators.vectors import HashingEncoder
    from lakecraft.plans import pipeline
    from lakecraft.sources.lake import Lake

    def source(session):
        return session.createDataFrame([("https://b.example/1", "Uno"), ("https://b.example/2", "down")], "url string, titulo string")

    lake = Lake(spark, f"file://{tmp_path}/lake")
    run = pipeline.Run("20260425_052340", "2026-04-25 05:23:46", {"bnp": source}, encoder=HashingEncoder(), model=Model(), pace=Pace(attempts=1))
    pipeline.run_all(lake, run)
    texts = {r.titulo: r.texto_embedding for r in lake.read("gold", "vectors", run.run_id).collect()}
    assert "Resumen: de Uno en Biblioteca" in texts["Uno"] and "Resumen" not in texts["down"]
    assert "contract" in str(list((tmp_path / "lake" / "gold").iterdir()))
    told = {r.entity_id: (r.error, r.attempts) for r in spark.read.parquet(lake.dataset("gold", "model_answers", run.run_id)).collect()}
    assert sorted(told.values(), key=str) == [("OSError: down", 1), (None, 1)]
