"""Projections, dedup, lifecycle, quality, lake and the whole pipeline on hand-made rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.operators import dedup, enrich, lifecycle, normalize, quality, vectors
from lakecraft.plans import pipeline
from lakecraft.schemas import GOLD_CATALOG, SILVER, SOURCES
from lakecraft.sources import paged, readers
from lakecraft.sources.lake import Lake

TS = "2026-04-25 05:23:46"
LIBRARY = "url string, titulo string, tipo string, etiquetas map<string,string>, imagen string, descripcion string, info_adicional string, estado string"
SHOP = "canonical_url string, source_url string, title string, description string, category string, date string, time string, location string, performer_list string, ticket_availability string"


def library(spark):
    return spark.createDataFrame([("https://b/agenda/taller-de-teatro-5902", None, "Bibliocine", {"Ingreso": "Libre"}, None, " una  charla ", "Sábado, 18 de Abril del 2026 6:30PM", None), ("https://b/2", "Dos", None, {"Sede": "Sala B", "Ingreso": "Entrada S/. 20"}, None, None, None, None)], LIBRARY)


def shop(spark):
    row = lambda url, title, desc, date, loc="Peru, San Isidro, Lima", who="A; B;nan": (url, None, title, desc, "teatro", date, "20:00", loc, who, "available")
    return spark.createDataFrame([row("u1", "Obra", "corta", "2026-05-01"), row("u2", " OBRA ", "mucho más larga", "2026-05-01"), row("u3", "Vieja", "x", "2019-12-31"), row("u4", "Justa", "x", "2020-01-01"), row("u5", "Sin fecha", "x", None), row("u6", None, "x", None), row("u7", None, "yy", None)], SHOP)


def test_projections_and_dedup(spark):
    rows = normalize.normalize_all(TS, bnp=library(spark), joinnus=shop(spark)).collect()
    by = {r.url_origen: r for r in rows}
    assert set(by) == {"https://b/agenda/taller-de-teatro-5902", "https://b/2", "u2", "u4", "u5", "u7"}
    a = by["https://b/agenda/taller-de-teatro-5902"]
    assert (a.titulo, a.tipo, a.fecha_inicio, a.hora_inicio, a.lugar, a.precio, a.descripcion) == ("Taller De Teatro", "cine", "2026-04-18", "18:30", "Biblioteca Nacional del Perú", "Gratuito", "una charla")
    assert by["https://b/2"].lugar == "Sala B" and by["https://b/2"].precio == "Pago" and by["https://b/2"].tipo == "cultural"
    assert by["u2"].tags == ["teatro", "San Isidro", "A", "B"] and by["u2"].precio == "Consultar"
    assert "None" not in by["https://b/2"].texto_embedding
    assert len({r.poi_id for r in rows}) == len(rows) and all(r.poi_id.startswith("poi_") and len(r.poi_id) == 28 for r in rows)


def test_identifiers_do_not_depend_on_order_or_partitions(spark):
    once = {tuple(r) for r in normalize.normalize_all(TS, joinnus=shop(spark)).select("entity_id", "poi_id").collect()}
    again = {tuple(r) for r in normalize.normalize_all(TS, joinnus=shop(spark).orderBy(F.desc("canonical_url")).repartition(5)).select("entity_id", "poi_id").collect()}
    assert once == again


def test_places(spark, tmp_path):
    items = [{"id": "p1", "displayName": {"text": "Museo X"}, "primaryType": "museo", "location": {"latitude": 0.0, "longitude": -77.0}, "photos": [{"name": "foto"}], "googleMapsUri": "https://maps/1", "types": ["museo", "nan", "museo"], "distrito": "san_borja", "reviews": [{"review_text": "muy buen lugar para ir"}]}, {"title": "T", "lat": "-12.0", "lng": "-77.0"}]
    (tmp_path / "p.json").write_text(json.dumps({"places": items}))
    records = normalize.place_records(readers.read_envelope(spark, str(tmp_path / "p.json")))
    a, b = normalize.places(records).orderBy(F.desc("url_origen")).collect()
    assert (a.titulo, a.tipo, a.lat, a.lng, a.distrito, a.url_origen, a.imagen_url, a.ciudad) == ("Museo X", "museo", 0.0, -77.0, "San Borja", "https://maps/1", "foto", "Lima")
    assert a.tags == ["museo", "San Borja"] and a.resumen_reviews == "muy buen lugar para ir" and a.descripcion == "Lugar en San Borja de tipo museo"
    assert b.titulo == "T" and b.lat == -12.0


def test_ticket_rows_and_seeds(spark):
    raw = normalize.ticket_raw(spark.createDataFrame([("u", "Obra", 12.5, "2026-05-01T20:30:00", "Sala", "Lince")], "url string, titulo string, precio_desde double, fecha_inicio string, ubicacion_nombre string, distrito string")).first()
    assert raw.description == "Obra. Categoria: cultural. Inicio: 2026-05-01T20:30:00. Lugar: Sala (Lince). desde 12.50 PEN." and raw.time == "20:30" and raw.location == "Peru, Sala, Lima"
    items = [json.dumps({"title": "A", "slug": "/a/", "location": {"venue": "V"}, "images": [{"imageUrl": "i"}], "price": "20,5"}), json.dumps({"name": "B", "url": "https://s/events/b?x", "location": "W", "images": "j"})]
    a, b = normalize.seeds(spark.createDataFrame([(i,) for i in items], "item string"), "teatro", "https://s").collect()
    assert (a.url, a.titulo, a.ubicacion_nombre, a.imagen_principal, a.precio_desde) == ("https://s/events/teatro/a", "A", "V", "i", 20.5)
    assert (b.url, b.titulo, b.ubicacion_nombre, b.imagen_principal, b.precio_desde) == ("https://s/events/b", "B", "W", "j", None)


def test_conform(spark):
    df = normalize.conform(spark.createDataFrame([("a", "2026-13-40", "x"), ("b", "2026-04-18T10:00", "y")], "entity_id string, fecha_inicio string, extra string"), SILVER)
    assert df.columns == SILVER.names
    assert [str(r.fecha_inicio) for r in df.collect()] == ["None", "2026-04-18"]
    assert normalize.conform(df, GOLD_CATALOG).columns == GOLD_CATALOG.names


@pytest.mark.parametrize("policy", ["hard", "soft"])
def test_lifecycle_script(spark, policy):
    runs = [(1, True, "ABC"), (2, True, "AB"), (3, False, "A"), (4, True, "AC"), (5, True, "AC")]
    state, seen = None, {}
    for run, full, ids in runs:
        batch = spark.createDataFrame([(i, run) for i in ids], "entity_id string, value int")
        state = lifecycle.step(state, batch, str(run), f"t{run}", full_run=full, policy=policy)
        seen[run] = {r.entity_id: (r.is_active, r.missing_full_runs) for r in state.collect()}
    if policy == "hard":
        assert seen[2] == {"A": (True, 0), "B": (True, 0), "C": (False, 1)} and seen[3] == seen[2]
        assert seen[4] == {"A": (True, 0), "B": (False, 1), "C": (True, 0)} and seen[5] == {"A": (True, 0), "C": (True, 0)}
    else:
        assert {k: v[0] for k, v in seen[5].items()} == {"A": True, "B": False, "C": True}


def test_upsert_keeps_fields_that_the_batch_lacks(spark):
    a = lifecycle.step(None, spark.createDataFrame([("A", 1, "x")], "entity_id string, v int, w string"), "1", "t1", full_run=True)
    b = lifecycle.step(a, spark.createDataFrame([("A", 2), (None, 3)], "entity_id string, v int"), "2", "t2", full_run=True).collect()
    assert [(r.entity_id, r.v, r.w, r.first_seen_at, r.last_seen_at, r.change) for r in b] == [("A", 2, "x", "t1", "t2", "modified")]


def silver(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, entity_type string, titulo string, url_origen string, fuente string, texto_embedding string, fecha_run string, scraped_at string")


@pytest.mark.parametrize(
    ("rows", "previous", "verdict"),
    [
        ([(str(i), "event", "t", "u", "bnp", "x", "d", "s") for i in range(10)], None, "PASS"),
        ([("1", "event", "t", "u", "bnp", "x", "d", "s")] * 2, None, "FAIL"),
        ([(None, "event", "t", "u", "bnp", "x", "d", "s"), ("1", "event", "t", "u", "bnp", "x", "d", "s")], None, "FAIL"),
        ([], None, "FAIL"),
        ([(str(i), "event", None if i < 31 else "t", "u", "bnp", "x", "d", "s") for i in range(100)], None, "WARN"),
        ([(str(i), "event", None if i < 30 else "t", "u", "bnp", "x", "d", "s") for i in range(100)], None, "PASS"),
        ([(str(i), "event", "t", "u", "bnp", "x", "d", "s") for i in range(3)], {"bnp": 10}, "WARN"),
        ([(str(i), "event", "t", "u", "bnp", "x", "d", "s") for i in range(4)], {"bnp": 10}, "PASS"),
    ],
)
def test_silver_verdicts(spark, rows, previous, verdict):
    assert quality.check_silver(silver(spark, rows), previous=previous, expected=("bnp",)).verdict == verdict


def test_gold_verdicts(spark):
    frame = lambda vs: spark.createDataFrame([(str(i), v) for i, v in enumerate(vs)], "entity_id string, embedding array<float>")
    check = lambda vs: quality.check_gold(frame(vs), declared=len(vs), dimension=2)
    assert quality.check_gold(None, declared=0).verdict == "WARN" and quality.check_gold(None, declared=3).verdict == "FAIL"
    assert check([[1.0, 0.0], [0.0, 1.0]]).verdict == "PASS"
    assert check([[1.0, 0.0], [0.0]]).verdict == "FAIL" and check([[1.0, float("nan")]]).verdict == "FAIL"
    assert check([[0.5, 0.0]] * 3).verdict == "WARN"
    assert check([[1.0, 0.0], [1.0, 0.0]]).metrics["near_duplicates"] == 1


def test_bronze_verdicts():
    assert quality.check_bronze({"a": (3, 3)}, {"a": 3}, ("a",)).verdict == "PASS"
    assert quality.check_bronze({"a": (3, 2)}, {"a": 3}, ("a",)).verdict == "WARN"
    assert quality.check_bronze({"a": None}, {"a": 3}, ("a",)).verdict == "FAIL"
    assert quality.check_bronze({"a": (3, 3)}, {"a": 4}, ("a", "b")).verdict == "WARN"


def test_geocode_asks_once_for_each_miss(spark):
    rows = spark.createDataFrame([("1", "event", "calle 1", None, None, None), ("2", "event", "calle 1", None, None, None), ("3", "event", None, "Sala", None, None), ("4", "place", "calle 1", None, 1.0, 2.0), ("5", "event", "conocida", None, None, None), ("6", "event", None, None, None, None)], "entity_id string, entity_type string, direccion string, lugar string, lat double, lng double")
    cache = spark.createDataFrame([("conocida", -12.0, -77.0)], "address string, lat double, lng double")
    out, new, rejected = enrich.geocode(rows, cache, lambda a: (5.0, 6.0) if a == "calle 1" else None)
    got = {r.entity_id: (r.lat, r.lng) for r in out.collect()}
    assert got == {"1": (5.0, 6.0), "2": (5.0, 6.0), "3": (None, None), "4": (1.0, 2.0), "5": (-12.0, -77.0), "6": (None, None)}
    assert sorted(r.address for r in new.collect()) == ["calle 1", "conocida"] and [r.address for r in rejected.collect()] == ["Sala, Lima, Perú"]


def test_top_k_keeps_ties_by_id(spark):
    vs = spark.createDataFrame([(i, [1.0, 0.0] if i < 40 else [0.0, 1.0]) for i in range(80)], "entity_id int, embedding array<float>").repartition(7)
    qs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id int, embedding array<float>")
    got = vectors.top_k(vs, qs, 3, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.entity_id) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 40), (1, 41), (1, 42)]
    assert vectors.overlap_summary(vectors.overlap(vectors.top_k(vs, qs, 3), vectors.top_k(vs, qs, 3))).first().mean == 1.0


@pytest.mark.parametrize("block", [7, 1000])
@pytest.mark.parametrize("without_self", [False, True])
def test_top_k_in_blocks(spark, block, without_self):
    vs = np.random.default_rng(1).integers(-2, 3, (60, 4)).astype(float)  # many equal scores
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vs)] + [(99, None)], "entity_id int, embedding array<double>")
    asked = rows.where("entity_id >= 30").withColumnRenamed("entity_id", "query_id")
    want = set()
    for q in range(30, 60):
        best = sorted((-float(v @ vs[q]), i) for i, v in enumerate(vs) if not (without_self and i == q))[:5]
        want |= {(q, i, -s, rank) for rank, (s, i) in enumerate(best, 1)}
    found = vectors.top_k(rows, asked, 5, block=block, without_self=without_self)
    assert {tuple(r) for r in found.collect()} == want
    assert vectors.top_k(rows, asked.where("false"), 5, block=block).count() == 0 and vectors.top_k(rows.where("false"), asked, 5, block=block).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\nbroken\n\n{"b":2}\n')
    assert tuple(readers.line_counts(readers.read_jsonl(spark, str(tmp_path / "a.jsonl"))).first()) == (3, 2)
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text('a,b\n"x\ny",3\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "*.csv")).collect()] == [("x\ny", "3")]
    pages = spark.createDataFrame([('{"total": 41}',), ('{"totalPages": 3, "total": 1}',)], "r string").select(paged.page_count("r", 20).alias("n"))
    assert [r.n for r in pages.collect()] == [3, 3]


def test_pipeline_over_runs(spark, tmp_path):
    lake, reports = Lake(spark, f"file://{tmp_path}/lake"), []

    def broken(_):
        raise OSError("down")

    for k, sources in enumerate([{"bnp": library, "joinnus": shop}, {"bnp": library, "mali": broken}]):
        run = pipeline.Run(f"20260425_05234{k}", f"2026-04-2{5 + k} 05:23:46", sources, encoder=vectors.HashingEncoder())
        state = pipeline.run_all(lake, run)
        reports.append(run.reports)
    assert lake.runs("silver", "eventos_estandar") == ["20260425_052340", "20260425_052341"] and lake.latest("gold") == "20260425_052341"
    assert lake.manifest("gold", "20260425_052340")["vector_count"] == 6
    assert any("down" in (e["notes"] or "") for e in lake.manifest("bronze", "20260425_052341")["sources"])
    assert state.count() == 6 and state.where("is_active").count() == 6, "a partial run ages nothing"
    assert reports[1]["silver"].verdict == "WARN" and not lifecycle.is_full_run(["bnp"], SOURCES)
    assert pipeline.stats(lake.read("silver", "eventos_estandar", "20260425_052340")).where("column = 'fuente'").count() == 2
    assert lake.purge("silver", "eventos_estandar", 1) == ["20260425_052340"]


def test_new_per_batch_and_sample(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("b", 3), ("c", 4), ("c", 5)], "link string, batch int")
    assert sorted(map(tuple, dedup.new_per_batch(df).collect())) == [(1, 2, 0), (2, 0, 1), (3, 0, 2), (4, 1, 0), (5, 0, 1)]
    ids = spark.range(100)
    assert [r.id for r in dedup.hash_sample(ids, "id", 5).collect()] == [r.id for r in dedup.hash_sample(ids.repartition(3), "id", 5).collect()]


def test_two_runs_ask_once(spark, tmp_path):
    """Sources and provider are asked once in a run, cached addresses never again; what is rejected is kept; vectors have a state."""
    lake, log = Lake(spark, f"file://{tmp_path}/lake"), tmp_path / "asked"
    log.mkdir()

    def source(session):
        (log / f"source-{len(list(log.glob('source-*')))}").write_text("")
        return library(session)

    def provider(address):
        import uuid

        (log / f"{uuid.uuid4().hex}.txt").write_text(address)
        return (-12.0, -77.0) if "Sala" in address else None

    states, reports = [], []
    for k in range(2):
        run = pipeline.Run(f"20260425_05234{k}", f"2026-04-2{5 + k} 05:23:46", {"bnp": source}, encoder=vectors.HashingEncoder(), geocoder=provider)
        states.append(pipeline.run_all(lake, run))
        reports.append(run.reports)
    asked = [p.read_text() for p in log.glob("*.txt")]
    assert asked.count("Sala B, Lima, Perú") == 1 and asked.count("Biblioteca Nacional del Perú, Lima, Perú") == 2, "known ones are not asked for again, rejected ones are"
    assert len(list(log.glob("source-*"))) == 2
    assert lake.read("silver", "geocode_cache", "20260425_052341").count() == 1
    assert [r.address for r in lake.read("silver", "geocode_rejected", "20260425_052341").collect()] == ["Biblioteca Nacional del Perú, Lima, Perú"]
    assert {r.lat for r in states[1].collect()} == {-12.0, None}
    served = pipeline.serving(lake, "vectors").read().collect()
    assert len(served) == 2 and {r.last_seen_run_id for r in served} == {"20260425_052341"} and {r.fuente for r in served} == {"bnp"}
    assert reports[1]["bronze"].metrics == {"bnp": 2} and "recall_at_k" in reports[1]["gold"].metrics
    folder = lake.dataset("silver", "export", "20260425_052341")
    assert spark.read.csv(f"{folder}/csv", header=True).count() == 2 == spark.read.json(f"{folder}/json").count()


def test_activity_objects(spark):
    from lakecraft.functions import scalars as s

    pages = ['{"activity": {"a": 1}, "blogs": []}', '{"activity": {"a": {"b": "}\\" {"}}\n,"related": 3}', '{"activity": {"a": 3}, "other": 1}', '{"activity": {"a": 4}}', '{"activity": broken}', '{"activity": {"a": 5', None, "", '"activity":{"x":{"blogs":1}},"recommended":' + '{"y":"\\"}"}' * 20_000]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").select(F.to_json(s.activity_json("html")).alias("j"))
    assert [r.j for r in rows.collect()] == ['{"a":1}', '{"a":{"b":"}\\" {"}}', None, None, None, None, None, None, '{"x":{"blogs":1}}']
