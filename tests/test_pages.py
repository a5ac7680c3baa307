import pytest
from pyspark.sql import functions as F

from lakecraft.functions import markup as m
from lakecraft.operators import normalize, pages

PAGES = {
    "nested": ("<div class='a b'>x<div>in</div>tail</div><div>after</div>", "div", ["x in tail", "in", "after"]),
    "class": ("<p class='ab'>no</p><p class=\"x a\">yes</p><p data-class='a'>no</p><P CLASS=a>too</P>", "p.a", ["yes", "too"]),
    "steps": ("<ul><li>1</li></ul><div class=box><ul><li>2<ul><li>3</ul></ul></div><li>4", "div.box ul li", ["2 3", "3"]),
    "unclosed": ("<ul><li>one<li>two <b>x</ul><p>p1<p>p2<div>out", "li", ["one", "two x"]),
    "paragraphs": ("<div><p>p1<p>p2<div>d</div></div>tail", "p", ["p1", "p2"]),
    "stray close": ("</div><p>a</b> b</p></p>", "p", ["a b"]),
    "outer close": ("<div><span>a<b>b</div>c", "span", ["a b"]),
    "quotes": ("<a title='1 > 0' href=\"x\">t</a><a href>u</a>", "a[href]", ["t", "u"]),
    "attributes": ("<i data-cy='x-price-y'>1</i><i data-cy=other>2</i><i class=price>3</i>", "[data-cy*='price'],.price", ["1", "3"]),
    "scripts": ("<div>a<script>var x = '<div>no</div>';</script><!-- <div>no</div> --><style>div{}</style>b</div>", "div", ["a b"]),
    "references": ("<p>&lt;b&gt; &amp;amp; &ntilde;&#233;&#x1F600;&nope; & x&nbsp;</p>", "p", ["<b> &amp; ñé😀&nope; & x"]),
    "no tags": ("1 < 2 and 3 > 2 & <", "p", []),
    "cut off": ("<div>a<p class='x", "div", ["a < p class='x"]),
    "empty": ("", "div", []),
    "void": ("<div>a<br>b<img class=p>c</div>", "div", ["a b c"]),
    "long": ("<p>" + "<b>x</b> it's " * 5_000 + "</p>", "p", ["x it's " * 4_999 + "x it's"]),
    "quotes without end": ("a <b 'x" + "'y\" " * 20_000 + "<p>z</p>", "p", None),
}


@pytest.mark.parametrize("name", PAGES)
def test_elements(spark, name):
    html, selector, want = PAGES[name]
    row = spark.createDataFrame([(html,)], "html string").withColumn("page", m.parse("html"))
    got = row.select(F.transform(m.select("page", selector), lambda e: m.joined_text("page", e))).first()[0]
    assert want is None or got == want


def test_null_page(spark):
    row = spark.createDataFrame([(None,)], "html string").withColumn("page", m.parse("html"))
    assert row.select(m.select("page", "p"), m.whole_text("page", m.first("page", "p"))).first() == (None, None)
    with pytest.raises(ValueError):
        m.select("page", "p > b")


def test_pages_to_events(spark):
    html = '<h1>Un taller</h1><span style="background-color:red">Taller</span><ul><li><span>Sede</span><span>Sala 1</span></li><li><span>Ingreso</span><span>Libre</span></li></ul><p class="descripcion">Texto</p><p>18 de Abril del 2026, 7:30 PM</p>'
    rows = spark.createDataFrame([("https://b.example/1", html), ("https://b.example/un-titulo-2", None)], "url string, html string")
    got = {r.url_origen: r for r in normalize.library_events(pages.library_page(rows, "url")).collect()}
    event = got["https://b.example/1"]
    assert (event.titulo, event.tipo, event.fecha_inicio, event.hora_inicio, event.lugar, event.precio, event.descripcion) == ("Un taller", "taller", "2026-04-18", "19:30", "Sala 1", "Gratuito", "Texto")
    assert got["https://b.example/un-titulo-2"].titulo == "Un Titulo"
    html = "<h1 class='entry-title'>Muestra</h1><div class='card-body'><ul><li><strong>Fecha:</strong> 01/05/2026</li><li><strong>Lugar:</strong> Sala 2</li></ul><p>Entrada libre</p></div>"
    event = normalize.museum_events(pages.museum_page(spark.createDataFrame([("https://m.example/1", html)], "url string, html string"), "url")).first()
    assert (event.titulo, event.fecha_inicio, event.lugar, event.precio, event.descripcion) == ("Muestra", "2026-05-01", "Sala 2", "Gratuito", "Entrada libre")


def test_event_page_edges(spark):
    """A null page leaves the seed, a page with nothing has its path's category, a price of 0 is none, JSON that is no object is none."""
    seed = "struct<titulo:string,categoria_principal:string,descripcion_corta:string,fecha_inicio:string,fecha_fin:string,ubicacion_nombre:string,ubicacion_direccion:string,precio_desde:double,moneda:string,imagen_principal:string>"
    given = ("t", "c", "d", "2026-01-01", None, "Sala", "Lince", 5.0, "USD", "i.png")
    rows = [
        ("https://t.example/events/arte/1", None, given),
        ("https://t.example/events/arte/2", "", None),
        ("https://t.example/x", '<script type="application/ld+json">{"@type":"Event","name":["no"],"offers":{"price":0},"location":"Lima","image":{"url":"u"}}</script><b class=price>S/ 9</b>', given),
        ("https://t.example/x", '<script>{"activity": [1], "blogs": 1}</script><script type="application/ld+json">[1, "a", {"@type":"Event"}]</script>', None),
    ]
    df = spark.createDataFrame(rows, f"url string, html string, seed {seed}")
    got = pages.event_page(df, seed="seed").collect()
    assert (got[0].titulo, got[0].categoria_principal, got[0].descripcion_completa, got[0].precio_desde, got[0].moneda, got[0].distrito) == ("t", "c", None, 5.0, "USD", None)
    assert (got[1].titulo, got[1].categoria_principal, got[1].precio_desde, got[1].moneda, got[1].ciudad) == (None, "arte", None, "PEN", "Lima")
    assert (got[2].precio_desde, got[2].ubicacion_nombre, got[2].distrito, got[2].imagen_principal) == (5.0, "Sala", "Lince", "i.png")
    assert (got[3].titulo, got[3].categoria_principal) == (None, None)


def test_feed_links(spark):
    html = "<a href='/events/teatro/a?x=1'>a</a><a href='https://t.example/events/teatro/a#y'>again</a><a href='/events/musica/b/'>b</a><a href='https://other.example/events/teatro/c'>c</a><a>d</a>"
    rows = spark.createDataFrame([(1, html), (2, None)], "k int, html string")
    assert pages.event_links(rows, "https://t.example", "teatro", "k").first().links == ["https://t.example/events/teatro/a"]
    assert pages.event_links(rows, "https://t.example", "danza", "k").first().links == ["https://t.example/events/teatro/a", "https://t.example/events/musica/b"]
