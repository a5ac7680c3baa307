"""Registered queries about pages: elements, scripts, raw rows of the sources; each beside its SQL.

The pages are made from the tables, so that what stands in them is known to SQL without reading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import pages
from .queries import query, table


def _dealt(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """A table's rows over all cores: a few bytes of a row become a page here, so the table's splits are far too few for the work."""
    return table(spark, d, name).select(*columns).repartition(4 * spark.sparkContext.defaultParallelism)


def _when(test, text):
    return F.when(test, text).otherwise(F.lit(""))


@query("""with p as (select p_partkey k, p_name n, p_partkey % 2 = 1 ld, p_partkey // 2 % 2 = 1 act, p_partkey // 4 % 2 = 1 seed, p_partkey // 8 % 2 = 1 nodes, p_partkey // 16 % 2 = 1 meta from part)
    select k, case when ld then 'LD ' || n when seed then 'seed ' || k when meta then 'meta "title"' end titulo, case when act then 'teatro' else 'arte' end categoria_principal,
        case when seed then 'seed text' when meta then 'meta text' when act then 'act text' end descripcion_corta, case when act then 'act text' else 'block of text' end descripcion_completa,
        case when ld then '2026-05-01T20:00' when seed then '2026-01-01' end fecha_inicio, case when act then 'Act venue' when ld then 'LD venue' when seed then 'Seed venue' end ubicacion_nombre,
        case when act then 'Jr. 2, Miraflores' when ld then 'Av. 1, Lince' when seed then 'Ca. 3, Surquillo' end ubicacion_direccion,
        case when act and k % 3 <> 0 then 7 when ld then 12.5 when seed then 30 when nodes then 40.25 end::double precio_desde, case when ld and k % 3 = 1 then 'USD' else 'PEN' end moneda,
        case when act then 'poster.png' when ld then 'ld.png' when seed then 'seed.png' when meta then 'meta.png' end imagen_principal, case when act then 'Miraflores' when ld then 'Lince' when seed then 'Surquillo' end distrito from p""")
def q_event_page(spark, d):
    """SRC-5, JSON-1, JSON-2, HTML-2, HTML-4, AGG-13, URL-4: pages on which ld+json, activity, seed, meta tags and elements compete."""
    k, lit = F.col("p_partkey"), F.lit
    bit = lambda n: F.floor(k / n) % 2 == 1
    offers = F.when(k % 3 == 1, F.to_json(F.struct(lit("12,50").alias("price"), lit("USD").alias("priceCurrency")))).otherwise('[{"price":"S/ 20"},{"price":"12,50"},{"price":null}]')
    ld = F.concat(
        lit('<script type="application/ld+json">{broken</script><SCRIPT id="a" type="application/ld+json">[{"@type":"Organization","name":"no"},{"@type":"MusicEvent","name":"LD '),
        "p_name",
        lit('","startDate":"2026-05-01T20:00","image":["ld.png","other.png"],"location":{"name":"LD venue","address":{"streetAddress":"Av. 1, Lince","addressLocality":"Lima"}},"offers":'),
        offers,
        lit("}]</SCRIPT>"),
    )
    price = F.when(k % 3 == 0, "0").otherwise("7")
    act = F.concat(lit('<script>x={"activity": {"loc": {"a": {"b": 1}}, "note": "} \\" {", "category": "teatro", "description": " act  text", "localName": "Act venue", "addressRef": "Jr. 2, Miraflores", "priceFrom": '), price, lit(', "imagePosterUrl": "poster.png", "imageUrl": "small.png"} , "related":[]}</script>'))
    meta = lit("<meta content='meta &quot;title&quot;' property=\"og:title\"><meta property='og:description' content='meta text'><meta property=\"og:image\" content=\"meta.png\">")
    nodes = lit('<div class="big price"><span>S/</span> <div>45.5</div></div><p data-cy="x-price-y">desde 40,25<p class="ticket-price">99')
    block = lit('<h1>no title</h1><div class="x description-html"><div>block <b>of</b></div>text</div><div>outside</div>')
    seed = F.struct(
        F.concat(lit("seed "), k).alias("titulo"), lit("musica").alias("categoria_principal"), lit("seed text").alias("descripcion_corta"), lit("2026-01-01").alias("fecha_inicio"), lit(None).cast("string").alias("fecha_fin"),
        lit("Seed venue").alias("ubicacion_nombre"), lit("Ca. 3, Surquillo").alias("ubicacion_direccion"), lit(30.0).alias("precio_desde"), lit(None).cast("string").alias("moneda"), lit("seed.png").alias("imagen_principal"),
    )
    html = F.concat(_when(bit(16), meta), _when(k % 2 == 1, ld), _when(bit(2), act), block, _when(bit(8), nodes))
    rows = _dealt(spark, d, "part", "p_partkey", "p_name").select(k.alias("k"), html.alias("html"), F.concat(lit("https://t.example/events/arte/"), k, lit("/x")).alias("url"), F.when(bit(4), seed).alias("seed"))
    names = ("titulo", "categoria_principal", "descripcion_corta", "descripcion_completa", "fecha_inicio", "ubicacion_nombre", "ubicacion_direccion", "precio_desde", "moneda", "imagen_principal", "distrito")
    return pages.event_page(rows, "k", seed="seed").select("k", *names)


@query("""select p_partkey k, case p_partkey % 6 when 0 then 'nested' when 1 then '} " {' when 2 then 'recommended' end b from part""")
def q_activity_json(spark, d):
    """JSON-2: objects within, braces in strings, each end; no object without a known key behind it or without an end."""
    k, lit = F.col("p_partkey"), F.lit
    cases = {0: '{"loc": {"a": {}}, "b": "nested"}, "blogs": []', 1: '{"b": "} \\" {", "c": []}\n , "related": 1', 2: '{"x": {"blogs": 2, "y": {"related": {}}}, "b": "recommended"},"recommended":{}', 3: '{"b": "no end"', 4: '{"b": "another key"}, "other": 1', 5: "{b: broken}, \"blogs\": []"}
    html = F.concat(lit('<p>{</p><script>s = {"first": {}, "activity" : '), F.coalesce(*[F.when(k % 6 == n, lit(t)) for n, t in cases.items()]), lit("}</script>"))
    return _dealt(spark, d, "part", "p_partkey").select(k.alias("k"), F.try_variant_get(s.activity_json(html), "$.b", "string").alias("b"))


@query("""select p_partkey k, case when p_partkey % 4 = 0 then p_type else p_name || ' & ' || p_partkey end titulo, 'Taller' tipo, 'Auditorio ' || p_partkey sede, case when p_partkey % 3 = 0 then 'libre' end ingreso, case when p_partkey % 3 = 0 then 2 else 1 end::bigint labels,
    case when p_partkey % 5 > 0 then 'i/' || p_partkey || '.png' end imagen, 'Texto de ' || p_partkey descripcion, 'Hora 7:30 PM hoy' info_adicional, 'Pago' estado from part""")
def q_library_page(spark, d):
    """SRC-1, HTML-1, HTML-2, HTML-3: a library's event page with open and nested tags; of equal labels the last value."""
    k, lit = F.col("p_partkey"), F.lit
    title = F.when(k % 4 == 0, F.concat(lit("<h2> "), "p_type", lit("</h2>"))).otherwise(F.concat(lit("<h2>sub</h2><h1>\n <em>"), "p_name", lit("</em> &amp; "), k, lit("</h1>")))
    html = F.concat(
        title,
        lit('<!-- <h1>no</h1> --><span style="color:red">no</span><span class=x style="color:red; background-color: #fff"> Taller </span><ul><li><span>Sede</span><span>A</span><span>Sala</span>'),
        _when(k % 3 == 0, lit("<li><span>Ingreso</span>: <ul><li>inner</li></ul><span> libre </span></li>")),
        lit("<li><span>only</span><li><span>Sede\nmore</span> <b><span>Auditorio "),
        k,
        lit('</span></b></ul><div><p>intro <span>AM</p><p class="x descripcion">Texto <b>de</b> '),
        k,
        lit("<p>Hora 7:30 PM\n <i> hoy </i></div><div><strong> Pago </strong></div>"),
        _when(k % 5 > 0, F.concat(lit("<img class='a img-event-detail' alt=\"a > b\" src=i/"), k, lit(".png>"))),
    )
    # The first paragraph with AM has to lose against none: it is taken out of the page below.
    rows = _dealt(spark, d, "part", "p_partkey", "p_name", "p_type").select(k.alias("k"), F.replace(html, lit("<span>AM</p>"), lit("</p>")).alias("html"))
    label = lambda name: F.try_element_at("etiquetas", lit(name))
    return pages.library_page(rows, "k").select("k", "titulo", "tipo", label("Sede").alias("sede"), label("Ingreso").alias("ingreso"), F.size("etiquetas").cast("bigint").alias("labels"), "imagen", "descripcion", "info_adicional", "estado")


@query("""select s_suppkey k, 'https://b.example/agenda-cultural/' || s_suppkey || ' https://b.example/agenda-cultural/x' links, 's/' || s_suppkey card, s_name titulo_lista, case when s_suppkey % 2 = 0 then '18/04/2026' end fecha_lista from supplier""")
def q_listing_pages(spark, d):
    """SRC-1, SRC-2: what the library's and the museum's listings link to."""
    k, lit = F.col("s_suppkey"), F.lit
    a = F.concat(lit('<a href="/agenda-cultural/out">no</a><div class="row portfolio"><div><a href="/agenda-cultural/'), k, lit('">x</a></div><a href="/otro/1">no</a><a href=\'/agenda-cultural/x\'>y</a><a href="/agenda-cultural/'), k, lit('">again</a><a>none</a></div><a href="/agenda-cultural/after">no</a>'))
    b = F.concat(lit('<a class="thumblink" href=""><h4>no</h4></a><a href="s/0" class="other"><h4>no</h4></a><a class="thumblink big" href="s/'), k, lit('"><div><h4> '), "s_name", lit("</h4>"), _when(k % 2 == 0, lit("<p>18/04/2026</p>")), lit("</div></a><p>no</p>"))
    rows = _dealt(spark, d, "supplier", "s_suppkey", "s_name").select(k.alias("k"), a.alias("a"), b.alias("b"))
    links = pages.library_links(rows, "https://b.example", "k", html="a").select("k", F.array_join("links", " ").alias("links"))
    cards = pages.museum_cards(rows, "k", html="b")
    return links.join(cards.withColumnRenamed("url", "card"), "k")


@query("""select s_suppkey k, s_name titulo, case when s_suppkey % 2 = 0 then 'Exposición' end tipo, '18 de abril' fecha, case when s_suppkey % 3 > 0 then '7:00 PM' end hora, 'Sala ' || s_suppkey lugar, case when s_suppkey % 3 > 0 then 'Uno y dos. Tres ' || s_suppkey end descripcion, 'm.png' imagen from supplier""")
def q_museum_page(spark, d):
    """SRC-2, HTML-2, HTML-3: a museum's event page: labels and paragraphs of one box, an image within another."""
    k, lit = F.col("s_suppkey"), F.lit
    html = F.concat(
        lit("<h1>site</h1><h1 class='big entry-title'> "),
        "s_name",
        lit("</h1><img src=no.png><div class='post-thumbnail'><figure><img src='m.png'></figure></div><ul><li><strong>Lugar:</strong> outside</li></ul>"),
        _when(k % 2 == 0, lit('<span class="category_item x">Exposici&oacute;n</span>')),
        lit("<div class='card-body'><div><ul><li><strong>Fecha:</strong> 18 de <em>abril</em></li>"),
        _when(k % 3 > 0, lit("<li><b>x</b><li>Hora no<li><p><strong>Hora :</strong> 7:00 PM</p></li>")),
        lit("<li><strong>Lugar:</strong> antes</li><li><strong>Lugar</strong> <span>Sala</span> "),
        k,
        lit("</li></ul></div>"),
        _when(k % 3 > 0, F.concat(lit("<p> Uno <b>y</b> dos.<p></p><div><p>Tres "), k, lit("</p></div>"))),
        lit("</div><p>outside</p><div class='card-body'><p>second</p></div>"),
    )
    # The label's paragraph is one of the box's too, so it is left out of what is compared.
    rows = _dealt(spark, d, "supplier", "s_suppkey", "s_name").select(k.alias("k"), html.alias("html"))
    told = F.nullif(F.trim(F.replace("descripcion", lit("Hora : 7:00 PM"), lit(""))), lit(""))
    return pages.museum_page(rows, "k").withColumn("descripcion", told)
