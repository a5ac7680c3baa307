"""Pages to raw rows: what the sources' listings and detail pages hold, by elements, ld+json and scripts.

Each function parses a page once, into a column that the fields then read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup as m
from ..functions import scalars as s

# The fields of an event that a listing may have given before its page is read.
SEED = ("titulo", "categoria_principal", "descripcion_corta", "fecha_inicio", "fecha_fin", "ubicacion_nombre", "ubicacion_direccion", "precio_desde", "moneda", "imagen_principal")
PAGE = "_page"


def _raw(rows: DataFrame, html: str, fields: dict[str, Column], keep: tuple[str, ...], **more: Column) -> DataFrame:
    parsed = rows.withColumns({PAGE: m.parse(html)} | more)
    return parsed.select(*keep, *[c.alias(name) for name, c in fields.items()])


def library_links(rows: DataFrame, base: str, *keep: str, html: str = "html") -> DataFrame:
    """SRC-1: ``links``: the events that a listing of the library links to, each once."""
    href = F.transform(m.select(PAGE, "div.portfolio a"), lambda e: m.attribute(e["tag"], "href"))
    links = F.array_distinct(F.transform(F.filter(href, lambda h: F.contains(h, F.lit("/agenda-cultural/"))), lambda h: F.concat(F.lit(base), h)))
    return _raw(rows, html, {"links": links}, keep)


def library_page(rows: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """SRC-1: the raw columns of an event of the library (what :func:`~lakecraft.operators.normalize.library_events` takes)."""
    text = lambda selector: m.whole_text(PAGE, m.first(PAGE, selector))

    def label(item: Column) -> Column:
        def pair(spans: Column) -> Column:
            key = F.split_part(m.whole_text(PAGE, F.get(spans, F.lit(0))), F.lit("\n"), F.lit(1))
            return F.when(F.size(spans) >= 2, F.struct(key.alias("k"), m.whole_text(PAGE, F.get(spans, F.size(spans) - 1)).alias("v")))

        return m.let(m.select(PAGE, "span", item), pair)

    told = F.transform(m.select(PAGE, "p"), lambda e: m.joined_text(PAGE, e))
    fields = {
        "titulo": m.whole_text(PAGE, F.coalesce(m.first(PAGE, "h1"), m.first(PAGE, "h2"))),
        "tipo": text("span[style*=background-color]"),
        "etiquetas": m.last_of_equal_keys(F.filter(F.transform(m.select(PAGE, "ul li"), label), lambda p: p.isNotNull())),
        "imagen": m.attribute(m.first(PAGE, "img.img-event-detail")["tag"], "src"),
        "descripcion": text("p.descripcion"),
        "info_adicional": F.get(F.filter(told, lambda t: F.contains(t, F.lit("AM")) | F.contains(t, F.lit("PM"))), F.lit(0)),
        "estado": text("strong"),
    }
    return _raw(rows, html, fields, keep)


def museum_cards(rows: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """SRC-2: (url, titulo_lista, fecha_lista) of each event on a listing of the museum, in the order of the page."""
    text = lambda e, name: m.whole_text(PAGE, m.first(PAGE, name, e))
    cards = F.transform(m.select(PAGE, "a.thumblink"), lambda e: F.struct(m.attribute(e["tag"], "href").alias("url"), text(e, "h4").alias("titulo_lista"), text(e, "p").alias("fecha_lista")))
    found = _raw(rows, html, {"cards": F.filter(cards, lambda c: F.coalesce(c["url"], F.lit("")) != "")}, keep)
    # Outer, as for an inner one Spark infers a filter that parses every page once more, before rows are dealt out.
    return found.select(*keep, F.inline_outer("cards")).where(F.col("url").isNotNull())


def museum_page(rows: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """SRC-2: the raw columns of an event of the museum (what :func:`~lakecraft.operators.normalize.museum_events` takes)."""
    text = lambda selector: m.whole_text(PAGE, m.first(PAGE, selector))

    def label(item: Column) -> Column:
        def pair(strong: Column) -> Column:
            key = m.strip(F.replace(m.whole_text(PAGE, strong), F.lit(":"), F.lit("")))
            return F.when(strong.isNotNull(), F.struct(key.alias("k"), m.joined_text(PAGE, item, strong).alias("v")))

        return m.let(m.first(PAGE, "strong", item), pair)

    def told(box: Column) -> Column:
        texts = F.filter(F.transform(m.select(PAGE, "p", box), lambda e: m.joined_text(PAGE, e)), lambda t: t != "")
        return F.when(box.isNotNull(), F.nullif(F.array_join(texts, " "), F.lit("")))

    labels = F.when(F.col("_box").isNotNull(), m.last_of_equal_keys(F.filter(F.transform(m.select(PAGE, "ul li", F.col("_box")), label), lambda p: p.isNotNull())))
    value = lambda name: F.try_element_at("_labels", F.lit(name))
    fields = {"titulo": text("h1.entry-title"), "tipo": text("span.category_item"), "fecha": value("Fecha"), "hora": value("Hora"), "lugar": value("Lugar"), "descripcion": told(F.col("_box")), "imagen": m.attribute(m.first(PAGE, "div.post-thumbnail img")["tag"], "src")}
    boxed = rows.withColumn(PAGE, m.parse(html)).withColumn("_box", m.first(PAGE, "div.card-body"))
    return boxed.withColumn("_labels", labels).select(*keep, *[c.alias(name) for name, c in fields.items()])


def event_links(rows: DataFrame, base: str, category: str, *keep: str, html: str = "html") -> DataFrame:
    """SRC-4, FIL-4: ``links``: the events of a category that a feed's page links to; all that it links to where none is of the category."""
    found = F.transform(m.select(PAGE, "a[href]"), lambda e: s.event_url(m.attribute(e["tag"], "href"), base))
    found = F.array_distinct(F.filter(found, lambda u: u.isNotNull()))
    own = lambda us: F.filter(us, lambda u: F.contains(u, F.lit(f"/events/{category}/")))
    links = m.let(found, lambda us: m.let(own(us), lambda some: F.when(F.size(some) > 0, some).otherwise(us)))
    return _raw(rows, html, {"links": links}, keep)


def _meta(name: str) -> Column:
    return F.nullif(m.strip(m.attribute(m.first(PAGE, f"meta[property={name}]")["tag"], "content")), F.lit(""))


def _present(c: Column) -> Column:
    """A number unless it is 0, which counts as not given."""
    return F.nullif(c, F.lit(0.0))


def event_page(rows: DataFrame, *keep: str, html: str = "html", url: str = "url", seed: str | None = None) -> DataFrame:
    """SRC-5, AGG-13: an event's fields from its page. ``seed``: a struct column of what its listing gave (SEED's fields).

    Dates, title and venue of ld+json come before those of the seed, the script's activity before both for category,
    venue, address, price and image. Meta tags and elements fill what is still missing: description, and the least of
    the first 20 price nodes. A price of 0 counts as not given. The district is that of the address, else of the venue.
    A null page leaves the seed.
    """
    seeded = lambda name: (F.col(seed)[name] if seed else F.lit(None)).cast("double" if name == "precio_desde" else "string")
    ld, act = F.col("_ld"), F.col("_act")
    text = lambda v, p: F.nullif(F.try_variant_get(v, p, "string"), F.lit(""))
    told = lambda v, p: s.clean_text(text(v, p))
    kind = lambda v, p: F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, p, "variant")), r"^\w+", 0)
    offers = F.try_variant_get(ld, "$.offers", "array<variant>")
    offer = F.coalesce(F.array_min(F.transform(offers, lambda o: s.first_number(F.try_variant_get(o, "$.price", "string")))), s.first_number(text(ld, "$.offers.price")))
    nodes = F.slice(m.select(PAGE, "[data-cy*='price'],.price,.ticket-price"), 1, 20)
    node_price = F.array_min(F.transform(nodes, lambda e: s.first_number(m.joined_text(PAGE, e))))
    located = F.coalesce(told(ld, "$.location.address.streetAddress"), told(ld, "$.location.address.addressLocality"), seeded("ubicacion_direccion"))
    address = F.when(kind(ld, "$.location.address") == "STRING", told(ld, "$.location.address")).otherwise(located)
    image = F.when(kind(ld, "$.image") == "ARRAY", F.coalesce(text(ld, "$.image[0]"), seeded("imagen_principal")))
    image = image.when(kind(ld, "$.image") == "STRING", F.try_variant_get(ld, "$.image", "string")).otherwise(seeded("imagen_principal"))
    short = F.coalesce(F.nullif(seeded("descripcion_corta"), F.lit("")), _meta("og:description"), told(act, "$.description"))
    block = m.let(m.joined_text(PAGE, m.first(PAGE, ".description-html,.content_description")), s.clean_text)
    in_path = F.nullif(F.regexp_extract(url, r"/events/([^/]+)/", 1), F.lit(""))
    fields = {
        "titulo": F.coalesce(told(ld, "$.name"), F.nullif(seeded("titulo"), F.lit("")), _meta("og:title")),
        "categoria_principal": F.coalesce(text(act, "$.category"), in_path, seeded("categoria_principal")),
        "descripcion_completa": F.coalesce(told(act, "$.description"), block, short),
        "descripcion_corta": short,
        "fecha_inicio": F.coalesce(text(ld, "$.startDate"), seeded("fecha_inicio")),
        "fecha_fin": F.coalesce(text(ld, "$.endDate"), seeded("fecha_fin")),
        "ubicacion_nombre": F.coalesce(told(act, "$.localName"), told(ld, "$.location.name"), seeded("ubicacion_nombre")),
        "ubicacion_direccion": F.coalesce(told(act, "$.address"), told(act, "$.addressRef"), address),
        "precio_desde": F.coalesce(_present(s.first_number(text(act, "$.priceFrom"))), _present(offer), seeded("precio_desde"), node_price),
        "moneda": F.coalesce(text(ld, "$.offers.priceCurrency"), F.nullif(seeded("moneda"), F.lit("")), F.lit("PEN")),
        "imagen_principal": F.coalesce(text(act, "$.imagePosterUrl"), text(act, "$.imageUrl"), F.nullif(image, F.lit("")), _meta("og:image")),
        "ciudad": F.lit("Lima"),
    }
    bare = {name: seeded(name) for name in SEED} | {"moneda": F.coalesce(F.nullif(seeded("moneda"), F.lit("")), F.lit("PEN")), "ciudad": F.lit("Lima")}
    read = F.col(html).isNotNull()
    fields = {name: F.when(read, c).otherwise(bare.get(name, F.lit(None).cast("string"))) for name, c in fields.items()}
    out = _raw(rows, html, fields, tuple(dict.fromkeys((*keep, html))), _ld=s.ld_json(html), _act=s.activity_json(html))
    district = F.when(read, F.coalesce(s.district_in("ubicacion_direccion"), s.district_in("ubicacion_nombre")))
    return out.withColumn("distrito", district).select(*keep, *fields, "distrito")
