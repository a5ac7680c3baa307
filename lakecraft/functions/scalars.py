"""Column -> Column library; every function is a built-in expression, so nothing leaves the JVM.

Null, NaN, blank and the text ``nan`` all count as missing, a true 0 does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup

# Category fragments and their categories; the first fragment that a name contains decides.
CATEGORIES = (
    ("centro_cultural", "evento_cultural"), ("galeria_de_arte", "galeria"), ("iglesia_histórica", "iglesia"), ("iglesia_historica", "iglesia"), ("catedral", "iglesia"),
    ("mirador", "mirador"), ("sitio_turístico", "sitio_turistico"), ("sitio_turistico", "sitio_turistico"), ("acuario", "naturaleza"), ("laguna", "naturaleza"), ("playa", "naturaleza"),
    ("parque_temático", "parque"), ("parque_tematico", "parque"), ("parque", "parque"), ("museo", "museo"), ("patrimonio_cultural", "patrimonio"), ("malecon", "mirador"), ("malecón", "mirador"),
    ("zoologico", "naturaleza"), ("zoológico", "naturaleza"), ("sitio_arqueológico", "patrimonio"), ("sitio_arqueologico", "patrimonio"), ("plaza_historica", "patrimonio"),
    ("parque_de_diversiones", "parque"), ("bibliocine", "cine"), ("charla, conversatorio y/o conferencia", "evento_cultural"), ("conversatorio", "evento_cultural"), ("taller", "taller"),
    ("exposición", "galeria"), ("exposicion", "galeria"), ("concierto", "concierto"), ("teatro", "teatro"), ("danza", "danza"), ("infantil", "familia"), ("familia", "familia"),
    ("recorrido", "tour"), ("tour", "tour"), ("gastronomía", "gastronomia"), ("gastronomia", "gastronomia"), ("concerts", "concierto"), ("exhibitions", "galeria"), ("theater", "teatro"),
    ("gastronomy", "gastronomia"), ("culture", "evento_cultural"), ("family", "familia"), ("sports", "deporte"), ("workshop", "taller"), ("comidas & bebidas", "gastronomia"),
    ("stand-up", "teatro"), ("arte & cultura", "evento_cultural"), ("entertainment", "evento_cultural"),
)
# Districts, in the order in which they are looked for.
DISTRICTS = ("Ate", "Barranco", "Brena", "Carabayllo", "Chaclacayo", "Chorrillos", "Cieneguilla", "Comas", "El Agustino", "Independencia", "Jesus Maria", "La Molina", "La Victoria", "Lima", "Lince", "Los Olivos", "Lurin", "Magdalena", "Miraflores", "Pachacamac", "Pucusana", "Pueblo Libre", "Puente Piedra", "Punta Hermosa", "Punta Negra", "Rimac", "San Bartolo", "San Borja", "San Isidro", "San Juan de Lurigancho", "San Juan de Miraflores", "San Luis", "San Martin de Porres", "San Miguel", "Santa Anita", "Santa Maria del Mar", "Santa Rosa", "Santiago de Surco", "Surquillo", "Villa El Salvador", "Villa Maria del Triunfo")
# Months, and the words of the two price classes that are looked for in this order.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
FREE = ("gratuito", "libre", "gratis", "free")
PAID = ("pago", "entrada", "ticket", "s/.", "soles", "pen")
GEOHASH = "0123456789bcdefghjkmnpqrstuvwxyz"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str) -> Column:
    """A text that is blank or ``nan`` as null, else trimmed of blanks."""
    t = F.trim(_c(c).cast("string"))
    return F.when((t != "") & (t != "nan"), t)


def first_present(*cols: Column | str) -> Column:
    """The first column that is neither null, blank nor ``nan``, trimmed."""
    return F.coalesce(*[missing_to_null(c) for c in cols])


def clean_text(c: Column | str) -> Column:
    """TXT-1: white space of any kind to one blank, trimmed; missing to null (``nan`` only as the whole text)."""
    raw = _c(c).cast("string")
    t = F.trim(F.regexp_replace(raw, r"(?U)\s+", " "))
    return F.when((t != "") & (raw != "nan"), t)


def token(c: Column | str) -> Column:
    """TXT-2: cleaned and lower-case, missing as the empty text."""
    return F.coalesce(F.lower(clean_text(c)), F.lit(""))


def title_case(c: Column | str) -> Column:
    """Every run of letters with a capital first letter, so ``o'higgins 2do`` gives ``O'Higgins 2Do``."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(_c(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def district_name(c: Column | str) -> Column:
    """TXT-3: underscores and hyphens as blanks, then title case."""
    return title_case(clean_text(F.regexp_replace(_c(c), "[_-]", " ")))


def category(c: Column | str) -> Column:
    """TXT-4: the category of the first known fragment, else the name in lower case, ``cultural`` if missing."""
    name = F.lower(missing_to_null(c))
    found = F.coalesce(*[F.when(F.contains(name, F.lit(part)), F.lit(to)) for part, to in CATEGORIES])
    return F.coalesce(found, name, F.lit("cultural"))


def tags_text(c: Column | str) -> Column:
    """TXT-5: an array of tags as cleaned text, joined with commas."""
    return F.array_join(F.filter(F.transform(_c(c), clean_text), lambda x: x.isNotNull()), ", ")


def title_from_url(c: Column | str) -> Column:
    """TXT-6: the last path segment without a closing number, hyphens as blanks, title case."""
    last = F.element_at(F.split(F.regexp_replace(_c(c), "/+$", ""), "/"), -1)
    return F.nullif(title_case(F.trim(F.regexp_replace(F.regexp_replace(last, r"-\d+$", ""), "-", " "))), F.lit(""))


def labelled(parts: list[tuple[str, Column]], compat_none: bool = False) -> Column:
    """``label: value`` parts joined with bars; parts without a value are left out.

    ``compat_none`` writes a null value as the text ``None``, as historic catalogs have it.
    """
    value = lambda v: F.coalesce(v.cast("string"), F.lit("None")) if compat_none else F.coalesce(v.cast("string"), F.lit(""))
    texts = F.array(*[F.when(value(v) != "", F.concat(F.lit(f"{k}: "), value(v))) for k, v in parts])
    return F.array_join(F.filter(texts, lambda x: x.isNotNull()), " | ")


def embedding_text(compat_none: bool = False) -> Column:
    """TXT-7: the text that is embedded for a catalog row, by its columns; 12 parts for places, 7 for events."""
    c = F.col
    place = [("Lugar", c("titulo")), ("Nombre del lugar", c("titulo")), ("Categoría", F.coalesce(clean_text("categoria_google"), clean_text("tipo"), F.lit(""))), ("Distrito", F.coalesce(district_name("distrito"), F.lit(""))), ("Dirección", c("direccion")), ("Ciudad", F.concat(F.coalesce("ciudad", F.lit("Lima")), F.lit(", Perú"))), ("Descripción", c("descripcion")), ("Rating promedio", F.coalesce(c("rating").cast("string"), F.lit(""))), ("Cantidad de reseñas", F.coalesce(c("ratings_total").cast("string"), F.lit(""))), ("Reseñas destacadas", c("resumen_reviews")), ("Precio", c("precio")), ("Tags", F.coalesce(tags_text("tags"), F.lit("")))]
    event = [("Evento", c("titulo")), ("Tipo", c("tipo")), ("Lugar", c("lugar")), ("Ciudad", F.lit("Lima, Perú")), ("Descripción", c("descripcion")), ("Precio", c("precio")), ("Tags", F.coalesce(tags_text("tags"), F.lit("")))]
    return F.when(F.lower("entity_type") == "place", labelled(place, compat_none)).otherwise(labelled(event, compat_none))


def with_enrichment(text: Column, image: Column, summary: Column, tags: Column) -> Column:
    """TXT-8: the embedding text with what a model said about the row."""
    more = F.filter(F.array(F.concat(F.lit("Imagen: "), missing_to_null(image)), F.concat(F.lit("Resumen: "), missing_to_null(summary)), F.concat(F.lit("AI_Tags: "), F.nullif(tags_text(tags), F.lit("")))), lambda x: x.isNotNull())
    return F.array_join(F.concat(F.filter(F.array(missing_to_null(text)), lambda x: x.isNotNull()), more), " | ")


def category_slug(c: Column | str, fallback: str) -> Column:
    """TXT-9: lower case, white space as single hyphens, everything else but letters, digits and hyphens dropped."""
    raw = F.lower(markup.strip(F.coalesce(F.nullif(_c(c).cast("string"), F.lit("")), F.lit(fallback))))
    slug = F.regexp_replace(F.regexp_replace(raw, r"(?U)\s+", "-"), r"[^a-z0-9-]", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(fallback))


def district_in(c: Column | str, longest: bool = False) -> Column:
    """TXT-10: the first listed district that a text contains; with ``longest`` the longest one."""
    names = sorted(DISTRICTS, key=lambda d: -len(d)) if longest else DISTRICTS
    low = F.lower(_c(c))
    return F.coalesce(*[F.when(F.contains(low, F.lit(d.lower())), F.lit(d)) for d in names])


def second_segment(c: Column | str) -> Column:
    """TXT-11: what stands between the first and second comma, else the whole text."""
    return F.when(F.contains(_c(c), F.lit(",")), F.trim(F.split_part(_c(c), F.lit(","), F.lit(2)))).otherwise(_c(c))


def first_number(c: Column | str) -> Column:
    """TXT-12: the first number in a text, comma or point before its decimals."""
    return F.regexp_replace(F.nullif(F.regexp_extract(_c(c).cast("string"), r"\d+(?:[.,]\d+)?", 0), F.lit("")), ",", ".").try_cast("double")


def safe_float(c: Column | str) -> Column:
    """TXT-13: a number or null; NaN is null."""
    return F.nanvl(missing_to_null(c).try_cast("double"), F.lit(None).cast("double"))


def parse_dates(c: Column | str) -> Column:
    """DATE-1: struct(start, end) of ISO texts: an ISO prefix, ``18 de Abril del 2026``, or one or two dd/mm/yyyy. Not validated."""
    t = _c(c)
    long_date = r"(?iU)(\d{1,2}) de (\w+) del? (\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(t, long_date, 2)))
    spelled = F.when(month > 0, F.format_string("%s-%02d-%02d", F.regexp_extract(t, long_date, 3), month, F.regexp_extract(t, long_date, 1).try_cast("int")))
    days = F.transform(F.regexp_extract_all(t, F.lit(r"(\d{2}/\d{2}/\d{4})"), F.lit(1)), lambda d: F.concat(F.substring(d, 7, 4), F.lit("-"), F.substring(d, 4, 2), F.lit("-"), F.substring(d, 1, 2)))
    iso = t.rlike(r"^\d{4}-\d{2}-\d{2}")
    start = F.when(iso, F.substring(t, 1, 10)).otherwise(F.coalesce(spelled, F.get(days, F.lit(0))))
    return F.struct(start.alias("start"), F.when(~iso & spelled.isNull(), F.get(days, F.lit(1))).alias("end"))


def to_date(c: Column | str) -> Column:
    """DATE-2: a valid date or null; the time of day of an ISO text is dropped."""
    return F.substring(missing_to_null(c), 1, 10).try_cast("date")


def to_utc(c: Column | str) -> Column:
    """DATE-3: an instant or null, under a UTC session."""
    return missing_to_null(c).try_cast("timestamp")


def parse_time(c: Column | str) -> Column:
    """TIME-1: the first h:mm with an optional AM or PM as HH:MM. Hours are not validated."""
    t, pattern = _c(c), r"(?iU)(\d{1,2}):(\d{2})\s*(AM|PM)?"
    hour, half = F.regexp_extract(t, pattern, 1).try_cast("int"), F.upper(F.regexp_extract(t, pattern, 3))
    hour = F.when((half == "PM") & (hour != 12), hour + 12).when((half == "AM") & (hour == 12), 0).otherwise(hour)
    return F.when(hour.isNotNull(), F.format_string("%02d:%s", hour, F.regexp_extract(t, pattern, 2)))


def time_of_iso(c: Column | str) -> Column:
    """TIME-2: HH:MM after the T of an ISO text."""
    return F.nullif(F.regexp_replace(F.regexp_extract(_c(c), r"T\d\d:\d\d", 0), "T", ""), F.lit(""))


def price_class(c: Column | str) -> Column:
    """PRICE-1: Gratuito, Pago or Consultar by the words that the text contains, also inside other words."""
    low = F.lower(F.coalesce(_c(c), F.lit("")))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return F.when(has(FREE), "Gratuito").when(has(PAID), "Pago").otherwise("Consultar")


def availability_price(c: Column | str) -> Column:
    """PRICE-2: Consultar if tickets are available, else Gratuito."""
    return F.when(_c(c) == "available", "Consultar").otherwise("Gratuito")


def entity_id(source: Column | str, url: Column) -> Column:
    """HASH-1: 16 hex digits of the MD5 of source and URL."""
    source = F.lit(source) if isinstance(source, str) else source
    return F.substring(F.md5(F.concat(source, F.lit("::"), F.coalesce(url, F.lit("")))), 1, 16)


def poi_id() -> Column:
    """HASH-2: ``poi_`` and 24 hex digits of the SHA-1 of a row's stable parts, by its columns."""
    event = F.concat_ws("|", F.lit("v1"), F.lit("event"), *[token(c) for c in ("fuente", F.coalesce(missing_to_null("url_evento"), missing_to_null("url_origen")), "fecha_inicio", "hora_inicio", "lugar", "titulo", "categoria_normalizada")])
    stable = F.coalesce(*[F.nullif(token(c), F.lit("")) for c in ("place_id", F.coalesce(missing_to_null("url_origen"), missing_to_null("url_evento")), geohash(F.col("lat"), F.col("lng")), "titulo")], F.lit(""))
    place = F.concat_ws("|", F.lit("v1"), F.lit("place"), token("fuente"), stable, token("categoria_normalizada"))
    return F.concat(F.lit("poi_"), F.substring(F.sha1(F.when(token("entity_type") == "place", place).otherwise(event)), 1, 24))


def geohash(lat: Column, lng: Column, precision: int = 7) -> Column:
    """GEO-1: base-32 geohash. A point on a cell's border belongs to the upper cell; the poles and 180 degrees to the last one."""
    bits = 5 * precision
    nx, ny = (bits + 1) // 2, bits // 2
    x = F.least(F.floor((lng + 180) / 360 * (1 << nx)).cast("long"), F.lit((1 << nx) - 1))
    y = F.least(F.floor((lat + 90) / 180 * (1 << ny)).cast("long"), F.lit((1 << ny) - 1))
    letters = []
    for i in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5 * i, 5 * i + 5):  # longitude and latitude take turns
            whole, left = (x, nx - 1 - b // 2) if b % 2 == 0 else (y, ny - 1 - b // 2)
            value = value * 2 + F.shiftright(whole, left).bitwiseAND(F.lit(1))
        letters.append(F.substring(F.lit(GEOHASH), (value + 1).cast("int"), F.lit(1)))
    inside = (F.abs(lat) <= 90) & (F.abs(lng) <= 180) & ~F.isnan(lat) & ~F.isnan(lng)
    return F.when(inside, F.concat(*letters))


def address_of(direction: Column | str, venue: Column | str) -> Column:
    """GEO-2: the address to look up: the street, else the venue in Lima, else null."""
    return F.coalesce(missing_to_null(direction), F.concat(missing_to_null(venue), F.lit(", Lima, Perú")))


def tags_of(c: Column | str) -> Column:
    """ARR-1: tags from the text of a list or from comma-separated text."""
    t = missing_to_null(c)
    parsed = F.when(t.startswith("["), F.from_json(t, "array<string>"))
    return F.coalesce(F.filter(F.transform(F.coalesce(parsed, F.split(t, ",")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def reviews_summary(reviews: Column | str, most: int = 2, chars: int = 220, least: int = 20) -> Column:
    """ARR-2: the first distinct reviews of enough letters, cut, joined with bars; case does not make them distinct."""
    # Folded over, so that each review is cleaned once: (the keys seen, the texts taken).
    state = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("taken"))

    def take(acc: Column, x: Column) -> Column:
        new = (F.size(acc["taken"]) < most) & (F.length(x["x"]) >= least) & ~F.array_contains(acc["seen"], x["k"])
        return F.when(F.coalesce(new, F.lit(False)), F.struct(F.array_append(acc["seen"], x["k"]).alias("seen"), F.array_append(acc["taken"], F.substring(x["x"], 1, chars)).alias("taken"))).otherwise(acc)

    cleaned = F.transform(_c(reviews), lambda r: F.transform(F.array(clean_text(r)), lambda t: F.struct(F.lower(t).alias("k"), t.alias("x"))))
    return F.nullif(F.array_join(F.aggregate(F.flatten(cleaned), state, take, lambda acc: acc["taken"]), " | "), F.lit(""))


def ld_json(html: Column | str) -> Column:
    """JSON-1: the first ld+json item whose type is an event, as variant."""
    blocks = F.regexp_extract_all(_c(html), F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    parsed = F.transform(blocks, lambda b: F.try_parse_json(b))
    items = F.flatten(F.transform(parsed, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    return F.get(F.filter(items, lambda v: F.try_variant_get(v, "$['@type']", "string").isin("Event", "MusicEvent", "SocialEvent")), F.lit(0))


def activity_json(html: Column | str) -> Column:
    """JSON-2: the object after ``"activity":`` in a page's script, as variant; what follows it has to be one of the known keys."""
    return F.try_parse_json(markup.object_after(_c(html), "activity", ("blogs", "related", "recommended")))


def links(html: Column | str) -> Column:
    """HTML-1: the targets of all anchors."""
    return F.regexp_extract_all(_c(html), F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def tag_text(html: Column | str, tag: str) -> Column:
    """HTML-2: the text of the first such element, inner tags removed."""
    inner = F.regexp_extract(_c(html), rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    return clean_text(F.regexp_replace(inner, r"<[^>]*>", " "))


def list_map(html: Column | str) -> Column:
    """HTML-3: ``<li><strong>key:</strong> value</li>`` items as a map; of equal keys the last value stays."""
    items = F.transform(F.regexp_extract_all(_c(html), F.lit(r"(?is)<li[^>]*>\s*<(?:strong|b|span)[^>]*>(.*?</(?:strong|b|span)>.*?)</li>"), F.lit(1)), lambda x: F.split(x, r"(?i)</(?:strong|b|span)>", 2))
    text = lambda p, k: clean_text(F.regexp_replace(F.get(p, F.lit(k)), r"<[^>]*>", " "))
    pairs = F.transform(items, lambda p: F.struct(F.nullif(F.regexp_replace(F.coalesce(text(p, 0), F.lit("")), r"\s*:$", ""), F.lit("")).alias("k"), text(p, 1).alias("v")))
    return markup.last_of_equal_keys(pairs)


def meta_content(html: Column | str, name: str) -> Column:
    """HTML-4: the content of a meta property."""
    return F.nullif(F.regexp_extract(_c(html), rf'(?i)<meta[^>]*property="{name}"[^>]*content="([^"]*)"', 1), F.lit(""))


def plain_url(c: Column | str, base: str | None = None) -> Column:
    """URL-1: without fragment, query and closing slashes; a path is joined to ``base``."""
    t = _c(c)
    if base:
        t = F.when(t.startswith("/"), F.concat(F.lit(base.rstrip("/")), t)).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, r"[?#].*$", ""), "/+$", "")


def event_url(c: Column | str, base: str) -> Column:
    """FIL-5: an event's URL on ``base``, without fragment, query and closing slashes; null for any other."""
    on_base = lambda url: F.when(F.contains(url, F.lit("/events/")) & url.startswith(base.rstrip("/")), url)
    return markup.let(markup.strip(_c(c)), lambda t: markup.let(plain_url(t, base), on_base))


def item_url(direct: list[Column], slug: Column, category_name: str, base: str) -> Column:
    """URL-2: the first direct candidate that is an event's URL on ``base`` or a path to one, else one made from the slug."""
    urls = [event_url(missing_to_null(d), base) for d in direct]
    path = F.nullif(F.regexp_replace(missing_to_null(slug), "^/+|/+$", ""), F.lit(""))
    made = F.concat(F.lit(f"{base.rstrip('/')}/events/"), category_slug(F.lit(category_name), category_name), F.lit("/"), path)
    return F.coalesce(*urls, event_url(made, base))


def percent_encode(c: Column | str) -> Column:
    """URL-3: percent encoding with %20 for a blank."""
    return F.replace(F.url_encode(_c(c)), F.lit("+"), F.lit("%20"))


def category_in_url(c: Column | str) -> Column:
    """URL-4: the path segment after ``/events/``."""
    return F.nullif(F.regexp_extract(_c(c), r"/events/([^/?#]+)/", 1), F.lit(""))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(_c(v), _c(v)))
