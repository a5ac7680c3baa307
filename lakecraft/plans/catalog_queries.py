"""Registered queries of what is particular to the catalog: generic tables are shaped into raw rows, each query stands beside its SQL."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import dedup, enrich, lifecycle, normalize, quality, vectors
from ..schemas import GOLD_CATALOG, VERSION
from ..sources import readers
from ..sources.lake import BronzeManifest, Lake, SilverManifest
from ..sources.positions import Positions
from .queries import _DOT, query, table

RUN_TS = "2026-04-25 05:23:46"
_TITLE = "list_aggregate(list_transform(regexp_extract_all(lower({0}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"


def _category(k: str) -> str:
    when = " ".join(f"when contains({k}, '{part}') then '{to}'" for part, to in s.CATEGORIES)
    return f"coalesce(case {when} else {k} end, 'cultural')"


def _lines(c: str) -> Column:
    """Arrays as one text, so that both engines compare them alike."""
    return F.array_join(c, "|")


# PRJ-1, PRJ-8: library events.
_LIBRARY = """p as (select p_partkey k, 'https://bnp.example/agenda/' || replace(p_name, ' ', '-') || '-' || p_partkey url, case when p_partkey % 3 > 0 then p_name || ' x' end titulo, p_name,
    case p_partkey % 4 when 0 then 'Bibliocine' when 1 then 'Taller' when 3 then p_type end tipo, case when p_partkey % 5 < 3 then p_brand end sede, p_partkey % 3 fee, p_partkey % 2 odd from part)"""


@query(f"""with {_LIBRARY} select k, substr(md5('bnp::' || url), 1, 16) entity_id, coalesce(titulo, {_TITLE.format("p_name")}) titulo, {_category("lower(tipo)")} tipo, {_category("lower(tipo)")} categoria_normalizada,
    case odd when 0 then '2026-04-05' else '2026-02-01' end fecha_inicio, case odd when 1 then '2026-04-03' end fecha_fin, case odd when 0 then '18:30' else '10:05' end hora_inicio,
    coalesce(sede, 'Biblioteca Nacional del Perú') lugar, case fee when 0 then 'Gratuito' when 1 then 'Pago' else 'Consultar' end precio, array_to_string(list_filter([tipo, coalesce(sede, 'Biblioteca Nacional del Perú')], lambda x: x is not null), '|') tags,
    '2026-04-25' fecha_run, '{VERSION}' schema_version from p""")
def q_library_events(spark, d):
    """PRJ-1, PRJ-8, DATE-1, TIME-1, PRICE-1, TXT-6, HTML-3's map."""
    k, name = F.col("p_partkey"), F.col("p_name")
    raw = table(spark, d, "part").select(
        k.alias("k"),
        F.concat(F.lit("https://bnp.example/agenda/"), F.replace(name, F.lit(" "), F.lit("-")), F.lit("-"), k).alias("url"),
        F.when(k % 3 > 0, F.concat(F.lit("  "), name, F.lit(" \t x "))).alias("titulo"),
        F.when(k % 4 == 0, "Bibliocine").when(k % 4 == 1, "Taller").when(k % 4 == 2, " ").otherwise(F.col("p_type")).alias("tipo"),
        F.create_map(F.lit("Sede"), F.when(k % 5 < 3, F.col("p_brand")), F.lit("Ingreso"), F.when(k % 3 == 0, "Libre").when(k % 3 == 1, "Entrada S/. 20").otherwise("")).alias("etiquetas"),
        F.when(k % 2 == 0, "Sábado, 5 de Abril del 2026 6:30PM").otherwise("01/02/2026 - 03/04/2026 10:05 am").alias("info_adicional"),
    )
    rows = normalize.finish(normalize.library_events(raw), RUN_TS).join(raw.select("k", s.entity_id("bnp", F.col("url")).alias("entity_id")), "entity_id")
    return rows.select("k", "entity_id", "titulo", "tipo", "categoria_normalizada", "fecha_inicio", "fecha_fin", "hora_inicio", "lugar", "precio", _lines("tags").alias("tags"), F.col("fecha_run").cast("string").alias("fecha_run"), "schema_version")


@query(f"""with p as (select s_suppkey k, 'https://mali.example/' || s_suppkey url, s_name n, s_suppkey % 3 r, case s_suppkey % 4 when 0 then 'Exhibitions' when 1 then 'CINE' end tipo from supplier)
    select k, substr(md5('mali::' || url), 1, 16) entity_id, n titulo, {_category("lower(tipo)")} tipo, case r when 0 then '2026-03-09' when 1 then '2025-12-31' end fecha_inicio, case when r < 2 then '20:00' end hora_inicio,
    case when r = 0 then n else 'MALI - Museo de Arte de Lima' end lugar, 'Paseo Colón 125, Lima' direccion, case r when 0 then 'Pago' when 1 then 'Gratuito' else 'Consultar' end precio,
    array_to_string(list_filter([tipo, case when r = 0 then n else 'MALI - Museo de Arte de Lima' end, 'museo', 'arte'], lambda x: x is not null), '|') tags from p""")
def q_museum_events(spark, d):
    """PRJ-2."""
    k, r, name = F.col("s_suppkey"), F.col("s_suppkey") % 3, F.col("s_name")
    raw = table(spark, d, "supplier").select(
        k.alias("k"), F.concat(F.lit("https://mali.example/"), k).alias("url"), name.alias("titulo"), F.when(k % 4 == 0, "Exhibitions").when(k % 4 == 1, "CINE").alias("tipo"), F.when(r == 0, "2026-03-09T10:00:00").otherwise("nan").alias("fecha"), F.when(r == 1, "31/12/2025").alias("fecha_lista"),
        F.when(r < 2, "8:00 pm").alias("hora"), F.when(r == 0, name).otherwise(" ").alias("lugar"), F.when(r == 0, "Ticket: 30").when(r == 1, "Ingreso LIBRE con ticket").alias("descripcion"),
    )
    rows = normalize.museum_events(raw).join(raw.select("k", s.entity_id("mali", F.col("url")).alias("entity_id")), "entity_id")
    return rows.select("k", "entity_id", "titulo", "tipo", "fecha_inicio", "hora_inicio", "lugar", "direccion", "precio", _lines("tags").alias("tags"))


@query(f"""with p as (select o_orderkey k, o_orderkey % 4 r, 'https://shop.example/e/' || o_orderkey url, o_orderpriority c, strftime(o_orderdate, '%Y-%m-%d') as d0 from orders)
    select k, substr(md5('joinnus::' || url), 1, 16) entity_id, c titulo, {_category("case r when 0 then 'concerts' when 1 then 'teatro' end")} tipo, d0 fecha_inicio, '21:15' hora_inicio, case when r = 3 then 'Arena' else 'Sala ' || r end lugar,
    case when r = 0 then 'Gratuito' else 'Consultar' end precio, array_to_string(list_filter([case r when 0 then 'concerts' when 1 then 'teatro' end, case when r = 3 then 'Arena' else 'Sala ' || r end, 'A ' || r, 'B'], lambda x: x is not null), '|') tags from p""")
def q_ticket_events(spark, d):
    """PRJ-3, TXT-11, PRICE-2."""
    k, r = F.col("o_orderkey"), F.col("o_orderkey") % 4
    url = F.concat(F.lit("https://shop.example/e/"), k)
    raw = table(spark, d, "orders").select(
        k.alias("k"), F.when(r < 2, url).otherwise("nan").alias("canonical_url"), url.alias("source_url"), F.col("o_orderpriority").alias("title"), F.when(r == 0, "concerts").when(r == 1, "teatro").when(r == 2, "").alias("category"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("date"), F.lit("21:15").alias("time"),
        F.when(r == 3, "Arena").otherwise(F.concat(F.lit("Peru, Sala "), r, F.lit(" , Lima"))).alias("location"), F.concat(F.lit("A "), r, F.lit(" ; B;nan;")).alias("performer_list"), F.when(r > 0, "available").otherwise("sold out").alias("ticket_availability"),
    )
    rows = normalize.ticket_events(raw).join(raw.select("k", s.entity_id("joinnus", F.col("source_url")).alias("entity_id")), "entity_id")
    return rows.select("k", "entity_id", "titulo", "tipo", "fecha_inicio", "hora_inicio", "lugar", "precio", _lines("tags").alias("tags"))


def _place_items(spark, d) -> DataFrame:
    """One JSON text for each supplier, in the three shapes that places come in."""
    k = F.col("s_suppkey")
    new = F.to_json(F.struct(F.concat(F.lit("p"), k).alias("id"), F.struct(F.col("s_name").alias("text")).alias("displayName"), F.lit("museo").alias("primaryType"), F.struct((k % 90).cast("double").alias("latitude"), F.lit(-77.5).alias("longitude")).alias("location"), F.concat(F.lit("https://maps.example/"), k).alias("googleMapsUri"), F.array(F.lit("museo"), F.lit("nan"), F.lit("arte"), F.lit("museo")).alias("types"), F.lit("san_juan-de o'higgins").alias("distrito"), F.array(F.struct(F.lit("un lugar muy bonito para ir").alias("review_text")), F.struct(F.lit("UN lugar muy  bonito para ir").alias("review_text")), F.struct(F.lit("corto").alias("review_text"))).alias("reviews")))
    old = F.to_json(F.struct(F.col("s_name").alias("title"), F.lit("Cine").alias("categoria"), F.lit("4.5").alias("rating"), F.lit("12").alias("ratings_total"), F.lit("-12.25").alias("lat"), F.lit("x").alias("lng"), F.concat(F.lit("https://old.example/"), k).alias("url"), F.lit("Av. 1").alias("vicinity")))
    bare = F.to_json(F.struct(F.concat(F.lit("q"), k).alias("place_id"), F.lit("nan").alias("name"), F.lit("").alias("title"), F.lit(0).alias("rating")))
    return table(spark, d, "supplier").select(k.alias("k"), F.when(k % 3 == 0, new).when(k % 3 == 1, old).otherwise(bare).alias("item"))


@query("""select s_suppkey k, case s_suppkey % 3 when 0 then 'p' || s_suppkey when 2 then 'q' || s_suppkey end place_id, case when s_suppkey % 3 < 2 then s_name end "name", case s_suppkey % 3 when 0 then 'museo' when 1 then 'Cine' end category,
    case s_suppkey % 3 when 1 then '4.5' when 2 then '0' end rating, case when s_suppkey % 3 = 1 then '12' end reviews_total, case s_suppkey % 3 when 0 then 'https://maps.example/' || s_suppkey when 1 then 'https://old.example/' || s_suppkey end maps_url, case when s_suppkey % 3 = 1 then 'Av. 1' end formatted_address, 'Lima' city from supplier""")
def q_place_records(spark, d):
    """PRJ-5: of each field's paths the first with a value; a 0 is one."""
    items = _place_items(spark, d)
    rows = normalize.place_records(items.select(F.struct("k", "item").alias("both")).select("both.item", "both.k").withColumn("item", F.expr("concat('{\"archivo\":\"', k, '\",', substring(item, 2))")))
    return rows.select(F.col("archivo").cast("bigint").alias("k"), "place_id", "name", "category", "rating", F.col("user_ratings_total").alias("reviews_total"), "maps_url", "formatted_address", "city")


@query("""with p as (select s_suppkey k, s_suppkey % 3 r, s_name n from supplier)
    select k, substr(md5('google_places::' || case r when 0 then 'https://maps.example/' || k when 1 then 'https://old.example/' || k else 'q' || k end), 1, 16) entity_id, case when r < 2 then n end titulo, case r when 0 then 'museo' when 1 then 'cine' else 'cultural' end tipo,
    case r when 0 then 'San Juan De O''Higgins' end distrito, case r when 0 then 'Lugar en San Juan De O''Higgins de tipo museo' when 1 then 'Lugar en Lima de tipo cine con rating 4.5' else 'Lugar en Lima de tipo cultural con rating 0.0' end descripcion,
    case r when 0 then 'museo|arte|San Juan De O''Higgins' when 1 then 'Cine' else '' end tags, case r when 0 then (k % 90)::double when 1 then -12.25 end lat, case r when 0 then -77.5 end::double lng, case r when 1 then 4.5 when 2 then 0.0 end::double rating,
    case r when 1 then 12 end::bigint ratings_total, case r when 0 then 'un lugar muy bonito para ir' end resumen_reviews from p""")
def q_places(spark, d):
    """PRJ-4, TXT-3, TXT-13, ARR-2, DED-5."""
    items = _place_items(spark, d)
    rows = normalize.places(normalize.place_records(items))
    url = F.when(F.col("k") % 3 == 0, F.concat(F.lit("https://maps.example/"), "k")).when(F.col("k") % 3 == 1, F.concat(F.lit("https://old.example/"), "k")).otherwise(F.concat(F.lit("q"), "k"))
    return rows.join(items.select("k", s.entity_id("google_places", url).alias("entity_id")), "entity_id").select("k", "entity_id", "titulo", "tipo", "distrito", "descripcion", _lines("tags").alias("tags"), "lat", "lng", "rating", "ratings_total", "resumen_reviews")


@query("""with p as (select o_orderkey k, o_orderkey % 4 r, o_orderpriority c, strftime(o_orderdate, '%Y-%m-%dT') || '20:30:00' t, o_orderpriority pr from orders)
    select k, case when r = 1 then 'breve' else coalesce(case when r <> 3 then c end, 'Evento en Joinnus') || '. Categoria: ' || case when r = 2 then 'cultural' else pr end || '. Inicio: ' || t || '. Lugar: ' || case r when 0 then 'Sala (Lince)' when 3 then 'Lima' else 'Teatro Lince' end || '. '
    || case when r = 0 then 'desde 12.50 PEN' else 'precio por confirmar' end || '.' end description, '20:30' "time", 'Peru, ' || case r when 0 then 'Sala' when 3 then 'Lima' else 'Teatro Lince' end || ', Lima' "location", 'available' ticket_availability from p""")
def q_ticket_raw(spark, d):
    """PRJ-6, TIME-2."""
    k, r = F.col("o_orderkey"), F.col("o_orderkey") % 4
    events = table(spark, d, "orders").select(
        k.alias("k"), F.concat(F.lit("u"), k).alias("url"), F.when(r != 3, F.col("o_orderpriority")).alias("titulo"), F.when(r != 2, F.col("o_orderpriority")).alias("categoria_principal"), F.when(r == 1, "breve").otherwise(" ").alias("descripcion_corta"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T20:30:00")).alias("fecha_inicio"), F.when(r == 0, "Sala").when(r != 3, "Teatro Lince").alias("ubicacion_nombre"), F.when(r == 0, F.lit(12.5)).alias("precio_desde"), F.when(r < 3, "Lince").alias("distrito"),
    )
    return normalize.ticket_raw(events).select("k", "description", "time", "location", "ticket_availability")


@query("""select s_suppkey k, case s_suppkey % 4 when 0 then 'https://t.example/events/' || s_suppkey when 1 then 'https://t.example/events/arte/' || s_suppkey when 2 then 'https://t.example/events/arte--cultura/slug-' || s_suppkey end url, s_name titulo,
    case when s_suppkey % 4 = 1 then 'Música' else 'Arte & Cultura' end categoria_principal, case s_suppkey % 4 when 0 then 'Sala' when 1 then 'Plaza' when 2 then 'Casa' end ubicacion_nombre, case when s_suppkey % 4 = 0 then 20.5 end::double precio_desde,
    case s_suppkey % 4 when 0 then 'i.png' when 1 then 'j.png' when 2 then 'k.png' end imagen_principal, 'PEN' moneda from supplier""")
def q_seeds(spark, d):
    """PRJ-7, URL-2, FIL-5, TXT-9, TXT-12."""
    k, lit = F.col("s_suppkey"), F.lit
    a = F.to_json(F.struct(F.col("s_name").alias("title"), F.concat(lit("https://t.example/events/"), k, lit("?x=1")).alias("url"), F.struct(lit("Sala").alias("venue")).alias("location"), F.array(F.struct(lit("i.png").alias("imageUrl"))).alias("images"), lit("S/ 20,5").alias("price")))
    b = F.to_json(F.struct(F.col("s_name").alias("name"), lit("relative").alias("canonicalUrl"), F.concat(lit("/events/arte/"), k, lit("/#y")).alias("urlRedirection"), lit("Música").alias("activityCategory"), lit("Plaza").alias("location"), lit("j.png").alias("images")))
    c = F.to_json(F.struct(F.col("s_name").alias("title"), lit("https://blog.example/post").alias("canonicalUrl"), lit("https://blog.example/events/x").alias("url"), F.concat(lit("/slug-"), k, lit("/")).alias("slug"), F.struct(lit(" Casa ").alias("localName")).alias("location"), F.array(lit("k.png")).alias("images")))
    items = table(spark, d, "supplier").select(F.when(k % 4 == 0, a).when(k % 4 == 1, b).when(k % 4 == 2, c).otherwise(F.to_json(F.struct(F.col("s_name").alias("title")))).alias("item"))
    rows = normalize.seeds(items, "Arte & Cultura", "https://t.example/")
    return rows.join(table(spark, d, "supplier").select(F.col("s_name").alias("titulo"), k.alias("k")), "titulo").select("k", "url", "titulo", "categoria_principal", "ubicacion_nombre", "precio_desde", "imagen_principal", "moneda")


@query(f"""select 'e' || o_orderkey entity_id, case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y-%m-%d') end fecha_inicio, case when o_orderkey % 2 = 0 then o_totalprice end lat,
    cast(null as varchar) titulo, '{VERSION}' schema_version, {len(GOLD_CATALOG)}::bigint n_columns from orders""")
def q_conform(spark, d):
    """PRJ-9, DATE-2: missing columns null, others dropped, values that don't fit null."""
    k = F.col("o_orderkey")
    raw = table(spark, d, "orders").select(F.concat(F.lit("e"), k).alias("entity_id"), F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("2026-13-40").alias("fecha_inicio"), F.when(k % 2 == 0, F.col("o_totalprice").cast("string")).otherwise("abc").alias("lat"), F.lit("0").alias("schema_version"), F.lit(1).alias("extra"))
    out = normalize.conform(raw, GOLD_CATALOG)
    return out.select("entity_id", F.col("fecha_inicio").cast("string").alias("fecha_inicio"), "lat", "titulo", "schema_version", F.lit(len(out.columns)).cast("bigint").alias("n_columns"))


@query("""select 'e' || p_partkey entity_id, case when p_partkey % 2 = 0 then 'place' else 'event' end entity_type, case when p_partkey % 3 = 0 then 'o' else 'v' end url_origen, replace(p_name, ' ', '|') tags from part where p_partkey % 5 > 0""")
def q_documents_of(spark, d):
    """PRJ-10, FIL-8, ARR-1."""
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.when(k % 5 > 0, F.concat(F.lit("e"), k)).when(k % 2 == 0, " ").otherwise("nan").alias("entity_id"), F.when(k % 2 == 0, "place").when(k % 3 == 0, "").alias("entity_type"), F.when(k % 3 == 0, "o").otherwise(" ").alias("url_origen"), F.lit("v").alias("url_evento"), F.when(k % 2 == 0, F.to_json(F.split("p_name", " "))).otherwise(F.replace("p_name", F.lit(" "), F.lit(", "))).alias("tags"))
    return normalize.documents_of(rows).select("entity_id", "entity_type", "url_origen", _lines("tags").alias("tags"))


# DED-1..3, FIL-1, FIL-2, SET-2, SRT-1 over one shaped catalog.
_CATALOG = """r as (select o_orderkey k, ['bnp', 'mali', 'joinnus', 'joinnus', 'google_places'][o_orderkey % 5 + 1] fuente, case when o_orderkey % 5 = 4 then 'place' else 'event' end entity_type, 'e' || (o_orderkey // 2) entity_id,
    'T' || (o_custkey % 40) titulo, 'd' || repeat('x', cast(o_orderkey % 17 as integer)) descripcion, strftime(o_orderdate + interval 28 year, '%Y-%m') || '-01' fecha_inicio, '20:00' hora_inicio, 'L' || (o_custkey % 3) lugar, 'teatro' tipo, 'u' || o_orderkey url_origen, 'poi' || o_orderkey poi_id from orders)"""


@query(f"""with {_CATALOG}, a as (select *, fuente = 'joinnus' shop, row_number() over (partition by entity_id order by list_position(['bnp', 'mali', 'joinnus', 'google_places'], fuente), url_origen) n from r),
    b as (select *, row_number() over (partition by shop, case when shop then concat_ws('||', lower(titulo), fecha_inicio, hora_inicio, lower(lugar), tipo) else entity_id end order by length(descripcion) desc, url_origen) n2 from a where n = 1),
    c as (select * from b where n2 = 1 and not (shop and (fecha_inicio < '2020-01-01' or fecha_inicio > '2027-12-31'))),
    e as (select *, row_number() over (partition by shop, case when shop then concat_ws('||', lower(titulo), fecha_inicio) else entity_id end order by length(descripcion) desc, url_origen) n3 from c)
    select entity_id, fuente, url_origen, fecha_inicio, row_number() over (order by fecha_inicio nulls last, entity_id) pos from e where n3 = 1""")
def q_dedup_catalog(spark, d):
    """DED-1..3, FIL-1, FIL-2, SET-2, SRT-1."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, d, "orders").select(
        F.get(F.array(*map(F.lit, ("bnp", "mali", "joinnus", "joinnus", "google_places"))), (o % 5).cast("int")).alias("fuente"), F.when(o % 5 == 4, "place").otherwise("EVENT").alias("entity_type"), F.concat(F.lit("e"), F.floor(o / 2)).alias("entity_id"), F.concat(F.when(o % 2 == 0, " T").otherwise("t"), c % 40, F.lit(" ")).alias("titulo"), F.concat(F.lit("d"), F.repeat(F.lit("x"), (o % 17).cast("int"))).alias("descripcion"),
        F.concat(F.date_format(F.add_months("o_orderdate", 28 * 12), "yyyy-MM"), F.lit("-01")).alias("fecha_inicio"), F.lit("20:00").alias("hora_inicio"), F.concat(F.lit("L"), c % 3).alias("lugar"), F.lit("teatro").alias("tipo"), F.concat(F.lit("u"), o).alias("url_origen"), F.concat(F.lit("poi"), o).alias("poi_id"),
    )
    return vectors.id_map(dedup.dedup_catalog(rows).withColumn("key", F.struct(F.col("fecha_inicio").isNull(), "fecha_inicio", "entity_id")).withColumn("embedding", F.struct("fuente", "url_origen")).select(F.struct("key", "embedding").alias("row"), F.lit(1).alias("embedding")), "row").select("row.key.entity_id", "row.embedding.fuente", "row.embedding.url_origen", "row.key.fecha_inicio", (F.col("pos") + 1).alias("pos"))


def _coordinates(address: str) -> tuple[float, float] | None:
    """A provider for the geocoding queries: knows addresses of odd length, breaks on those with an x at their end."""
    if address.endswith("x, Lima, Perú") and len(address) % 2 == 0:
        raise OSError("no route")
    return (float(len(address)), -1.0) if len(address) % 2 else None


@query("""with r as (select c_custkey k, case when c_custkey % 4 = 3 then 'place' else 'event' end t, case when c_custkey % 4 = 1 then 5.0 end::double lat, case c_custkey % 2 when 0 then c_name end dir, 'Sala ' || (c_custkey % 7) || case when c_custkey % 3 = 0 then 'x' else '' end lugar from customer),
    w as (select *, case when t = 'event' and lat is null then coalesce(dir, lugar || ', Lima, Perú') end a from r)
    select k, case when t = 'event' and lat is null then case when k % 5 = 0 and dir is not null then 1.0 when length(a) % 2 = 1 then length(a) end else lat end::double lat from w""")
def q_geocode(spark, d):
    """FIL-3, GEO-2, JOIN-1, JOIN-2: cached addresses first, then the provider once for each address."""
    rows, cache = _geocoding(spark, d)
    out, _, _ = enrich.geocode(rows, cache, _coordinates)
    return out.select("k", "lat")


@query("""with r as (select c_custkey k, case when c_custkey % 4 <> 3 and c_custkey % 4 <> 1 then coalesce(case c_custkey % 2 when 0 then c_name end, 'Sala ' || (c_custkey % 7) || case when c_custkey % 3 = 0 then 'x' else '' end || ', Lima, Perú') end a from customer)
    select 'c' || k id, a address, case when a like '%x, Lima, Perú' then 'OSError: no route' else 'no results' end reason from r
    where a is not null and length(a) % 2 = 0 and a not in (select c_name from customer where c_custkey % 5 = 0 and c_custkey % 2 = 0)""")
def q_rejected_addresses(spark, d):
    """SNK-13: rows that the provider has no coordinates for, or breaks on, each with the reason."""
    rows, cache = _geocoding(spark, d)
    return enrich.geocode(rows.withColumn("poi_id", F.concat(F.lit("c"), "k")), cache, _coordinates)[2]


def _geocoding(spark, d) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.alias("k"), F.when(k % 4 == 3, "place").otherwise("event").alias("entity_type"), F.when(k % 4 == 1, F.lit(5.0)).when(k % 4 == 2, F.lit(float("nan"))).alias("lat"), F.lit(None).cast("double").alias("lng"), F.when(k % 2 == 0, F.col("c_name")).otherwise("nan").alias("direccion"), F.concat(F.lit("Sala "), k % 7, F.when(k % 3 == 0, "x").otherwise("")).alias("lugar"))
    cache = table(spark, d, "customer").where((k % 5 == 0) & (k % 2 == 0)).select(F.col("c_name").alias("address"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"))
    return rows, cache


@query("select s_suppkey k, case when s_suppkey % 4 < 3 then s_suppkey + 0.5 end::double lat, case when s_suppkey % 4 < 3 then -77.25 end::double lng from supplier")
def q_geocode_response(spark, d):
    """SRC-15: three shapes of an answer."""
    k = F.col("s_suppkey")
    shape = lambda body: F.concat(F.lit('{"results":['), body, F.lit("]}"))
    text = F.when(k % 4 == 0, shape(F.format_string('{"location":{"latitude":%s.5,"longitude":-77.25}}', k))).when(k % 4 == 1, shape(F.format_string('{"geometry":{"location":{"latitude":%s.5,"longitude":-77.25}}}', k))).when(k % 4 == 2, shape(F.format_string('{"geometry":{"location":{"lat":%s.5,"lng":-77.25}}}', k))).otherwise(F.lit('{"status":"none"}'))
    at = enrich.geocode_response("r")
    return table(spark, d, "supplier").select(k.alias("k"), text.alias("r")).select("k", at["lat"].alias("lat"), at["lng"].alias("lng"))


@query("""with f as (select o_custkey u, min_by('T' || o_orderkey, o_orderkey) titulo, min_by(o_orderpriority, o_orderkey) c from orders group by 1)
    select c_custkey k, case when c_custkey % 2 = 0 then c_name else f.titulo end titulo, f.c clerk from customer left join f on u = c_custkey""")
def q_seed_join(spark, d):
    """JOIN-3: the first seed of a URL; the event's own values come first."""
    events = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("u"), "c_custkey").alias("url"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("titulo"))
    seeds = table(spark, d, "orders").select(F.concat(F.lit("u"), "o_custkey").alias("url"), F.concat(F.lit("T"), "o_orderkey").alias("titulo"), F.col("o_orderpriority").alias("clerk"), F.col("o_orderkey").alias("n"))
    return enrich.seed_join(events, seeds, ["n"]).select("k", "titulo", "clerk")


@query("select n_regionkey v, count(*) n from (select case when n_nationkey % 3 > 0 then n_regionkey end n_regionkey from nation) group by 1")
def q_value_counts_nulls(spark, d):
    """AGG-2."""
    return quality.value_counts(table(spark, d, "nation").select(F.when(F.col("n_nationkey") % 3 > 0, F.col("n_regionkey")).alias("v")), "v", nulls=True)


_PAIRS = f"select a.vec_id id_a, b.vec_id id_b, {_DOT.format('a.embedding', 'b.embedding')} score from embeddings a, embeddings b where a.vec_id < b.vec_id"


@query(f"select count(*) pairs, round(count(*) / (select count(*) * (count(*) - 1) / 2 from embeddings), 8) ratio from ({_PAIRS}) where score >= 0.45")
def q_pair_ratio(spark, d):
    """AGG-9: near pairs are counted where they are found."""
    return vectors.near_duplicate_count(table(spark, d, "embeddings"), 0.45, id="vec_id").select("pairs", F.round("ratio", 8).alias("ratio"))


@query(f"select id_a, id_b, round(score, 4) score from ({_PAIRS}) where score >= 0.4 order by id_a, id_b limit 10")
def q_first_pairs(spark, d):
    """SRT-5."""
    return vectors.first_pairs(table(spark, d, "embeddings"), 0.4, id="vec_id").withColumn("score", F.round("score", 4))


_RANKED = "select query_id, vec_id, row_number() over (partition by query_id order by score desc, vec_id) k from (select a.vec_id query_id, b.vec_id, {0} score from embeddings a, embeddings b where a.vec_id % 100 = 0)"
_HALVES = f"""x as (select query_id, list(vec_id) l from ({_RANKED.format(_DOT.format("a.embedding", "b.embedding"))}) where k <= 10 group by 1), y as (select query_id, list(vec_id) m from ({_RANKED.format(_DOT.format("a.embedding[1:48]", "b.embedding[1:48]"))}) where k <= 10 group by 1),
    j as (select query_id, len(list_intersect(l, m)) / len(list_distinct(list_concat(l, m))) jaccard from x join y using (query_id))"""


def _overlap(spark, d) -> DataFrame:
    rows, some = table(spark, d, "embeddings"), F.slice("embedding", 1, 48)
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.overlap(vectors.top_k(rows, queries, 10, id="vec_id"), vectors.top_k(rows.withColumn("embedding", some), queries.withColumn("embedding", some), 10, id="vec_id"), "vec_id")


@query(f"with {_HALVES} select count(*) n, round(avg(jaccard), 6) mean, round(min(jaccard), 6) low, round(max(jaccard), 6) high, count(*) filter (jaccard >= 0.5) above from j")
def q_overlap_summary(spark, d):
    """AGG-11."""
    return vectors.overlap_summary(_overlap(spark, d), 0.5).select("n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")], "above")


@query(f"with {_HALVES} select query_id, round(jaccard, 6) jaccard from j order by jaccard desc, query_id limit 10")
def q_report_rows(spark, d):
    """SRT-6: the ten best rows of a comparison."""
    return vectors.report_rows(_overlap(spark, d)).withColumn("jaccard", F.round("jaccard", 6))


@query("""with s as (select o_custkey k, max(o_totalprice) filter (o_orderkey % 2 = 0) a, max(o_totalprice) filter (o_orderkey % 2 = 1) b, bool_or(o_orderkey % 2 = 0) x, bool_or(o_orderkey % 2 = 1) y from orders group by 1)
    select change, count(*) n from (select case when y and not x then 'inserted' when y and a = b then 'same' when y then 'modified' else 'inactivated' end change from s) group by 1""")
def q_change_counters(spark, d):
    """AGG-12 after two full runs."""
    batch = lambda r: table(spark, d, "orders").where(F.col("o_orderkey") % 2 == r).groupBy(F.col("o_custkey").alias("entity_id")).agg(F.max("o_totalprice").alias("value"))
    first = lifecycle.step(None, batch(0), "1", "t1", full_run=True)
    return lifecycle.counters(lifecycle.step(first, batch(1), "2", "t2", full_run=True))


@query("""select s_suppkey k, 'Lugar: ' || s_name || ' | Nombre del lugar: ' || s_name || ' | Categoría: ' || case when s_suppkey % 2 = 0 then 'Museo' else 'cine' end || case when s_suppkey % 3 = 0 then ' | Distrito: San Borja' else '' end || ' | Ciudad: Lima, Perú'
    || case when s_suppkey % 2 = 0 then ' | Descripción: d' else '' end || case when s_suppkey % 5 = 0 then ' | Rating promedio: 4.5 | Cantidad de reseñas: 7' else '' end || ' | Precio: Consultar' || case when s_suppkey % 4 = 0 then ' | Tags: a, b' else '' end texto,
    'poi_' || substr(sha1('v1|place|google_places|' || case when s_suppkey % 2 = 0 then 'id' || s_suppkey else 'http://x/' || s_suppkey end || '|museo'), 1, 24) poi_id from supplier""")
def q_place_text(spark, d):
    """TXT-7 and HASH-2, their branches for places."""
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    rows = table(spark, d, "supplier").select(
        k.alias("k"), F.lit("Place").alias("entity_type"), F.col("s_name").alias("titulo"), F.lit("cine").alias("tipo"), F.when(k % 2 == 0, "Museo").alias("categoria_google"), F.when(k % 3 == 0, "san_borja").alias("distrito"), F.when(k % 2 == 0, "d").alias("descripcion"), F.when(k % 5 == 0, F.lit(4.5)).alias("rating"), F.when(k % 5 == 0, F.lit(7)).alias("ratings_total"), F.lit("Consultar").alias("precio"), F.when(k % 4 == 0, F.array(F.lit(" a"), F.lit("b"), F.lit(" "))).alias("tags"),
        F.lit("google_places").alias("fuente"), F.when(k % 2 == 0, F.concat(F.lit("ID"), k)).alias("place_id"), F.concat(F.lit("http://X/"), k).alias("url_origen"), F.lit("museo").alias("categoria_normalizada"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), *[none.alias(c) for c in ("direccion", "ciudad", "resumen_reviews", "lugar", "url_evento", "fecha_inicio", "hora_inicio")],
    )
    return rows.select("k", s.embedding_text().alias("texto"), s.poi_id().alias("poi_id"))


@query("""with f as (select p_partkey k, row_number() over (order by p_partkey) <= 30 first from part)
    select k, 'texto' || case when first and k % 3 > 0 then ' | Resumen: resumen ' || k else '' end || case when first and k % 3 > 0 then ' | AI_Tags: ' || array_to_string(list_transform(range(1, 21), lambda i: 't' || i), ', ') else '' end texto from f""")
def q_enriched_text(spark, d):
    """TXT-8, ARR-3, WIN-6, ENR-1: the first rows only, twenty tags at most, null where the model fails."""

    class Model:
        def text(self, event: dict) -> str:
            n = int(event["titulo"])
            if n % 3 == 0:
                raise OSError("down") if n % 2 else ValueError("busy")
            return json.dumps({"tags": [f" t{j} " for j in range(1, 31)] + [""], "summary": f"resumen {n} "})

        def caption(self, image_url: str) -> str | None:
            return None

    rows = table(spark, d, "part").select(F.format_string("e%09d", "p_partkey").alias("entity_id"), F.lit(None).cast("string").alias("fecha_inicio"), F.col("p_partkey").cast("string").alias("titulo"), F.lit("d").alias("descripcion"), F.lit("texto").alias("texto_embedding"))
    return enrich.enrich(rows, Model(), most=30).select(F.substring("entity_id", 2, 9).cast("bigint").alias("k"), F.col("texto_embedding").alias("texto"))


@query("""select s_suppkey k, 'Av.%20' || s_suppkey || '%2C%20Per%C3%BA%20%26%20m%C3%A1s' encoded from supplier""")
def q_percent_encode(spark, d):
    """URL-3."""
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), s.percent_encode(F.concat(F.lit("Av. "), "s_suppkey", F.lit(", Perú & más"))).alias("encoded"))


@query("""select o_orderkey k from orders where o_orderpriority = '2-HIGH' union all select 1000000000 + o_orderkey from orders""")
def q_filter_or_all(spark, d):
    """FIL-4: a filter that would leave nothing leaves all."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    some, every = dedup.filter_or_all(rows, F.col("o_orderpriority") == "2-HIGH"), dedup.filter_or_all(rows, F.col("o_orderpriority") == "no such")
    return some.select("k").unionByName(every.select((F.col("k") + 1_000_000_000).alias("k")))


@query("""select c_custkey k, array_to_string(list_transform(list_sort(list_transform(list_distinct(l), lambda c: list_position(l, c))), lambda i: l[i]), '|') categories from (select c_custkey, list(o_orderpriority order by o_orderkey) l from customer join orders on o_custkey = c_custkey group by 1)""")
def q_categories_in_order(spark, d):
    """DED-7: distinct values in the order of their first appearance."""
    lists = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"]).alias("l"))
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return lists.join(known, "k").select("k", _lines(dedup.in_order_distinct("l")).alias("categories"))


@query("select distinct unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=\"([^\"]*)\"', 1)) link from pages")
def q_distinct_links(spark, d):
    """DED-4."""
    return table(spark, d, "pages").select(F.explode(s.links("html")).alias("link")).distinct()


@query("""select vec_id::varchar entity_id, case label % 3 when 0 then 'teatro' when 1 then 'cine' end tipo, label < 5 is_active, case when label < 5 then 0 else 1 end missing_full_runs, 'r' || case when label < 5 then 2 else 1 end last_seen_run_id, len(embedding)::bigint width from embeddings""")
def q_vector_state(spark, d):
    """LIFE-5, SNK-11: vectors with filter columns, two runs; rows that the second lacks become inactive."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("entity_id"), "label", "embedding", F.lit("hashing").alias("model_name"))
    catalog = rows.select("entity_id", F.when(F.col("label") % 3 == 0, "teatro").when(F.col("label") % 3 == 1, "cine").alias("tipo"), F.lit("bnp").alias("fuente"), F.lit("2026-01-01").alias("fecha_inicio"))
    one = lifecycle.vector_step(None, rows, catalog, "r1", "t1", full_run=True)
    two = lifecycle.vector_step(one, rows.where("label < 5"), catalog, "r2", "t2", full_run=True)
    return two.select("entity_id", "tipo", "is_active", "missing_full_runs", "last_seen_run_id", F.size("embedding").cast("bigint").alias("width"))


@query("""select 'p' || p_partkey poi_id, p_name nombre, case when p_partkey % 2 = 0 then 1.5 end::double lat, '' fuente, case when p_partkey % 3 = 0 then 2 end::bigint width, case when p_partkey % 4 > 0 then p_type else 'cultural' end categoria_normalizada from part""")
def q_poi_catalog(spark, d):
    """SNK-7, JOIN-4, TXT-13: names of the export, defaults, vectors by id."""
    k, none = F.col("p_partkey"), F.lit(None).cast("string")
    rows = table(spark, d, "part").select(k.cast("string").alias("entity_id"), F.concat(F.lit("p"), k).alias("poi_id"), F.col("p_name").alias("titulo"), F.when(k % 2 == 0, "1.5").otherwise("NaN").alias("lat"), F.lit("x").alias("lng"), F.lit("").alias("geo_hash"), F.when(k % 4 > 0, F.col("p_type")).alias("categoria_normalizada"), none.alias("rating"), none.alias("fuente"), none.alias("fecha_run"))
    own = table(spark, d, "part").where(k % 3 == 0).select(k.cast("string").alias("entity_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    out = normalize.poi_catalog(rows, own)
    return out.select("poi_id", "nombre", "lat", "fuente", F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("bigint").alias("width"), "categoria_normalizada")


@query("""with m as (select vec_id, row_number() over (order by vec_id) - 1 pos from embeddings) select pos, vec_id, label from m join embeddings using (vec_id) where pos % 7 = 3""")
def q_position_join(spark, d):
    """JOIN-5, SNK-9: positions of a written index to ids to rows."""
    rows = table(spark, d, "embeddings")
    index = Positions.write(rows.where("embedding is not null").select("vec_id"), "vec_id")
    asked = index.read().where("pos % 7 = 3").select("pos")
    return vectors.at_positions(index, rows.select("vec_id", "label"), asked, "vec_id").select("pos", "vec_id", "label")


@query("""select 'p' || p_partkey entity_id, p_name titulo, p_type tipo, p_retailprice rating, p_size::bigint ratings_total, p_brand categoria_google, 'r' || p_partkey resumen_reviews, p_retailprice score,
    'entity_id titulo tipo categoria_google rating ratings_total resumen_reviews' metadata, 'entity_id titulo tipo score' result from part""")
def q_default_projections(spark, d):
    """PRJ-11, PRJ-12: of the default columns those that there are, in their order, whatever the order of the rows' own."""
    part = table(spark, d, "part")
    rows = part.select(
        F.lit(0).alias("other"), F.concat(F.lit("r"), "p_partkey").alias("resumen_reviews"), F.col("p_retailprice").alias("score"), F.col("p_size").cast("bigint").alias("ratings_total"), F.col("p_brand").alias("categoria_google"),
        F.col("p_type").alias("tipo"), F.col("p_retailprice").alias("rating"), F.col("p_name").alias("titulo"), F.concat(F.lit("p"), "p_partkey").alias("entity_id"),
    )
    found, meta = normalize.search_result(rows), normalize.metadata(rows)
    names = {"metadata": F.lit(" ".join(meta.columns)), "result": F.lit(" ".join(found.columns))}
    return meta.join(found.select("entity_id", "score"), "entity_id").withColumns(names)


@query("""select count(*) n_rows, count(*) filter (event_id % 10 > 0) sane, 'r20260102' latest, 'r20260101' previous, 'PASS' verdict from events""")
def q_lake(spark, d):
    """SNK-1, SNK-2, SNK-5, SRC-9, SRC-10, SRC-13, SRC-14, WIN-3, JSON-4, DQ-1, SNK-14: two runs through the lake's layout and back."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lakecraft-")  # one machine, as in tests
    lake = Lake(spark, f"{root.rstrip('/')}/lake-{uuid.uuid4().hex}")
    events = table(spark, d, "events").select("event_id", "event_type", F.when(F.col("event_id") % 10 > 0, F.lit(1.0)).otherwise(F.lit(float("nan"))).alias("x"))
    for run in ("20260101", "20260102"):
        entry = lake.write_bronze(events, "bnp", run, RUN_TS)
        lake.write_manifest(BronzeManifest(run, RUN_TS, [entry]))
        path = lake.write(events, "silver", "eventos_estandar", run)
        lake.write_manifest(SilverManifest(run, RUN_TS, path, entry.row_count_estimate or 0))
    latest = lake.latest("silver")
    lines = readers.read_jsonl(spark, lake.bronze("bnp", latest))
    told = readers.line_counts(lines).first()
    report = quality.check_bronze({"bnp": tuple(told)}, {e["name"]: e["row_count_estimate"] for e in lake.manifest("bronze", latest)["sources"]}, ("bnp",))
    back = lake.read("silver", "eventos_estandar", latest).count()
    sane = lines.where(F.get_json_object("line", "$.x").isNotNull()).count()
    return spark.createDataFrame([(back, sane, f"r{latest}", f"r{lake.previous('silver', 'eventos_estandar', latest)}", report.verdict)], "n_rows long, sane long, latest string, previous string, verdict string")


_BEST = "select id_a v, score from ({0}) union all select id_b, score from ({0})".format(_PAIRS)


@query(f"""with n as (select vec_id, sqrt({_DOT.format('embedding', 'embedding')}) n from embeddings), p as ({_PAIRS}), t as (select v, max(score) top from ({_BEST}) group by 1),
    s as (select vec_id, n * n own, coalesce(top, -1) top from n left join t on v = vec_id), h as (select * from s order by md5(vec_id || '|42'), vec_id limit 300)
    select count(*) n, round(stddev_pop(n), 6) norm_std, (select count(*) from p where score >= 0.95) near_duplicates, (select round(avg(top), 5) from t) top1_mean, (select round(median(top), 5) from t) top1_median,
        (select avg(case when own > top then 1.0 else 0.0 end) from h) recall_at_1, case when avg(case when abs(n - 1) <= 0.001 then 1.0 else 0.0 end) < 0.95 then 'WARN' else 'PASS' end verdict from n""")
def q_check_gold(spark, d):
    """DQ-3, DQ-4, DQ-6, AGG-6, AGG-8, AGG-10: widths, norms, nearest rows, near duplicates and recall of the rows' own vectors as queries."""
    rows = table(spark, d, "embeddings").withColumnRenamed("vec_id", "entity_id")
    report = quality.check_gold(rows, declared=None, dimension=64, queries=rows.select(F.col("entity_id").alias("query_id"), "embedding"))
    m = report.metrics
    told = (m["n"], round(m["norm_std"], 6), m["near_duplicates"], round(m["top1_mean"], 5), round(m["top1_median"], 5), m["recall_at_1"], report.verdict)
    return spark.createDataFrame([told], "n long, norm_std double, near_duplicates long, top1_mean double, top1_median double, recall_at_1 double, verdict string")
