"""Projections of raw source rows onto the canonical schema, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as s
from ..schemas import VERSION


def _have(df: DataFrame, **kinds: str) -> DataFrame:
    """``df`` with the named columns; those that it lacks are null."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def _texts(df: DataFrame, names: str) -> DataFrame:
    return _have(df, **dict.fromkeys(names.split(), "string"))


def _tags(*parts: Column) -> Column:
    return F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "") & (x != "nan"))


def finish(df: DataFrame, run_ts: str) -> DataFrame:
    """PRJ-8: category default, geohash, run date and identifiers; the run's time is given, never read from a clock."""
    out = _have(df, lat="double", lng="double", place_id="string", rating="double", ratings_total="bigint", categoria_google="string", resumen_reviews="string", distrito="string", direccion="string")
    out = out.withColumns({"categoria_normalizada": F.coalesce(s.missing_to_null("tipo"), F.lit("cultural")), "geo_hash": s.geohash(F.col("lat"), F.col("lng")), "fecha_run": F.lit(run_ts).cast("timestamp").cast("date"), "scraped_at": F.lit(run_ts).cast("timestamp"), "poi_id_version": F.lit("v1"), "event_id": F.col("entity_id"), "schema_version": F.lit(VERSION)})
    return out.withColumn("poi_id", s.poi_id()).withColumn("texto_embedding", s.embedding_text())


def library_events(raw: DataFrame) -> DataFrame:
    """PRJ-1: events of the national library."""
    df = _texts(raw, "url titulo tipo imagen descripcion info_adicional estado")
    labels = F.col("etiquetas") if "etiquetas" in df.columns else F.create_map().cast("map<string,string>")
    fee = F.concat(F.coalesce(F.try_element_at(labels, F.lit("Ingreso")), F.lit("")), F.coalesce("estado", F.lit("")))
    df = df.withColumns({"d": s.parse_dates("info_adicional"), "venue": F.coalesce(s.clean_text(F.try_element_at(labels, F.lit("Sede"))), F.lit("Biblioteca Nacional del Perú")), "kind": s.category("tipo")})
    return df.select(
        s.entity_id("bnp", F.col("url")).alias("entity_id"), F.lit("event").alias("entity_type"), F.coalesce(s.clean_text("titulo"), s.title_from_url("url")).alias("titulo"), s.clean_text("descripcion").alias("descripcion"),
        F.col("kind").alias("tipo"), F.col("d.start").alias("fecha_inicio"), F.col("d.end").alias("fecha_fin"), s.parse_time("info_adicional").alias("hora_inicio"), F.col("venue").alias("lugar"), F.lit("Lima").alias("ciudad"),
        F.col("imagen").alias("imagen_url"), s.price_class(fee).alias("precio"), F.col("url").alias("url_origen"), F.col("url").alias("url_evento"), F.lit("bnp").alias("fuente"), _tags(s.missing_to_null("tipo"), F.col("venue")).alias("tags"),
    )


def museum_events(raw: DataFrame) -> DataFrame:
    """PRJ-2: events of the art museum."""
    df = _texts(raw, "url titulo tipo fecha hora lugar descripcion imagen fecha_lista")
    df = df.withColumns({"d": s.parse_dates(F.coalesce(s.missing_to_null("fecha"), s.missing_to_null("fecha_lista"))), "venue": F.coalesce(s.clean_text("lugar"), F.lit("MALI - Museo de Arte de Lima"))})
    return df.select(
        s.entity_id("mali", F.col("url")).alias("entity_id"), F.lit("event").alias("entity_type"), s.clean_text("titulo").alias("titulo"), s.clean_text("descripcion").alias("descripcion"), s.category("tipo").alias("tipo"),
        F.col("d.start").alias("fecha_inicio"), F.col("d.end").alias("fecha_fin"), s.parse_time("hora").alias("hora_inicio"), F.col("venue").alias("lugar"), F.lit("Paseo Colón 125, Lima").alias("direccion"), F.lit("Lima").alias("ciudad"),
        F.col("imagen").alias("imagen_url"), s.price_class("descripcion").alias("precio"), F.col("url").alias("url_origen"), F.col("url").alias("url_evento"), F.lit("mali").alias("fuente"), _tags(s.missing_to_null("tipo"), F.col("venue"), F.lit("museo"), F.lit("arte")).alias("tags"),
    )


def ticket_events(raw: DataFrame) -> DataFrame:
    """PRJ-3: events of the ticket shop."""
    df = _texts(raw, "title description category date time location image_url performer_list ticket_availability canonical_url source_url")
    url = s.first_present("canonical_url", "source_url")
    df = df.withColumns({"d": s.parse_dates("date"), "venue": s.clean_text(s.second_segment("location"))})
    artists = F.coalesce(F.transform(F.split("performer_list", ";"), lambda x: F.trim(x)), F.array().cast("array<string>"))
    tags = F.filter(F.concat(F.array(s.missing_to_null("category"), F.col("venue")), artists), lambda x: x.isNotNull() & (x != "") & (x != "nan"))
    return df.select(
        s.entity_id("joinnus", url).alias("entity_id"), F.lit("event").alias("entity_type"), s.clean_text("title").alias("titulo"), s.clean_text("description").alias("descripcion"), s.category("category").alias("tipo"),
        F.col("d.start").alias("fecha_inicio"), F.col("d.end").alias("fecha_fin"), s.parse_time("time").alias("hora_inicio"), F.col("venue").alias("lugar"), F.lit("Lima").alias("ciudad"), F.col("image_url").alias("imagen_url"),
        s.availability_price("ticket_availability").alias("precio"), url.alias("url_origen"), url.alias("url_evento"), F.lit("joinnus").alias("fuente"), tags.alias("tags"),
    )


def places(raw: DataFrame) -> DataFrame:
    """PRJ-4: places; ``raw`` as :func:`place_records` gives it."""
    df = _texts(raw, "place_id name title category categoria primary_type maps_url url website formatted_address address distrito image_url description editorial_summary city lat lng rating user_ratings_total reviews_total")
    url = s.first_present("maps_url", "url", "website")
    kind, area, rating = s.first_present("category", "categoria", "primary_type"), s.district_name("distrito"), s.safe_float("rating")
    types = F.col("types").cast("array<string>") if "types" in df.columns and isinstance(df.schema["types"].dataType, T.ArrayType) else s.tags_of("types") if "types" in df.columns else F.array().cast("array<string>")
    tags = F.array_distinct(F.filter(F.concat(F.coalesce(types, F.array().cast("array<string>")), F.array(kind, area)), lambda x: x.isNotNull() & (x != "") & (x != "nan")))
    reviews = F.transform("reviews", lambda r: r["review_text"]) if "reviews" in df.columns else F.lit(None).cast("array<string>")
    told = F.concat(F.lit("Lugar en "), F.coalesce(area, F.lit("Lima")), F.lit(" de tipo "), s.category(kind), F.coalesce(F.concat(F.lit(" con rating "), rating.cast("string")), F.lit("")))
    title = s.clean_text(s.first_present("title", "name"))
    return df.select(
        s.entity_id("google_places", s.first_present(url, "place_id", "name")).alias("entity_id"), F.lit("place").alias("entity_type"), title.alias("titulo"), F.coalesce(s.clean_text("description"), s.clean_text("editorial_summary"), told).alias("descripcion"), s.category(kind).alias("tipo"),
        F.lit(None).cast("string").alias("fecha_inicio"), F.lit(None).cast("string").alias("fecha_fin"), F.lit(None).cast("string").alias("hora_inicio"), title.alias("lugar"), s.clean_text(s.first_present("formatted_address", "address")).alias("direccion"), area.alias("distrito"), F.coalesce(s.missing_to_null("city"), F.lit("Lima")).alias("ciudad"),
        s.missing_to_null("image_url").alias("imagen_url"), F.lit("Consultar").alias("precio"), url.alias("url_origen"), url.alias("url_evento"), F.lit("google_places").alias("fuente"), tags.alias("tags"), s.safe_float("lat").alias("lat"), s.safe_float("lng").alias("lng"),
        s.missing_to_null("place_id").alias("place_id"), rating.alias("rating"), s.first_present("user_ratings_total", "reviews_total").try_cast("double").cast("bigint").alias("ratings_total"), kind.alias("categoria_google"), s.reviews_summary(reviews).alias("resumen_reviews"),
    )


# For each field of a place record the paths of an item that may hold it, in order.
PLACE_PATHS = {
    "place_id": "place_id id name", "name": "name title displayName.text displayName", "title": "title name displayName.text displayName", "category": "category categoria primaryType primary_type", "categoria": "categoria category primaryType primary_type",
    "primary_type": "primary_type primaryType category", "rating": "rating average_rating", "user_ratings_total": "user_ratings_total ratings_total userRatingCount", "reviews_total": "reviews_total user_ratings_total userRatingCount",
    "maps_url": "maps_url googleMapsUri url", "url": "url maps_url googleMapsUri", "website": "website websiteUri website_url", "formatted_address": "formatted_address formattedAddress vicinity", "address": "address formatted_address formattedAddress",
    "distrito": "distrito", "archivo": "archivo", "image_url": "image_url photo_url photos[0].url photos[0].name", "photo_url": "photo_url image_url", "description": "description shortFormattedAddress", "editorial_summary": "editorial_summary editorialSummary.text",
    "city": "city", "lat": "lat latitude location.latitude geometry.location.lat", "lng": "lng longitude location.longitude geometry.location.lng",
}


def place_records(items: DataFrame, column: str = "item") -> DataFrame:
    """PRJ-5: flat records from the JSON text of items; of each field's paths the first with a value counts."""
    at = lambda p: F.get_json_object(column, f"$.{p}")
    fields = {k: s.first_present(*[F.when(~at(p).startswith("{"), at(p)) for p in paths.split()]) for k, paths in PLACE_PATHS.items()}
    fields["city"] = F.coalesce(fields["city"], F.lit("Lima"))
    out = [v.alias(k) for k, v in fields.items()]
    out.append(F.from_json(at("reviews"), "array<struct<review_text string>>").alias("reviews"))
    out.append(F.coalesce(F.from_json(at("types"), "array<string>"), F.from_json(at("categories"), "array<string>")).alias("types"))
    return items.select(*out)


def ticket_raw(events: DataFrame) -> DataFrame:
    """PRJ-6: raw rows of the ticket shop from event records, with a sentence where a description is missing."""
    df = _have(_texts(events, "url titulo categoria_principal descripcion_completa descripcion_corta fecha_inicio fecha_fin ubicacion_nombre ubicacion_direccion moneda imagen_principal ciudad distrito"), precio_desde="double")
    venue, area = F.coalesce(s.clean_text("ubicacion_nombre"), F.lit("Lima")), s.clean_text("distrito")
    where = F.when(area.isNotNull() & ~F.contains(F.lower(venue), F.lower(area)), F.concat(venue, F.lit(" ("), area, F.lit(")"))).otherwise(venue)
    price = F.when(F.col("precio_desde").isNotNull(), F.format_string("desde %.2f %s", "precio_desde", F.coalesce(s.clean_text("moneda"), F.lit("PEN")))).otherwise("precio por confirmar")
    told = F.concat(F.coalesce(s.clean_text("titulo"), F.lit("Evento en Joinnus")), F.lit(". Categoria: "), F.coalesce(s.clean_text("categoria_principal"), F.lit("cultural")), F.lit(". Inicio: "), F.coalesce(s.clean_text("fecha_inicio"), F.lit("fecha por confirmar")), F.lit(". Lugar: "), where, F.lit(". "), price, F.lit("."))
    place = F.coalesce(s.missing_to_null("ubicacion_nombre"), s.missing_to_null("distrito"), F.lit("Lima"))
    return df.withColumns({"moneda": F.coalesce(s.missing_to_null("moneda"), F.lit("PEN")), "ciudad": F.coalesce(s.missing_to_null("ciudad"), F.lit("Lima")), "source_url": F.col("url"), "canonical_url": F.col("url"), "title": F.col("titulo"), "description": F.coalesce(s.missing_to_null("descripcion_completa"), s.missing_to_null("descripcion_corta"), told), "category": F.col("categoria_principal"), "date": F.col("fecha_inicio"), "time": s.time_of_iso("fecha_inicio"), "location": F.concat(F.lit("Peru, "), place, F.lit(", Lima")), "image_url": F.col("imagen_principal"), "performer_list": F.lit(None).cast("string"), "ticket_availability": F.lit("available")})


def seeds(items: DataFrame, category: str, base: str, column: str = "item") -> DataFrame:
    """PRJ-7: event records from the JSON text of a search result's items; location and images may be objects, lists or texts."""
    at = lambda p: s.missing_to_null(F.get_json_object(column, f"$.{p}"))
    flat = lambda p: F.when(~at(p).startswith("{") & ~at(p).startswith("["), at(p))
    return items.select(
        s.item_url([at("canonicalUrl"), at("canonical_url"), at("url"), at("urlRedirection")], F.coalesce(at("activityUrl"), at("slug"), at("activity_slug")), category, base).alias("url"),
        s.clean_text(F.coalesce(at("title"), at("name"))).alias("titulo"), s.clean_text(F.coalesce(at("activityCategory"), F.lit(category))).alias("categoria_principal"), s.clean_text(F.coalesce(at("description"), at("summary"))).alias("descripcion_corta"),
        F.coalesce(at("date"), at("dateStart")).alias("fecha_inicio"), at("dateEnd").alias("fecha_fin"), s.clean_text(F.coalesce(at("location.name"), at("location.localName"), at("location.venue"), flat("location"))).alias("ubicacion_nombre"), s.clean_text(F.coalesce(at("location.address"), at("location.addressRef"), at("location.streetAddress"))).alias("ubicacion_direccion"),
        s.first_number(at("price")).alias("precio_desde"), F.coalesce(s.clean_text(at("currency")), F.lit("PEN")).alias("moneda"), s.clean_text(F.coalesce(at("images[0].url"), at("images[0].image"), at("images[0].imageUrl"), flat("images[0]"), flat("images"))).alias("imagen_principal"),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ-9: exactly the schema's columns: missing ones null, others dropped, values that do not fit null, the version constant."""

    def field(f: T.StructField) -> Column:
        if f.name == "schema_version":
            return F.lit(VERSION)
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.DateType) and isinstance(df.schema[f.name].dataType, T.StringType):
            return s.to_date(f.name)
        return F.col(f.name).try_cast(f.dataType)

    return df.select(*[field(f).alias(f.name, metadata={"schema_version": VERSION}) for f in schema])


def documents_of(df: DataFrame) -> DataFrame:
    """PRJ-10: rows to serve: without blank ids, entity type and origin filled in, tags as an array."""
    df = _texts(df, "entity_id entity_type url_origen url_evento")
    tags = (F.coalesce("tags", F.array().cast("array<string>")) if isinstance(df.schema["tags"].dataType, T.ArrayType) else s.tags_of("tags")) if "tags" in df.columns else F.array().cast("array<string>")
    return df.where(s.missing_to_null("entity_id").isNotNull()).withColumns({"entity_type": F.coalesce(s.missing_to_null("entity_type"), F.lit("event")), "url_origen": s.first_present("url_origen", "url_evento"), "tags": tags})


def only_available(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """PRJ-11, PRJ-12: the named columns that there are."""
    return df.select(*[c for c in names if c in df.columns])


# The columns of a search result and of the metadata beside the vectors, in order.
RESULT = ("entity_id", "titulo", "tipo", "fecha_inicio", "lugar", "distrito", "precio", "url_origen", "score")
METADATA = (
    "entity_id", "entity_type", "event_id", "titulo", "tipo", "fecha_inicio", "lugar",
    "precio", "fuente", "ciudad", "url_origen", "url_evento", "imagen_url",
    "direccion", "distrito", "categoria_google", "rating", "ratings_total", "lat", "lng",
    "resumen_reviews", "descripcion", "tags", "texto_embedding",
)


def search_result(df: DataFrame) -> DataFrame:
    """PRJ-12: the default columns of a search result that there are."""
    return only_available(df, RESULT)


def metadata(df: DataFrame) -> DataFrame:
    """PRJ-11, SNK-8: the default columns of the metadata that there are."""
    return only_available(df, METADATA)


def poi_catalog(df: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """SNK-7: the exported catalog; vectors join on entity_id."""
    df = df.join(vectors.select("entity_id", "embedding"), "entity_id", "left") if vectors is not None else df.withColumn("embedding", F.lit(None).cast("array<float>"))
    text = lambda c, d="": F.coalesce(F.col(c).cast("string"), F.lit(d)).alias({"titulo": "nombre"}.get(c, c))
    return df.select(text("poi_id"), text("titulo"), s.safe_float("lat").alias("lat"), s.safe_float("lng").alias("lon"), F.nullif("geo_hash", F.lit("")).alias("geo_hash"), text("categoria_normalizada", "cultural"), s.safe_float("rating").alias("rating"), text("fuente"), text("fecha_run"), "embedding")


def union_all(*frames: DataFrame) -> DataFrame:
    """SET-1: union by name, columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def normalize_all(run_ts: str, *, bnp: DataFrame | None = None, mali: DataFrame | None = None, joinnus: DataFrame | None = None, google_places: DataFrame | None = None) -> DataFrame:
    """The canonical rows of all given sources, deduplicated, in range."""
    from .dedup import dedup_catalog

    given = [(bnp, library_events), (mali, museum_events), (joinnus, ticket_events), (google_places, places)]
    rows = union_all(*[f(df) for df, f in given if df is not None])
    return dedup_catalog(finish(rows, run_ts))
