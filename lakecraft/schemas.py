"""Versioned schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

VERSION = "1.0.0"


TEXT, DOUBLE, LONG, DAY, INSTANT = T.StringType(), T.DoubleType(), T.LongType(), T.DateType(), T.TimestampType()
TEXTS, VECTOR = T.ArrayType(TEXT), T.ArrayType(T.FloatType())

# Columns of the layers, required and critical ones, vector width.
SILVER = T.StructType(
    [
        T.StructField("entity_id", TEXT),
        T.StructField("entity_type", TEXT),
        T.StructField("event_id", TEXT),
        T.StructField("poi_id", TEXT),
        T.StructField("poi_id_version", TEXT),
        T.StructField("titulo", TEXT),
        T.StructField("descripcion", TEXT),
        T.StructField("tipo", TEXT),
        T.StructField("categoria_normalizada", TEXT),
        T.StructField("fecha_inicio", DAY),
        T.StructField("fecha_fin", DAY),
        T.StructField("hora_inicio", TEXT),
        T.StructField("lugar", TEXT),
        T.StructField("direccion", TEXT),
        T.StructField("distrito", TEXT),
        T.StructField("ciudad", TEXT),
        T.StructField("imagen_url", TEXT),
        T.StructField("precio", TEXT),
        T.StructField("url_origen", TEXT),
        T.StructField("url_evento", TEXT),
        T.StructField("fuente", TEXT),
        T.StructField("tags", TEXTS),
        T.StructField("geo_hash", TEXT),
        T.StructField("lat", DOUBLE),
        T.StructField("lng", DOUBLE),
        T.StructField("place_id", TEXT),
        T.StructField("rating", DOUBLE),
        T.StructField("ratings_total", LONG),
        T.StructField("categoria_google", TEXT),
        T.StructField("resumen_reviews", TEXT),
        T.StructField("texto_embedding", TEXT),
        T.StructField("fecha_run", DAY),
        T.StructField("scraped_at", INSTANT),
        T.StructField("schema_version", TEXT),
    ]
)
GOLD_CATALOG = T.StructType(
    [
        T.StructField("entity_id", TEXT),
        T.StructField("entity_type", TEXT),
        T.StructField("poi_id", TEXT),
        T.StructField("titulo", TEXT),
        T.StructField("descripcion", TEXT),
        T.StructField("tipo", TEXT),
        T.StructField("fecha_inicio", DAY),
        T.StructField("fecha_fin", DAY),
        T.StructField("hora_inicio", TEXT),
        T.StructField("lugar", TEXT),
        T.StructField("direccion", TEXT),
        T.StructField("distrito", TEXT),
        T.StructField("ciudad", TEXT),
        T.StructField("imagen_url", TEXT),
        T.StructField("precio", TEXT),
        T.StructField("url_origen", TEXT),
        T.StructField("fuente", TEXT),
        T.StructField("tags", TEXTS),
        T.StructField("geo_hash", TEXT),
        T.StructField("lat", DOUBLE),
        T.StructField("lng", DOUBLE),
        T.StructField("rating", DOUBLE),
        T.StructField("fecha_run", DAY),
        T.StructField("schema_version", TEXT),
    ]
)
GOLD_VECTORS = T.StructType(
    [
        T.StructField("entity_id", TEXT),
        T.StructField("titulo", TEXT),
        T.StructField("tipo", TEXT),
        T.StructField("fuente", TEXT),
        T.StructField("fecha_inicio", DAY),
        T.StructField("texto_embedding", TEXT),
        T.StructField("embedding", VECTOR),
        T.StructField("model_name", TEXT),
        T.StructField("schema_version", TEXT),
    ]
)
REQUIRED = ("entity_id", "entity_type", "titulo", "fuente", "url_origen", "texto_embedding", "scraped_at", "fecha_run")
CRITICAL = ("entity_id", "entity_type", "titulo", "fuente", "texto_embedding")
SOURCES = ("bnp", "mali", "joinnus", "google_places")
DIMENSION = 384
