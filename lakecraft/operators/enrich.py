"""Lookups: cached coordinates, providers for what the cache lacks, seeds, model enrichment."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup
from ..functions import scalars as s
from .dedup import first_n, keep_first
from .providers import Pace, ask


class Geocoder(Protocol):
    """(lat, lng) of an address, or None."""

    def __call__(self, address: str) -> tuple[float, float] | None: ...


def cache_join(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """JOIN-1: left join with a lookup table, one row for each key there; broadcast or not by its size."""
    return df.join(keep_first(cache.where(F.col(key).isNotNull()), [key], [F.col(c).asc_nulls_last() for c in cache.columns if c != key] or [F.col(key)]), key, "left")


def cache_misses(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """JOIN-2: each distinct key that the lookup table lacks, once."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().join(cache.select(key), key, "left_anti")


PLACE = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])


def ask_places(keys: DataFrame, provider: Geocoder, pace: Pace = Pace(), *, path: str | None = None) -> DataFrame:
    """SRC-15: a provider's answers (address, lat, lng, error, attempts); executors call it, once for each address."""

    def place(request: dict) -> dict | None:
        got = provider(request["address"])
        return got and {"lat": got[0], "lng": got[1]}

    return ask(keys.select("address"), "address", place, PLACE, pace, path=path)


def geocode_response(response: str) -> dict[str, F.Column]:
    """SRC-15: coordinates from the three known shapes of an answer (JSON text in a column)."""
    at = lambda p: F.get_json_object(response, p).try_cast("double")
    return {"lat": F.coalesce(at("$.results[0].location.latitude"), at("$.results[0].geometry.location.latitude"), at("$.results[0].geometry.location.lat")), "lng": F.coalesce(at("$.results[0].location.longitude"), at("$.results[0].geometry.location.longitude"), at("$.results[0].geometry.location.lng"))}


def geocode(df: DataFrame, cache: DataFrame, provider: Geocoder | None = None, *, keep: Callable[[DataFrame], DataFrame] = lambda answers: answers, pace: Pace = Pace(), path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events without coordinates get those of their address.

    Returns rows, the new cache, and the rejected rows (SNK-13): each with its id (``poi_id``, else ``entity_id``, if there
    is one), its address and the reason. A provider that raises leaves such a row and the others go on.

    ``keep`` writes the provider's answers and returns them read back, so that all three come from one request for each
    address; with ``path`` the answers are kept there (see :func:`~lakecraft.operators.providers.ask`).
    """
    wants = (F.coalesce(F.lower("entity_type"), F.lit("event")) == "event") & (F.col("lat").isNull() | F.isnan("lat"))
    rows = df.withColumn("address", F.when(wants, s.address_of("direccion", "lugar")))
    cache = cache.select("address", "lat", "lng")
    ids = [F.col(c).cast("string") for c in ("poi_id", "entity_id") if c in df.columns]
    asked = rows.where("address is not null").select(F.coalesce(*ids, F.lit(None).cast("string")).alias("id"), "address")
    rejected = asked.where("false").withColumn("reason", F.lit(""))
    if provider is not None:
        answers = keep(ask_places(cache_misses(rows, cache, "address"), provider, pace, path=path))
        cache = cache.unionByName(answers.where("error is null").select("address", "lat", "lng"))
        rejected = asked.join(answers.where("error is not null").select("address", F.col("error").alias("reason")), "address").select("id", "address", "reason")
    found = cache_join(rows, cache.select("address", F.col("lat").alias("_lat"), F.col("lng").alias("_lng")), "address")
    lat, lng = F.when(wants, F.col("_lat")).otherwise(F.col("lat")), F.when(wants, F.col("_lng")).otherwise(F.col("lng"))
    out = found.withColumns({"lat": lat, "lng": lng}).withColumn("geo_hash", s.geohash(F.col("lat"), F.col("lng"))).drop("address", "_lat", "_lng")
    return out.select(df.columns + [c for c in out.columns if c not in df.columns]), cache, rejected


def seed_join(events: DataFrame, seeds: DataFrame, order: list[str]) -> DataFrame:
    """JOIN-3: the first seed of each URL; the event's own values come before the seed's."""
    one = keep_first(seeds.where(F.col("url").isNotNull()), ["url"], [F.col(c) for c in order])
    both = [c for c in one.columns if c != "url" and c in events.columns]
    joined = events.alias("e").join(one.alias("s"), "url", "left")
    rest = [F.col(f"e.{c}") for c in events.columns if c != "url" and c not in both]
    return joined.select("url", *[F.coalesce(F.col(f"e.{c}"), F.col(f"s.{c}")).alias(c) for c in both], *rest, *[F.col(f"s.{c}") for c in one.columns if c != "url" and c not in both])


class Model(Protocol):
    """What a model says about an event (titulo, descripcion, tipo, lugar), as text, and about its image; either may raise."""

    def text(self, event: dict) -> str: ...

    def caption(self, image_url: str) -> str | None: ...


ANSWER = T.StructType([T.StructField("answer", T.StringType()), T.StructField("caption", T.StringType())])
ASKED = ("titulo", "descripcion", "tipo", "lugar", "imagen_url")


def parsed_answer(answer: Column | str, most: int = 20) -> dict[str, Column]:
    """ENR-1: ai_tags and ai_summary of a model's answer, which has to be a JSON object and nothing else; null where it is not.

    Tags are a list's non-blank values as trimmed texts, the first ``most``; null where none is left.
    """
    plain = markup.strip(F.col(answer) if isinstance(answer, str) else answer)
    whole = markup.object_after(F.concat(F.lit('"answer":'), plain), "answer")
    v = F.try_parse_json(F.when(whole == plain, plain))  # the parser would not mind what follows an object
    text = lambda x: markup.strip(F.try_variant_get(x, "$", "string"))
    tags = F.slice(F.filter(F.transform(F.try_variant_get(v, "$.tags", "array<variant>"), text), lambda t: t != ""), 1, most)
    return {"ai_tags": F.when(F.size(tags) > 0, tags), "ai_summary": F.nullif(markup.strip(F.try_variant_get(v, "$.summary", "string")), F.lit(""))}


def enrich(df: DataFrame, model: Model, *, most: int = 200, tags: int = 20, pace: Pace = Pace(), path: str | None = None) -> DataFrame:
    """ENR-1: the embedding text of the first ``most`` rows (by date, then id) with a model's tags, summary and caption.

    0 or less for ``most`` means all rows. A row for which the model raises, or gives no JSON object, keeps what was not
    said about it; a caption that fails leaves the text's answer. ``path``: where answers are kept by id, so that a run
    that is started again asks for the missing ones only.
    """

    def said(event: dict) -> dict | None:
        plain = {k: "" if event.get(k) is None else str(event[k]).strip() for k in ASKED}
        image, caption = plain.pop("imagen_url"), None
        answer = model.text(plain)
        if image:
            try:
                caption = (model.caption(image) or "").strip() or None
            except Exception:  # noqa: BLE001
                caption = None
        return {"answer": answer, "caption": caption}

    there = df.select("entity_id", "fecha_inicio", *[F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string").alias(c) for c in ASKED])
    first = first_n(there.where(F.col("entity_id").isNotNull()), [F.col("fecha_inicio").asc_nulls_last(), F.col("entity_id")], most).drop("fecha_inicio")
    told = ask(first, "entity_id", said, ANSWER, pace, path=path)
    told = told.select("entity_id", F.nullif("caption", F.lit("")).alias("_caption"), *[c.alias(f"_{name}") for name, c in parsed_answer("answer", tags).items()])
    out = df.join(told, "entity_id", "left")
    text = s.with_enrichment(F.col("texto_embedding"), F.col("_caption"), F.col("_ai_summary"), F.col("_ai_tags"))
    return out.withColumn("texto_embedding", text).select(*df.columns)
