"""URL filters by a temporal list join, with DataFrame functions only.

A list is a history: at a date a rule (a domain, or a domain and the beginning of a path) is set to block or
allow, or removed. Each rule's history becomes validity intervals, from an entry to the next one of the same
rule. A capture is looked up under all rules that could cover it, its host's suffixes and its path's
beginnings, and joined as of its fetch time. Of the rules active then, the most specific decides.

The join is a plain equi-join on the rule with a range condition, so a rule that covers a large share of the
captures is split by adaptive execution on the captures' side, and a small list is broadcast by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTIONS = ("remove", "allow", "block")


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and closing dot; empty where there is none."""
    authority = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(authority, r"^.*@|:\d*$|\.$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def rules_of(host: Column, path: Column, segments: int) -> Column:
    """All rules that cover a URL: suffixes of the host, the host with the path's beginnings of up to ``segments`` segments."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(segments))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))
    return F.when(host != "", F.array_distinct(F.concat(suffixes, F.filter(prefixes, lambda p: ~p.endswith("/")))))


def rule_of(rule: Column) -> Column:
    """A rule with its host in lower case and single slashes, none at its end; paths keep their case."""
    parts = F.filter(F.split(rule, "/"), lambda s: s != "")
    host = F.lower(F.substring_index(rule, "/", 1))
    # A rule without a host ("/ads") covers nothing.
    return F.when(host != "", F.array_join(F.concat(F.array(host), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))), "/"))


def validity(entries: DataFrame) -> DataFrame:
    """(rule, action, category, valid_from, valid_to) from (rule, action, category, listed_at).

    Of entries of a rule at the same instant one holds: block before allow before remove, then the category
    that sorts last. Entries without rule or date, or with another action, say nothing.
    """
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    known = entries.select(rule_of(F.col("rule")).alias("rule"), "action", "category", F.col("listed_at").cast("timestamp").alias("valid_from")).where(F.col("rule").isNotNull() & F.col("valid_from").isNotNull() & F.col("action").isin(*ACTIONS))
    one = known.groupBy("rule", "valid_from").agg(F.max_by(F.struct("action", "category"), F.struct(rank, "category")).alias("e"))
    to = F.lead("valid_from").over(Window.partitionBy("rule").orderBy("valid_from"))
    return one.select("rule", "e.action", "e.category", "valid_from", to.alias("valid_to")).where("action <> 'remove'")


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Verdict of the list on every capture (page_id, url, fetched_at) as of its fetch time.

    Returns a row for each capture: page_id, url, fetched_at, verdict (block, allow or none), rule, category,
    listed_at (of the deciding entry, else null). Paths are looked up as deep as the list's longest rule goes.

    A null or malformed URL has no host and so verdict none, as has a capture without a fetch time; a URL of any
    length is looked up whole. Rules are a host or a host and the beginning of a path, cut at slashes: a slash at
    the end and repeated slashes say nothing, the host's case neither, the path's does. Rules without a host, with
    a scheme or with wildcards cover nothing. Rows repeated each get a row. Empty tables: no captures give no rows, an empty list gives none everywhere.
    Other columns are ignored. An interval includes its first instant and excludes its last.
    """
    rows = captures.select("page_id", "url", F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    active = validity(entries)
    segments = active.agg(F.max(F.size(F.split("rule", "/")) - 1)).first()[0] or 0
    looked = rows.select("*", F.posexplode_outer(rules_of(host_of(F.col("url")), path_of(F.col("url")), segments)).alias("k", "rule"))
    active = active.withColumnRenamed("rule", "listed")
    during = (F.col("rule") == F.col("listed")) & (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    met = looked.join(active, during, "left")
    decided = F.max_by(F.struct("action", F.col("listed").alias("rule"), "category", F.col("valid_from").alias("listed_at")), F.when(F.col("listed").isNotNull(), F.struct(F.length("listed"), "listed")))
    out = met.groupBy("page_id", "url", "fetched_at").agg(decided.alias("d"), F.count(F.when(F.coalesce("k", F.lit(0)) == 0, 1)).alias("copies"))
    out = out.select("page_id", "url", "fetched_at", F.coalesce("d.action", F.lit("none")).alias("verdict"), "d.rule", "d.category", "d.listed_at", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return out.drop("copy")
