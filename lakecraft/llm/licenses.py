"""License scans by diagonal voting, with DataFrame functions only.

All rolling k-word hashes of every text are joined with the k-word hashes of the templates, a fixed list
that is broadcast. Where the words behind a hash are those of the template too, word p of the text and word q of
the template vote for the diagonal p - q, so a span's coverage counts verified words only.
Votes are summed by diagonal, diagonals that differ by a few words (an inserted or missing word) are merged,
and a merged span counts if it covers enough of the template's words.

A text is exploded into word positions within one stage; what is shuffled are matches and one row for
each document. All rows of a document go to one task, as many as it has matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialise

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 4
# Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# Opening notices of public licenses, as their texts give them.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)


COPIES = 4096


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lowered; a null text has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))


def gram_hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def template_grams(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(gram, places): for each k-word hash its places (template, tpos, words); as many rows as the fixed list has grams."""
    rows = [(number, tpos, words[tpos : tpos + K]) for number, (_, text) in enumerate(templates) for words in [text.split()] for tpos in range(len(words) - K + 1)]
    frame = spark.createDataFrame(rows, "template int, tpos int, words array<string>")
    return frame.groupBy(gram_hash([F.get("words", F.lit(i)) for i in range(K)]).alias("gram")).agg(F.collect_list(F.struct("template", "tpos", "words")).alias("places"))


def license_scan(docs: DataFrame, *, templates: tuple[tuple[str, str], ...] = TEMPLATES, neighbours: int = 2, coverage: float = 0.75) -> DataFrame:
    """Licenses that each document names or quotes.

    Returns a row for each row of ``docs``: doc_id, n_words, n_base (places of the fixed phrases), first_word
    and last_word (their smallest and largest first word, from 0; null without any), base_labels, labels (base
    ones and those of templates covered to ``coverage``; both distinct, sorted, comma-joined), score (1 with a
    base place, else the largest share of a template's words that a span covers).

    A null text counts as empty: no words, empty labels, score 0. A null doc_id stays null. Rows repeated with
    a doc_id each get a row. Texts are read whole. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"), words_of(F.col("text")).alias("words"))
    at = rows.select("doc_id", "th", "words", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("pos"))  # -1: the document itself
    word = [F.get("words", F.when(F.col("pos") >= 0, F.col("pos") + i)) for i in range(K)]
    base = F.lit(None).cast("string")
    for phrase, label in reversed(PHRASES):
        match = F.lit(True)
        for i, w in enumerate(phrase.split()):
            match = match & (word[i] == w)
        base = F.when(match, F.lit(label)).otherwise(base)
    grams = at.select("doc_id", "th", "pos", F.when(F.col("pos") < 0, F.size("words")).alias("n"), base.alias("base"), F.when(word[K - 1].isNotNull(), gram_hash(word)).alias("gram"), "words")
    hits = grams.join(F.broadcast(template_grams(spark, templates)), "gram", "left").where("pos < 0 or base is not null or places is not null")
    # Of the text only the K words at a hit go on.
    spelled = F.when(F.col("places").isNotNull(), F.slice("words", F.greatest(F.col("pos") + 1, F.lit(1)), K)).alias("spelled")
    hits = hits.select("doc_id", "th", "pos", "n", "base", spelled, "places")
    same = F.transform(F.filter("places", lambda p: p["words"] == F.col("spelled")), lambda p: F.struct(p["template"].alias("template"), p["tpos"].alias("tpos")))
    own = F.when(F.col("n").isNotNull() | F.col("base").isNotNull(), F.array(F.struct(F.lit(None).cast("int").alias("template"), F.lit(None).cast("int").alias("tpos"))))
    none = F.expr("cast(array() as array<struct<template int, tpos int>>)")
    votes = hits.select("doc_id", "th", "pos", "n", "base", F.inline(F.concat(F.coalesce(own, none), F.coalesce(same, none))))
    is_own = F.col("template").isNull()
    votes = votes.select("doc_id", "th", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos", F.when(is_own, F.col("n")).alias("n"), F.when(is_own, F.col("base")).alias("base"), F.when(is_own & F.col("base").isNotNull(), F.col("pos")).alias("place"))
    # Equal votes are counted before they are sent, so a row repeated however often is one row for each task here.
    diagonals = votes.groupBy("doc_id", "th", "template", "diagonal").agg(
        F.collect_set("tpos").alias("tpos"),
        F.max("n").alias("n"),
        F.count("n").alias("copies"),
        F.count("place").alias("places"),
        F.min("place").alias("first_word"),
        F.max("place").alias("last_word"),
        F.collect_set("base").alias("base"),
    )
    diagonals = diagonals.repartition("doc_id", "th")  # serves all that follows
    line = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > neighbours, F.lit(True))
    merged = diagonals.withColumn("new", new.cast("int")).withColumn("span", F.sum("new").over(line))
    merged = merged.groupBy("doc_id", "th", "template", "span").agg(
        F.flatten(F.collect_list("tpos")).alias("tpos"),
        *[F.max(c).alias(c) for c in ("n", "copies", "places", "first_word", "last_word", "base")],
    )
    sizes = F.array(*[F.lit(len(t.split())) for _, t in templates])
    names = F.array(*[F.lit(label) for label, _ in templates])
    covered = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda q: F.sequence(q, q + K - 1))))) / F.get(sizes, F.col("template"))
    spans = merged.withColumn("covered", F.when(F.col("template").isNotNull(), covered)).withColumn("label", F.when(F.col("covered") >= coverage, F.get(names, F.col("template"))))
    out = spans.groupBy("doc_id", "th").agg(
        F.max("n").cast("long").alias("n_words"),
        F.max("copies").alias("copies"),
        F.max("places").alias("places"),
        F.max("first_word").cast("long").alias("first_word"),
        F.max("last_word").cast("long").alias("last_word"),
        F.max("base").alias("base"),
        F.collect_set("label").alias("found"),
        F.max("covered").alias("covered"),
    )
    text = lambda labels: F.array_join(F.sort_array(labels), ",")
    out = out.select(
        "doc_id",
        "n_words",
        (F.col("places") / F.col("copies")).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        text(F.col("base")).alias("base_labels"),
        text(F.array_union("base", "found")).alias("labels"),
        F.when(F.col("places") > 0, F.lit(1.0)).otherwise(F.coalesce("covered", F.lit(0.0))).alias("score"),
        "copies",
    )
    out = materialise(out, "licenses")
    # A row for each copy: some thousand of one row at a time, those of the others are dealt anew.
    many = out.where(F.col("copies") > COPIES).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    many = many.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - F.col("nth") * COPIES)).drop("nth")
    every = out.where(F.col("copies") <= COPIES).unionByName(many)
    return every.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")
