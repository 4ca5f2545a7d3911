"""License scans by diagonal voting, in DataFrame operations only.

All rolling word pairs of the documents are hashed and joined to the places of the same pair in license templates.
Each match votes for the diagonal on which the document's words line up with the template's: position in the text
minus position in the template. Votes are summed by diagonal, neighbouring diagonals are merged (a word more or less in
the text shifts it by one), and a span counts when enough of its template's pairs were met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHIFT = 2
LEAST_COVER = 0.7

# Base phrases with their labels, found only where all their words stand together.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of licenses and their notices, found where most of their word pairs line up.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-terms": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "cc-notice": "licensed under cc by nc 4 0",
    "cc-terms": "this work is licensed under a creative commons attribution 4 0 international license",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published "
    "by the free software foundation",
    "mit-notice": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
}


def template_pairs(spark, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """One row per word pair of a template; as many rows as the given wordings have words, so a broadcast is bounded."""
    rows = []
    for exact, wordings in ((True, [(label, words) for words, label in phrases.items()]), (False, list(templates.items()))):
        for label, wording in wordings:
            words = wording.split()
            if len(words) < 2:
                raise ValueError(f"{wording!r} must have two words or more")
            name = len({row[0] for row in rows})
            rows += [(name, label, exact, len(words) - 1, i, *words[i : i + 2]) for i in range(len(words) - 1)]
    schema = "template int, label string, exact boolean, pairs int, place int, t1 string, t2 string"
    return spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64("t1", "t2"))


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """Per input row, the license phrases and wordings of its whole text.

    Columns: ``doc_id``, ``n_words``, ``n_base`` (places where a phrase's words stand consecutively), ``first_word`` and
    ``last_word`` (smallest and largest start of these, from 0; null without any), ``base_labels`` and ``labels``
    (distinct, sorted, comma-joined; the latter with the templates' labels), ``score`` (0 to 1: 1 for a phrase, else
    the best share of a template's pairs met), ``spans`` (label and first and last word of each template found).
    Words are runs of digits, letters and non-ASCII characters, lower-cased. One row per input row, repeated rows
    included. Null and empty texts have no words, empty labels and score 0. A null id stays null.
    """
    spark = docs.sparkSession
    pairs = template_pairs(spark, PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), NOT_WORD), "")
    split = docs.select(F.col(f"`{doc_id}`").alias("id"), F.monotonically_increasing_id().alias("row"), words.alias("w"))
    rolling = F.arrays_zip(F.col("w").alias("w1"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("w2"))
    rolled = split.select("id", "row", F.size("w").alias("n_words"), F.posexplode_outer(rolling).alias("at", "pair"))
    rolled = rolled.select("id", "row", "n_words", "at", "pair.w1", "pair.w2", F.xxhash64("pair.w1", "pair.w2").alias("hash"))
    joined = rolled.join(F.broadcast(pairs), "hash", "left")
    same = F.coalesce((F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2")), F.lit(False))
    # The first pair of a text, or the empty row of a text without any, carries the row itself.
    votes = joined.withColumn("same", same).where(F.col("same") | (F.coalesce("at", F.lit(0)) == 0))

    row = ("id", "row", "n_words")
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    kept = {name: F.when(F.col("same"), F.col(name)).alias(name) for name in ("template", "label", "exact", "pairs")}
    by_diagonal = votes.groupBy(*row, *kept.values(), F.when(F.col("same"), diagonal).alias("diagonal")).agg(
        F.collect_set(F.when(F.col("same"), F.col("place"))).alias("places")
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT)
    marked = by_diagonal.withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0))
    merged = marked.withColumn("run", F.sum("new").over(order)).groupBy(*row, "template", "label", "exact", "pairs", "run")
    met = F.array_distinct(F.flatten(F.collect_list("places")))
    spans = merged.agg(met.alias("met"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    share = F.size("met") / F.col("pairs")
    spans = spans.select(
        *row,
        F.col("label"),
        (F.col("exact") & (share == 1)).alias("base"),
        (~F.col("exact") & (share >= LEAST_COVER)).alias("similar"),
        F.when(F.col("template").isNotNull() & (~F.col("exact") | (share == 1)), share).alias("share"),
        (F.col("low") + F.array_min("met")).alias("first"),
        (F.col("high") + F.array_max("met") + 1).alias("last"),
    )
    start = F.when(F.col("base"), F.col("first"))
    found = F.when(F.col("similar"), F.struct("first", "last", "label"))
    done = spans.groupBy(*row).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set(F.when(F.col("base") | F.col("similar"), F.col("label")))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(found)).alias("spans"),
    )
    return done.select(
        F.col("id").alias(doc_id),
        F.col("n_words").cast("long").alias("n_words"),
        "n_base",
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        "spans",
    )
