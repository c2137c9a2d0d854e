"""License scans by diagonal voting.

All word pairs of a document are joined to the positions of the same pairs in license templates. A
match votes for the diagonal (place in the document minus place in the template). Votes are summed
per diagonal, neighbouring diagonals of a template are merged so that an inserted or missing word
does not break a notice, and the merged spans are verified: a phrase must have every pair on one
diagonal, a notice must have at least ``COVER`` of its pairs in one span. Pairs are joined by hash
and compared as text, so a verified span holds exactly these words.

Null and empty texts have no words and no spans, repeated rows get equal results, an empty table
gives an empty result, extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from linegauge.llm.common import let, row_key, stored, words

# Phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Opening words of public license notices and the labels they add.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license":
        "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license":
        "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files":
        "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
}
PAIR = 2
#: Template places in one bit mask; longer templates have several.
MASK = 64
#: Diagonals of one template that differ by at most this many words belong to one span.
SLACK = 2
#: Share of a notice's pairs a span must have.
COVER = 0.8


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per template: number, text, label, whether it is a phrase, and its number of pairs."""
    rows = [(n, text, label, text in phrases and n < len(phrases)) for n, (text, label) in
            enumerate([*phrases.items(), *notices.items()])]
    listed = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(t).alias("text"), F.lit(label).alias("label"),
                                F.lit(p).alias("is_phrase")) for n, t, label, p in rows])
    out = spark.range(1).select(F.explode(listed).alias("t")).select("t.*")
    return out.withColumn("pairs", F.size(F.split("text", " ")) - (PAIR - 1))


def pairs(items: Column) -> Column:
    """Every two neighbouring words as one text."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - PAIR, F.lit(0)))
    each = F.transform(starts, lambda i: F.concat(F.get(items, i), F.lit(" "), F.get(items, i + 1)))
    return F.when(F.size(items) >= PAIR, each).otherwise(F.array().cast("array<string>"))


def votes(docs: DataFrame, table: DataFrame) -> DataFrame:
    """doc_key, template, diagonal, word, places: a bit per template place that voted, ``MASK`` places to a word."""
    places = table.select("template", F.posexplode(pairs(F.split("text", " "))).alias("at", "pair"))
    places = places.select("template", "at", F.col("pair").alias("_pair"), F.xxhash64("pair").alias("hash"))
    places = stored(places, "template-places")  # Spark broadcasts them by their stored size
    listed = docs.select(row_key().alias("doc_key"), let(words(F.col("text")), pairs).alias("all"))
    matched = (listed.select("doc_key", F.posexplode("all").alias("pos", "pair")).withColumn("hash", F.xxhash64("pair")).join(places, "hash").where("pair = _pair"))
    # repeated rows share a key: a bit per template place counts each place once
    return (matched.groupBy("doc_key", "template", (F.col("pos") - F.col("at")).alias("diagonal"), F.floor(F.col("at") / MASK).alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, at % {MASK})")).alias("places")))


def spans(voted: DataFrame, table: DataFrame) -> DataFrame:
    """Verified spans: doc_key, template, label, is_phrase, start (first diagonal), cover.

    A phrase's span is one diagonal with all its pairs, which cannot be shared between diagonals.
    """
    known = voted.join(stored(table.drop("text"), "templates"), "template")
    voters = F.sum(F.bit_count("places"))
    phrases = (known.where("is_phrase").groupBy("doc_key", "template", "label", "is_phrase", "pairs", "diagonal").agg(voters.alias("n"))
               .where("n = pairs").select("doc_key", "template", "label", "is_phrase", F.col("diagonal").alias("start"), F.lit(1.0).alias("cover")))
    order = W.partitionBy("doc_key", "template").orderBy("diagonal", "word")
    breaks = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= SLACK, 0).otherwise(1)
    merged = (known.where("NOT is_phrase").withColumn("breaks", breaks)
              .withColumn("span", F.sum("breaks").over(order.rowsBetween(W.unboundedPreceding, 0)))
              .groupBy("doc_key", "template", "label", "is_phrase", "pairs", "span", "word")
              .agg(F.min("diagonal").alias("start"), F.bit_or("places").alias("places"))
              .groupBy("doc_key", "template", "label", "is_phrase", "pairs", "span").agg(F.min("start").alias("start"), voters.alias("n")))
    notices = merged.select("doc_key", "template", "label", "is_phrase", "start", (F.col("n") / F.col("pairs")).alias("cover"))
    return phrases.unionByName(notices)


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest covered share of any template, 0 without a match.
    """
    table = templates(docs.sparkSession, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    found = spans(votes(docs, table), table)
    accepted = F.col("is_phrase") | (F.col("cover") >= COVER)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.col("is_phrase")
    per_doc = stored(found.groupBy("doc_key").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.when(accepted, F.col("label"))).alias("labels"),
        F.max("cover").alias("score")), "licenses")
    counted = docs.select("doc_id", row_key().alias("doc_key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    return counted.join(per_doc, "doc_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
