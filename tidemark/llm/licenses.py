"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word pair of every text is hashed and joined with the word pairs
of the license templates (a small fixed table, broadcast). A hit at word p
against template word q votes for the diagonal p - q. Votes are summed by
document, template and diagonal; neighbouring diagonals are merged into one
span, so that inserted or missing words don't split it; the words themselves
are compared in the join, and a span must cover enough of its template.
A short phrase must lie whole on one diagonal: these are the base places.

Null or empty texts have no words and no places. Rows that repeat a doc_id
with the same text get the same result; with another text, their own. Null
doc_ids are scanned like others. Very long texts are scanned whole. Ties cannot
arise: all spans that cover enough are kept. An empty table gives an empty result.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases that are looked for and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening words of widely used public licenses.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
}
MIN_COVERAGE = 0.7
MAX_DRIFT = 3                  # diagonals this close belong to one span


def words_of(text: Column) -> Column:
    # lower() also changes letters beyond A-Z, but never the bounds of a word, and
    # of those only the Kelvin sign becomes A-Z; the base phrases have no k
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(t, NOT_WORD), lambda w: w != "")


def template_pairs(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(pair hash, pair, template, label, is phrase, position, pairs in all); one
    row per template word, so as small as the templates."""
    rows = []
    for k, (body, label) in enumerate([*phrases.items(), *notices.items()]):
        w = body.split()
        rows += [(f"{a} {b}", k, label, k < len(phrases), i, len(w) - 1)
                 for i, (a, b) in enumerate(zip(w, w[1:]))]
    t = spark.createDataFrame(rows, "t_pair string, template int, label string, phrase boolean, "
                                    "t_at int, t_pairs int")
    return t.withColumn("t_hash", F.xxhash64("t_pair"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
         min_coverage: float = MIN_COVERAGE, max_drift: int = MAX_DRIFT) -> DataFrame:
    """The verified spans: doc_id, text_key, label, phrase, first, last word, coverage."""
    templates = template_pairs(docs.sparkSession, phrases, notices)
    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("w"))
    pairs = d.select("doc_id", "text_key", F.posexplode(F.expr(
        "zip_with(w, slice(w, 2, greatest(size(w) - 1, 0)), (a, b) -> concat(a, ' ', b))")).alias("at", "pair"))
    hits = (pairs.withColumn("hash", F.xxhash64("pair"))
            .join(F.broadcast(templates), (F.col("hash") == F.col("t_hash")) & (F.col("pair") == F.col("t_pair")))
            .withColumn("diagonal", F.col("at") - F.col("t_at")))
    who = ["doc_id", "text_key", "template", "label", "phrase", "t_pairs"]
    votes = hits.groupBy(*who, "diagonal").agg(F.sort_array(F.collect_set("t_at")).alias("got"))
    # a phrase is whole on one diagonal, so each of its diagonals is a span of its own;
    # of the others, diagonals a few words apart belong together
    w = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(w) > max_drift)
    spans = (votes.filter(F.when(F.col("phrase"), F.size("got") == F.col("t_pairs")).otherwise(F.size("got") > 1))
             .withColumn("span", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(w))
             .groupBy(*who, "span")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("got")))).alias("covered"),
                  F.min(F.col("diagonal") + F.array_min("got")).alias("first"),
                  F.max(F.col("diagonal") + F.array_max("got") + 1).alias("last"))
             .withColumn("coverage", F.col("covered") / F.col("t_pairs")))
    return (spans.filter(F.col("phrase") | (F.col("coverage") >= min_coverage))
            .select("doc_id", "text_key", "label", "phrase", "first", "last", "coverage"))


def label_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per document with its places and labels."""
    spans = scan(docs, **options)
    per_doc = spans.groupBy("doc_id", "text_key").agg(
        F.count_if("phrase").alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"))
    stats = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                        F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    p = per_doc.withColumnsRenamed({"doc_id": "p_doc", "text_key": "p_key"})
    joined = stats.join(p, stats.doc_id.eqNullSafe(p.p_doc) & (stats.text_key == p.p_key), "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                         "first_word", "last_word",
                         F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                         F.coalesce("labels", F.lit("")).alias("labels"),
                         F.coalesce("score", F.lit(0.0)).alias("score"))


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """Base places and labels of every document."""
    return label_documents(table(spark, sf_dir, "documents"))
