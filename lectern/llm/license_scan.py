"""License scans by diagonal voting, in DataFrame functions only.

Every rolling ``K``-word hash of every text is joined to the positions of the same
hashes in the license templates (a fixed table, broadcast). A match at document word
``p`` and template word ``q`` votes for the offset diagonal ``p - q``. Votes are aggregated
by diagonal; diagonals of one template that are at most ``GAP`` words apart are merged,
which tolerates inserted and missing words; a merged span is verified by the
share of the template's words it covers and by its length. A base phrase is found
where one diagonal holds all of the phrase's windows.

One scan of the texts feeds the join, and only matches and one marker row per document
are shuffled. Votes are counted before their first shuffle, so a row repeated for a third
of the table is one group per task; its copies come back in bounded blocks that spread over
tasks. A group never exceeds one document's diagonals.

Defined cases: null or empty text has no words, no places and score 0; documents
repeated with the same id and text are scanned once and returned as often as they
came; a null id is a group of its own per text; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
GAP = 2
LEAST_COVER = 0.75
MOST_STRETCH = 1.5
BLOCK = 10_000

#: Base phrases and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Notices whose near-complete spans give a label.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("dedicated to the public domain under cc0 1 0 universal", "cc0"),
]


def words(text) -> F.Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. ``lower`` maps
    one other character to ASCII, the Kelvin sign, which is replaced first; other
    case changes stay outside ASCII and cannot meet a template."""
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å")))
    return F.array_remove(F.split(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def window_hashes(w) -> F.Column:
    """Hash of each window of ``K`` words."""
    n = F.size(w)
    return F.when(n >= K, F.transform(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))),
                                      lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(K)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, base=tuple(BASE), notices=tuple(NOTICES)) -> DataFrame:
    """(hash, template, size, is_base, label, at): one row per window of each template."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(text).alias("text"), F.lit(label).alias("label"),
                     F.lit(i < len(base)).alias("is_base")) for i, (text, label) in enumerate([*base, *notices])]
    t = spark.range(1).select(F.inline(F.array(*rows))).withColumn("w", words(F.col("text")))
    return t.select("template", F.size("w").alias("size"), "is_base", "label",
                    F.posexplode(window_hashes(F.col("w"))).alias("at", "hash"))


def scan(docs: DataFrame, base=tuple(BASE), notices=tuple(NOTICES), least_cover: float = LEAST_COVER,
         most_stretch: float = MOST_STRETCH, gap: int = GAP) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    short = [text for text, _ in [*base, *notices] if len(text.split()) < K]
    if short:
        raise ValueError(f"templates need at least {K} words: {short}")
    doc = ["doc_id", "text_hash", "n_words"]
    src = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    # place 0 is a marker that keeps documents without a match; window p is at place p + 1
    rolled = src.select("doc_id", "text_hash", F.size("w").cast("bigint").alias("n_words"), F.posexplode(
        F.concat(F.array(F.lit(None).cast("bigint")), window_hashes(F.col("w")))).alias("place", "hash"))
    found = (rolled.join(F.broadcast(templates(docs.sparkSession, base, notices)), "hash", "left")
             .where("place = 0 or template is not null")
             .withColumn("diagonal", (F.col("place") - 1 - F.col("at")).cast("bigint")))
    votes = found.groupBy(*doc, "template", "size", "is_base", "label", "diagonal").agg(
        F.collect_set("at").alias("at"), F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy(*doc, "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    merged = (votes.withColumn("new", F.when(step > gap, 1).otherwise(0))
              .withColumn("span", F.sum("new").over(order))
              .groupBy(*doc, "template", "size", "is_base", "label", "span")
              .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.max("rows").alias("rows"),
                   F.min(F.array_min("at") + F.col("diagonal")).alias("start"),
                   F.max(F.array_max("at") + F.col("diagonal") + K).alias("end"),
                   # base places: diagonals that hold all windows
                   F.collect_list(F.when(F.col("is_base") & (F.size("at") == F.col("size") - K + 1), F.col("diagonal"))).alias("places")))
    cover = F.size(F.array_distinct(F.flatten(F.transform("at", lambda q: F.sequence(q, q + K - 1))))) / F.col("size")
    real = F.col("template").isNotNull()
    fits = real & (F.col("end") - F.col("start") <= most_stretch * F.col("size"))
    judged = (merged.withColumn("cover", F.when(fits, cover)).withColumn(
        "named", (F.col("is_base") & (F.size("places") > 0)) | (~F.col("is_base") & (F.col("cover") >= least_cover))))
    per_doc = judged.groupBy(*doc).agg(
        F.max(F.when(~real, F.col("rows"))).alias("copies"),
        F.sum(F.size("places")).cast("bigint").alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"), F.max(F.array_max("places")).alias("last_word"),
        F.collect_set(F.when(F.col("is_base") & F.col("named"), F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("named"), F.col("label"))).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"))
    join = lambda c: F.array_join(F.sort_array(c), ",").alias(c)
    out = per_doc.select("doc_id", "text_hash", "n_words", "n_base", "first_word", "last_word", join("base_labels"),
                         join("labels"), "score", "copies")
    return repeat(out, ["doc_id", "text_hash"]).drop("text_hash")


def repeat(rows: DataFrame, key: list[str], copies: str = "copies", block: int = BLOCK) -> DataFrame:
    """Each row ``copies`` times. The copies are dealt in blocks of at most ``block`` rows,
    which spread over tasks, so no array or task holds all copies of one row."""
    last = F.floor((F.col(copies) - 1) / block).cast("bigint")
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.col(copies) - F.col("_block") * block, F.lit(block)).cast("int")
    # a number of partitions of its own: joined by bytes, small rows of many copies would meet in one task
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = blocks.repartition(n, *key, "_block")
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop("_block", "_copy", copies)
