"""License scans by diagonal voting, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text. Every run of three words of every
document is hashed and joined with the runs of the license templates below (a fixed list, so the broadcast is
bounded). A match at word p of a document and word t of a template votes for the diagonal p - t. Votes are
summed by document, template and diagonal; neighbouring diagonals (a word more or less in the text) are
merged; and a merged span is a license if it holds enough of the template's runs in about its length.

Beside this, all places of three base phrases are reported.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crossfade.llm.tables import materialize

RUN = 3
LEAST_SHARE = 0.8  # of a template's runs
GAP = 3  # diagonals at most this far apart belong together

# The phrases of the base labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences by which licenses are granted or named, as words.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]


def words_of(text: str = "text") -> Column:
    """The words of a text in order, only A-Z lower-cased; null has none."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"), "")


def base_columns(words: str = "words") -> list[Column]:
    """n_words, n_base, first_word, last_word and base (an array of labels) from an array of words."""
    n = F.size(words)
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    held = {phrase: F.contains(line, F.lit(f" {phrase} ")) for phrase in BASE}

    def here(i: Column) -> Column:
        found = F.lit(False)
        for phrase in BASE:
            whole = F.lit(True)
            for k, word in enumerate(phrase.split()):
                whole = whole & F.coalesce(F.get(F.col(words), i + k) == word, F.lit(False))
            found = found | whole
        return found

    none = F.array().cast("array<int>")
    some = F.lit(False)
    for there in held.values():
        some = some | there
    # only texts that hold a phrase are searched word by word
    places = F.when(some, F.filter(F.sequence(F.lit(0), n - 1), here)).otherwise(none)
    labels = F.array(*(F.when(held[phrase], F.lit(label)) for phrase, label in BASE.items()))
    return [n.cast("long").alias("n_words"), places.alias("places"), F.array_sort(F.array_compact(labels)).alias("base")]


def template_runs(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, label, runs, length, at, a, b, c): the runs of three words of each template."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = text.split()
        if len(words) < RUN:
            raise ValueError(f"template {text!r} has fewer than {RUN} words")
        runs = len(words) - RUN + 1
        rows += [(number, label, runs, len(words), at, *words[at : at + RUN]) for at in range(runs)]
    return spark.createDataFrame(rows, "template int, label string, runs int, length int, at int, a string, b string, c string")


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, text_hash, label, first_word, last_word, share): the license spans in each document. Rows
    repeated with the same id and text give their spans once."""
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of().alias("w"))
    words = words.where(F.size("w") >= RUN)
    n = F.size("w")
    runs = F.arrays_zip(F.slice("w", 1, n - 2).alias("a"), F.slice("w", 2, n - 2).alias("b"), F.slice("w", 3, n - 2).alias("c"))
    grams = words.select("doc_id", "text_hash", F.posexplode(runs).alias("p", "run")).select(
        "doc_id", "text_hash", "p", "run", F.xxhash64("run.a", "run.b", "run.c").alias("h")
    )
    known = template_runs(docs.sparkSession, templates).withColumn("h", F.xxhash64("a", "b", "c"))
    same = (F.col("run.a") == F.col("a")) & (F.col("run.b") == F.col("b")) & (F.col("run.c") == F.col("c"))
    votes = grams.join(F.broadcast(known), "h").where(same)
    keys = ["doc_id", "text_hash", "template"]
    diagonals = votes.groupBy(*keys, (F.col("p") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("at"), F.min("p").alias("first"), F.max("p").alias("last"),
        F.first("label").alias("label"), F.first("runs").alias("runs"), F.first("length").alias("length"),
    )
    order = Window.partitionBy(*keys).orderBy("diagonal")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > GAP).cast("int"), F.lit(1))
    merged = diagonals.withColumn("opens", opens).withColumn("span", F.sum("opens").over(order)).groupBy(*keys, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("hit"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.first("label").alias("label"), F.first("runs").alias("runs"), F.first("length").alias("length"),
    )
    share = F.col("hit") / F.col("runs")
    length = F.col("last") - F.col("first") + RUN
    return merged.where((share >= LEAST_SHARE) & (length <= F.col("length") + 2 * GAP)).select(
        "doc_id", "text_hash", "label", F.col("first").cast("long").alias("first_word"),
        (F.col("last") + RUN - 1).cast("long").alias("last_word"), share.alias("share"),
    )


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a base phrase stands, else the best share of a license's template found, else 0.
    Null and empty texts have no words and no labels; repeated rows each give a row; null ids are kept.
    """
    spans = materialize(
        find_licenses(docs, templates).groupBy("doc_id", "text_hash").agg(
            F.sort_array(F.collect_set("label")).alias("licenses"), F.max("share").alias("share")
        )
    )
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of().alias("words"))
    base = base.select("doc_id", "text_hash", *base_columns())
    own = spans.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "licenses", "share")
    both = base.join(own, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("licenses", F.array().cast("array<string>"))))
    return both.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
