"""License scans with DataFrame functions only: diagonal voting.

Every document's rolling word k-grams are hashed, for k = 2 and k = 4, and joined
with the positions that hold the same k-gram in a fixed set of templates; the
words themselves are compared where hashes agree. A hit votes for the diagonal
(document position - template position). Votes are added up by document, template
and diagonal before the shuffle. A base phrase stands where one diagonal has all its
k-grams. For longer templates, neighbouring diagonals, which inserted or dropped
words set apart, are merged, and a span counts where the merged votes cover
enough of the template.

The templates are fixed text, so broadcasting their positions is bounded.

Results on unusual rows: a null, empty or wordless text has n_words 0, no places,
null positions, empty labels and score 0; equal texts get equal rows, and rows that
repeat an id each get their own; a null id is carried along; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of the k-grams for phrases and for whole notices.
SHORT, LONG = 2, 4
#: Diagonals this close together are one span's.
GAP = 12
#: Least share of a notice's k-grams that a span must hold.
LEAST_COVER = 0.5

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of public license notices and the labels that they call for.
NOTICES = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "mit-notice": "released under the mit license",
    "apache-text": "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "apache-notice": "licensed under the apache license version 2 0",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "lgpl-notice": "under the terms of the gnu lesser general public license as published by the free software foundation",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense-text": "this is free and unencumbered software released into the public domain",
}

# Separators in the raw text: all of ASCII but digits and letters. A-Z become lower case word by word.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, in their own case."""
    # The Kelvin sign is the one sign outside ASCII whose lower case is an ASCII letter alone.
    kept = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b"))
    return F.array_remove(F.split(kept, _SEPARATORS), "")


def with_grams(df: DataFrame) -> DataFrame:
    """Adds columns pairs and quads, hashes of 2 and 4 words from each position of ``words`` on."""
    after = lambda name, step: lambda x, i: F.xxhash64(x, F.get(name, i + step))
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    paired = hashed.withColumn("pairs", F.transform("hashes", after("hashes", 1)))
    return paired.withColumn("quads", F.transform("pairs", after("pairs", 2))).drop("hashes")


def templates(spark) -> DataFrame:
    """Rows (gram, template, label, base, at, grams, k, gram_text), one for each position of each template."""
    rows = [(f"base {i}", label, True, SHORT, text.split(" ")) for i, (text, label) in enumerate(PHRASES.items())]
    rows += [(name, name, False, LONG, text.split(" ")) for name, text in NOTICES.items()]
    made = with_grams(spark.createDataFrame(rows, "template string, label string, base boolean, k int, words array<string>"))
    count = F.size("words") - F.col("k") + 1
    grams = F.slice(F.when(F.col("base"), F.col("pairs")).otherwise(F.col("quads")), F.lit(1), count)
    placed = made.select("template", "label", "base", "k", "words", count.alias("grams"), F.posexplode(grams).alias("at", "gram"))
    return placed.select("gram", "template", "label", "base", "k", "at", "grams", F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), " ").alias("gram_text"))


def license_spans(docs: DataFrame) -> DataFrame:
    """Verified spans of documents (doc_id, text): doc_id, text_key, label, base, first, last, cover."""
    read = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words")).where(F.size("words") > 1)
    grams = with_grams(read).select("doc_id", "text_key", "words", F.concat("pairs", "quads").alias("grams"))
    # The outer form keeps the optimizer from testing the arrays' sizes before they are made.
    rolled = grams.select("doc_id", "text_key", "words", F.posexplode_outer("grams").alias("place", "gram"))
    place = F.pmod("place", F.size("words"))
    same_words = F.lower(F.array_join(F.slice("words", place + 1, F.col("k")), " ")) == F.col("gram_text")
    hits = rolled.join(F.broadcast(templates(docs.sparkSession)), "gram").where(same_words)
    keys = ["doc_id", "text_key", "template", "label", "base", "grams", "k"]
    votes = hits.groupBy(*keys, (place - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats")  # at most as many as the template has
    )
    by_diagonal = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > GAP, F.lit(True))
    runs = votes.withColumn("opens", (F.col("base") | apart).cast("int")).withColumn("run", F.sum("opens").over(by_diagonal))
    merged = runs.groupBy(*keys, "run").agg(
        F.min(F.col("diagonal") + F.array_min("ats")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("ats")).alias("last_gram"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"),
    )
    whole = merged.withColumn("cover", F.col("held") / F.col("grams")).where(F.col("cover") >= F.when(F.col("base"), 1.0).otherwise(LEAST_COVER))
    return whole.select("doc_id", "text_key", "label", "base", "first", (F.col("last_gram") + F.col("k") - 1).alias("last"), "cover")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: the largest share of a template that the text holds.
    """
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    only = lambda value: F.when(F.col("base"), value)
    listed = lambda labels: F.array_join(F.array_sort(labels), ",")
    found = license_spans(source).groupBy("doc_id", "text_key").agg(
        F.count_if("base").alias("n_base"),
        F.min(only(F.col("first"))).cast("long").alias("first_word"),
        F.max(only(F.col("first"))).cast("long").alias("last_word"),
        listed(F.collect_set(only(F.col("label")))).alias("base_labels"),
        listed(F.collect_set("label")).alias("labels"),
        F.max("cover").alias("score"),
    )
    counted = source.select("doc_id", F.xxhash64("text").alias("text_key"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD)).cast("long").alias("n_words")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
    return counted.join(found.alias("f"), same, "left").select(
        "d.doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
