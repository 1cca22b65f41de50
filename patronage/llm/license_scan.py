"""License scans by diagonal voting.

Every place of a text where k words stand votes for the template positions with the same k
words, found by a join on their hash and confirmed by the words themselves. A template
that stands in a text votes along one diagonal (place in the text minus place
in the template); missing or added words shift it, so diagonals near each
other are merged. A span is verified by how much of its template
the confirmed words cover, a template position counting once however often it is met. Of
spans that overlap in a text, the one that covers most grams of its template counts: wordings of one
family share most of theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.columns import ascii_lower, whole_text
from patronage.session import stage

#: Words of a gram.
GRAM = 3
#: Diagonals this far apart may belong to one span.
SLACK = 8
#: Words between two votes of one span at most.
GAP = 12
#: Share of a template's grams that a span must cover.
COVERAGE = 0.6

#: Phrases that are looked for word by word; places of them are the base result.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Standard wordings of public licenses and notices, with the labels they give.
TEMPLATES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("gpl", "licensed under the GNU General Public License version 3"),
    ("gpl", "licensed under the GNU General Public License version 2"),
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("bsd", "licensed under the BSD 3 clause License"),
    ("cc-by-nc", "licensed under CC BY NC 4"),
    ("cc-by-sa", "licensed under CC BY SA 4"),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    (
        "agpl",
        "it under the terms of the GNU Affero General Public License as published by the Free"
        " Software Foundation",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If"
        " a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free"
        " to copy, modify, publish, use, compile, sell, or distribute this software",
    ),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "text is available under the Creative Commons Attribution ShareAlike License"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
)


def word_array(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of an already lower-cased text."""
    return F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _template_grams(spark: SparkSession, templates, phrases) -> DataFrame:
    """One row per template position: template, label, is_base, at, grams, gram, h.

    A row per word of the given wordings, a few hundred whatever the input.
    """
    wordings = [(label, True, text) for text, label in phrases]
    wordings += [(label, False, text) for label, text in templates]
    rows = [(i, *row) for i, row in enumerate(wordings)]
    frame = spark.createDataFrame(rows, "template int, label string, is_base boolean, wording string")
    words = word_array(ascii_lower(F.col("wording")))
    placed = frame.select("template", "label", "is_base", words.alias("words")).select(
        "template",
        "label",
        "is_base",
        (F.size("words") - (GRAM - 1)).alias("grams"),
        F.posexplode("words").alias("at", "word"),
        "words",
    )
    return (
        placed.where(F.col("at") < F.col("grams"))
        .select(
            "template",
            "label",
            "is_base",
            F.col("at").cast("long").alias("at"),
            F.col("grams").cast("long").alias("grams"),
            *[_word("words", F.col("at"), k).alias(f"t{k}") for k in range(GRAM)],
        )
        .withColumn("h", F.xxhash64(*[f"t{k}" for k in range(GRAM)]))
    )


def _word(words: str, place: Column, k: int) -> Column:
    return F.get(F.col(words), place + k)


def scan(
    docs: DataFrame,
    templates=TEMPLATES,
    phrases=PHRASES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``n_base`` counts the places of all phrases, ``first_word`` and ``last_word`` are
    their smallest and largest start (null without any). ``labels`` adds those of verified
    template spans; ``score`` is the largest coverage, 1 for a phrase and 0 for
    nothing. Null and empty texts have no words and no labels (empty strings).
    Rows alike in id and text have the same result; other columns are not
    read. A phrase must have at least ``GRAM`` words.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(whole_text(text_column)).alias("text_key"),
        word_array(ascii_lower(whole_text(text_column))).alias("words"),
    )
    places = texts.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "w0"))
    grams = places.select(
        "doc_id",
        "text_key",
        F.col("pos").cast("long").alias("pos"),
        *[_word("words", F.col("pos"), k).alias(f"w{k}") for k in range(GRAM)],
    ).withColumn("hash", F.xxhash64(*[f"w{k}" for k in range(GRAM)]))
    templates_of = _template_grams(spark, templates, phrases)
    same = F.col("hash") == F.col("h")
    for k in range(GRAM):
        same = same & (F.col(f"w{k}") == F.col(f"t{k}"))
    votes = grams.join(F.broadcast(templates_of), same).select(
        "doc_id",
        "text_key",
        "template",
        "label",
        "is_base",
        "grams",
        "pos",
        "at",
        (F.col("pos") - F.col("at")).alias("diagonal"),
    )
    key = ["doc_id", "text_key", "template", "label", "is_base", "grams"]
    # Phrases and templates both read the diagonals: written once, the texts are
    # searched once.
    diagonals = stage(
        votes.groupBy(*key, "diagonal").agg(
            F.collect_set("at").alias("ats"),  # as many as the template has, at most
            F.min("pos").alias("lo"),
            F.max("pos").alias("hi"),
        ),
        "diagonals",
    )
    places_of_phrases = diagonals.where(F.col("is_base") & (F.size("ats") == F.col("grams")))
    base = places_of_phrases.select(
        "doc_id",
        "text_key",
        "label",
        F.lit(True).alias("is_base"),
        F.col("diagonal").alias("start"),
        F.lit(1.0).alias("coverage"),
    )
    # Diagonals near each other first, then the places on them: votes on a diagonal far from a
    # span's do not come between its parts.
    in_text = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(in_text) > SLACK
    in_cluster = Window.partitionBy("doc_id", "text_key", "template", "cluster").orderBy(
        "lo", "diagonal"
    )
    earlier = in_cluster.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.col("lo") - F.max("hi").over(earlier) > GAP
    spans = (
        diagonals.where(~F.col("is_base"))
        .withColumn("far", F.when(far, 1).otherwise(0))
        .withColumn("cluster", F.sum("far").over(in_text))
        .withColumn("begins", F.when(apart, 1).otherwise(0))
        .withColumn("span", F.sum("begins").over(in_cluster))
        .select(*key, "cluster", "span", "lo", "hi", F.explode("ats").alias("at"))
        .groupBy(*key, "cluster", "span")
        .agg(
            F.size(F.collect_set("at")).alias("covered"),
            F.min("lo").alias("start"),
            (F.max("hi") + GRAM - 1).alias("end"),
        )
        .withColumn("coverage", F.col("covered") / F.col("grams"))
        .where(F.col("coverage") >= COVERAGE)
    )
    # Templates share wordings: of spans on the same words, the one with most words counts.
    of_text = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    before = of_text.rowsBetween(Window.unboundedPreceding, -1)
    afresh = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    on_place = Window.partitionBy("doc_id", "text_key", "place").orderBy(
        F.desc("covered"), F.desc("coverage"), "template"
    )
    spans = (
        spans.withColumn("afresh", F.when(afresh, 1).otherwise(0))
        .withColumn("place", F.sum("afresh").over(of_text))
        .withColumn("best", F.row_number().over(on_place))
        .where("best = 1")
        .select("doc_id", "text_key", "label", "is_base", "start", "coverage")
    )
    found = (
        base.union(spans)
        .groupBy("doc_id", "text_key")
        .agg(
            F.count_if("is_base").alias("n_base"),
            F.min(F.when(F.col("is_base"), F.col("start"))).alias("first_word"),
            F.max(F.when(F.col("is_base"), F.col("start"))).alias("last_word"),
            F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))).alias("base"),
            F.array_sort(F.collect_set("label")).alias("all"),
            F.max("coverage").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    )
    sizes = texts.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    return sizes.join(
        found,
        F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")),
        "left",
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
