"""License notices by diagonal voting."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.llm.sqltext import rolling, words

K = 2
#: Phrases that always count, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Wordings of notices that may be met with words changed, left out or put in.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "reserved": ["All rights reserved"],
}
#: Diagonals this near belong to one place of a text with words put in or left out.
NEAR = 3
#: Share of a notice's word pairs that must be found in a place.
LEAST_SHARE = 0.7


def templates(spark: SparkSession) -> DataFrame:
    """The word pairs of all wordings with their places: a few hundred rows, fixed with the lists above."""
    rows = []
    wordings = [(phrase, label, True) for phrase, label in PHRASES.items()]
    wordings += [(text, label, False) for label, texts in NOTICES.items() for text in texts]
    for number, (text, label, exact) in enumerate(wordings):
        parts = re.findall(r"[a-z0-9]+", text.lower())
        rows += [(number, label, exact, place, len(parts) - K + 1, *parts[place:place + K])
                 for place in range(len(parts) - K + 1)]
    if any(grams > 64 for *_, grams, _, _ in rows):
        raise ValueError("a wording of more than 65 words has more places than a vote has bits")
    pairs = spark.createDataFrame(
        rows, "template int, label string, exact boolean, place int, grams int, t0 string, t1 string")
    return pairs.withColumn("gram", F.xxhash64("t0", "t1"))


def license_votes(docs: DataFrame) -> DataFrame:
    """Votes of the word pairs: one row for each document, template and diagonal met, one more per document.

    The extra row (no template) carries the number of words, so documents without any notice stay.
    """
    text = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    text = text.withColumn("n_words", F.size("words"))
    # a null before the first word: its row meets no template and is there for every document
    marked = F.concat(F.expr("array(cast(null as string))"), F.col("words"))
    grams = text.select(
        "row", "doc_id", "n_words", F.posexplode(rolling(marked, F.col("n_words") + 1, K)).alias("at", "w"),
    ).select("row", "doc_id", "n_words", (F.col("at") - 1).alias("at"), "w.w0", "w.w1", F.xxhash64("w.w0", "w.w1").alias("hash"))
    table = F.broadcast(templates(docs.sparkSession))
    met = grams.join(table, (F.col("hash") == F.col("gram")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")), "left")
    met = met.where(F.col("template").isNotNull() | (F.col("at") < 0))
    # bits of the template's places, so that a place met twice near by counts once
    bit = F.expr("shiftleft(1L, place)")
    return met.groupBy(
        "row", "doc_id", "n_words", "template", "label", "exact", "grams", (F.col("at") - F.col("place")).alias("diagonal"),
    ).agg(F.bit_or(bit).alias("places"), F.count("template").alias("votes"))


def license_spans(docs: DataFrame) -> DataFrame:
    """Places of notices: votes of neighbouring diagonals merged and verified.

    Takes doc_id and text; other columns are ignored, whatever their names. Returns a row for each place
    (row, doc_id, n_words, template, label, exact, start, share) and one without template per input row.
    `share` is the part of the notice's word pairs found; exact phrases count only whole on one diagonal.
    Equal rows are kept apart by `row`; null and empty texts have no words; no rows give no rows.
    """
    votes = license_votes(docs)
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    places = F.when(F.col("exact"), F.col("places")).otherwise(
        F.bit_or("places").over(near.rangeBetween(0, NEAR)))
    share = F.bit_count(places) / F.col("grams")
    spans = votes.withColumn("share", share).where(
        F.col("template").isNull() | (F.col("share") >= F.when(F.col("exact"), 1.0).otherwise(LEAST_SHARE)))
    # of diagonals side by side the first stands for the place
    follows = ~F.col("exact") & (F.col("diagonal") <= F.lag("diagonal").over(near) + NEAR)
    spans = spans.withColumn("follows", F.coalesce(follows, F.lit(False))).where(~F.col("follows"))
    return spans.select("row", "doc_id", "n_words", "template", "label", "exact", F.col("diagonal").alias("start"), "share")


def license_labels(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, base and all labels, score (best share)."""
    base = F.col("exact")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return license_spans(docs).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    ).drop("row")
