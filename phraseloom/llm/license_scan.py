"""9. License scans by diagonal voting.

Every rolling k-gram of words of every text is joined to the positions of that k-gram in a set of license templates.
A match votes for the diagonal `position in text - position in template`. Votes are counted by diagonal, neighbouring
diagonals are merged (a few words more or less in the middle move the rest to a diagonal nearby), and a merged span is
verified by the share of the template's k-grams it holds; of overlapping spans the largest share counts. A base phrase counts only on a full diagonal.

The template table is fixed, so its broadcast has a fixed size. Only matches and one row per text are shuffled.

Defined results: null or empty texts, and texts without a license, have no places, null words, empty label strings and
score 0; whole texts count, however long; rows that share an id, and null ids, are scanned each on its own; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from phraseloom.llm.words import NOT_ALNUM, Words, text_slices

K = 2
NEAR_DIAGONALS = 3
LEAST_SHARE = 0.6

# Base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Passages of public license notices, as words.
NOTICES = [
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("all rights reserved", "all-rights-reserved"),
]


def rolling_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word within the text, hash) of every k-gram, and the number of words of every text."""
    words = Words(data, offsets, NOT_ALNUM, lower=True)
    hashed, inside = words.rolling(K)
    at = np.flatnonzero(inside)
    text = words.text[at]
    return text, at - words.first[text], hashed[at].view(np.int64), words.counts


def template_positions(spark: SparkSession, base: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(h, template, at, grams, is_base, label) of every k-gram of every template."""
    rows = []
    for t, (phrase, label) in enumerate(base + notices):
        data = np.frombuffer(phrase.encode(), np.uint8)
        _, at, hashed, _ = rolling_grams(data, np.array([0, len(data)]))
        rows += [(int(h), t, int(a), len(at), t < len(base), label) for a, h in zip(at, hashed)]
    return spark.createDataFrame(rows, "h bigint, template int, at int, grams int, is_base boolean, label string")


def license_scan(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; spans of the notices as `spans`."""
    spark = docs.sparkSession

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per k-gram, and one per text with `h` null and its number of words in `pos`."""
        from pyspark import TaskContext

        row0 = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False) if batch.column("doc_id").null_count == 0 else None
            for start, stop, data, offsets in text_slices(batch):
                text, pos, hashed, counts = rolling_grams(data, offsets)
                rows = pa.array(np.concatenate([text, np.arange(stop - start)]) + (row0 + start))
                blank = np.zeros(len(text) + stop - start, bool)
                blank[len(text) :] = True
                h = pa.array(np.concatenate([hashed, np.zeros(stop - start, np.int64)]), mask=blank)
                own = batch.column("doc_id").slice(start, stop - start)
                if ids is None:
                    own = pa.concat_arrays([pa.nulls(len(text), pa.int64()), own])
                else:
                    own = pa.array(np.concatenate([np.zeros(len(text), np.int64), ids[start:stop]]), pa.int64())
                yield pa.RecordBatch.from_arrays([rows, own, pa.array(np.concatenate([pos, counts])), h], ["row", "doc_id", "pos", "h"])
            row0 += len(batch)

    templates = F.broadcast(template_positions(spark, base, notices))
    every = docs.select("doc_id", "text").mapInArrow(grams, "row bigint, doc_id bigint, pos bigint, h bigint")
    joined = every.join(templates, "h", "left").filter(F.col("h").isNull() | F.col("template").isNotNull())

    # Votes by diagonal. A text's own row goes the same way, with a null template.
    group = ["row", "template", "diagonal"]
    voted = joined.withColumn("diagonal", F.col("pos") - F.col("at")).groupBy(*group).agg(
        F.max(F.when(F.col("h").isNull(), F.col("doc_id"))).alias("doc_id"),
        F.max(F.when(F.col("h").isNull(), F.col("pos"))).alias("n_words"),
        F.collect_set("at").alias("ats"),
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
        *[F.first(c).alias(c) for c in ("grams", "is_base", "label")],
    )
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(by) <= NEAR_DIAGONALS
    # A base phrase never merges: each of its full diagonals is one place.
    piece = F.sum(F.when(F.coalesce(fresh & ~F.col("is_base"), F.lit(False)), 0).otherwise(1)).over(by)
    spans = (
        voted.withColumn("piece", piece)
        .groupBy("row", "template", "piece")
        .agg(
            *[F.max(c).alias(c) for c in ("doc_id", "n_words", "grams", "is_base", "label", "high")],
            F.min("low").alias("low"),
            F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"),
        )
        .withColumn("share", F.col("held") / F.col("grams"))
    )
    place = F.col("is_base") & (F.col("held") == F.col("grams"))
    notice = ~F.col("is_base") & (F.col("share") >= LEAST_SHARE)
    span = F.struct("low", (F.col("high") + K).alias("end"), "label", "share")
    out = spans.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("low"))).alias("first_word"),
        F.max(F.when(place, F.col("low"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(place, F.col("label")))).alias("_base"),
        F.array_sort(F.collect_list(F.when(notice, span))).alias("_spans"),
    )
    # Of spans that overlap, only those of the largest share count: notices resemble each other.
    out = out.withColumn("spans", F.expr("filter(_spans, s -> not exists(_spans, t -> t.share > s.share and t.low < s.end and s.low < t.end))"))
    best = F.greatest(F.when(F.col("n_base") > 0, 1.0), F.array_max("spans.share"), F.lit(0.0))
    out = out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", "spans.label")), ",").alias("labels"),
        best.alias("score"),
        "spans",
    )
    return out
