"""License scans by diagonal voting.

Every rolling word k-gram of every document is hashed and joined by Spark to
the positions of the same hashes in the license templates.  A hit votes for its
diagonal (place in the document minus place in the template).  Votes are summed
by diagonal, neighbouring diagonals (a few words more or less) are merged, and
the words of the resulting span are aligned with the template to verify it.

The template table has a fixed size, which is checked before it is broadcast;
grams that hit nothing never leave their task.  A hit carries the words around
its diagonal, so that verification needs no second pass over the texts and no
shuffle of them.  All groups are within one document and template.

Phrases (templates that must match exactly) count at every place; longer
templates count from ``MIN_SIMILARITY`` on.

Defined results: null and empty texts have no words and no labels; rows that
repeat id and text get the same result each; an empty table gives an empty
result; other columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value
from docsmith.llm.plain_words import words_of

#: Phrase -> label.  Their words must stand consecutively.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Texts of common license notices -> label.
NOTICES = {
    "all rights reserved": "all-rights-reserved",
    "licensed under cc by nc 4.0": "cc-by-nc",
    "licensed under cc by sa 4.0": "cc-by-sa",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the software), to deal in the software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software": "mit",
    "licensed under the apache license, version 2.0 (the license); you may not use this file except in compliance with "
    "the license. you may obtain a copy of the license at": "apache",
    "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public "
    "license as published by the free software foundation, either version 3 of the license, or (at your option) any "
    "later version": "gpl",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license, v. 2.0": "mpl",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
}
#: Words of a gram, for templates that have at least so many words.
GRAMS = (2, 5)
#: Diagonals so near are one span.
BAND = 3
#: Share of a template's words by which the words it is aligned with reach beyond
#: its diagonal: so many may have been inserted.
REACH = 0.25
#: Share of a span's grams that must vote for it to be verified.
MIN_VOTES = 0.3
MIN_SIMILARITY = 0.9
MAX_TEMPLATE_GRAMS = 100_000


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def template_table(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(hash, template, label, phrase, at, words): every gram of every
    template with its place."""
    rows = []
    for t, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        words = template_words(text)
        if len(words) < GRAMS[0]:
            raise ValueError(f"a template needs {GRAMS[0]} words: {text}")
        k = max(k for k in GRAMS if k <= len(words))
        rows += [(t, label, t < len(phrases), k, at, words[at : at + k], words) for at in range(len(words) - k + 1)]
    if len(rows) > MAX_TEMPLATE_GRAMS:
        raise ValueError(f"{len(rows)} template grams are too many to broadcast")
    df = spark.createDataFrame(rows, "template int, label string, phrase boolean, k int, at int, gram array<string>, words array<string>")
    hashed = F.lit(None).cast("long")
    for k in GRAMS:
        hashed = F.when(F.col("k") == k, F.xxhash64(F.lit(k), *[F.get("gram", F.lit(i)) for i in range(k)])).otherwise(hashed)
    return df.withColumn("hash", hashed).drop("gram")


def hits(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Gram hits: (doc_id, text_hash, template, label, phrase, k, at, words,
    diagonal, lead, around): ``around`` is the document's words from ``lead``
    words before the diagonal on, to as many beyond the template's length."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.lit(1), F.col(text_col)).alias("text_hash"), words_of(F.col(text_col)).alias("own"))
    each = own.select("doc_id", "text_hash", "own", F.posexplode("own").alias("pos", "word"))
    grams = [F.xxhash64(F.lit(k), F.col("word"), *[F.get("own", F.col("pos") + i) for i in range(1, k)]) for k in GRAMS]
    found = each.select("doc_id", "text_hash", "own", "pos", F.explode(F.array(*grams)).alias("hash")).join(F.broadcast(templates), "hash")
    diagonal = F.col("pos") - F.col("at")
    reach = F.greatest(F.lit(BAND), F.floor(F.size("words") * REACH).cast("int"))
    first = F.greatest(diagonal - reach, F.lit(0))
    around = F.slice("own", first + 1, diagonal - first + F.size("words") + reach)
    return found.select("doc_id", "text_hash", "template", "label", "phrase", "k", "at", "words", diagonal.alias("diagonal"), (diagonal - first).alias("lead"), around.alias("around"))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        first, last, like = [], [], []
        for words, around, lead, diagonal, phrase in zip(pdf["words"], pdf["around"], pdf["lead"], pdf["diagonal"], pdf["phrase"], strict=True):
            words, around = list(words), list(around)
            if phrase:
                same = around[lead : lead + len(words)] == words if lead >= 0 else False
                like.append(float(same))
                first.append(diagonal)
                last.append(diagonal + len(words))
                continue
            blocks = [b for b in SequenceMatcher(None, words, around, autojunk=False).get_matching_blocks() if b.size]
            like.append(sum(b.size for b in blocks) / len(words))
            first.append(diagonal - lead + (blocks[0].b if blocks else 0))
            last.append(diagonal - lead + (blocks[-1].b + blocks[-1].size if blocks else 0))
        yield pdf[["doc_id", "text_hash", "label", "phrase"]].assign(first=first, last=last, similarity=like)


def spans(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: (doc_id, text_hash, label, phrase, first, last,
    similarity), words from 0, last exclusive."""
    key = ["doc_id", "text_hash", "template"]
    voted = (
        hits(docs, template_table(docs.sparkSession, phrases, notices), id_col, text_col)
        .groupBy(*key, "diagonal")
        .agg(F.count_distinct("at").alias("votes"), *[F.first(c).alias(c) for c in ("label", "phrase", "k", "words", "lead", "around")])
    )
    order = W.partitionBy(*key).orderBy("diagonal")
    fresh = F.col("phrase") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > BAND, F.lit(True))
    merged = voted.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    best = W.partitionBy(*key, "span")
    strongest = F.row_number().over(best.orderBy(F.desc("votes"), "diagonal"))
    spanned = merged.withColumn("all_votes", F.sum("votes").over(best)).withColumn("nth", strongest).filter("nth = 1")
    needed = F.when(F.col("phrase"), F.lit(1.0)).otherwise(F.lit(MIN_VOTES)) * (F.size("words") - F.col("k") + 1)
    likely = spanned.filter((F.col("all_votes") >= needed) & (F.col("diagonal") + F.size("words") > 0))
    schema = "doc_id long, text_hash long, label string, phrase boolean, first int, last int, similarity double"
    return likely.select("doc_id", "text_hash", "label", "phrase", "diagonal", "lead", "words", "around").mapInPandas(_verify, schema)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (the best similarity of a span)."""
    base = F.col("phrase") & (F.col("similarity") == 1)
    listed = lambda when: F.array_join(F.sort_array(F.collect_set(F.when(when, F.col("label")))), ",")
    found = spans(docs, phrases, notices, id_col, text_col).groupBy("doc_id", "text_hash").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("first"))).alias("last_word"),
        listed(base).alias("base_labels"), listed(base | (~F.col("phrase") & (F.col("similarity") >= MIN_SIMILARITY))).alias("labels"),
        F.max("similarity").alias("score"))
    text = F.col(text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.lit(1), text).alias("text_hash"),
                      F.size(words_of(text)).cast("long").alias("n_words"))
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_hash") == F.col("f.text_hash"))
    return own.alias("d").join(found.alias("f"), same, "left").select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


ship_by_value(__name__)
