"""License scan: an exact set-similarity join between blocks of text and license templates.

Tokens are ordered by how many documents hold them, rarest first.  A block that shares at least
``need`` tokens with a template must hold one of its first ``size - need + 1`` tokens (prefix
filter), must have ``need`` tokens itself (length filter), and from the place of a shared token on
both sides must have enough tokens left (positional filter).  What passes is verified in full, so
every block that reaches the containment threshold is found.  Phrases are templates too; their
verified blocks are searched for places where the words stand consecutively.

Blocks are ``2 * STRIDE`` words, one every ``STRIDE``: a span of up to ``STRIDE + 1`` words lies
whole in the block that its first word begins in.  Only blocks with a prefix token leave their row.
The template table is a parameter of the call and as small as its source text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import store, words

# Phrases to be found word by word, and openings of public license texts.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance "
                 "with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
THRESHOLD = 0.8
STRIDE = 32


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def needed(size: int, threshold: float) -> int:
    """Shared tokens that a template of ``size`` tokens asks for."""
    return max(1, math.ceil(threshold * size - 1e-9))


def token_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each token of the vocabulary (one row per token reaches the driver)."""
    held = docs.select(F.explode(F.array_intersect(words(F.col("text")), _array(vocabulary))).alias("token"))
    return {r[0]: r[1] for r in held.groupBy("token").count().collect()}


def license_scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Licenses that every document names or quotes.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  ``phrases`` are (label,
    words) of at most ``STRIDE + 1`` words, ``templates`` (label, text).  Returns one row per input
    row: ``doc_id``, ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word``
    (their least and greatest start, null without places), ``base_labels``, ``labels`` (of phrases
    and of blocks with at least ``threshold`` of a template's distinct words; sorted, comma-joined,
    '' without any), ``score`` (greatest containment found, 0 without any).  Null or empty texts
    have no words; rows that repeat an id and a text get equal results.
    """
    known = [(label, text.split(), True) for label, text in phrases]
    known += [(label, text.split(), False) for label, text in templates]
    if not known or any(len(ws) > STRIDE + 1 for _, ws, exact in known if exact):
        raise ValueError("give at least one template, and no phrase longer than a stride and a word")
    spark = docs.sparkSession
    counts = token_counts(docs, sorted({w for _, ws, _ in known for w in ws}))
    order = sorted({w for _, ws, _ in known for w in ws}, key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    postings = []
    for label, ws, exact in known:
        tokens = sorted(set(ws), key=place.__getitem__)
        need = needed(len(tokens), threshold)
        postings += [
            (t, i, label, " ".join(ws) if exact else None, tokens, need)
            for i, t in enumerate(tokens[: len(tokens) - need + 1])
        ]
    schema = "token string, i int, label string, phrase string, tokens array<string>, need int"
    posted = spark.createDataFrame(postings, schema)
    prefix = _array(sorted({p[0] for p in postings}))

    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark")]
    ws = F.col("ws")
    docs_ws = docs.select(*key, words(F.col("text")).alias("ws")).where(F.arrays_overlap(ws, prefix))
    at = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.array_contains(prefix, F.get(ws, i)))
    number = lambda i: F.floor(i / STRIDE).cast("int")
    blocks = F.transform(at, lambda i: F.sequence(F.greatest(F.lit(0), number(i) - 1), number(i)))
    blocks = F.transform(
        F.array_distinct(F.flatten(blocks)),
        lambda b: F.struct(
            (b * STRIDE).alias("start"),
            F.slice(ws, b * STRIDE + 1, 2 * STRIDE).alias("words"),
        ),
    )
    block = docs_ws.select("doc_id", "mark", F.explode(blocks).alias("b")).select("doc_id", "mark", "b.*")
    # The result follows the order of the first array: rarest first.
    block = block.withColumn("held", F.array_intersect(_array(order), F.col("words")))
    held = F.size("held")
    pairs = block.select("*", F.posexplode("held").alias("j", "token")).join(posted, "token")
    pairs = pairs.where(held >= F.col("need"))
    pairs = pairs.where(1 + F.least(F.size("tokens") - 1 - F.col("i"), held - 1 - F.col("j")) >= F.col("need"))
    shared = F.size(F.array_intersect("held", "tokens"))
    found = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    length = F.size(F.split("phrase", " "))
    starts = F.filter(
        F.sequence(F.lit(0), F.lit(STRIDE - 1)),
        lambda p: F.array_join(F.slice("words", p + 1, length), " ") == F.col("phrase"),
    )
    starts = F.when(F.col("phrase").isNull(), F.array().cast("array<int>")).otherwise(starts)
    found = found.select(
        "doc_id", "mark", "label", "phrase", (F.col("shared") / F.size("tokens")).alias("score"),
        F.transform(starts, lambda p: p + F.col("start")).alias("starts"),
    )
    # A block can pass by several prefix tokens; sets take each place once.
    places = F.flatten(F.collect_set(F.transform("starts", lambda s: F.struct("phrase", s.alias("start")))))
    hits = found.groupBy("doc_id", "mark").agg(
        F.array_distinct(places).alias("places"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.array_sort(F.collect_set(F.when(F.size("starts") > 0, F.col("label")))).alias("base"),
        F.max("score").alias("score"),
    )
    at = F.transform("places", lambda p: p["start"])
    hits = store(
        hits.select(
            "doc_id", "mark", F.size("places").cast("bigint").alias("n_base"),
            F.array_min(at).cast("bigint").alias("first_word"), F.array_max(at).cast("bigint").alias("last_word"),
            F.array_join("base", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        ),
        "licenses",
    )
    count = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")
    every, hit = docs.select(*key, count.alias("n_words")).alias("e"), hits.alias("h")
    same = every["doc_id"].eqNullSafe(hit["doc_id"]) & (every["mark"] == hit["mark"])
    return every.join(hit, same, "left").select(
        "e.doc_id", "e.n_words", F.coalesce("h.n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "h.first_word", "h.last_word", F.coalesce("h.base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("h.labels", F.lit("")).alias("labels"), F.coalesce("h.score", F.lit(0.0)).alias("score"),
    )
