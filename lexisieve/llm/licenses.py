"""License scan: an exact containment join of text blocks with license templates.

A block is a run of words; a template is met when at least ``threshold`` of its distinct
words occur in the block, of templates below ten words all of them. Blocks have twice as
many words as a template, rounded up to a power of two (64 at least), or fewer at the end
of a text. Every block that starts with a template's word is looked at; any other block
holds no more of a template than the next one that does.

The join: words are ordered by how many documents hold them, rare ones first, counted
over all documents. Of a template's words in that order, one of the first
``size - need + 1`` must be in the block (prefix), the block must hold ``need`` words that
are in templates at all (length), and the words after the first common one must suffice
on both sides (position). What is left is intersected.

Native: one pass over the texts; words are carried on only for documents that hold
enough of a template's words anywhere, which no filter by frequency is needed for.

Defined results: null or empty text has no words and no labels; rows with equal ids share
one id's labels; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.llm.common import ascii_lower, split_words
from lexisieve.session import materialize

SHORT = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# --- fixed values: phrases and public license notices --------------------------

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = [
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files the software to deal in the software without restriction",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of"
        " the license at http www apache org licenses license 2 0",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of"
        " the gnu general public license as published by the free software foundation",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
    (
        "warranty",
        "the software is provided as is without warranty of any kind express or implied including"
        " but not limited to the warranties of merchantability fitness for a particular purpose and"
        " noninfringement in no event shall the authors or copyright holders be liable for any claim"
        " damages or other liability",
    ),
]


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]  # distinct
    need: int
    span: int  # words of the whole notice


def templates(threshold: float, texts: list[tuple[str, str]] = TEMPLATES) -> list[Template]:
    return [
        Template(
            i,
            label,
            words,
            len(words) if len(words) < SHORT else math.ceil(threshold * len(words) - 1e-9),
            len(text.split()),
        )
        for i, (label, text) in enumerate(texts)
        for words in [tuple(dict.fromkeys(text.split()))]
    ]


def block_size(template: Template) -> int:
    """Twice a power of two that is no less than the notice and no less than 32."""
    return 2 * max(32, 1 << (template.span - 1).bit_length())


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the words of ``phrase`` stand one after another, from 0."""
    first, *rest = phrase.split()

    def place(word: Column, i: Column) -> Column:
        here = word == first
        for k, other in enumerate(rest, 1):
            here = here & (F.get(words, i + k) == other)
        return F.when(here, i.cast("bigint"))

    return F.array_compact(F.transform(words, place))


def scan_words(docs: DataFrame, chosen: list[Template], id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: words count, phrase places, template words, and all words
    where some template's need could be met."""
    vocabulary = sorted({w for t in chosen for w in t.words})
    words = split_words(ascii_lower(F.col(text_col)), SEPARATORS)
    df = docs.select(F.col(id_col).alias("doc_id"), words.alias("_words"))
    df = df.withColumn(
        "known", F.array_distinct(F.filter("_words", lambda w: w.isin(vocabulary)))
    )
    last = sorted({p.split()[-1] for p in PHRASES})
    none = F.array().cast("array<bigint>")
    places = [
        F.when(F.arrays_overlap("known", F.array(*map(F.lit, last))), phrase_places(F.col("_words"), p))
        .otherwise(none)
        .alias(label)
        for p, label in PHRASES.items()
    ]
    may_meet = F.lit(False)
    for t in chosen:
        shared = F.size(F.array_intersect("known", F.array(*map(F.lit, t.words))))
        may_meet = may_meet | (shared >= t.need)
    return df.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.struct(*places).alias("places"),
        "known",
        F.when(may_meet, F.col("_words")).alias("words"),
    )


def word_order(scanned: DataFrame) -> dict[str, int]:
    """Template words by rising document count, ties by word; bounded by the templates."""
    counted = scanned.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    return {r["word"]: i for i, r in enumerate(sorted(counted, key=lambda r: (r["count"], r["word"])))}


def prefix_table(spark: SparkSession, chosen: list[Template], order: dict[str, int]) -> DataFrame:
    """``(word, template, t_at, t_size, need, label, block, words)`` of every prefix word."""
    rows = []
    for t in chosen:
        ranked = sorted(t.words, key=lambda w: (order.get(w, -1), w))
        for at, word in enumerate(ranked[: len(ranked) - t.need + 1]):
            rows.append((word, t.number, at, len(ranked), t.need, t.label, block_size(t), ranked))
    return spark.createDataFrame(
        rows,
        "word string, template int, t_at int, t_size int, need int, label string, block int,"
        " t_words array<string>",
    )


def license_blocks(scanned: DataFrame, chosen: list[Template]) -> DataFrame:
    """Every block that starts with a word of a template it meets: ``doc_id, template, label, start,
    end, containment``.

    ``start`` and ``end`` bound the block in words.
    """
    spark = scanned.sparkSession
    order = word_order(scanned)
    vocabulary = sorted(order, key=order.get)
    if not vocabulary:
        vocabulary = [""]
    ranked_vocabulary = F.array(*map(F.lit, vocabulary))
    every = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)))
    starts = []
    for size in sorted({block_size(t) for t in chosen}):
        theirs = sorted({w for t in chosen if block_size(t) == size for w in t.words})
        places = F.filter(every, lambda i: F.get("words", i).isin(theirs))  # noqa: B023
        starts.append(F.transform(places, lambda i: F.struct(i.alias("start"), F.lit(size).alias("block"))))  # noqa: B023
    blocks = (
        scanned.filter("words IS NOT NULL")
        .select("doc_id", "words", F.inline(F.concat(*starts)))
        .withColumn("first", F.get("words", F.col("start")))
        # the vocabulary is in global order, and an intersection keeps the left side's order
        .withColumn(
            "tokens",
            F.array_intersect(ranked_vocabulary, F.slice("words", F.col("start") + 1, F.col("block"))),
        )
        .withColumn("end", F.least(F.col("start") + F.col("block"), F.size("words")))
        .select("doc_id", "start", "end", "block", "first", "tokens")
    )
    prefixes = prefix_table(spark, chosen, order)
    hits = (
        blocks.select("*", F.posexplode("tokens").alias("b_at", "word"))
        .join(F.broadcast(prefixes), ["word", "block"])  # bounded by the templates
        .filter((F.size("tokens") >= F.col("need")) & F.array_contains("t_words", F.col("first")))
        .groupBy("doc_id", "start", "end", "template", "label", "need", "t_size", "t_words", "tokens")
        .agg(F.min("b_at").alias("b_at"), F.min("t_at").alias("t_at"))
        .filter(
            F.least(F.col("t_size") - F.col("t_at"), F.size("tokens") - F.col("b_at")) >= F.col("need")
        )
        .withColumn("shared", F.size(F.array_intersect("tokens", "t_words")))
        .filter(F.col("shared") >= F.col("need"))
    )
    return hits.select(
        "doc_id", "template", "label", "start", "end", (F.col("shared") / F.col("t_size")).alias("containment")
    )


def license_scan(
    docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(per document, blocks)``.

    Per document: word count, phrase counts and places, the phrases' labels, all labels and
    the best containment of any template (0 without one).
    """
    chosen = templates(threshold)
    scanned = materialize(scan_words(docs, chosen, id_col, text_col))
    blocks = license_blocks(scanned, chosen)
    best = blocks.groupBy("doc_id").agg(
        F.collect_set("label").alias("_found"), F.max("containment").alias("_score")
    )
    places = {label: F.col(f"places.{label}") for label in PHRASES.values()}
    everywhere = F.concat(*places.values())
    base = F.array_compact(F.array(*[F.when(F.size(at) > 0, F.lit(label)) for label, at in places.items()]))
    documents = (
        scanned.select("doc_id", "n_words", everywhere.alias("_at"), base.alias("_base"))
        .join(best, "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.size("_at").cast("bigint").alias("n_base"),
            F.array_min("_at").alias("first_word"),
            F.array_max("_at").alias("last_word"),
            F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(
                    F.array_union("_base", F.coalesce("_found", F.array().cast("array<string>")))
                ),
                ",",
            ).alias("labels"),
            F.coalesce("_score", F.lit(0.0)).alias("score"),
        )
    )
    return documents, blocks
