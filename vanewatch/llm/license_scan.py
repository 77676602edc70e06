"""Finds license notices: a set-similarity join of text blocks with notice templates.

For a template of ``w`` words a block is a window of ``2 * w`` consecutive words, starting ``w`` after the one before, so
that every stretch as long as the template lies in one of them. A block meets a template if it holds at least
``threshold`` of the template's distinct words. Words are ordered by their frequency over all texts, the rarest first.
With ``need`` the smallest overlap that suffices for a template of ``n`` distinct words, at least one of its
``n - need + 1`` rarest words must be in the block (prefix filter), so only blocks around such a word are looked at: the
texts' words are joined with the prefixes' words. The block must have ``need`` distinct words (length filter), and the
words that follow the first common one on either side must be enough (positional filter). What is left is counted
exactly, so nothing is missed.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm.words import lower_ascii, split_words

# fixed values: what lies between two words
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: phrases and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.9
# Words of templates that are broadcast at once, some 100 bytes each; longer lists of templates take several rounds.
PART_WORDS = 200_000

# fixed values: notices as they are commonly written, and their labels
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]


def notice_words(text: Column) -> Column:
    return split_words(lower_ascii(F.coalesce(text, F.lit(""))), GAP)


Template = tuple[int, str, list[str]]


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table as one literal, which needs no Python worker and leaves the plan as short as it is."""
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def template_words(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> list[Template]:
    """Number, label and words of each template that has words."""
    rows = [{"template": i, "label": label, "text": text} for i, (label, text) in enumerate(templates)]
    found = _table(spark, rows, "template: int, label: string, text: string").select(
        "template", "label", notice_words(F.col("text")).alias("words")
    )
    return [(r["template"], r["label"], r["words"]) for r in found.collect() if r["words"]]


def _parts(templates: list[Template]) -> Iterator[list[Template]]:
    """The templates in lists that may be broadcast; a longer template is in one of its own."""
    part, size = [], 0
    for template in templates:
        if part and size + len(template[2]) > PART_WORDS:
            yield part
            part, size = [], 0
        part.append(template)
        size += len(template[2])
    if part:
        yield part


def _ranks(texts: DataFrame, templates: list[Template]) -> dict[str, int]:
    """The place of each template word in their order by occurrences in all texts, the rarest first."""
    words = sorted({word for *_, words in templates for word in words})
    known = _table(texts.sparkSession, [{"word": word} for word in words], "word: string")
    counts = texts.select(F.explode_outer("words").alias("word")).join(F.broadcast(known), "word", "left_semi").groupBy("word").count()
    # at most one row for each word of the templates, which come from the driver
    found = {row["word"]: row["count"] for row in counts.collect()}
    return {word: rank for rank, word in enumerate(sorted(words, key=lambda w: (found.get(w, 0), w)))}


def _met(texts: DataFrame, templates: list[Template], threshold: float) -> DataFrame:
    """``key``, ``label`` and ``share`` for each block of ``texts`` (``key``, ``words``) that meets a template."""
    spark = texts.sparkSession
    order = _ranks(texts, templates)
    sets, prefixes = [], []
    for number, label, words in templates:
        tokens = sorted(set(words), key=order.__getitem__)
        need = max(1, math.ceil(round(threshold * len(tokens), 9)))
        ranks = [order[token] for token in tokens]
        prefix = len(tokens) - need + 1
        sets.append({"template": number, "label": label, "need": need, "ranks": ranks, "prefix": ranks[:prefix]})
        prefixes += [{"rare": t, "template": number, "width": len(words), "need": need} for t in tokens[:prefix]]
    index = _table(spark, prefixes, "rare: string, template: int, width: int, need: int")
    known = _table(spark, [{"word": word, "rank": rank} for word, rank in order.items()], "word: string, rank: int")
    wanted = _table(spark, sets, "template: int, label: string, need: int, ranks: array<int>, prefix: array<int>")

    # prefix filter; the words themselves stay in the scan's own stage and only blocks leave it. A plain explode would have
    # the words split once more, in a filter of empty arrays
    placed = texts.select("key", "words", F.posexplode_outer("words").alias("at", "rare")).join(F.broadcast(index), "rare")
    cell = F.floor(F.col("at") / F.col("width")).cast("int")
    around = placed.select(
        "key", "template", "need", "width", "rare", "at", "words", F.explode(F.array(cell - 1, cell)).alias("block")
    ).filter("block >= 0 and (block = 0 or (block + 1) * width < size(words))")
    window = F.slice("words", F.col("block") * F.col("width") + 1, 2 * F.col("width"))
    # length filter, and of a word that is in the block several times the first place alone
    blocks = around.select(
        "key", "template", "need", "block", "rare", (F.col("at") - F.col("block") * F.col("width") + 1).alias("place"), window.alias("window")
    ).filter((F.size("window") >= F.col("need")) & (F.array_position("window", F.col("rare")) == F.col("place")))
    held = (
        blocks.select("key", "template", "block", F.explode_outer(F.array_distinct("window")).alias("word"))
        .join(F.broadcast(known), "word")
        .groupBy("key", "template", "block")
        .agg(F.collect_set("rank").alias("held"))
        .join(F.broadcast(wanted), "template")
    )
    first = held.withColumn("first", F.array_min(F.array_intersect("prefix", "held")))
    after = F.size(F.filter("held", lambda rank: rank >= F.col("first")))
    left = F.size("ranks") - F.array_position("ranks", F.col("first")) + 1
    positioned = first.filter((after >= F.col("need")) & (left >= F.col("need")))
    overlap = F.size(F.array_intersect("ranks", "held"))
    return positioned.filter(overlap >= F.col("need")).select("key", "label", (overlap / F.size("ranks")).alias("share"))


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each row of ``docs``: phrase places, labels, and the best template containment as score.

    Null and empty texts have no words and no labels, and score 0. A document without a template that is met
    scores 0. Equal texts, repeated rows among them, get the same result; an empty table gives an empty one, and
    templates without words are never met. Only the text and the id are read, so other columns may have any name.
    Texts are scanned whole, however long, three times; what is shuffled is a row for each template word, one for each
    block that holds a rare word of a template, and one without its text for each document.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    split = rows.select("id", F.xxhash64("body").alias("key"), notice_words(F.col("body")).alias("words"))
    texts = split.select("key", "words")
    met = _table(docs.sparkSession, [], "key: long, label: string, share: double")
    for part in _parts(template_words(docs.sparkSession, templates)):
        met = met.unionByName(_met(texts, part, threshold))
    best = met.groupBy("key").agg(F.collect_set("label").alias("met"), F.max("share").alias("share"))

    placed = split.select(
        "id", "key", F.size("words").cast("long").alias("n_words"), _phrase_places(F.col("words"), phrases).alias("places")
    )
    found = placed.join(best, "key", "left")
    base = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["at"].cast("long"))
    more = F.coalesce("met", F.array().cast("array<string>"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    return found.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )


def _places(words: Column, phrase: str, label: str) -> Column:
    parts = phrase.split(" ")

    def is_here(i: Column) -> Column:
        test = F.lit(True)
        for k, word in enumerate(parts):
            test = test & F.get(words, i + k).eqNullSafe(F.lit(word))
        return test

    places = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(words)), is_here),
        lambda i: F.struct(F.lit(label).alias("label"), i.alias("at")),
    )
    holds = F.array_contains(words, parts[0]) & F.array_contains(words, parts[-1])
    return F.when(holds, places).otherwise(F.array().cast("array<struct<label:string,at:int>>"))


def _phrase_places(words: Column, phrases: dict[str, str]) -> Column:
    """Every place where a phrase's words stand one after another."""
    none = F.array().cast("array<struct<label:string,at:int>>")
    return F.concat(none, *[_places(words, phrase, label) for phrase, label in phrases.items()])
