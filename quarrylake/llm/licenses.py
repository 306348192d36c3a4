"""License scans by an exact set-similarity join of text blocks with templates.

A block is a run of consecutive words of the whole text, whatever lines it spans, half
as long again as the template it is held against. It meets the template if it holds at
least `CONTAINMENT` of the template's distinct words. Words are ranked by how many
documents hold them, the rarest first; of a template only its prefix, the words of
which a match must hold one, is looked up. Around each such word, surroundings with
fewer template words than a match needs (length filter) and those whose remaining words
after the common one cannot reach it (positional filter) are dropped before sets are
intersected; then every block inside them is tried.

Notices of one family differ by a word. Of two templates where one holds `CONTAINMENT`
of the other, only the one that fits better counts where their blocks overlap: the
greater share, then the more words met.

Beside that, fixed phrases are found wherever their words stand consecutively in
the whole text. All of it is column expressions and joins.

Defined cases: a null or empty text has no words, places or labels and score 0;
repeated rows are returned each and told apart by a row number of the stored pass;
extra columns are ignored; an empty table gives no rows. The score is the best
containment of a met template, one half where only a fixed phrase was found.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import stored

SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Public license notices and the labels they stand for.
TEMPLATES = (
    ("spdx:apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("spdx:apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("spdx:mit", "Released under the MIT License."),
    ("spdx:mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("spdx:gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("spdx:gpl-3.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("spdx:lgpl-3.0-or-later", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("spdx:lgpl-3.0-or-later", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("spdx:agpl-3.0-or-later", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("spdx:agpl-3.0-or-later", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("spdx:mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("spdx:bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("spdx:cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("spdx:cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("spdx:cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)
CONTAINMENT = 0.8


def words_in(text: str) -> list[str]:
    return [w for w in re.split(SIGNS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def words_of_lower(text: Column) -> Column:
    return F.array_remove(F.split(text, SIGNS), "")


def texts_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def ranks_of(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of every template word, by the number of documents that hold it, over all documents.

    What comes back is a count per template word, so its size is that of the templates.
    """
    held = F.array_intersect(words_of_lower(F.lower("text")), texts_array(vocabulary))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = {row["word"]: row["n"] for row in counts.collect()}
    ordered = sorted(vocabulary, key=lambda w: (known.get(w, 0), w))
    return {word: rank for rank, word in enumerate(ordered)}


def block_words(text: str) -> int:
    """Words of a block that is held against a template: half as many again as the template has."""
    return -(-3 * len(words_in(text)) // 2)


def twins(templates: Sequence[tuple[str, str]], containment: float) -> list[tuple[int, int]]:
    """Pairs (a, b) of templates of which b holds enough of a to meet it."""
    sets = [set(words_in(text)) for _, text in templates]
    pairs = ((a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b)
    return [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= needed(len(sets[a]), containment)]


def needed(size: int, containment: float) -> int:
    return math.ceil(containment * size - 1e-9)


def phrase_starts(words: Column, phrase: str) -> Column:
    """All places where the phrase's words stand consecutively."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return same

    return F.when(F.size(words) > 0, F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)).otherwise(F.array().cast("array<int>"))


def met_templates(rows: DataFrame, templates: Sequence[tuple[str, str]], ranks: dict[str, int], containment: float) -> DataFrame:
    """(id, template, first, end, met, share): every block that starts with a word of a template and meets it.

    `rows` are (id, held) with `held` the places and ranks of the text's template words
    in order of place; a word outside all templates, which no intersection can use,
    never enters the join.
    """
    spark = rows.sparkSession
    prefixes, sets = [], []
    for number, (_, text) in enumerate(templates):
        own = sorted({ranks[w] for w in words_in(text)})
        least = needed(len(own), containment)
        sets.append((number, own, block_words(text)))
        prefixes += [(rank, number, i, len(own), least) for i, rank in enumerate(own[:len(own) - least + 1])]
    widest = max(length for _, _, length in sets)
    looked_up = sorted({p[0] for p in prefixes})
    numbered = F.transform("held", lambda p, x: F.struct(p["rank"].alias("rank"), p["at"].alias("at"), x.alias("x")))
    near = lambda h: F.slice("held", F.greatest(h["x"] - widest + 2, F.lit(1)), 2 * widest - 1)
    hits = F.transform(F.filter(numbered, lambda h: h["rank"].isin(looked_up)), lambda h: F.struct(h["rank"].alias("rank"), h["at"].alias("at"), near(h).alias("near")))
    exploded = rows.select("id", F.explode(hits).alias("hit")).select("id", "hit.*")
    # Both right sides hold the templates and nothing else: their size is a parameter.
    joined = exploded.join(F.broadcast(spark.createDataFrame(prefixes, "rank int, template int, i int, size int, least int")), "rank")
    joined = joined.join(F.broadcast(spark.createDataFrame(sets, "template int, own array<int>, length int")), "template")
    around = joined.withColumn("near", F.filter("near", lambda p: F.abs(p["at"] - F.col("at")) < F.col("length")))
    around = around.withColumn("words", F.array_sort(F.array_distinct(F.transform("near", lambda p: p["rank"]))))
    n, j = F.size("words"), F.array_position("words", F.col("rank")).cast("int") - 1
    reach = F.least("i", j) + 1 + F.least(F.col("size") - 1 - F.col("i"), n - 1 - j)
    able = around.filter((n >= F.col("least")) & (reach >= F.col("least")) & (F.size(F.array_intersect("words", "own")) >= F.col("least")))
    mine = able.withColumn("near", F.filter("near", lambda p: F.array_contains("own", p["rank"])))

    def block(start: Column) -> Column:
        inside = F.filter("near", lambda p: (p["at"] >= start["at"]) & (p["at"] < start["at"] + F.col("length")))
        return F.struct(start["at"].alias("first"), F.size(F.array_distinct(F.transform(inside, lambda p: p["rank"]))).alias("met"))

    blocks = mine.select("id", "template", "size", "length", "least", F.explode(F.transform("near", block)).alias("b")).filter(F.col("b.met") >= F.col("least"))
    return blocks.select(
        "id", "template", "b.first", (F.col("b.first") + F.col("length")).alias("end"), "b.met", (F.col("b.met") / F.col("size")).alias("share"),
    ).distinct()


def unshadowed(met: DataFrame, templates: Sequence[tuple[str, str]], containment: float) -> DataFrame:
    """The matches of a text that no better fitting twin overlaps. Only matches that start
    less than a block away are looked at, so a text of many notices costs no more a notice."""
    widest = max(block_words(text) for _, text in templates)
    pairs = [a * len(templates) + b for a, b in twins(templates, containment)]
    near = F.collect_list(F.struct("template", "first", "end", "met", "share")).over(Window.partitionBy("id").orderBy("first").rangeBetween(-widest, widest))

    def better(o: Column) -> Column:
        twin = (F.col("template") * len(templates) + o["template"]).isin(pairs) if pairs else F.lit(False)
        fits = (o["share"] > F.col("share")) | ((o["share"] == F.col("share")) & (o["met"] > F.col("met")))
        return twin & fits & (o["first"] < F.col("end")) & (F.col("first") < o["end"])

    return met.withColumn("near", near).filter(~F.exists("near", better)).drop("near")


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> tuple[DataFrame, DataFrame]:
    """Stored rows (id, doc_id, n_words, text; the text only of rows that hold a rare
    template word or a phrase's first word) and the blocks of theirs that meet a template."""
    vocabulary = sorted({w for _, text in templates for w in words_in(text)})
    ranks = ranks_of(docs, vocabulary)
    by_rank = {rank: word for word, rank in ranks.items()}
    looked_up = {phrase.split(" ")[0] for phrase, _ in PHRASES}
    for _, text in templates:
        own = sorted({ranks[w] for w in words_in(text)})
        looked_up |= {by_rank[r] for r in own[:len(own) - needed(len(own), containment) + 1]}
    # Full lower case finds at least what lower-casing A-Z finds, and parts words alike.
    parted = docs.select("doc_id", "text", words_of_lower(F.lower(F.coalesce("text", F.lit("")))).alias("__words"))
    rows = stored(parted.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", F.size("__words").cast("long").alias("n_words"),
        F.when(F.arrays_overlap("__words", texts_array(sorted(looked_up))), F.translate("text", UPPER, LOWER)).alias("text"),
    ), "license-rows")
    order = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, ranks[w])])
    words = rows.filter(F.col("text").isNotNull()).select("id", words_of_lower(F.col("text")).alias("words"))
    own = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda p: p["word"].isin(vocabulary))
    held = F.transform(own, lambda p: F.struct(p["at"].alias("at"), F.element_at(order, p["word"]).alias("rank")))
    least = min(needed(len(set(words_in(text))), containment) for _, text in templates)
    texts = stored(words.select("id", held.alias("held")).filter(F.size("held") >= least), "license-held")
    return rows, stored(unshadowed(met_templates(texts, templates, ranks, containment), templates, containment), "license-met")


def license_blocks(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, first, end, label, share): the blocks that meet a template, by words from 0,
    the end exclusive, with the share of the template they hold."""
    rows, met = scan(docs, templates, containment)
    named = met.join(rows.select("id", "doc_id"), "id")
    return named.select("doc_id", "first", "end", label_of(F.col("template"), templates).alias("label"), "share")


def label_of(number: Column, templates: Sequence[tuple[str, str]]) -> Column:
    return F.element_at(texts_array([label for label, _ in templates]), number + 1)


def license_labels(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows, met = scan(docs, templates, containment)
    per_row = met.groupBy("id").agg(F.collect_set(label_of(F.col("template"), templates)).alias("found"), F.max("share").alias("share"))
    words = rows.filter(F.col("text").isNotNull()).select("id", "doc_id", "n_words", words_of_lower(F.col("text")).alias("__words"))
    placed = words.select("id", "doc_id", "n_words", *[phrase_starts(F.col("__words"), phrase).alias(f"at_{k}") for k, (phrase, _) in enumerate(PHRASES)])
    starts = F.concat(*[f"at_{k}" for k in range(len(PHRASES))])
    base = F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"at_{k}") > 0, label) for k, (_, label) in enumerate(PHRASES)])))
    based = placed.select("id", "doc_id", "n_words", starts.alias("starts"), base.alias("base"))
    labelled = based.join(per_row, "id", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    some = labelled.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", "found"))), ",").alias("labels"),
        F.coalesce("share", F.when(F.size("starts") > 0, 0.5), F.lit(0.0)).alias("score"),
    )
    nothing = F.lit(None).cast("long")
    others = rows.filter(F.col("text").isNull()).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_base"), nothing.alias("first_word"), nothing.alias("last_word"),
        F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"),
    )
    return some.unionByName(others)
