"""Licence scan by a positional index of rare words.

The notices in `TEMPLATES` are indexed by their rarest words and where these stand. Each
file looks up all of its words that are indexed; every shared word votes for the offset at
which the notice would begin, and the votes of one offset add up to the share of the
notice's weight found there. A notice counts if that share is high enough and one of its
mandatory key phrases is in the file. IDF comes from all documents.

Column expressions only. The index is a literal of at most `INDEXED` entries per template;
nothing but the counts of licence words (one row per word) is shuffled or collected.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import NOT_IN_WORD, plain_words

# Public licence notices, label -> (opening words, key phrases of which one must occur).
TEMPLATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        ("apache license",),
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution", "cc by 4 0"),
    ),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", ("cc by nc",)),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        ("general public license",),
    ),
    "lgpl": (
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
        ("lesser general public license",),
    ),
    "mit": ("Released under the MIT License", ("mit license",)),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
    ),
}
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Rarest words of a template that are indexed, with their places.
INDEXED = 8
# Share of a template's weight that must stand at one offset.
ENOUGH = 0.6


def words_of(text: str) -> list[str]:
    """Words of a phrase or template, as `plain_words` has them."""
    return re.sub(NOT_IN_WORD, " ", text.lower()).split()


def licence_words(templates: dict = TEMPLATES) -> list[str]:
    return sorted({w for text, _ in templates.values() for w in words_of(text)})


def word_weights(docs: DataFrame, templates: dict = TEMPLATES) -> dict[str, float]:
    """IDF of each licence word over all documents: ln((rows + 1) / (rows with it + 1)) + 1."""
    lexicon = licence_words(templates)
    found = F.array_intersect(plain_words(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, lexicon)))
    # one more word that no text can contain counts the rows
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("word"))
    counts = {row.word: row.n for row in rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1 for w in lexicon}


def rare_index(weights: dict[str, float], templates: dict = TEMPLATES) -> tuple[dict[str, list], list[float]]:
    """Postings word -> [(template number, place, weight)] of the rarest words; template totals."""
    postings: dict[str, list] = {}
    totals = []
    for number, (text, _) in enumerate(templates.values()):
        placed = sorted(enumerate(words_of(text)), key=lambda pw: (-weights[pw[1]], pw[0]))[:INDEXED]
        for place, word in placed:
            postings.setdefault(word, []).append((number, place, weights[word]))
        totals.append(sum(weights[word] for _, word in placed))
    return postings, totals


def _alignments(words: str, postings: dict[str, list]) -> Column:
    """Votes (template, offset, weight) of all indexed words of a file, in order."""
    schema = "map<string, array<struct<t: int, p: int, w: double>>>"
    index = F.from_json(
        F.lit(json.dumps({w: [{"t": t, "p": p, "w": x} for t, p, x in rows] for w, rows in postings.items()})), schema
    )
    placed = F.filter(
        F.transform(F.col(words), lambda w, i: F.when(w.isin(sorted(postings)), F.struct(w.alias("w"), i.alias("i")))),
        lambda s: s.isNotNull(),
    )
    votes = F.flatten(
        F.transform(
            placed,
            lambda s: F.transform(
                F.element_at(index, s["w"]),
                lambda x: F.struct(x["t"].alias("t"), (s["i"] - x["p"]).alias("d"), x["p"].alias("p"), x["w"].alias("w")),
            ),
        )
    )
    return F.sort_array(votes)


def _best_shares(votes: str, totals: list[float]) -> Column:
    """For each template the largest share of its weight at one offset; one pass over sorted votes."""
    zero = F.array_repeat(F.lit(0.0), len(totals))
    start = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("d"), F.lit(0.0).alias("s"), zero.alias("best"))

    def step(acc: Column, vote: Column) -> Column:
        same = (acc["t"] == vote["t"]) & (acc["d"] == vote["d"])
        summed = F.when(same, acc["s"] + vote["w"]).otherwise(vote["w"])
        best = F.transform(acc["best"], lambda b, t: F.when(t == vote["t"], F.greatest(b, summed)).otherwise(b))
        return F.struct(vote["t"].alias("t"), vote["d"].alias("d"), summed.alias("s"), best.alias("best"))

    whole = F.array(*(F.lit(float(t)) for t in totals))
    best = F.aggregate(F.col(votes), start, step, lambda acc: acc["best"])
    return F.zip_with(best, whole, lambda b, t: F.when(t > 0, F.least(F.lit(1.0), b / t)).otherwise(0.0))


def _starts_here(words: str, phrase: list[str]):
    def test(i: Column) -> Column:
        met = F.lit(True)
        for k, word in enumerate(phrase):
            met = met & F.coalesce(F.get(F.col(words), i + k) == word, F.lit(False))
        return met

    return test


def scan(docs: DataFrame, templates: dict = TEMPLATES, base: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """Each row's doc_id with its licence labels.

    n_words; n_base, first_word, last_word: places of the base phrases (words from 0, null
    where there is none); base_labels and labels (the base labels and those of the
    templates found): sorted, distinct, comma-joined, empty if none; score: 1 where a base
    phrase stands, else the largest share of a found template's weight, 0 if none; and
    found, an array of (label, share). A null or empty text has no words and no labels.
    Repeated rows and null doc_ids stay; other columns are ignored.
    """
    postings, totals = rare_index(word_weights(docs, templates), templates)
    names = list(templates)
    df = docs.select("doc_id", plain_words(F.coalesce("text", F.lit(""))).alias("_words"))
    keyed = sorted({p for _, phrases in templates.values() for p in phrases} | set(base))
    # key phrases are looked for first: no label can do without one, and few files have any
    df = df.select(
        "doc_id",
        "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")).alias("_line"),
    )
    has = {p: F.col("_line").contains(f" {p} ") for p in keyed}
    any_key = F.lit(False)
    for p in keyed:
        any_key = any_key | has[p]
    df = df.withColumn("_keys", F.array(*(F.when(has[p], F.lit(p)) for p in keyed)))
    df = df.withColumn("_any", F.exists("_keys", lambda k: k.isNotNull())).drop("_line")
    df = df.withColumn("_votes", F.when(F.col("_any"), _alignments("_words", postings)))
    places = F.sequence(F.lit(0), F.size("_words") - 1)

    def label_at(i: Column) -> Column:
        at = F.lit(None).cast("string")
        for phrase, label in base.items():
            at = F.when(_starts_here("_words", words_of(phrase))(i), F.lit(label)).otherwise(at)
        return at

    marked = F.transform(places, lambda i: F.struct(i.cast("bigint").alias("i"), label_at(i).alias("label")))
    df = df.withColumn("_base", F.when(F.col("_any"), F.filter(marked, lambda m: m["label"].isNotNull())))
    df = df.withColumn("_shares", F.when(F.col("_any"), _best_shares("_votes", totals)))

    def verified(t: int, phrases: tuple[str, ...]) -> Column:
        key = F.lit(False)
        for p in phrases:
            key = key | F.array_contains(F.array_compact("_keys"), p)
        share = F.get("_shares", F.lit(t))
        return F.when(key & (share >= ENOUGH), F.struct(F.lit(names[t]).alias("label"), share.alias("share")))

    checks = [verified(t, phrases) for t, (_, phrases) in enumerate(templates.values())]
    found = F.array_compact(F.array(*checks))
    none = F.array().cast("array<struct<label: string, share: double>>")
    df = df.withColumn("found", F.when(F.col("_any"), found).otherwise(none))
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda m: m["label"])))
    no_labels = F.array().cast("array<string>")
    df = df.withColumn("_base_labels", F.coalesce(base_labels, no_labels))
    all_labels = F.array_sort(F.array_union("_base_labels", F.transform("found", lambda f: f["label"])))
    n_base = F.coalesce(F.size("_base"), F.lit(0))
    n_base = F.when(F.col("_base").isNull(), F.lit(0)).otherwise(n_base).cast("bigint")
    score = F.when(n_base > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    )
    return df.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.get("_base", F.lit(0))["i"].alias("first_word"),
        F.get("_base", F.size("_base") - 1)["i"].alias("last_word"),
        F.array_join("_base_labels", ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        score.alias("score"),
        "found",
    )
