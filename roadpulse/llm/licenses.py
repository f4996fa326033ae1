"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of ``BLOCK`` words; windows start every ``STEP`` words, so a passage of up to
``STEP`` words lies in one of them whole. A template holds in a block that has at least ``SHARE`` of its
distinct words. Candidates come from the rarest words of a template: words are ordered by their count
in the whole corpus, and a block without one of a template's first ``n - needed + 1`` words can't hold it.

Templates of few words hold for other licenses too, as those differ in a word or two. So a label is stated
only where the template's name stands in the same block as well, its words side by side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import TO_LOWER, words

BLOCK, STEP, SHARE = 64, 32, 0.8

# Phrases that name a license, and sentences that licensed works carry.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("proprietary", "All rights reserved no part may be reproduced without written permission"),
]
# Template -> what names its license, and words after which it is another one. The other templates are
# long sentences of their own.
NAMES = {
    "Released under the MIT License": ("mit", ()),
    "Licensed under the Apache License, Version 2.0": ("apache", ()),
    "This work is licensed under the GNU General Public License, version 3": ("gnu general public", ()),
    "you can redistribute it and/or modify it under the terms of the GNU General Public License": ("gnu general public", ()),
    "Licensed under CC BY 4.0": ("cc by", ("nc", "nd", "sa")),
    "Licensed under CC BY-NC 4.0": ("cc by nc", ("nd", "sa")),
    "Licensed under CC BY-SA 4.0": ("cc by sa", ("nc", "nd")),
}


def template_words(text: str) -> list[str]:
    """The distinct words of a template, in order."""
    low = text.translate(TO_LOWER)
    return list(dict.fromkeys("".join(c if c.isalnum() else " " for c in low).split()))


def needed(size: int, share: float = SHARE) -> int:
    """The fewest common words with which a template of ``size`` words holds."""
    return math.ceil(share * size - 1e-9)


def _places(found: Column, phrase: str) -> Column:
    """Word numbers at which a phrase stands."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        here = F.get(found, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            here &= F.get(found, i + k) == part
        return here

    last = F.size(found) - len(parts)
    some = F.array_contains(found, parts[-1]) & F.array_contains(found, parts[0]) & (last >= 0)
    none = F.array().cast("array<int>")
    return F.when(some, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)).otherwise(none)


def name_places(found: Column) -> Column:
    """Where the names of the templates stand: array of (name, word, until)."""

    def listed(name: str, unless: tuple[str, ...]) -> Column:
        n = len(name.split())
        places = _places(found, name)
        if unless:
            places = F.filter(places, lambda i: ~F.coalesce(F.get(found, i + n).isin(*unless), F.lit(False)))
        return F.transform(places, lambda i: F.struct(F.lit(name).alias("name"), i.alias("word"), (i + n).alias("until")))

    return F.concat(*[listed(*named) for named in sorted(set(NAMES.values()))])


def _stated(held: Column, names: Column) -> Column:
    """Labels of the held (block, template, label) whose template has no name or its name in the block."""
    name_of = F.array(*[F.lit(NAMES.get(t, (None,))[0]).cast("string") for _, t in TEMPLATES])

    def stands(h: Column) -> Column:
        name, start = F.get(name_of, h["template"]), h["block"] * STEP
        inside = lambda p: (p["name"] == name) & (p["word"] >= start) & (p["until"] <= start + BLOCK)
        return name.isNull() | F.exists(names, inside)

    return F.transform(F.filter(held, stands), lambda h: h["label"])


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda i: F.struct(F.lit(label).alias("label"), i.alias("word")))


def phrase_places(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows without ``text``, with ``n_words``, ``places``: array of (label, word), words from 0, and ``names``."""
    found = docs.withColumn("__words__", words(F.col(text)))
    listed = F.concat(*[_labelled(_places(F.col("__words__"), p), label) for p, label in PHRASES.items()])
    kept = [c for c in docs.columns if c not in (text, "n_words", "places", "names")]
    names = name_places(F.col("__words__"))
    return found.select(*kept, F.size("__words__").alias("n_words"), listed.alias("places"), names.alias("names"))


def word_order(docs: DataFrame, vocabulary: list[str], text: str = "text") -> list[str]:
    """The vocabulary from its rarest word to its commonest, by the number of documents with each.

    Counts cover all rows; at most one number per word of the templates reaches the driver.
    """
    wanted = F.array(*map(F.lit, vocabulary))
    seen = docs.select(F.explode(F.array_intersect(words(F.col(text)), wanted)).alias("word"))
    counts = {r["word"]: r["count"] for r in seen.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_matches(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    share: float = SHARE,
) -> DataFrame:
    """Every (block, template) that holds: the key columns, ``block``, ``template``, ``label``, ``containment``."""
    spark = docs.sparkSession
    sets = [(i, label, template_words(t)) for i, (label, t) in enumerate(templates)]
    order = word_order(docs, sorted({w for *_, s in sets for w in s}), text)
    rank = {w: i for i, w in enumerate(order)}
    sets = [(i, label, sorted(s, key=rank.get)) for i, label, s in sets]
    # The index: a row per template and prefix word. Its size is that of the templates.
    index = spark.createDataFrame(
        [
            (word, at, i, label, s, needed(len(s), share))
            for i, label, s in sets
            for at, word in enumerate(s[: len(s) - needed(len(s), share) + 1])
        ],
        "word string, at int, template int, label string, own array<string>, needed int",
    )
    fewest = min(needed(len(s), share) for *_, s in sets)
    firsts = F.array(*[F.lit(w) for w in sorted({w for *_, s in sets for w in s[: len(s) - needed(len(s), share) + 1]})])
    ordered = F.array(*map(F.lit, order))
    found = docs.select(*keys, words(F.col(text)).alias("w")).where(F.arrays_overlap("w", firsts))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1 - STEP, F.lit(0)), F.lit(STEP))
    # A block's words in the templates' vocabulary, rarest first; other words can't be common.
    blocks = found.select(
        *keys,
        F.posexplode(F.transform(starts, lambda s: F.array_intersect(ordered, F.slice("w", s + 1, BLOCK)))).alias("block", "b"),
    ).where(F.size("b") >= fewest)
    listed = blocks.select(*keys, "block", "b", F.posexplode("b").alias("j", "word"))
    # Length and position: what can still be common after this word must reach the number needed.
    left = F.least(F.size("own") - F.col("at"), F.size("b") - F.col("j"))
    candidates = listed.join(F.broadcast(index), "word").where((F.size("b") >= F.col("needed")) & (left >= F.col("needed") - F.col("at")))
    common = F.size(F.array_intersect("b", "own"))
    return (
        candidates.where(common >= F.col("needed"))
        .select(*keys, "block", "template", "label", (common / F.size("own")).alias("containment"))
        .distinct()
    )


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, places of the phrases, labels of phrases and templates, and a score.

    ``labels`` are those of the phrases and of the templates that hold and whose names stand there, so they do
    not contradict each other; ``held_labels`` are those of every template that holds, also of one that only
    resembles the text's license. ``score`` is 1 where a phrase stands, else the greatest containment of a
    template that holds, stated or not, else 0.
    A null or empty text has no words, no labels and a score of 0. Repeated rows stay, each with the result
    of its own text; a null key is a key like any other. Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
    based = phrase_places(rows, "t")
    matched = (
        template_matches(rows, ["k", "h"], "t")
        .groupBy(F.col("k").alias("mk"), F.col("h").alias("mh"))
        .agg(
            F.collect_set("label").alias("found"),
            F.max("containment").alias("best"),
            F.collect_set(F.struct("block", "template", "label")).alias("held"),
        )
    )
    joined = based.join(matched, F.col("k").eqNullSafe(F.col("mk")) & (F.col("h") == F.col("mh")), "left")
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    none = F.array().cast("array<string>")
    stated = F.coalesce(_stated(F.col("held"), F.col("names")), none)
    return joined.select(
        F.col("k").alias(key),
        "n_words",
        "places",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, stated)).alias("labels"),
        F.array_sort(F.coalesce("found", none)).alias("held_labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
