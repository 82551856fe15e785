"""License scan by an exact set-similarity join of text blocks and templates.

A block is a stretch of words wherever lines end (or a line, without ``windows``); a template is the set of words of a
usual notice. Windows are a fourth longer than the template they are held against and start so often that any stretch as long as
the template lies in one: notices broken over several lines are found, words scattered over a long line are not. A block matches a
template if it holds at least ``percent`` per cent of the template's words. The tokens of all templates are put in one global order, rarest in all
blocks first. A matching block must hold one of a template's first ``size - need + 1`` tokens (prefix filter), needs at
least ``need`` template tokens at all (length filter), and behind the places of the first shared token both sides must
have enough tokens left (positional filter). Pairs that pass are counted exactly, so no match is lost.

Only the templates' own words take part, as no other word can add to a containment, and a document without any prefix
token is not looked at further. The templates are a parameter and the order of their words (a row per distinct word of
the templates) the only thing that reaches the driver.

Beside the join, the places where a license's name stands word by word are counted with their word numbers.

Behaviour: null text is an empty one (no words, no labels, score 0, null places); empty tables give empty results;
repeated rows and ties are scanned row by row (rows with equal ids and texts have equal results); null ids are kept;
extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

APART = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"  # no part of a word, once A-Z are lower-cased
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The names asked for, and usual wordings of license notices with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = (
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                   "associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
)
PERCENT = 90


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), f"[{APART}]+"), "")


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(f"[^{APART}]+", text.lower())))


def template_length(text: str) -> int:
    return len(re.findall(f"[^{APART}]+", text.lower()))


def _any_of(phrases) -> str:
    """A pattern for one of the phrases, in any case, as whole words."""
    inside = "|".join(f"[{APART_RAW}]+".join(map(re.escape, p.split())) for p in phrases)
    return f"(?i)(?<![^{APART_RAW}])(?:{inside})(?![^{APART_RAW}])"


#: As ``APART`` for text that is not lower-cased: A-Z belong to words.
APART_RAW = "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(words: Column, phrase: str) -> Column:
    """Numbers of the words at which ``phrase`` starts."""
    parts = phrase.split()

    def starts(i):
        holds = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            holds &= F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return holds

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), starts)


def base(text: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Struct of ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` (array)."""
    kind = "struct<n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>>"
    nothing = F.struct(F.lit(0), F.lit(None), F.lit(None), F.array()).cast(kind)

    def found(words):
        each = F.array(*(F.struct(F.lit(label).alias("label"), _places(words, p).alias("places")) for p, label in phrases.items()))

        def told(e):
            places = F.flatten(F.transform(e, lambda x: x["places"]))
            held = F.filter(e, lambda x: F.size(x["places"]) > 0)
            return F.struct(
                F.size(places), F.array_min(places), F.array_max(places), F.array_sort(F.array_distinct(F.transform(held, lambda x: x["label"])))
            ).cast(kind)

        return _let(each, told)

    return F.when(F.rlike(text, F.lit(_any_of(phrases))), _let(words_of(text), found)).otherwise(nothing)


def _lines_with(docs: DataFrame, vocabulary: list[str], having: list[str] | None) -> DataFrame:
    """``doc``, ``tie``, ``block`` (its line) and ``tokens``: distinct words of the line that are in ``vocabulary``."""
    rows = docs.where(F.rlike("text", F.lit(_any_of(having)))) if having else docs
    lines = rows.select("doc", "tie", F.posexplode(F.split("text", "\n")).alias("block", "line"))
    if having:
        lines = lines.where(F.rlike("line", F.lit(_any_of(having))))
    return lines.select("doc", "tie", "block", F.array_intersect(words_of(F.col("line")), F.array(*map(F.lit, vocabulary))).alias("tokens"))


def slack(length: int) -> int:
    """Words by which a window is longer than a template of ``length`` words, and between the starts of windows."""
    return max(1, length // 4)


def _windows_with(docs: DataFrame, shapes: dict[int, tuple[list[str], int]], having: list[str]) -> DataFrame:
    """``doc``, ``tie``, ``length``, ``block`` (first word) and ``tokens`` of windows for templates of each ``length``.

    ``shapes``: the words of the templates of a length, and how many of them a window must hold at least.
    """
    rows = docs.where(F.rlike("text", F.lit(_any_of(having)))).select("doc", "tie", words_of(F.col("text")).alias("words"))
    rows = rows.where(F.size("words") > 0)

    def cut(length, vocabulary, need):
        step = slack(length)
        held = F.transform(
            F.sequence(F.lit(0), F.size("words") - 1, F.lit(step)),
            lambda i: F.struct(
                F.lit(length).alias("length"), i.alias("block"),
                F.array_intersect(F.slice("words", i + 1, length + step), F.array(*map(F.lit, vocabulary))).alias("tokens"),
            ),
        )
        return F.filter(held, lambda x: F.size(x["tokens"]) >= need)

    each = F.flatten(F.array(*(cut(n, ws, need) for n, (ws, need) in sorted(shapes.items()))))
    return rows.select("doc", "tie", F.inline(each))


def matches(
    docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
    windows: bool = True,
) -> DataFrame:
    """All blocks and templates that match: ``doc``, ``tie``, ``block`` (number of the window's first word, or of
    the line), ``label``, ``containment``."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))
    sets = [(label, template_words(wording)) for label, wording in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    counted = _lines_with(keyed, vocabulary, None).select(F.explode("tokens").alias("token")).groupBy("token").count()
    counts = {r["token"]: r["count"] for r in counted.collect()}  # a row per word of the templates
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}

    prefixes, first_tokens, shapes = [], set(), {}
    for number, (label, ws) in enumerate(sets):
        ranks = sorted(order[w] for w in ws)
        need = -(-percent * len(ranks) // 100)
        length = template_length(templates[number][1]) if windows else 0
        for place, rank in enumerate(ranks[: len(ranks) - need + 1]):
            prefixes.append((rank, place, number, label, need, ranks, length))
        held, least = shapes.get(length, ([], need))
        shapes[length] = (sorted({*held, *ws}), min(least, need))
        first_tokens |= {w for w in ws if order[w] in ranks[: len(ranks) - need + 1]}
    index = spark.createDataFrame(prefixes, "rank int, place int, template int, label string, need int, ranks array<int>, length int")

    rank_of = F.create_map(*(x for w, k in order.items() for x in (F.lit(w), F.lit(k))))
    if windows:
        blocks, keys = _windows_with(keyed, shapes, sorted(first_tokens)), ["length", "rank"]
    else:
        blocks, keys = _lines_with(keyed, vocabulary, sorted(first_tokens)), ["rank"]
        index = index.drop("length")
    blocks = blocks.withColumn("ranks_b", F.sort_array(F.transform("tokens", lambda w: F.element_at(rank_of, w))))
    heads = blocks.select("doc", "tie", *keys[:-1], "block", "ranks_b", F.posexplode("ranks_b").alias("place_b", "rank"))
    both = F.array_intersect("ranks_b", "ranks")
    shared = F.size(both)
    fit = (
        heads.join(index, keys)
        .where(F.size("ranks_b") >= F.col("need"))  # length
        .where(F.least(F.size("ranks") - F.col("place"), F.size("ranks_b") - F.col("place_b")) >= F.col("need"))  # position
        .where((F.array_min(both) == F.col("rank")) & (shared >= F.col("need")))  # at the first shared token only
    )
    return fit.select("doc", "tie", "block", "label", (shared / F.size("ranks")).alias("containment"))


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, percent: int = PERCENT,
    id_col: str = "doc_id", text_col: str = "text", windows: bool = True,
) -> DataFrame:
    """Per row: id, ``n_words``, the places of names (``n_base``, ``first_word``, ``last_word``, ``base_labels``),
    ``labels``, ``score`` (1 with a name, else the best containment, else 0) and ``blocks`` (first words of matching
    windows, or matching lines)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = matches(docs, templates, percent, id_col, text_col, windows).groupBy("doc", "tie").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"), F.collect_set("block").alias("_blocks")
    )
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_tie"),
        F.regexp_count(text, F.lit(f"[^{APART_RAW}]+")).cast("bigint").alias("n_words"), base(text, phrases).alias("_base"),
    )
    joined = rows.join(hits, F.col("_id").eqNullSafe(F.col("doc")) & (F.col("_tie") == F.col("tie")), "left")
    labels = F.coalesce("_labels", F.array().cast("array<string>"))
    named = F.col("_base.base_labels")
    return joined.select(
        F.col("_id").alias(id_col), "n_words", "_base.n_base", "_base.first_word", "_base.last_word",
        F.array_join(named, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(named, labels)), ",").alias("labels"),
        F.when(F.col("_base.n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
        F.sort_array(F.coalesce("_blocks", F.array().cast("array<int>"))).alias("blocks"),
    )
