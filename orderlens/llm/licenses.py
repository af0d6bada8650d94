"""License scan: phrases, and an exact set-similarity join of text blocks with templates.

Tokens are ordered by how many documents hold them, rarest first. A block that contains a
template to the threshold must hold one of the template's first few tokens in that order (the
prefix), have tokens enough (length), and have enough of them left around the shared token
(position). Pairs that pass are verified on whole sets. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import document_key, whole
from orderlens.llm.quality import shifted
from orderlens.session import staged

# Characters that end a word, in texts that still have their capitals.
BREAKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.8
TEMPLATES = {
    "agpl": "gnu affero general public license as published by the free software foundation",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are"
           " permitted provided that the following conditions are met",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related"
           " rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with"
           " or without fee is hereby granted",
    "lgpl": "gnu lesser general public license as published by the free software foundation",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of"
                " this software and associated documentation files the software to deal in the"
                " software without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "proprietary": "confidential and proprietary unauthorized copying of this file is strictly"
                   " prohibited",
}


def license_words(text: Column) -> Column:
    """Lower-cased words. ``lower`` also changes letters beyond A-Z, but neither where words
    end nor whether one equals an ASCII word (the Kelvin sign aside, which becomes k)."""
    return F.filter(F.split(F.lower(text), f"[{BREAKS}]+"), lambda w: w != "")


def phrase_pattern(phrases: list[str]) -> str:
    """Where a phrase may stand, in any case; exact places are found on words."""
    return "(?i)" + "|".join(p.replace(" ", f"[{BREAKS}]+") for p in phrases)


def _equals(part: str) -> Callable[[Column], Column]:
    return lambda w: w == part


def places(tokens: str, phrase: str) -> Column:
    """Word positions, from 0, where the phrase's words stand consecutively."""
    parts = phrase.split()
    follow = F.transform(F.col(tokens), _equals(parts[0]))
    for n, part in enumerate(parts[1:], 1):
        met = F.transform(shifted(F.col(tokens), n), _equals(part))
        follow = F.zip_with(follow, met, lambda ok, w: ok & F.coalesce(w, F.lit(False)))
    return F.filter(F.transform(follow, lambda ok, i: F.when(ok, i)), lambda i: i.isNotNull())


def phrase_places(docs: DataFrame, keep: list[Column],
                  phrases: dict[str, str] = PHRASES) -> DataFrame:
    """n_words and, per phrase label, ``_at`` with its sorted word positions."""
    text = whole()
    may = text.rlike(phrase_pattern(list(phrases)))
    tokens = docs.select(*keep, license_words(text).alias("_w"), may.alias("_may"))
    found = [F.struct(F.lit(label).alias("label"), places("_w", phrase).alias("at"))
             for phrase, label in phrases.items()]
    return tokens.select(
        *[c for c in tokens.columns if c not in ("_w", "_may")],
        F.size("_w").cast("long").alias("n_words"),
        F.filter(F.when(F.col("_may"), F.array(*found)), lambda s: F.size(s["at"]) > 0)
        .alias("_at"))


def token_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template tokens by the number of documents that hold them, rarest first.

    The counts cover every document; the result has as many rows as the templates tokens.
    """
    held = F.array_intersect(license_words(whole()), F.array(*map(F.lit, vocabulary)))
    counts = {r["token"]: r["count"] for r in docs.select(
        F.explode(held).alias("token")).groupBy("token").count().collect()}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


def template_labels(docs: DataFrame, threshold: float = THRESHOLD,
                    templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(_doc, _hash, labels, score) of documents with a block that contains at least
    ``threshold`` of a template's distinct tokens; score is the best containment.

    Blocks are the lines, and for notices wrapped over lines every run of consecutive words of
    the whole text that is as long as the template with a share of 1 - ``threshold`` put in.

    The template side is a constant of this module, so its broadcasts are small at any size
    of the corpus. The documents are never shuffled, only the blocks that match.
    """
    sets = {label: sorted(set(t.split())) for label, t in templates.items()}
    order = token_order(docs, sorted({t for s in sets.values() for t in s}))
    rank = {t: i for i, t in enumerate(order)}
    need = {label: math.ceil(threshold * len(s) - 1e-9) for label, s in sets.items()}
    prefix = []
    for label, s in sets.items():
        own = sorted(s, key=rank.get)
        for at, token in enumerate(own[:len(own) - need[label] + 1]):
            prefix.append((token, label, own, at, need[label]))
    spark = docs.sparkSession
    wanted = spark.createDataFrame(
        prefix, "token string, label string, _template array<string>, _at int, _need int")

    starts = F.array(*[F.lit(t) for t in sorted({p[0] for p in prefix})])
    lines = docs.select(*document_key(), F.explode(F.split(whole(), "\n")).alias("_line"))
    # Tokens of templates only, in the global order: array_intersect keeps the left one's.
    blocks = lines.select("_doc", "_hash", license_words(F.col("_line")).alias("_w")).where(
        F.arrays_overlap("_w", starts)).select(
        "_doc", "_hash", F.size(F.array_distinct("_w")).alias("_size"),
        F.array_intersect(F.array(*map(F.lit, order)), F.col("_w")).alias("_block"))
    shared = blocks.select("*", F.posexplode("_block").alias("_pos", "token")).join(
        F.broadcast(wanted), "token")
    rest = F.least(F.size("_template") - F.col("_at"), F.size("_block") - F.col("_pos"))
    passed = shared.where(
        (F.col("_size") >= F.col("_need"))
        & (F.least("_at", "_pos") + rest >= F.col("_need")))
    overlap = F.size(F.array_intersect("_block", "_template"))
    met = passed.withColumn("_overlap", overlap).where("_overlap >= _need").select(
        "_doc", "_hash", "label", "_overlap", "_template")
    met = met.union(wrapped(docs, wanted, starts, threshold, templates))
    return met.groupBy("_doc", "_hash").agg(
        F.collect_set("label").alias("_labels"),
        F.max(F.col("_overlap") / F.size("_template")).alias("_score"))


def wrapped(docs: DataFrame, wanted: DataFrame, starts: Column, threshold: float,
            templates: dict[str, str]) -> DataFrame:
    """(_doc, _hash, label, _overlap, _template) of runs of words that hold a template.

    A run that holds it has one of its prefix tokens, so only the words around such a token are
    looked at: first whether they hold enough tokens at all, then every run through it.
    """
    lengths = {label: math.ceil(len(t.split()) / threshold) for label, t in templates.items()}
    widest = max(lengths.values())
    length = F.element_at(F.create_map(*[F.lit(x) for kv in lengths.items() for x in kv]),
                          F.col("label"))
    several = docs.where(whole().contains("\n")).select(
        *document_key(), license_words(whole()).alias("_w")).where(F.arrays_overlap("_w", starts))
    at = F.filter(F.transform("_w", lambda w, i: F.when(F.array_contains(starts, w), i)),
                  lambda i: i.isNotNull())
    around = F.transform(at, lambda i: F.struct(
        F.element_at("_w", i + 1).alias("token"), F.least(i, F.lit(widest - 1)).alias("_before"),
        F.slice("_w", F.greatest(i - widest + 2, F.lit(1)), F.least(i, F.lit(widest - 1)) + widest)
        .alias("_near")))
    near = several.select("_doc", "_hash", F.inline(around)).join(
        F.broadcast(wanted), "token").withColumn("_length", length).where(
        F.size(F.array_intersect("_near", "_template")) >= F.col("_need"))
    first = F.greatest(F.col("_before") - F.col("_length") + 2, F.lit(1))
    best = F.array_max(F.transform(F.sequence(first, F.col("_before") + 1), lambda s: F.size(
        F.array_intersect(F.slice("_near", s, F.col("_length")), F.col("_template")))))
    return near.withColumn("_overlap", best).where("_overlap >= _need").select(
        "_doc", "_hash", "label", "_overlap", "_template")


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 where a base phrase stands, else the best containment of a template, else
    0. A null text has no words. Repeated rows stay, each with its own row. No rows give no rows.
    """
    plain = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    found = phrase_places(plain, [F.col("doc_id"), *document_key()])
    met = staged(template_labels(plain))
    at = F.flatten(F.transform("_at", lambda s: s["at"]))
    base = F.coalesce(F.transform("_at", lambda s: s["label"]), F.array().cast("array<string>"))
    both = F.array_union(base, F.coalesce("_labels", F.array().cast("array<string>")))
    return (
        found.join(met, ["_doc", "_hash"], "left")
        .select(
            "doc_id", "n_words", F.coalesce(F.size(at), F.lit(0)).cast("long").alias("_n"),
            F.array_min(at).cast("long").alias("first_word"),
            F.array_max(at).cast("long").alias("last_word"),
            F.array_join(F.array_sort(base), ",").alias("base_labels"),
            F.array_join(F.array_sort(both), ",").alias("labels"),
            F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0)))
            .alias("score"))
        .withColumn("n_base", F.greatest("_n", F.lit(0).cast("long"))).drop("_n"))
