"""License scans: phrases at word positions, and text blocks that contain a license template.

Words are runs outside ASCII separators, of the text with A-Z lower-cased. *Base* labels come from
phrases whose words stand consecutively. The method finds *templates* (notices as sets of words) by
an exact set-similarity join of text blocks with templates under containment: a block matches if it
has at least ``THRESHOLD`` of the template's distinct words.

A template of w words is sought in blocks of 2s words that begin at every multiple of s, the least
power of two that is w or more, so each notice lies whole in some block. Only words that occur in
templates count, which loses no overlap. They are ordered by their number of occurrences in the
corpus, rarest first. With k distinct words in a template and ``need`` of them wanted:

* prefix filter: a match shares one of the template's ``k - need + 1`` rarest words, so the texts'
  words are joined with these prefixes only (a table that grows with the templates, broadcast);
* length filter: a block with fewer than ``need`` template words cannot match;
* positional filter: if the shared word is the i-th of the template and the j-th of the block,
  at most ``1 + min(k - i, block's words - j)`` words are shared from there on. The first shared word of a
  match always passes.

What is left is verified by intersection. Blocks are slices of the row's own words, so texts are
never shuffled; only matches and slim rows are. Everything is a built-in function or join.

Edge cases: a null text is empty, without words; positions count from 0; repeated rows get equal
results, each its own; rows with a null id are scanned like others; columns other than id and text
are ignored; an empty table gives an empty result. Templates must be ASCII.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import join_groups

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9


@dataclass(frozen=True)
class Notice:
    label: str
    text: str

    @property
    def words(self) -> list[str]:
        return [w for w in re.split("[^0-9a-z]+", self.text.lower()) if w]

    @property
    def step(self) -> int:
        return 1 << (len(self.words) - 1).bit_length()

    def __post_init__(self):
        if not self.text.isascii() or not self.words:
            raise ValueError("a notice is ASCII text with words")


#: Phrases of the base labels.
PHRASES = [Notice("mit", "mit license"), Notice("apache", "apache license"), Notice("gpl", "general public license")]

#: Public notices of common licenses.
TEMPLATES = [
    Notice("apache", "Licensed under the Apache License, Version 2.0"),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Notice("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Notice("gpl", "This work is licensed under the GNU General Public License, version 3"),
    Notice("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Notice("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Notice("mit", "Released under the MIT License"),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    Notice("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def normal(text: Column) -> Column:
    """The words of a text, joined by one space each.

    All letters are lower-cased, not only A-Z, which is cheaper: words are compared with ASCII words
    only, and of all other letters just U+212A would turn into an ASCII letter, so it is replaced.
    """
    plain = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u00e5")))
    return F.trim(F.regexp_replace(plain, SEPARATORS, " "))


def places(words: str, phrase: Notice) -> Column:
    """Start positions of a phrase in an array of at least as many words."""
    wanted = phrase.words

    def stands(i):
        same = F.lit(True)
        for k, word in enumerate(wanted):
            same = same & (F.get(F.col(words), i + k) == word)
        return same

    return F.filter(F.sequence(F.lit(0), F.size(words) - len(wanted)), stands)


def phrase_scan(base: DataFrame, phrases: list[Notice] = PHRASES) -> DataFrame:
    """Adds ``n_words``, ``n_base``, ``first_word``, ``last_word`` and the array ``base``; needs ``line``."""
    out = base.withColumn("n_words", F.when(F.col("line") == "", 0).otherwise(F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1).cast("long"))
    spaced = F.concat(F.lit(" "), "line", F.lit(" "))
    there = [F.contains(spaced, F.lit(f" {' '.join(p.words)} ")) for p in phrases]
    some = there[0]
    for one in there[1:]:
        some = some | one
    out = out.withColumn("_words", F.when(some, F.split("line", " ")))
    out = out.withColumns({f"_p{k}": F.when(t, places("_words", p)) for k, (t, p) in enumerate(zip(there, phrases, strict=True))})
    none = F.array().cast("array<int>")
    everywhere = F.flatten(F.array(*[F.coalesce(f"_p{k}", none) for k in range(len(phrases))]))
    labels = F.array(*[F.when(F.col(f"_p{k}").isNotNull(), F.lit(p.label)) for k, p in enumerate(phrases)])
    return out.withColumns({
        "n_base": F.size(everywhere).cast("long"),
        "first_word": F.array_min(everywhere).cast("long"),
        "last_word": F.array_max(everywhere).cast("long"),
        "base": F.array_compact(labels),
    }).drop("_words", *[f"_p{k}" for k in range(len(phrases))])


def word_rows(base: DataFrame) -> DataFrame:
    """A row for each word: ``id``, ``h``, the array ``words``, ``at`` and ``word``."""
    words = base.where("line <> ''").withColumn("words", F.split("line", " "))
    return words.select("id", "h", "words", F.posexplode("words").alias("at", "word"))


def local(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def frequencies(base: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the templates occurs in all texts."""
    wanted = F.broadcast(local(base.sparkSession, [(w,) for w in vocabulary], ["word"]))
    counts = word_rows(base).join(wanted, "word").groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def need_of(size: int, threshold: float) -> int:
    """Least overlap that makes up the threshold of ``size`` words."""
    return max(1, math.ceil(round(threshold * size, 9)))


def block_matches(base: DataFrame, templates: list[Notice] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """All blocks that meet a template: ``id``, ``h``, ``start``, ``template`` (its place in the list),
    ``label`` and ``containment``.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    often = frequencies(base, vocabulary)
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    prefixes = []
    for number, template in enumerate(templates):
        words = sorted(set(template.words), key=rank.get)
        need = need_of(len(words), threshold)
        prefixes += [(w, number, template.label, template.step, i, need, words) for i, w in enumerate(words[: len(words) - need + 1], 1)]
    spark = base.sparkSession
    rare = local(spark, prefixes, ["word", "template", "label", "step", "i", "need", "wanted"])
    hits = word_rows(base).join(F.broadcast(rare), "word")
    step, whole = F.col("step"), F.floor(F.col("at") / F.col("step")).cast("int") * F.col("step")
    hits = hits.withColumn("start", F.explode(F.filter(F.array(whole, whole - step), lambda s: s >= 0)))
    hits = hits.withColumn("block", F.slice("words", F.col("start") + 1, step * 2)).drop("words")
    # One hit of a word in a block is enough: its first.
    hits = hits.where(F.array_position("block", F.col("word")) + F.col("start") - 1 == F.col("at"))
    ranks = F.create_map(*[F.lit(x) for w, k in rank.items() for x in (w, k)])
    known = F.array_sort(F.array_distinct(F.array_compact(F.transform("block", lambda w: F.element_at(ranks, w)))))
    hits = hits.withColumn("known", known).where(F.size("known") >= F.col("need"))
    j = F.array_position("known", F.element_at(ranks, F.col("word")))
    size = F.size("wanted")
    hits = hits.where(1 + F.least(size - F.col("i"), F.size("known") - j) >= F.col("need"))
    shared = F.size(F.array_intersect("block", "wanted"))
    found = hits.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    return found.select("id", "h", "start", "template", "label", (F.col("shared") / F.size("wanted")).alias("containment")).distinct()


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[Notice] = TEMPLATES) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and
    ``score``: 1 where a phrase stands, else the largest containment found, else 0.
    """
    base = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("h"), normal(F.col(text)).alias("line"))
    slim = phrase_scan(base).drop("line")
    matches = block_matches(base, templates).groupBy("id", "h").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    joined = join_groups(slim, matches, ["id", "h"], null_group=True)
    everything = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(everything, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def oracle(templates: list[Notice] = TEMPLATES, phrases: list[Notice] = PHRASES) -> str:
    """DuckDB SQL that compares every block with every template."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    notice = ",\n            ".join(f"({k}, '{t.label}', {t.step}, {need_of(len(set(t.words)), THRESHOLD)}, {quoted(sorted(set(t.words)))})" for k, t in enumerate(templates))
    phrase = ",\n            ".join(f"('{p.label}', {quoted(p.words)})" for p in phrases)
    return rf"""
        WITH notice(template, label, step, need, wanted) AS (VALUES {notice}),
        phrase(label, ws) AS (VALUES {phrase}),
        w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        place AS (SELECT doc_id, w.ws AS ws, unnest(range(0, len(ws))) AS i FROM w),
        base AS (SELECT doc_id, count(*) AS n, min(i) AS low, max(i) AS high, list(DISTINCT label) AS labels
            FROM place JOIN phrase ON place.ws[i + 1 : i + len(phrase.ws)] = phrase.ws GROUP BY doc_id),
        block AS (SELECT doc_id, label, need, wanted, ws, step, unnest(range(0, len(ws), step)) AS start FROM w, notice),
        shared AS (SELECT doc_id, label, need, wanted, len(list_intersect(list_distinct(ws[start + 1 : start + 2 * step]), wanted)) AS n FROM block),
        found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(n / len(wanted)) AS containment FROM shared WHERE n >= need GROUP BY doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0) AS n_base, low AS first_word, high AS last_word,
            array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
            CASE WHEN n > 0 THEN 1.0 ELSE coalesce(containment, 0) END::DOUBLE AS score
        FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
    """
