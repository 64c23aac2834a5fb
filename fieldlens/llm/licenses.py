"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of ``2 * stride`` words, one beginning every ``stride`` words,
so any run of ``stride`` words lies whole in some block, across line breaks. Templates
of more words (a whole license) get blocks of their own, of the next doubled
stride that holds them, so templates of any length lie whole in a block. A
template matches a block when at least ``ceil(threshold * |T|)`` of its |T|
distinct words are in the block.

Words are ordered by how many documents of the whole corpus have them, rarest
first. With the overlap ``need`` that a match must reach, the first common word
stands among the first |T| - need + 1 words of the template and the first
|B| - need + 1 of the block (B: the block's template words in the same order),
so only these are joined (prefix filter); a block needs |B| >= need (length
filter), and behind a common word at places i and j there must be room:
1 + min(|T| - i - 1, |B| - j - 1) >= need (positional filter). Candidates are
verified by the exact overlap, so every match is found and none is wrong.

The join's broadcast side is the prefix table of the templates (a fixed list,
counted against ``MAX_BROADCAST``); documents without any prefix word make no
block. What is shuffled: candidates, and one marker per document.

Base phrases are counted at every place where their words stand in a row.

Defined results: a null or empty text has no words, no label and score 0; a
label found by several templates or phrases is listed once; repeated rows
(also with equal or null ids) get a result row each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ALNUM_WORD, SQL_ALNUM_WORD, ascii_lower, let, read_table, whole, words_of

THRESHOLD, STRIDE = 0.85, 32
TEMPLATE_WORD = r"[0-9a-z\x80-\U0010ffff]+"
MAX_BROADCAST = 1_000_000

# Phrases and labels that every scan reports.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# Notices as their public licenses recommend them.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def template_words(text: str) -> list[str]:
    """Distinct words of a template."""
    return sorted(set(re.findall(TEMPLATE_WORD, text.lower())))


def stride_of(n_words: int, stride: int = STRIDE) -> int:
    """The stride of a template's blocks: ``stride``, doubled until it holds the template."""
    while stride < n_words:
        stride *= 2
    return stride


def _list(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def words_in_order(docs: DataFrame, words: list[str], text: str = "text") -> list[str]:
    """``words`` by the number of documents of the whole table that have them, rarest first."""
    found = F.array_intersect(_list(words), words_of(ascii_lower(whole(F.col(text))), ALNUM_WORD))
    counts = docs.select(F.explode_outer(found).alias("w")).where("w is not null").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    n = {r["w"]: r["n"] for r in counts.collect()}  # one row per template word at most
    return sorted(words, key=lambda w: (n.get(w, 0), w))


def _places(words: Column, phrases: dict[str, str]) -> Column:
    """(at, label) of every phrase in a row of words."""
    def label(w: Column, i: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, phrase in phrases.items():
            first, *rest = phrase.split()
            here = w == first
            for k, other in enumerate(rest, 1):
                here = here & (F.get(words, i + k) == other)
            out = F.when(here, F.lit(name)).otherwise(out)
        return F.struct(i.alias("at"), out.alias("label"))

    none = F.array().cast("array<struct<at:int,label:string>>")
    likely = F.arrays_overlap(words, _list([p.split()[-1] for p in phrases.values()]))
    return F.when(likely, F.filter(F.transform(words, label), lambda x: x["label"].isNotNull())).otherwise(none)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, stride: int = STRIDE,
         doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, ``places`` of base phrases, ``labels`` of templates and the best containment ``best``."""
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    spark = docs.sparkSession
    sets = [(label, template_words(t)) for label, t in templates]
    # repeated words count too: the notice in a text has them all, and only a run of stride words lies whole in a block
    own = [stride_of(len(re.findall(TEMPLATE_WORD, t.lower())), stride) for _, t in templates]
    order = words_in_order(docs, sorted({w for _, t in sets for w in t}), text)
    rank = {w: i for i, w in enumerate(order)}
    rows, least, used = [], {}, {}
    for k, ((label, t), wide) in enumerate(zip(sets, own)):
        need = math.ceil(threshold * len(t) - 1e-9)
        t = sorted(t, key=rank.__getitem__)
        least[wide] = min(least.get(wide, need), need)
        used.setdefault(wide, set()).update(t)
        rows += [(w, wide, i, k, label, need, t) for i, w in enumerate(t[:len(t) - need + 1])]
    if len(rows) > MAX_BROADCAST:
        raise ValueError("scan the templates in several lists")
    prefixes = spark.createDataFrame(rows, "t_word string, t_stride int, t_at int, template int, label string, need int, t_words array<string>")

    words = words_of(ascii_lower(whole(F.col(text))), ALNUM_WORD)
    base = docs.select(F.col(doc_id).alias("doc_id"), F.md5(whole(F.col(text)).cast("binary")).alias("digest"), words.alias("words"))
    w = F.col("words")
    entry = "array<struct<b:int,stride:int,at:int,word:string,words:array<string>>>"

    def blocks(wide: int) -> Column:
        """The entries of all blocks of one stride, for the templates of that stride."""
        mine = _list([x for x in order if x in used[wide]])

        def entries(b: Column) -> Column:
            def prefix(have: Column) -> Column:
                keep = F.greatest(F.size(have) - F.lit(least[wide]) + 1, F.lit(0))
                return F.transform(F.slice(have, F.lit(1), keep), lambda x, j: F.struct(
                    b.alias("b"), F.lit(wide).alias("stride"), j.alias("at"), x.alias("word"), have.alias("words")))

            return let(F.array_intersect(mine, F.slice(w, b * wide + 1, 2 * wide)), prefix)   # in global order

        found = F.flatten(F.transform(F.sequence(F.lit(0), F.ceil(F.size(w) / wide).cast("int") - 1), entries))
        likely = F.arrays_overlap(w, _list(sorted({r[0] for r in rows if r[1] == wide})))
        return F.when(likely, found).otherwise(F.array().cast(entry))

    marker = F.array(F.struct(F.lit(-1).alias("b"), F.lit(0).alias("stride"), F.lit(-1).alias("at"), F.lit(None).cast("string").alias("word"),
                              F.array().cast("array<string>").alias("words"))).cast(entry)
    candidates = [blocks(wide).cast(entry) for wide in sorted(used)]
    base = base.select("doc_id", "digest", F.size(w).cast("long").alias("n_words"), _places(w, phrases).alias("places"),
                       F.concat(marker, *candidates).alias("entries"))
    flat = base.select("doc_id", "digest", "n_words", "places", F.explode_outer("entries").alias("e"))
    found = flat.join(F.broadcast(prefixes), (F.col("e.word") == F.col("t_word")) & (F.col("e.stride") == F.col("t_stride")), "left")
    room = F.least(F.size("t_words") - F.col("t_at"), F.size("e.words") - F.col("e.at"))
    passes = (F.size("e.words") >= F.col("need")) & (room >= F.col("need"))
    overlap = F.size(F.array_intersect(F.col("e.words"), F.col("t_words")))
    found = found.withColumn("shared", F.when(F.col("template").isNotNull() & passes, overlap))
    found = found.where((F.col("e.b") < 0) | (F.col("shared") >= F.col("need")))
    got = found.groupBy("doc_id", "digest", "n_words", "places").agg(
        F.count(F.when(F.col("e.b") < 0, 1)).alias("copies"), F.sort_array(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max(F.col("shared") / F.size("t_words")), F.lit(0.0)).alias("best"))
    return got.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copies", "copy", "digest")


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    at = F.transform("places", lambda x: x["at"])
    base = F.sort_array(F.array_distinct(F.transform("places", lambda x: x["label"])))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                        F.array_join(base, ",").alias("base_labels"),
                        F.array_join(F.sort_array(F.array_union(base, F.col("labels"))), ",").alias("labels"),
                        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.col("best")).alias("score"))


def _sql_values() -> str:
    return ", ".join(f"({k}, '{label}', {len(ws)}, {math.ceil(THRESHOLD * len(ws) - 1e-9)}, '{w}')"
                     for k, (label, t) in enumerate(TEMPLATES) for ws in [template_words(t)] for w in ws)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH t(k, label, n, need, w) AS (VALUES {_sql_values()}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_ALNUM_WORD}') AS ws FROM documents
), x AS (
  SELECT rid, i - 1 AS i, ws[i] AS w, coalesce(ws[i + 1], '') AS w1, coalesce(ws[i + 2], '') AS w2
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws))) AS i FROM d)
), p AS (
  SELECT rid, i, CASE WHEN w = 'cc' AND w1 = 'by' THEN 'cc-by'
                      WHEN w = 'general' AND w1 = 'public' AND w2 = 'license' THEN 'gpl'
                      WHEN w = 'all' AND w1 = 'rights' AND w2 = 'reserved' THEN 'reserved' END AS label FROM x
), b AS (
  SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p WHERE label IS NOT NULL GROUP BY rid
), m AS (
  SELECT rid, k, label, n, blk, count(DISTINCT w) AS c
  FROM (SELECT rid, w, unnest([i // 32, i // 32 - 1]) AS blk FROM x) JOIN t USING (w)
  WHERE blk >= 0 GROUP BY ALL HAVING count(DISTINCT w) >= any_value(need)
), l AS (
  SELECT rid, label, c / n AS score FROM m UNION ALL SELECT rid, label, 1.0 FROM p WHERE label IS NOT NULL
), a AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM l GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)
"""
