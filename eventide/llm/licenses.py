"""License scan as an exact set-similarity join, in DataFrame operations only.

A template is a list of words.  A text block is a window of consecutive document
words, as long as the template times ``stretch`` (a shorter document is one
block).  A block meets a template when it holds at least ``threshold`` of the
template's distinct words: ``need`` of them.

1. Count, over all documents, the words of all templates: the global order,
   rarest first.  Words of no template can not be shared and stay out of it.
2. Prefix: a block that holds ``need`` of ``size`` words misses at most
   ``size - need``, so it holds one of the first ``size - need + 1`` in the
   order.  Document words are joined with these alone.
3. Length: a document with fewer than ``need`` words can not meet it.
4. Position: what surrounds a met word, up to a block's length to both sides, is
   cut out, and its shared words are put in the global order.  A block whose
   first shared word is the met one holds at most those from its position on, so
   fewer than ``need`` of them rule all such blocks out.
5. Verify: each block around the met word is counted exactly.  The word must be
   the block's first shared one, at its first place there, so a block is found
   once, whatever number of its words are met.

A template may ask for its words in their order, one after the other
(``ordered``): its prefix is its rarest word, whose place in it gives the only
place where it may stand, and that is compared word by word.

Templates are parameters of the operator, never data: at most ``MAX_WORDS``
words together, which bounds what is broadcast.  The document side is never
shuffled; only found windows are.

Defined results: a null or empty text has no words, no blocks and score 0;
repeated documents get equal rows; texts are read whole; an empty table gives no
rows; of equally rare words the lesser comes first.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, packed, row_key, same_key
from .decontaminate import raw_words

MAX_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    """A label and the words it is told by; ``ordered``: all of them, one after the other."""

    label: str
    text: str
    threshold: float = 0.8
    ordered: bool = False

    @property
    def words(self) -> list[str]:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), self.text)
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    @property
    def need(self) -> int:
        size = len(set(self.words))
        return max(1, math.ceil(size * self.threshold - 1e-9))

    def span(self, stretch: float) -> int:
        return len(self.words) if self.ordered else math.ceil(len(self.words) * stretch - 1e-9)


# Phrases that name a license, and sentences of the public notices.
PHRASES = [
    Template("mit", "under the mit license", ordered=True),
    Template("apache-2", "apache license version 2", ordered=True),
    Template("cc-by-nc", "cc by nc", ordered=True),
]
NOTICES = [
    Template("mit", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    )),
    Template("apache-2", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License"
    )),
    Template("gpl-3", "under the GNU General Public License, version 3", threshold=1.0),
    Template("gpl-3", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License"
    )),
    Template("bsd", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    )),
    Template("isc", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted"
    )),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "under a Creative Commons Attribution NonCommercial", threshold=1.0),
]
TEMPLATES = PHRASES + NOTICES


def _document_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each word with its place, and the document's words; ``key`` is coarser than the words' own lower case."""
    d = docs.select(*row_key(id_col, text_col), raw_words(F.col(text_col)).alias("w"))
    d = d.select("_id", "_h", "w", F.posexplode_outer("w").alias("pos", "word"))
    return d.withColumn("key", F.lower("word"))


def _order(doc_words: DataFrame, templates: list[Template]) -> dict[str, int]:
    """Occurrences in all documents of the templates' words; a bounded table."""
    vocabulary = sorted({w for t in templates for w in t.words})
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"templates hold {len(vocabulary)} distinct words, more than {MAX_WORDS}")
    spark = doc_words.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "key string"))
    counted = doc_words.select("key").join(wanted, "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return {w: 0 for w in vocabulary} | {r["key"]: r["n"] for r in counted.collect()}


PREFIX = (
    "key string, template int, label string, ordered boolean, off int, words array<string>, "
    "need int, size int, span int"
)


def _prefixes(templates: list[Template], counts: dict[str, int], stretch: float) -> list[tuple]:
    """Prefix words of each template that can be met: with no document word, fewer than ``need`` can be shared."""
    rows = []
    for number, t in enumerate(templates):
        if not t.words:
            raise ValueError(f"template {number} ({t.label}) has no words")
        ranked = sorted(set(t.words), key=lambda w: (counts[w], w.encode()))
        if sum(counts[w] > 0 for w in ranked) < (len(ranked) if t.ordered else t.need):
            continue
        prefix = ranked[:1] if t.ordered else ranked[: len(ranked) - t.need + 1]
        shared = t.words if t.ordered else ranked
        for word in prefix:
            off = t.words.index(word) if t.ordered else 0
            rows.append((word, number, t.label, t.ordered, off, shared, t.need, len(ranked), t.span(stretch)))
    return rows


def matching_windows(
    docs: DataFrame, templates: list[Template] = TEMPLATES, stretch: float = 1.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every block that meets a template: ``_id, _h, template, label, ordered, start, len, containment``.

    ``template`` is its place in the list, ``start`` a word number from 0.
    """
    doc_words = _document_words(docs, id_col, text_col)
    prefixes = _prefixes(templates, _order(doc_words, templates), stretch)
    prefix = F.broadcast(docs.sparkSession.createDataFrame(prefixes, PREFIX))
    n, pos, span, words, need = F.size("w"), F.col("pos"), F.col("span"), F.col("words"), F.col("need")
    met = doc_words.join(prefix, "key").where(n >= F.least(need, span))

    low = F.greatest(pos - span + 1, F.lit(0))
    around = F.split(lower_ascii(F.array_join(F.slice("w", low + 1, F.least(pos + span, n) - low), " ")), " ")
    last = F.least(pos, F.greatest(n - span, F.lit(0)))

    def blocks(context: Column) -> Column:
        """Starts of the blocks around the met word whose first shared word it is, with their shared words."""
        first = F.greatest(pos - span + 1, F.lit(0))
        common = F.array_intersect(words, context)
        left = F.size(common) - F.array_position(common, F.col("key")).cast("int") + 1
        counted = F.transform(F.sequence(first, last), lambda s: _counted(F.slice(context, s - low + 1, span), s))
        found = F.filter(counted, lambda b: (b["shared"] >= need) & b["mine"])
        return F.when(F.array_contains(context, F.col("key")) & (left >= need), found)

    def _counted(block: Column, s: Column) -> Column:
        common = F.array_intersect(words, block)
        mine = (F.element_at(common, 1) == F.col("key")) & (F.array_position(block, F.col("key")) - 1 + s == pos)
        return F.struct(s.alias("start"), F.size(common).alias("shared"), F.coalesce(mine, F.lit(False)).alias("mine"))

    at = pos - F.col("off")
    stands = (at >= 0) & (at + span <= n) & (
        lower_ascii(F.array_join(F.slice("w", F.greatest(at, F.lit(0)) + 1, span), " ")) == F.array_join(words, " ")
    )
    placed = F.when(stands, F.array(F.struct(at.alias("start"), F.col("size").alias("shared"), F.lit(True).alias("mine"))))
    unordered = F.element_at(F.transform(F.array(around), blocks), 1)
    found = met.select(
        "_id", "_h", "template", "label", "ordered", F.least(span, n).alias("len"), "size",
        F.explode(F.when(F.col("ordered"), placed).otherwise(unordered)).alias("b"),
    )
    return found.select(
        "_id", "_h", "template", "label", "ordered", F.col("b.start").alias("start"), "len",
        (F.col("b.shared") / F.col("size")).alias("containment"),
    )


def license_blocks(
    docs: DataFrame, templates: list[Template] = TEMPLATES, stretch: float = 1.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Blocks of a template that overlap or touch, put together.

    Returns ``id_col, label, template, first_word, end_word, containment`` (the best), repeats of a row once.
    """
    windows = matching_windows(docs, templates, stretch, id_col, text_col).groupBy(
        "_id", "_h", "template", "label", "start"
    ).agg((F.col("start") + F.max("len")).alias("end"), F.max("containment").alias("containment"))
    order = Window.partitionBy("_id", "_h", "template").orderBy("start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = windows.withColumn("_new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    grouped = opened.withColumn("_block", F.sum("_new").over(order)).groupBy("_id", "_h", "template", "label", "_block")
    return grouped.agg(
        F.min("start").alias("first_word"), F.max("end").alias("end_word"), F.max("containment").alias("containment")
    ).select(F.col("_id").alias(id_col), "label", "template", "first_word", "end_word", "containment")


def scan(
    docs: DataFrame, templates: list[Template] = TEMPLATES, stretch: float = 1.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document, from its blocks.

    Returns ``id_col, n_words``; of ordered templates ``n_places``, ``first_word`` and
    ``last_word`` (least and greatest start), ``place_labels``; of all ``labels``
    (both sorted arrays) and ``score``, the greatest containment.
    """
    windows = matching_windows(docs, templates, stretch, id_col, text_col)
    place = F.when(F.col("ordered"), F.col("start"))
    # One place of a row that stands in the table several times counts once.
    found = windows.groupBy("_id", "_h", "label", "ordered", "template", "start").agg(F.max("containment").alias("c"))
    per_doc = found.groupBy("_id", "_h").agg(
        F.count(place).alias("n_places"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("ordered"), F.col("label")))).alias("place_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("c").alias("score"),
    )
    base = docs.select(*row_key(id_col, text_col), F.size(raw_words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return base.join(per_doc, same_key(base, per_doc), "left").select(
        base["_id"].alias(id_col), "n_words", F.coalesce("n_places", F.lit(0)).cast("long").alias("n_places"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("place_labels", none).alias("place_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def with_license(
    docs: DataFrame, templates: list[Template] = TEMPLATES, stretch: float = 1.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, columns as they were, that meet a template."""
    found = matching_windows(docs, templates, stretch, id_col, text_col).select("_id", "_h").distinct()
    keyed = packed(docs, *row_key(id_col, text_col))
    return keyed.join(found, same_key(keyed, found), "left_semi").select("_row.*")
