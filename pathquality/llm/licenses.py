"""License scans by diagonal voting.

Every template, from a two-word phrase to a whole license text, has the hashes of its word
k-grams (k is 5, or its length if that is less). The k-gram hashes of all texts are rolled in
one pass, those that some template has are joined to its positions, and each hit votes for the
diagonal `position in the text - position in the template`. Neighbouring diagonals merge into
a span, and a span counts by the share of template words that its hits, compared word for
word, cover.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_class, mix, rolling, signed, stored, strings, text_key, word_hashes, word_spans

LETTERS = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GRAM = 5
GAP = 3        # diagonals further apart are spans of their own
COVERED = 0.8  # share of a template's words that makes a label

# Phrases and their labels.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Texts and notices of public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at"),
    "cc-by-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "mit-release": "Released under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved",
}


def split(text: bytes) -> list[bytes]:
    return WORDS.findall(text.lower())


def gram_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    words = word_hashes(text, starts, ends)
    return {k: mix(rolling(words, k) + np.uint64(k)) for k in sizes}


def positions(templates: Mapping[str, str], base: Mapping[str, str]) -> list[tuple]:
    """(template, is_base, n_words, k, position, hash, gram) of every template k-gram."""
    out = []
    for is_base, source in ((True, base), (False, templates)):
        for name, text in sorted(source.items()):
            lower = text.encode().lower()
            starts, ends = word_spans(lower, LETTERS)
            words, k = split(lower), min(GRAM, len(starts))
            hashes = signed(gram_hashes(lower, starts, ends, [k])[k])
            out += [(name, is_base, len(words), k, i, int(h), b" ".join(words[i:i + k]).decode())
                    for i, h in enumerate(hashes)]
    return out


def _hits(table: list[tuple]):
    wanted = {k: np.unique(np.array([r[5] for r in table if r[3] == k], dtype=np.int64))
              for k in sorted({r[3] for r in table})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits = [], []
            for text in strings(batch.column("text")):
                text = text.lower()
                starts, ends = word_spans(text, LETTERS)
                n_words.append(len(starts))
                found = []
                for k, hashes in gram_hashes(text, starts, ends, list(wanted)).items():
                    hashes = signed(hashes)
                    at = np.minimum(np.searchsorted(wanted[k], hashes), len(wanted[k]) - 1)
                    for i in np.flatnonzero(wanted[k][at] == hashes).tolist():
                        gram = " ".join(text[a:b].decode() for a, b in
                                        zip(starts[i:i + k], ends[i:i + k], strict=True))
                        found.append({"hash": int(hashes[i]), "gram": gram, "at": i})
                hits.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(n_words, pa.int64()),
                 pa.array(hits, pa.list_(pa.struct(
                     [("hash", pa.int64()), ("gram", pa.string()), ("at", pa.int64())])))],
                ["doc_id", "row_key", "n_words", "hits"])
    return run


def spans(hits: DataFrame, templates: DataFrame) -> DataFrame:
    """`doc_id`, `row_key`, `template`, `is_base`, `first`, `last` (words), `covered`: merged
    diagonals. `hits`: (`doc_id`, `row_key`, `hash`, `gram`, `at`)."""
    votes = hits.join(F.broadcast(templates), ["hash", "gram"]).withColumn(
        "diagonal", F.col("at") - F.col("position"))
    place = Window.partitionBy("doc_id", "row_key", "template", "is_base").orderBy("diagonal", "at")
    apart = F.col("diagonal") - F.lag("diagonal").over(place) > F.when(F.col("is_base"), 0).otherwise(GAP)
    numbered = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "span", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    covers = F.sequence(F.col("position"), F.col("position") + F.col("k") - 1)
    return numbered.groupBy("doc_id", "row_key", "template", "is_base", "span").agg(
        F.min("at").alias("first"), (F.max(F.col("at") + F.col("k")) - 1).alias("last"),
        # positions within one template
        (F.size(F.array_distinct(F.flatten(F.collect_set(covers)))) / F.first("n_template")).alias("covered"))


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None,
         base: Mapping[str, str] | None = None) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_base` (places of base phrases),
    `first_word` and `last_word` (their smallest and largest start), `base_labels`, `labels`,
    `score` (largest share of a template that a span covers) and `found`, the labelled spans.

    Null and empty texts have no words; without base phrases the starts are null; rows that
    repeat get the same result each, doc_id null as well. An empty table gives no rows, other
    columns of `docs` are not read.
    """
    spark: SparkSession = docs.sparkSession
    table = positions(TEMPLATES if templates is None else templates, BASE if base is None else base)
    known = spark.createDataFrame(
        table, "template string, is_base boolean, n_template int, k int, position int, hash long, gram string")
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("row_key"), "text")
    rows = stored(texts.mapInArrow(
        _hits(table), "doc_id long, row_key long, n_words long,"
        " hits array<struct<hash: long, gram: string, at: long>>"), "license-hits")
    hits = rows.filter(F.size("hits") > 0).dropDuplicates(["doc_id", "row_key"]).select(
        "doc_id", "row_key", F.inline("hits"))
    places = spans(hits, known).filter((F.col("covered") >= COVERED) | F.col("is_base"))
    per_doc = places.groupBy(F.col("doc_id").alias("d"), F.col("row_key").alias("k")).agg(
        F.count_if("is_base").alias("n"), F.min(F.when(F.col("is_base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("first"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("template")))).alias("base"),
        F.array_sort(F.collect_set("template")).alias("all"), F.max("covered").alias("best"),
        F.array_sort(F.collect_list(F.struct("first", "last", "template", "covered"))).alias("found"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k"))
    names = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return rows.join(per_doc, same, "left").select(
        "doc_id", "n_words", F.coalesce("n", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", names("base").alias("base_labels"), names("all").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"), "found")
