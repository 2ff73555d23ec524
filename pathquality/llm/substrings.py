"""Repeated passages: Rabin-Karp hashes of every 50-word window, counted in Spark.

Counting every window by itself would shuffle the corpus many times over, so windows travel
in runs. In every window the smallest hash of its 12-word grams is its anchor, which depends
on the window's words alone: equal windows have equal anchors, and neighbouring windows mostly
share theirs. A run is the windows of one document around one anchor.

1. Runs are grouped by (anchor, run hash). A run that an earlier document has too is repeated
   as a whole; of each group only its first document goes on.
2. Anchors that still have different runs (the edges of copied passages) have the windows of
   those first documents counted one by one, by (window hash, anchor).
3. Repeated windows merge into maximal intervals, which are cut from the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, rolling, signed, stored, strings, text_key, word_hashes, word_spans

WINDOW = 50
GRAM = 12


def runs(h: np.ndarray, window: int, gram: int):
    """Anchors of a document's word hashes, the first and last window of each run, and the
    hashes of all windows."""
    grams = rolling(h, gram)
    width = window - gram + 1
    pick = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    pick = pick + np.arange(len(pick))
    cut = np.flatnonzero(np.diff(pick)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(pick)]]) - 1
    return grams[pick[first]], first, last, rolling(h, window)


def _hashes(text: bytes) -> np.ndarray:
    return word_hashes(text, *word_spans(text))


def _run_hash(wh: np.ndarray, anchors: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The run's first and last window hold all its words; its length and anchor fix the rest."""
    length = (last - first).astype(np.uint64)
    return mix(mix(mix(wh[first]) ^ wh[last]) ^ mix(length + anchors))


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchor, whole, first, last = [], [], [], [], []
            for i, text in enumerate(strings(batch.column("text"))):
                h = _hashes(text)
                if len(h) < window:
                    continue
                a, s, e, wh = runs(h, window, gram)
                rows.append(np.full(len(a), i))
                anchor.append(a)
                whole.append(_run_hash(wh, a, s, e))
                first.append(s)
                last.append(e)
            if not rows:
                continue
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("row_key").take(take),
                 pa.array(signed(np.concatenate(anchor))), pa.array(signed(np.concatenate(whole))),
                 pa.array(np.concatenate(first).astype(np.int32)),
                 pa.array(np.concatenate(last).astype(np.int32))],
                ["doc_id", "row_key", "anchor", "run", "first", "last"])
    return run


def _windows(window: int, gram: int):
    """The single windows of the runs that start at `spans`, with what tells them apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, where, key, anchor = [], [], [], []
            spans = batch.column("spans").to_pylist()
            for i, text in enumerate(strings(batch.column("text"))):
                a, s, e, wh = runs(_hashes(text), window, gram)
                wanted = set(spans[i])
                for g, f, t in zip(a, s.tolist(), e.tolist(), strict=True):
                    if f in wanted:
                        where.append(np.arange(f, t + 1))
                        key.append(wh[f:t + 1])
                        anchor.append(np.full(t + 1 - f, g))
                        rows.append(np.full(t + 1 - f, i))
            if not rows:
                continue
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("row_key").take(take),
                 pa.array(signed(np.concatenate(key))), pa.array(signed(np.concatenate(anchor))),
                 pa.array(np.concatenate(where).astype(np.int32))],
                ["doc_id", "row_key", "window", "anchor", "start"])
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            spans = batch.column("spans").to_pylist()
            for i, text in enumerate(strings(batch.column("text"))):
                words = text.split()
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                for span in spans[i] or ():
                    gone[span["first"]] += 1
                    gone[span["last"] + window] -= 1
                gone = np.cumsum(gone)[:len(words)] > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                if n_removed[-1]:
                    words = [words[j] for j in np.flatnonzero(~gone)]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array([k.decode() for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """`doc_id`, `row_key`, `first`, `last`: runs of windows that an earlier document has too."""
    texts = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), text_key().alias("row_key"), "text")
    found = stored(texts.mapInArrow(
        _anchors(window, gram),
        "doc_id long, row_key long, anchor long, run long, first int, last int"), "substring-runs")
    variants = stored(found.groupBy("anchor", "run").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest")), "substring-variants")
    edges = variants.groupBy("anchor").agg(
        F.min("owner").alias("a"), F.max("owner").alias("b")
    ).filter("a < b").select("anchor", F.lit(True).alias("edge"))
    shared = variants.join(edges, "anchor", "left").filter("latest > owner or edge")
    placed = stored(found.join(shared, ["anchor", "run"]).filter("doc_id > owner or edge").select(
        "doc_id", "row_key", "first", "last", (F.col("doc_id") > F.col("owner")).alias("whole")
    ), "substring-placed")
    whole = placed.filter("whole").select("doc_id", "row_key", "first", "last")
    asked = placed.filter("not whole").groupBy(
        F.col("doc_id").alias("d"), F.col("row_key").alias("k")
    ).agg(F.collect_set("first").alias("spans"))  # within one document
    singles = texts.join(asked, (F.col("doc_id") == F.col("d")) & (F.col("row_key") == F.col("k"))).select(
        "doc_id", "row_key", "text", "spans"
    ).mapInArrow(_windows(window, gram),
                 "doc_id long, row_key long, window long, anchor long, start int")
    singles = stored(singles, "substring-windows")
    owners = singles.groupBy("window", "anchor").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest")
    ).filter("latest > owner").drop("latest")
    parts = singles.join(owners, ["window", "anchor"]).filter("doc_id > owner").select(
        "doc_id", "row_key", F.col("start").alias("first"), F.col("start").alias("last"))
    return whole.unionByName(parts)


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_removed`, `kept_sha256` and `kept`, the
    words left, joined by one space.

    Removed is each word inside a window of `window` words that also starts in a document with
    a smaller doc_id, judged on the input. Null and short texts lose nothing; so do rows with
    doc_id null, and they take nothing from others. Rows that repeat a doc_id do not take
    from each other. An empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("row_key"), "text")
    spans = removals(docs, window, gram).groupBy(
        F.col("doc_id").alias("d"), F.col("row_key").alias("k")
    ).agg(F.collect_set(F.struct("first", "last")).alias("spans"))  # within one document
    return texts.join(
        spans, (F.col("doc_id") == F.col("d")) & (F.col("row_key") == F.col("k")), "left"
    ).select("doc_id", "text", "spans").mapInArrow(
        _cut(window),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
