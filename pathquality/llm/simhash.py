"""Near duplicates: SimHash fingerprints linked by meet-in-the-middle balls.

Two fingerprints at distance 3 or less meet at a word within 2 bits of the one and 1 bit of
the other. So each emits the words of a ball of radius 2 and of one of radius 1, and two
fingerprints link where balls of the two kinds share a word. Words are shuffled by their
leading bits: a fingerprint is sent once for every lead that its balls reach, with the flips
it has left, and the words below the lead are spelled out where they meet. A lead that more
than MOST rows reach is replaced by longer ones, STEP bits at a time; a whole word is reached by
few fingerprints, so this ends. Each task folds the links it finds into a spanning forest block
by block, so a large group of near copies gives links in proportion to its members; nothing
that connects is left out.

Which ball flips what is fixed by the pair: with x < y the highest differing bit is 0 in x.
x flips it and the second highest, y flips the lowest of three. Every link is found so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, put_back, set_aside, signed, stored, strings, text_key
from .components import components

SEED = 42
SHINGLE = 3
RADIUS = 3
PER_GROUP = 20_000
MOST = 80_000  # rows of a lead that is not made longer
STEP = 6
_BLOCK = 1 << 21


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if set in over half the XXH64 hashes of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest, seed = xxhash.xxh64_intdigest, SEED
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:len(words) - shingle].tolist()]
    stops = (ends[shingle - 1:] - 1).tolist()
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK >> 3):
        block = np.array(hashes[at:at + (_BLOCK >> 3)], dtype="<u8")
        ones += np.unpackbits(
            block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([simhash(t) for t in strings(batch.column("text"))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(signed(found))],
            ["doc_id", "row_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id`, `row_key`, `fp` (the 64 bits as a signed long). A text without words has 0, as
    null has."""
    return docs.select(F.col("doc_id").cast("long"), text_key().alias("row_key"), "text").mapInArrow(
        _fingerprints, "doc_id long, row_key long, fp long")


# Balls ------------------------------------------------------------------------------------


def _bits(lo: int, hi: int) -> np.ndarray:
    return np.uint64(1) << np.arange(lo, hi, dtype=np.uint64)


def _flip(fp: np.ndarray, word: np.ndarray, kind: np.ndarray, old: int, new: int) -> tuple[np.ndarray, ...]:
    """From rows that have made their flips in the first `old` bits to rows that have made
    them in the first `new` ones. `kind` is 4 times 2 (the wide ball) or 1, plus the flips left."""
    high = _bits(64 - new, 64 - old)
    out = [(fp, word, kind)]
    two = kind == 10
    other = (kind == 9) | (kind == 5)
    any_x, any_word, any_kind = fp[other], word[other], kind[other] - 1
    x, at = fp[two], word[two]
    for c, top in enumerate(high):
        out.append((any_x, any_word ^ top, any_kind))
        free = (at & top) == 0
        zero, flipped = x[free], at[free] ^ top
        out.append((zero, flipped, np.full(len(zero), 9, np.int8)))
        out += [(zero, flipped ^ second, np.full(len(zero), 8, np.int8)) for second in high[:c]]
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


_BALLS = "bits int, lead long, kind byte, fp long"


def _emit(levels: list[tuple[int, np.ndarray]], last_only: bool = False):
    """Leads that the two balls of a fingerprint reach: (bits, lead, kind, fp). `levels`: lengths
    of leads, each with the leads of this length that the next one replaces, in order."""

    def rows(level: int, fp, word, kind, old: int) -> Iterator[pa.RecordBatch]:
        bits, crowded = levels[level]
        fp, word, kind = _flip(fp, word, kind, old, bits)
        lead = word >> np.uint64(64 - bits)
        more = np.isin(lead, crowded)
        if not last_only or level == len(levels) - 1:
            stay = ~more
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(int(stay.sum()), bits, np.int32)), pa.array(signed(lead[stay])),
                 pa.array(kind[stay]), pa.array(signed(fp[stay]))], ["bits", "lead", "kind", "fp"])
        fp, word, kind = fp[more], word[more], kind[more]
        for at in range(0, len(fp), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield from rows(level + 1, fp[part], word[part], kind[part], bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for start in range(0, len(fps), 4096):
                x = fps[start:start + 4096]
                kind = np.repeat(np.array([10, 5], np.int8), len(x))
                yield from rows(0, np.tile(x, 2), np.tile(x, 2), kind, 0)
    return run


def balls(distinct: DataFrame, lead: int, most: int = MOST) -> DataFrame:
    """`bits`, `lead`, `kind`, `fp`: at most `most` rows a lead, unless it is a whole word."""
    levels = [(lead, np.empty(0, dtype=np.uint64))]
    while levels[-1][0] < 64:
        bits = levels[-1][0]
        crowded = distinct.mapInArrow(_emit(levels, True), _BALLS).groupBy("lead").count().filter(
            F.col("count") > most).select("lead").collect()  # one for every `most` rows
        if not crowded:
            break
        levels[-1] = bits, np.sort(np.array([r.lead for r in crowded], dtype=np.int64).view(np.uint64))
        levels.append((min(64, bits + STEP), np.empty(0, dtype=np.uint64)))
    return distinct.mapInArrow(_emit(levels), _BALLS)


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the given links that first connect two trees."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(nodes)))
    kept = []
    for i, (a, b) in enumerate(zip(at[:len(u)].tolist(), at[len(u):].tolist(), strict=True)):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return u[kept], v[kept]


def _meet():
    def links(fp: np.ndarray, kind: np.ndarray, lead: int, group: int) -> tuple[np.ndarray, np.ndarray]:
        n_low = 64 - lead
        low = _bits(0, n_low)
        c_at, b_at = np.tril_indices(n_low, -1)
        pair_mask, pair_top = low[c_at] ^ low[b_at], low[c_at]
        below = np.uint64((1 << n_low) - 1)
        prefix = np.uint64(group << n_low & 2**64 - 1)
        narrow = fp[kind >> 2 == 1]
        left = kind[kind >> 2 == 1] & 3
        own = narrow & below | prefix
        words = [own]
        who = [np.arange(len(narrow))]
        wide_left = np.flatnonzero(left == 1)
        if wide_left.size:
            words.append((own[wide_left][:, None] ^ low).ravel())
            who.append(np.repeat(wide_left, n_low))
        words, who = np.concatenate(words), np.concatenate(who)
        order = np.lexsort((narrow[who], words))
        words, ys = words[order], narrow[who[order]]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        unique, y_of = words[first], ys[first]
        hit_by = np.zeros(len(unique), dtype=np.uint64)
        hit = np.zeros(len(unique), dtype=bool)
        us, vs, held = [], [], 0

        def add(u: np.ndarray, v: np.ndarray) -> None:
            nonlocal held
            apart = (u != v) & (np.bitwise_count(u ^ v) <= RADIUS)
            us.append(u[apart])
            vs.append(v[apart])
            held += len(us[-1])
            if held > _BLOCK:
                fold()
                held = 0

        def fold() -> None:
            u, v = np.concatenate(us), np.concatenate(vs)
            both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
            u, v = _forest(both[:, 0], both[:, 1])
            us[:], vs[:] = [u], [v]

        def look(x: np.ndarray, word: np.ndarray) -> None:
            at = np.searchsorted(unique, word)
            at[at == len(unique)] = 0
            same = np.flatnonzero(unique[at] == word)
            if same.size:
                x, at = x[same], at[same]
                hit[at], hit_by[at] = True, x
                add(x, y_of[at])

        for flips in (0, 1, 2):
            x = fp[kind == 8 + flips]
            base = x & below | prefix
            if flips == 0:
                look(x, base)
                continue
            if flips == 1:  # one flip above, one or none below
                look(x, base)
                for at in range(0, len(x), _BLOCK // 64):
                    part, word = x[at:at + _BLOCK // 64], base[at:at + _BLOCK // 64]
                    look(np.repeat(part, n_low), (word[:, None] ^ low).ravel())
                continue
            step = max(1, _BLOCK // max(1, len(pair_mask)))
            for at in range(0, len(x), step):
                part, word = x[at:at + step, None], base[at:at + step, None]
                for mask, top in ((low, low), (pair_mask, pair_top)):
                    rows, cols = np.nonzero((part & top) == 0)
                    look(part[rows, 0], word[rows, 0] ^ mask[cols])
        # all that meet at a word that a wide ball holds are linked to that ball's owner
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
        more = hit[run]
        add(hit_by[run[more]], ys[more])
        fold()
        return us[0], vs[0]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        kind = table.column("kind").to_numpy()
        if len(np.unique(fp)) < 2 or not (kind >> 2 == 1).any() or not (kind >> 2 == 2).any():
            u = v = np.empty(0, dtype=np.uint64)
        else:
            u, v = links(fp, kind, key[0].as_py(), key[1].as_py())
        return pa.table({"u": pa.array(signed(u)), "v": pa.array(signed(v))})

    return run


def lead_bits(n: int) -> int:
    """So many leading bits that a group holds about PER_GROUP rows, if leads are even."""
    lead = 4
    while lead < 24 and n * (2 + 1.5 * lead + lead * lead / 4) > PER_GROUP * 2**lead:
        lead += 1
    return lead


def links(fps: DataFrame, lead: int | None = None, most: int = MOST) -> DataFrame:
    """`u`, `v`: links between distinct fingerprints (`fp`) at distance 3 or less, as many as
    connect whatever the links connect."""
    distinct = stored(fps.select("fp").distinct(), "simhash-fingerprints")
    if lead is None:
        lead = lead_bits(distinct.count())
    met = balls(distinct.repartition(partitions(fps.sparkSession)), lead, most)
    return met.groupBy("bits", "lead").applyInArrow(_meet(), "u long, v long")


def _rooted(classes: DataFrame, lead: int | None) -> DataFrame:
    """`classes`, one row per fingerprint (`fp`), with `root`: which component it is in."""
    roots = components(links(classes, lead))
    return classes.join(roots, classes.fp == roots.node, "left").withColumn(
        "root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame, lead: int | None = None) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` (16 hex digits), `component_id`: the
    smallest doc_id that links reach from it, itself included.

    Texts without words, null ones among them, share the fingerprint zero and are linked like
    any other; rows that repeat are linked by their equal fingerprints; doc_id null is larger
    than all. An empty table gives no rows; other columns of `docs` are not read.
    """
    rows = stored(fingerprints(docs), "simhash-rows")
    classes = _rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), lead)
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = stored(classes.select("fp", "root").join(ids, "root").drop("root"), "simhash-classes")
    return rows.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, lead: int | None = None) -> DataFrame:
    """`docs` with one row of every component: the smallest doc_id, null being larger than all.

    Rows are told apart by doc_id and text, so of rows that share a doc_id only the one with the
    smaller key stays, if they are in one component, and each stays where they are in several.
    Repeated rows leave one. An empty table stays empty; no column name clashes.
    """
    rows = stored(fingerprints(docs), "simhash-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    first = rows.groupBy("fp").agg(least.alias("first"))  # before the join, so that no class is hot
    kept = _rooted(first, lead).groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.row_key").alias("kept_key"))
    held = set_aside(docs, "doc_id", "text").withColumn("row_key", text_key())
    left = held.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row_key") == F.col("kept_key")))
    return put_back(left.dropDuplicates(["doc_id", "row_key"]), docs, "doc_id", "text")
