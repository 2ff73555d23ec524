from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pathquality.llm import simhash, substrings
from pathquality.llm.components import components

SCHEMA = "doc_id long, text string"


def by_bits(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps: list[int], ids: list[int]) -> dict[int, int]:
    at = {i: i for i in ids}

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, x in zip(ids, fps, strict=True):
        for b, y in zip(ids, fps, strict=True):
            if a < b and (x ^ y).bit_count() <= 3:
                r, s = find(a), find(b)
                at[max(r, s)] = min(r, s)
    return {i: find(i) for i in ids}


def test_simhash_follows_its_definition():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 700):
        text = " \t".join(rng.choice(["Ab", "ÄÖ", "c", "d e"]) for _ in range(n))
        assert simhash.simhash(text.encode()) == by_bits(text)


def test_spark_hashes_a_shingle_alike(spark):
    got = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("lead", [4, 9])
def test_links_connect_all_within_three_bits(spark, lead):
    rng = random.Random(lead)
    fps = []
    for _ in range(30):
        base = rng.getrandbits(64)
        fps.append(base)
        for _ in range(rng.randrange(6)):
            fps.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    fps += [0, 7, 2**63, 2**64 - 1, 2**64 - 8]
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(rows, lead).collect()
    assert all(((r.u ^ r.v) % 2**64).bit_count() <= 3 for r in found)
    got = {r.node: r.root for r in components(simhash.links(rows, lead)).collect()}
    want = roots(fps, signed)
    assert {f: got.get(f, f) for f in signed} == {
        f: min(g for g in signed if want[g] == want[f]) for f in signed}


def test_a_large_family_is_split_and_stays_connected(spark):
    rng = random.Random(12)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(300)}
    fps |= {base ^ 1 << b for b in range(64)} | {rng.getrandbits(64) for _ in range(20)}
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(2)
    sizes = simhash.balls(rows, 6, 150).groupBy("bits", "lead").count().collect()
    assert max(r["count"] for r in sizes if r.bits < 64) <= 150 and max(r.bits for r in sizes) > 6
    found = simhash.links(rows, 6, 150).collect()
    assert all(0 < ((r.u ^ r.v) % 2**64).bit_count() <= 3 for r in found)
    got = {r.node: r.root for r in components(simhash.links(rows, 6, 150)).collect()}
    want = roots(fps, signed)
    assert {f: got.get(f, f) for f in signed} == {
        f: min(g for g in signed if want[g] == want[f]) for f in signed}


def test_whole_words_as_leads(spark):
    rows = spark.createDataFrame([(f,) for f in (0, 7, 2**20, -1, -4, -2**63)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(rows, 4, 0)).collect()}
    assert got == {0: -2**63, 7: -2**63, 2**20: -2**63, -2**63: -2**63, -1: -4, -4: -4}


def test_hits_are_folded_block_by_block(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "_BLOCK", 64)
    sizes = []
    forest = simhash._forest
    monkeypatch.setattr(simhash, "_forest", lambda u, v: sizes.append(len(u)) or forest(u, v))
    fps = np.array([1 << i | 1 << j for i in range(16) for j in range(i)], dtype=np.int64)
    emitted = pa.Table.from_batches(simhash._emit([(4, np.empty(0, np.uint64))])(
        [pa.RecordBatch.from_arrays([pa.array(fps)], ["fp"])])).filter(pa.compute.field("lead") == 0)
    links = simhash._meet()((pa.scalar(4), pa.scalar(0)), emitted)
    assert links.num_rows == len(fps) - 1 and len(sizes) > 2 and max(sizes) < 16 * len(fps)


def test_near_duplicates_of_edge_cases(spark):
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "changed", *words[201:]]
    rows = [
        (5, " ".join(words), "x"), (3, " ".join(near), "x"), (9, " ".join(words).upper(), None),
        (2, None, "x"), (7, "", "x"), (8, " \n", "x"), (1, "alone here", "x"), (1, "alone here", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, 6).collect()}
    assert simhash.near_duplicates(docs, 6).count() == len(rows)
    assert got[2].component_id == got[7].component_id == got[8].component_id == 2
    assert got[2].fingerprint == "0" * 16
    assert got[5].component_id == got[9].component_id and got[1].component_id == 1
    near_bits = (by_bits(rows[0][1]) ^ by_bits(rows[1][1])).bit_count()
    assert (got[3].component_id == got[5].component_id) == (near_bits <= 3)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert got[201] == 200 and len(got) == 41 + 40 + 2
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Repeated passages ------------------------------------------------------------------------


def removed(rows: list[tuple], window: int) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    split = {d: (t or "").encode().split() for d, t in rows}
    for d, w in split.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("window", "gram"), [(50, 12), (10, 4)])
def test_substrings_against_brute_force(spark, window, gram):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(200)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([window, 3 * window, 20]))]
                for _ in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randrange(5)):
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(2 * window))]
            words += rng.choice(passages)[rng.randrange(3):]
        rows.append((d * 7 % 61, " ".join(words)))
    rows += [(100, rows[5][1]), (101, rows[5][1] + " tail"), (102, None), (103, ""),
             (104, "a " * 3 * window), (105, "a " * 5 * window), (106, "b a " * 2 * window),
             (107, " ".join(vocabulary))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substrings.substring_dedup(docs, window, gram).collect()}
    assert got == removed(rows, window)


def test_substrings_of_null_ids_repeated_rows_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(None, text, 1), (4, text, 2), (4, text, 3), (6, text, 4)], "doc_id long, text string, first int")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.substring_dedup(docs).collect())
    assert got == [(0, 0), (4, 0), (4, 0), (6, 60)]
    assert substrings.substring_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_word_hash_of_long_words():
    from pathquality.llm.common import word_hashes, word_spans

    text = b"a" * 300 + b" " + b"a" * 301 + b" ab abcdefgh abcdefghi " + b"a" * 300
    h = word_hashes(text, *word_spans(text))
    assert h[0] == h[-1] and len(np.unique(h)) == 5
