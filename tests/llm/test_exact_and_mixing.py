from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pathquality.llm import exact, mixing

SCHEMA = "doc_id long, text string"


def test_fingerprints_compose():
    rng = random.Random(1)
    text = bytes(rng.randrange(256) for _ in range(5000))
    whole = exact.fingerprint(text)
    for size in (1, 7, 64, 4999, 5000, 9000):
        parts = [exact.fingerprint(text[i:i + size], max(0, len(text) - i - size))
                 for i in range(0, len(text), size)]
        assert sum(parts) % exact.PRIME == whole


def groups(rows):
    normal = [(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for d, t in rows]
    out = []
    for d, t in normal:
        same = [e for e, u in normal if u == t]
        ids = [e for e in same if e is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(same), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "prime"), [(64 << 10, exact.PRIME), (16, exact.PRIME), (16, 251), (8, 3)])
def test_exact_duplicates_against_brute_force(spark, chunk, prime):
    """Tiny moduli make different texts share a fingerprint, which the comparison must part."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("aBc é\n") for _ in range(n)) for n in (3, 3, 3, 17, 17, 40, 40, 40, 65)]
    rows = [(i, rng.choice(texts).swapcase() if rng.random() < 0.3 else rng.choice(texts)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "É"), (103, "é"), (None, texts[0]), (None, "only here"),
             (7, rows[7][1]), (104, texts[8]), (104, texts[8])]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA + ", fp string").repartition(3)
    got = [tuple(r) for r in exact.exact_duplicates(docs, chunk, prime).collect()]
    assert sorted(got, key=repr) == groups(rows)


def test_exact_duplicates_of_nothing(spark):
    assert exact.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(exact, "PER_SALT", 3)
    docs = spark.createDataFrame([(i, "same text") for i in range(20)] + [(50, "other")], SCHEMA)
    got = exact.exact_duplicates(docs).filter("kept").select("doc_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(19, 20), (50, 1)]


# Mixing -----------------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, n_chars long"


def some(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)


def water(sizes: list[int]) -> list[float]:
    """Targets by repeated sharing, as the contract words it."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while left > 1e-9 and open_:
        total = sum(weights[i] for i in open_)
        for i in open_:
            target[i] += left * weights[i] / total
        left = 0.0
        for i in list(open_):
            if target[i] >= 3 * sizes[i]:
                left += target[i] - 3 * sizes[i]
                target[i] = 3.0 * sizes[i]
                open_.discard(i)
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_budgets(spark, seed):
    rng = random.Random(seed)
    names = sorted({rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(9)})
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 60]))),
             rng.choice([None, *names[:3], *names[:3], *names])) for i in range(150)]
    got = mixing.mix(some(spark, rows)).collect()
    assert len(got) == len(rows)
    sources = sorted({r[2] for r in rows if r[2] is not None}) + [None] * any(r[2] is None for r in rows)
    sizes = [sum(len((t or "").split()) for _, t, s in rows if s == name) for name in sources]
    for name, size, target in zip(sources, sizes, water(sizes), strict=True):
        mine = [r for r in got if r.source == name]
        assert all(r.source_size == size and r.target == pytest.approx(target) for r in mine)
        assert sum(r.taken for r in mine) == int(target + 0.5)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
    again = mixing.mix(some(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two three four", "b"), (3, "one two three four", "b"),
            (None, "x y", None), (5, "\x1cnot split", "")]
    docs = some(spark, rows).withColumn("size", mixing.F.lit("clash"))
    got = {(r.doc_id, r.source): r for r in mixing.mix(docs).collect()}
    assert got[1, "a"].size == 0 == got[1, "a"].taken and got[5, ""].size == 1
    assert mixing.mix(some(spark, [])).count() == 0
    empty = mixing.mix(some(spark, [(1, None, "a"), (2, "", "b")])).collect()
    assert [r.taken for r in empty] == [0, 0]


def test_repeated_holds_what_is_taken(spark):
    rows = [(i, f"a{i} b\nc  d e", "s" if i < 4 else "t") for i in range(12)]
    mixed = mixing.mix(some(spark, rows))
    want = sum(r.taken for r in mixed.collect())
    out = mixing.repeated(mixed, ["doc_id", "text", "source", "n_chars"]).collect()
    assert sum(len(r.text.split()) for r in out) == want
    assert all(r.n_chars == len(r.text) for r in out)


def test_mixing_runs_no_python(spark):
    plan = mixing.mix(some(spark, [(1, "a", "b")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_documents_without_id_are_mixed_like_others(spark, duck):
    rows = [(None, f"{'word ' * (i % 7)}number {i}", f"s{i % 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA + ", source string")
    assert docs.select(mixing.random_key()).distinct().count() == 400
    names = ("size_", "n_docs", "weight", "rest", "__key")
    wide = docs.select("*", *[F.length("text").alias(n) for n in names])
    got = mixing.mix(wide)
    assert got.columns == [*wide.columns, "size", "source_size", "target", "taken"]
    assert got.filter("n_docs <> length(text) or `__key` <> length(text)").count() == 0
    duck.register("mixed_docs", docs.toPandas().astype({"doc_id": "Int64"}))
    sql = mixing.MIX_SQL.replace("from documents", "from mixed_docs")
    want = duck.execute(f"select size, source_size, target, taken from ({sql})").fetchall()
    assert sorted(map(tuple, got.select("size", "source_size", "target", "taken").collect())) == sorted(want)
