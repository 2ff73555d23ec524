from __future__ import annotations

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pathquality.llm import covertree
from pathquality.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    held = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            held[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for q in held:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(held[q], held[i], strict=True)), i)
                            for i in held if i != q and len(held[i]) == len(held[q]))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("centres", "per_part"), [(4, 10_000), (8, 20), (1, 7)])
def test_top_k_against_brute_force(spark, centres, per_part):
    rng = np.random.default_rng(centres)
    middle = rng.normal(size=(5, 6))
    rows = [(int(i), [float(np.float32(x)) for x in middle[i % 5] + rng.normal(size=6) * 0.2]) for i in range(400)]
    rows += [(400, rows[7][1]), (401, rows[7][1]), (402, None), (403, []), (404, [1.0] * 5 + [None]),
             (405, [float("nan")] * 6), (406, [float("inf")] + [0.0] * 5), (None, rows[0][1]),
             (450, [1.0, 2.0]), (451, [0.5, 0.25]), (500, [9.0] * 3)]
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = covertree.top_k(vectors, 50, 5, centres, per_part).collect()
    assert sorted(map(tuple, got)) == brute(rows, 50, 5)


def test_queries_of_a_cell_are_dealt_into_blocks(spark):
    rows = spark.range(600).selectExpr("id as vec_id", "4 as dim", "int(id % 2) as cell", "int(id % 3) as part")
    asked = rows.filter("cell = 0").drop("part").crossJoin(spark.range(3).selectExpr("int(id) as part"))
    queries, held = covertree.dealt(asked, rows, 20)
    sizes = queries.groupBy("dim", "cell", "part", "block").count().collect()
    assert len(sizes) == 3 * 15 and max(r["count"] for r in sizes) < 60 and queries.count() == asked.count()
    assert held.groupBy("vec_id").count().filter("count <> 15").count() == 0 and held.count() == 300 * 15
    one = [(i, [1.0, 2.0], 0) for i in range(400)] + [(400 + i, [float(i), 1.0], 0) for i in range(100)]
    vectors = spark.createDataFrame(one, SCHEMA)
    want = sorted(map(tuple, covertree.top_k(vectors, 5, 3, 4, 50).collect()))
    assert sorted(map(tuple, covertree.top_k(vectors, 5, 3, 4, 50, 7).collect())) == want and len(want) == 300


def test_top_k_of_nothing_and_of_one(spark):
    assert covertree.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert covertree.top_k(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).count() == 0
    two = spark.createDataFrame([(0, [1.0], 1), (0, [1.0], 1), (3, [-1.0], 1)], SCHEMA)
    assert sorted(map(tuple, covertree.top_k(two).collect())) == [(0, 1, 0, 65536)] * 2 + [(0, 2, 3, -65536)] * 2


@pytest.mark.parametrize(("centres", "per_part"), [(4, 10_000), (8, 20)])
def test_top_k_of_repeated_ids_and_large_components(spark, centres, per_part):
    rng = np.random.default_rng(centres)
    rows = [(int(i) % 150, (rng.normal(size=5) * 10.0**float(rng.choice([0, 3, 5, 6]))).tolist()) for i in range(400)]
    rows += [(i, rows[3][1]) for i in (50, 50, 7)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = [[math.floor(256 * x) for x in v] for _, v in rows]
    want = []
    for a, (q, _) in enumerate(rows):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(whole[a], whole[b], strict=True)), i)
                            for b, (i, _) in enumerate(rows) if b != a)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert max(s for *_, s in want) > 2**53
    assert sorted(map(tuple, covertree.top_k(vectors, 50, 5, centres, per_part).collect())) == sorted(want)


def test_nodes_cover_their_points():
    points = np.floor(np.random.default_rng(1).normal(size=(500, 4)) * 256)

    def walk(node):
        away = np.sqrt(((points[node.rows] - node.centre) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        for child in node.children:
            walk(child)

    walk(covertree.cover_tree(points, leaf=8))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    got = QUERIES[name](spark, small)
    rows = sorted(repr(tuple(r)) for r in got.collect())
    assert rows
    if name in ORACLES:
        columns = ", ".join(f'"{c}"' for c in got.columns)
        assert rows == sorted(map(repr, duck.execute(f"select {columns} from ({ORACLES[name]})").fetchall()))


def test_registered_once_for_each_operator():
    found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_nothing_else_imports_the_package():
    top = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(top, "pathquality")):
        for file in files:
            if file.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, file)) as text:
                    assert "pathquality.llm" not in text.read()


def test_pipeline_stages(spark, small, tmp_path):
    base = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, "", "en", "src0", 0), (10**6, "", "en", "src0", 0),
         *((10**6 + 3 * i, "you idiot moron scum", "en", "src1", 20) for i in range(1, 9))], base.schema)
    docs, seen = base.unionByName(extra), []
    assert docs.filter("text = 'you idiot moron scum'").count() == 8
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
    assert all(d.columns == base.columns for d in seen[:-1])
    kept, cut, single, mixed, coded = seen
    assert kept.filter("text = 'you idiot moron scum'").count() == 0
    assert kept.count() == cut.count() >= single.count()
    assert single.select("doc_id").distinct().count() == single.count()
    assert mixed.count() == coded.count()
    assert coded.filter("not round_trip").count() == 0


def test_pipeline_of_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0


def test_pipeline_and_clashing_columns(spark, small):
    names = ("gone", "__d", "__row_key", "row_key", "rest", "n_lines", "n_removed", "size", "target", "taken",
             "source_size", "n_docs", "weight", "__copy", "kept_id", "fp", "root", "c0")
    docs = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 40")
    docs = docs.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)


def test_one_row_of_a_component_stays(spark, small):
    a, b = "first words of one text", "other things stand in this one"
    rows = [(1, b), (2, a), (2, b), (2, b), (None, a), (None, "third text with words of its own"), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()
    assert sorted(map(tuple, left), key=repr) == [(1, b), (2, a), (None, rows[5][1])]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), small).count() == 0
