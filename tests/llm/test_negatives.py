from __future__ import annotations

import math

import numpy as np
import pytest

from pathquality.llm import negatives, vectors
from pathquality.llm.negatives import Anchors, Candidates, hard_negatives, mine, spanning_tree

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, k=10):
    held = [(n, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v])
            for n, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, label, v in held:
        if i is None or i % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=True)), m is None, m or 0, r, m, other)
            for r, m, other, w in held if r != n and len(w) == len(v))
        for p, _, _, _, positive, other in [x for x in scored if x[5] == label][:positives]:
            inside = [x for x in scored if x[5] != label and 30 * -p <= 100 * -x[0] <= 90 * -p]
            out += [(i, positive, rank + 1, x[4], -p, -x[0]) for rank, x in enumerate(inside[:k])]
    return sorted(out, key=repr)


def table(seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, 5))
    rows = [(i, [float(x) for x in middle[i % 6] + rng.normal(size=5) * 0.4], i % 4) for i in range(1200)]
    hot = rows[100][1]
    rows += [(2000 + i, hot, i % 2) for i in range(400)]               # a third of one vector, anchors among them
    rows += [(100, rows[200][1], 1), (100, rows[200][1], 1), (7, rows[200][1], None), (8, None, 1),
             (9, [1.0, None, 0.0, 0.0, 0.0], 1), (10, [float("nan")] * 5, 1), (11, [float("inf")] + [0.0] * 4, 1),
             (None, hot, 0), (None, hot, 1), (3000, [], 1), (3001, [], 1), (3002, [], 2), (3100, [0.5, 0.25], 1),
             (3101, [1.0, 2.0], 1), (3102, [0.5, 1.0], 2), (3200, [0.0] * 5, 1), (3201, [-1.0] * 5, 9)]
    return rows


@pytest.mark.parametrize(("per_block", "per_part", "first"), [(8000, 20_000, 64), (4, 150, 5)])
def test_against_brute_force(spark, per_block, per_part, first):
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as row", "1 as dim", "2 as score").repartition(3)
    got = hard_negatives(frame, per_block=per_block, per_part=per_part, first=first).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_components_beyond_double_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(1, 10**6, 4)], i % 2) for i in range(1, 300)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got and sorted(map(tuple, got), key=repr) == brute(rows)
    huge = vectors.products(np.array([[2.0**40, 1.0], [2.0**20, 3.0]]), np.array([[2.0**40, 1.0], [5.0, 7.0]]))
    assert huge.tolist() == [[vectors.LARGEST, 5 * 2**40 + 7], [2**60 + 3, 5 * 2**20 + 21]]


def test_of_nothing(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 2)], SCHEMA)).count() == 0
    assert hard_negatives(spark.createDataFrame([(100, [1.0], 1), (None, None, None)], SCHEMA)).count() == 0


def test_tree_spans_by_short_edges():
    points = np.floor(np.random.default_rng(2).normal(size=(300, 4)) * 256)
    parent, edge = spanning_tree(points, deepest=6)
    assert (parent == -1).sum() == 1
    for i, p in enumerate(parent):
        assert math.isclose(edge[i], np.sqrt(((points[i] - (points[p] if p >= 0 else 0)) ** 2).sum()))
        steps = 0
        while parent[i] >= 0:
            i, steps = parent[i], steps + 1
        assert steps <= 6
    loose, long = spanning_tree(points, deepest=300), spanning_tree(points, deepest=1)
    assert loose[1].sum() <= edge.sum() <= long[1].sum()


def test_bounds_leave_out_most_candidates():
    """Tight clusters: few candidates of a far cluster are scored, and the result is the same."""
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(20, 16)) * 3000
    points = np.floor(middle[np.arange(4000) % 20] + rng.normal(size=(4000, 16)) * 20)
    held = Candidates(np.arange(4000), np.arange(4000), np.arange(4000) % 3, points)
    ids = np.arange(0, 4000, 40)
    parent, edge = spanning_tree(points[ids])
    best = np.sort(vectors.products(points[ids], points), axis=1)[:, -5].tolist()
    asked = Anchors(ids, held.label[ids], points[ids], parent, edge,
                    [[3 * p // 10] for p in best], [[9 * p // 10] for p in best])
    slots, scored = mine(asked, held, 10, same=False)
    assert scored < 0.5 * len(ids) * 4000
    for i, own in zip(ids, slots, strict=True):
        score = points @ points[i]
        fits = np.flatnonzero((held.label != held.label[i]) & (score >= own[0].low) & (score <= own[0].high))
        want = fits[np.lexsort((fits, -score[fits]))][:10]
        assert own[0].row.tolist() == want.tolist()
