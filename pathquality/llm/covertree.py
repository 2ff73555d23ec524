"""Exact top-k by inner product: dual-tree search over cover trees.

A cover tree splits its points by distance to a few of them, level by level; a node knows its
centre and its covering radius, the largest distance of a point below. For a query node with
centre q and radius s, and a data node with centre p and radius r, no inner product between
their points exceeds <q, p> + s|p| + r|q| + rs, so a pair of nodes is skipped when that is
below the worst k-th score that the node's queries have already.

The top of the data tree is spread by Spark: centres are taken from a bounded sample, every row
goes to its nearest centre, and a cell with more rows than a task should hold is dealt into
parts, and its queries into blocks: a task holds one part and one block. Each query first searches the cell it lies in, which gives it a k-th score; cells whose
bound is below that are then left out, the others are searched by their own tree against the
queries that remain, indexed together.

Bounds are in double precision with a margin for its rounding; scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import cleaned, matrix, products

K = 5
CENTRES = 64          # top-level cells, at most
PER_CELL = 500        # rows for which another cell is worth its tree
SAMPLE = 4096         # rows that the centres are chosen from, at most about
PER_PART = 20_000     # rows of one cell in one task
PER_BLOCK = 20_000    # queries in one task
LEAF = 512            # rows below which a node is compared as a block, and queries
QUERY_LEAF = 128

MARGIN = 1e-9         # of the product of two norms: more than their bound can be off by rounding
NO_SCORE = -(1 << 63) + 1

_VECTOR = "row long, vec_id long, dim int, vector binary"


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    norm: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Children are the cells of points picked one by one, each the furthest from those before,
    until all points are within half the node's radius of one (or 16 are picked)."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    with np.errstate(over="ignore", invalid="ignore"):  # what overflows is not split or skipped
        mean = own.mean(axis=0)
        centre = own[np.argmin(((own - mean) ** 2).sum(axis=1))]
        away = np.sqrt(((own - centre) ** 2).sum(axis=1))
        radius = float(away.max())
        node = Node(centre, radius, float(np.sqrt((centre**2).sum())), rows, [])
    if len(rows) <= leaf or radius == 0 or not np.isfinite(radius):
        return node
    nearest, distance, n = np.zeros(len(rows), dtype=int), away, 1
    while n < 16 and distance.max() > radius / 2:
        far = int(distance.argmax())
        to_far = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
        closer = to_far < distance
        nearest[closer], distance = n, np.minimum(distance, to_far)
        n += 1
    parts = [rows[nearest == i] for i in range(n)]
    node.children = [cover_tree(points, p, leaf) for p in parts if len(p)]
    return node


class Best:
    """The k best of every query so far: higher score first, then the smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), NO_SCORE, dtype=np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        cut = self.score[rows, -1]
        if scores.shape[1] > self.k:  # only those that reach the block's k-th best can enter
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            cut = np.maximum(cut, kth)
        row, col = np.nonzero((scores >= cut[:, None]) & (scores > NO_SCORE))
        if not len(row):
            return
        n = len(rows)
        owner = np.concatenate([np.repeat(np.arange(n), self.k), row])
        score = np.concatenate([self.score[rows].ravel(), scores[row, col]])
        found = np.concatenate([self.ids[rows].ravel(), ids[col]])
        order = np.lexsort((found, -score, owner))
        first = np.searchsorted(owner[order], np.arange(n))
        best = order[first[:, None] + np.arange(self.k)]
        self.score[rows], self.ids[rows] = score[best], found[best]


def dual_search(queries: np.ndarray, query_rows: np.ndarray, data: np.ndarray, rows: np.ndarray,
                ids: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """The k best rows of `data` for each query, its own row left out. Rows below `floor`, a
    score that k others reach, may be missing."""
    best = Best(len(queries), k)
    if not len(queries) or not len(data):
        return best
    stack = [(cover_tree(queries, leaf=QUERY_LEAF), cover_tree(data))]
    while stack:
        q, p = stack.pop()
        with np.errstate(over="ignore", invalid="ignore"):
            bound = float(q.centre @ p.centre) + q.radius * p.norm + p.radius * q.norm + q.radius * p.radius
            margin = MARGIN * (q.norm + q.radius) * (p.norm + p.radius)
        need = np.maximum(best.score[q.rows, -1], floor[q.rows]).min()
        if bound < need - MARGIN * abs(need) - margin:
            continue
        if not q.children and not p.children:
            scores = products(queries[q.rows], data[p.rows])
            scores[query_rows[q.rows][:, None] == rows[p.rows][None, :]] = NO_SCORE
            best.add(q.rows, scores, ids[p.rows])
        elif p.children and (not q.children or p.radius >= q.radius):
            nearest = sorted(p.children, key=lambda c: float(q.centre @ c.centre) + c.radius * q.norm)
            stack += [(q, c) for c in nearest]  # the most promising comes off first
        else:
            stack += [(c, p) for c in q.children]
    return best


# Over Spark -------------------------------------------------------------------------------


def _pick(vectors: np.ndarray, n: int) -> np.ndarray:
    """Sample points far from each other."""
    chosen = [0]
    away = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(vectors)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def _assign(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), dtype=np.int32)
            away = np.zeros(len(dims))
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = matrix(batch.column("vector").take(pa.array(mine)), int(dim))
                c = centres.get(int(dim), np.zeros((1, dim)))
                with np.errstate(over="ignore", invalid="ignore"):
                    square = (x**2).sum(axis=1)[:, None] - 2 * x @ c.T + (c**2).sum(axis=1)
                    cell[mine] = square.argmin(axis=1)
                    away[mine] = np.sqrt(((x - c[cell[mine]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])
    return run


def _search(k: int):
    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not asked.num_rows or not held.num_rows:
            return _RESULT.empty_table()
        query_rows = asked.column("row").to_numpy()
        best = dual_search(
            matrix(asked.column("vector"), dim), query_rows, matrix(held.column("vector"), dim),
            held.column("row").to_numpy(), held.column("vec_id").to_numpy(),
            asked.column("floor").to_numpy(), k)
        row, col = np.nonzero(best.score > NO_SCORE)
        return pa.table({
            "query_row": query_rows[row], "query_id": asked.column("vec_id").to_numpy()[row],
            "vec_id": best.ids[row, col], "score": best.score[row, col]}, schema=_RESULT)
    return run


_RESULT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_RESULT_DDL = "query_row long, query_id long, vec_id long, score long"
_LEAST = -1.0e300


def _possible(cells: list[tuple], centres: dict[int, np.ndarray]):
    """For each query, the cells whose bound reaches its k-th score."""
    by_dim: dict[int, list[tuple]] = {}
    for row in cells:
        by_dim.setdefault(row[0], []).append(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            own, floor = batch.column("own").to_numpy(), batch.column("floor").to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = matrix(batch.column("vector").take(pa.array(mine)), int(dim))
                with np.errstate(over="ignore"):
                    norm = np.sqrt((x**2).sum(axis=1))
                for _, cell, radius, parts in by_dim.get(int(dim), ()):
                    centre = centres[int(dim)][cell]
                    with np.errstate(over="ignore", invalid="ignore"):
                        bound = x @ centre + radius * norm
                        slack = MARGIN * (norm * (np.sqrt((centre**2).sum()) + radius) + np.abs(floor[mine]))
                        go = mine[~(bound + slack < floor[mine]) & (own[mine] != cell)]
                    for part in range(parts if len(go) else 0):
                        at = pa.array(go)
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(c).take(at) for c in ("row", "vec_id", "dim")),
                             pa.array(np.full(len(go), cell, np.int32)), pa.array(np.full(len(go), part, np.int32)),
                             batch.column("vector").take(at), pa.array(floor[go])],
                            ["row", "vec_id", "dim", "cell", "part", "vector", "floor"])
    return run


def _topped(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def dealt(asked: DataFrame, data: DataFrame, per_block: int,
          key: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """Both with `block`: the queries of a cell are dealt by `key` into blocks of about `per_block`, every
    part of the cell is copied for each. Cells that no query asks for are left out."""
    counts = asked.filter("part = 0").groupBy("dim", "cell").count().collect()  # per centre
    if not counts:
        none = F.lit(0).alias("block")
        return asked.select("*", none), data.select("*", none).limit(0)
    blocks = F.create_map(*[x for r in counts for x in (
        F.lit(f"{r['dim']}:{r['cell']}"), F.lit(-(-r["count"] // per_block)))])
    n_blocks = F.try_element_at(blocks, F.concat_ws(":", "dim", "cell"))
    return (asked.withColumn("block", F.pmod(F.xxhash64(key, F.lit("block")), n_blocks).cast("int")),
            data.withColumn("n_blocks", n_blocks).filter("n_blocks is not null").withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks"))


def top_k(vectors: DataFrame, every: int = 50, k: int = K, n_centres: int = CENTRES,
          per_part: int = PER_PART, per_block: int = PER_BLOCK) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: for every row whose vec_id `every`
    divides, the k rows of highest integer inner product, ties to the smaller vec_id.

    A component x counts as floor(256 x). Scores are exact (beyond +-(2^63 - 16): that). Vectors
    that are null or empty, or hold a null or non-finite component, take no part, nor do rows with
    vec_id null. Rows that repeat a vec_id all take part: each of them is a query, with the others
    among its candidates. Vectors are compared with those of their length. An empty table gives no
    rows; other columns are not read.
    """
    rows = vectors.filter("vec_id is not null").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), "embedding")
    # written once, so that a row keeps its number
    rows = stored(rows.mapInArrow(cleaned(["row", "vec_id"]), _VECTOR).filter("dim > 0"), "top-rows")
    n = rows.count()
    share = min(1.0, SAMPLE / max(1, n))
    picked = rows.filter(
        F.pmod(F.xxhash64("row", F.lit("centre")), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample: dict[int, list[bytes]] = {}
    for r in picked.collect():  # about SAMPLE rows
        sample.setdefault(r["dim"], []).append(bytes(r["vector"]))
    centres = {
        dim: _pick(np.frombuffer(b"".join(sorted(found)), dtype="<f8").reshape(-1, dim),
                   min(n_centres, 1 + n // PER_CELL))
        for dim, found in sample.items()}
    placed = stored(rows.mapInArrow(_assign(centres), _VECTOR + ", cell int, away double"), "top-placed")
    cells = placed.groupBy("dim", "cell").agg(F.max("away"), F.count(F.lit(1))).collect()  # per centre
    centres |= {dim: np.zeros((1, dim)) for dim, *_ in cells if dim not in centres}
    cells = [(dim, cell, radius, -(-count // per_part)) for dim, cell, radius, count in cells]
    parts = F.create_map(*[x for d, c, _, p in cells for x in (F.lit(f"{d}:{c}"), F.lit(p))]) if cells else None
    n_parts = F.lit(1) if parts is None else parts[F.concat_ws(":", "dim", "cell")]
    data = placed.withColumn("part", F.pmod(F.xxhash64("row"), n_parts).cast("int"))
    queries = placed.filter(F.col("vec_id") % every == 0)
    home = queries.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))).withColumn(
        "floor", F.lit(_LEAST)).drop("away")
    keys = ("dim", "cell", "part", "block")

    def searched(asked: DataFrame, name: str) -> DataFrame:
        asked, held = dealt(asked, data, per_block, "row")
        return stored(asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
            _search(k), _RESULT_DDL), name)

    near = searched(home, "top-near")
    kth = _topped(near, k).filter(F.col("rank") == k).select("query_row", F.col("score").alias("kth"))
    rest = queries.join(kth, F.col("row") == F.col("query_row"), "left").select(
        "row", "vec_id", "dim", F.col("cell").alias("own"), "vector",
        F.coalesce(F.col("kth").cast("double"), F.lit(_LEAST)).alias("floor"))
    far = searched(rest.mapInArrow(
        _possible(cells, centres), "row long, vec_id long, dim int, cell int, part int, vector binary, floor double"),
        "top-far")
    return _topped(near.unionByName(far), k).select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
with ints as (
    select row_number() over () as row, vec_id, [floor(256 * x::double)::hugeint for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.row, q.vec_id as query_id, d.vec_id,
           list_sum([p[1] * p[2] for p in list_zip(q.v, d.v)])::bigint as score
    from ints q join ints d on q.row <> d.row and len(q.v) = len(d.v)
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by row order by score desc, vec_id) as rank
    from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""
