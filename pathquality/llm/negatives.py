"""Hard negatives: rows of another label that score just below an anchor's positives.

Anchors are joined to a spanning tree of short edges. For a candidate x, an anchor a and its
parent p in the tree, <a, x> lies within |a - p| |x| of <p, x>: a score known at the parent
bounds the child's, the bounds widen along edges that add no score, and only candidates whose
bounds overlap the window an anchor looks for are scored there. (The root's parent is the
origin, where every score is zero.)

Anchors near each other share a block, which has one tree; rows are dealt into parts. A task
meets one block and one part. A pass over a fixed share of the rows comes first: the scores it
finds raise the lower end of the windows for the pass over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import LARGEST, cleaned, matrix, nearest, norms, products, spread_out

POSITIVES = 5
NEGATIVES = 10
PER_BLOCK = 8_000     # anchors of one tree, about
PER_PART = 20_000     # rows in one task, about
SAMPLE = 4096         # anchors that block centres are chosen from, at most about
FIRST = 64            # one row in so many takes part in the first pass
DEEPEST = 32          # edges between a tree's root and any anchor

_ROW = "row long, vec_id long, label long, dim int, vector binary"
_FOUND = "anchor_row long, anchor_id long, slot int, row long, vec_id long, score long"
_NO_ID = np.iinfo(np.int64).max


def spanning_tree(points: np.ndarray, deepest: int = DEEPEST) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1: the origin) and edge length of every point. The closest point outside the tree
    is joined to the closest one inside that is not at the deepest level yet."""
    n = len(points)
    parent, edge = np.full(n, -1, dtype=np.int64), np.zeros(n)
    if not n:
        return parent, edge
    root = int(norms(points - points.mean(axis=0)).argmin())
    edge[root] = norms(points[root:root + 1])[0]
    depth, close = np.zeros(n, dtype=np.int64), np.full(n, root)
    away = norms(points - points[root])
    outside = np.ones(n, dtype=bool)
    outside[root] = False
    for _ in range(n - 1):
        left = np.flatnonzero(outside)
        i = int(left[away[left].argmin()])
        outside[i] = False
        parent[i], edge[i], depth[i] = close[i], away[i], depth[close[i]] + 1
        if depth[i] < deepest:
            to_i = norms(points - points[i])
            closer = to_i < away
            away[closer], close[closer] = to_i[closer], i
    return parent, edge


@dataclass
class Anchors:
    row: np.ndarray
    label: np.ndarray
    points: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    low: list[list[int]]    # of each anchor, its windows' ends, both included
    high: list[list[int]]


@dataclass
class Candidates:
    row: np.ndarray
    vec_id: np.ndarray      # _NO_ID: null
    label: np.ndarray
    points: np.ndarray


class Slot:
    """The k best candidates of one window: higher score first, then smaller id."""

    def __init__(self, low: int, high: int, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.score = self.vec_id = self.row = np.empty(0, dtype=np.int64)

    def add(self, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        inside = (score >= self.low) & (score <= self.high)
        score, vec_id, row = (np.concatenate([old, new[inside]]) for old, new in (
            (self.score, score), (self.vec_id, vec_id), (self.row, row)))
        best = np.lexsort((row, vec_id, -score))[:self.k]
        self.score, self.vec_id, self.row = score[best], vec_id[best], row[best]
        if len(best) == self.k:
            self.low = max(self.low, int(self.score[-1]))


def mine(anchors: Anchors, found: Candidates, k: int, same: bool) -> tuple[list[list[Slot]], int]:
    """The slots of every anchor, filled from candidates of the same or of another label, and how
    many products that took."""
    slots = [[Slot(lo, hi, k) for lo, hi in zip(*ends, strict=True)]
             for ends in zip(anchors.low, anchors.high, strict=True)]
    children: list[list[int]] = [[] for _ in anchors.row]
    roots = []
    for i, p in enumerate(anchors.parent):
        (children[p] if p >= 0 else roots).append(i)
    norm = norms(found.points)
    nothing = np.zeros(len(norm))
    stack = [(i, nothing, nothing) for i in roots]
    scored = 0
    with np.errstate(over="ignore", invalid="ignore"):
        while stack:
            i, middle, reach = stack.pop()
            reach = reach + anchors.edge[i] * norm * (1 + 1e-9)
            asked = [s for s in slots[i] if s.low <= s.high]
            if asked:
                slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
                low, high = min(s.low for s in asked), max(s.high for s in asked)
                # what is not a number, from components beyond all bounds, is scored
                out = (middle + reach + slack < low) | (middle - reach - slack > high)
                fits = (found.label == anchors.label[i]) == same
                near = np.flatnonzero(fits & ~out & (found.row != anchors.row[i]))
                score = products(anchors.points[i:i + 1], found.points[near])[0]
                scored += len(near)
                for slot in asked:
                    slot.add(score, found.vec_id[near], found.row[near])
                if children[i]:
                    middle, reach = middle.copy(), reach.copy()
                    middle[near], reach[near] = score, 0.0
            stack += [(c, middle, reach) for c in children[i]]
    return slots, scored


# Over Spark -------------------------------------------------------------------------------


def _to_cells(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), dtype=np.int32)
            for dim in np.unique(dims):
                mine_ = np.flatnonzero(dims == dim)
                if int(dim) in centres and dim:
                    cell[mine_] = nearest(
                        matrix(batch.column("vector").take(pa.array(mine_)), int(dim)), centres[int(dim)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])
    return run


def _to_tree(key: tuple, block: pa.Table) -> pa.Table:
    block = block.sort_by("row")
    parent, edge = spanning_tree(matrix(block.column("vector"), key[0].as_py()))
    place = pa.array(np.arange(block.num_rows))
    return block.append_column("place", place).append_column(
        "parent", pa.array(parent)).append_column("edge", pa.array(edge))


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy()


def _meet(k: int, same: bool):
    schema = pa.schema([("anchor_row", pa.int64()), ("anchor_id", pa.int64()), ("slot", pa.int32()),
                        ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        dim = key[0].as_py()
        asked = asked.sort_by("place")
        anchors = Anchors(
            asked.column("row").to_numpy(), asked.column("label").to_numpy(),
            matrix(asked.column("vector"), dim), asked.column("parent").to_numpy(),
            asked.column("edge").to_numpy(), asked.column("low").to_pylist(), asked.column("high").to_pylist())
        slots, _ = mine(anchors, Candidates(
            held.column("row").to_numpy(), _ids(held.column("vec_id")), held.column("label").to_numpy(),
            matrix(held.column("vector"), dim)), k, same)
        out = [(i, j, s) for i, own in enumerate(slots) for j, s in enumerate(own) if len(s.row)]
        if not out:
            return schema.empty_table()
        size = [len(s.row) for *_, s in out]
        place = np.repeat([i for i, *_ in out], size)
        vec_id = np.concatenate([s.vec_id for *_, s in out])
        return pa.table([
            pa.array(anchors.row[place]), asked.column("vec_id").take(pa.array(place)).combine_chunks(),
            pa.array(np.repeat(np.array([j for _, j, _ in out], dtype=np.int32), size)),
            pa.array(np.concatenate([s.row for *_, s in out])), pa.array(vec_id, mask=vec_id == _NO_ID),
            pa.array(np.concatenate([s.score for *_, s in out]))], schema=schema)
    return run


def _by_dim(values: dict[int, int]) -> Column:
    if not values:
        return F.lit(None).cast("int")
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("dim"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "slot").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(anchors: DataFrame, per_block: int) -> tuple[DataFrame, dict[int, int]]:
    """The anchors with their place in a tree, and how many blocks there are of each length."""
    counts = {r["dim"]: r["count"] for r in anchors.groupBy("dim").count().collect()}
    share = min(1.0, SAMPLE / max(1, sum(counts.values())))
    picked: dict[int, list[bytes]] = {}
    for r in anchors.filter(F.pmod(F.xxhash64("row", F.lit("centre")), F.lit(1 << 30))
                            < int(share * (1 << 30))).collect():  # about SAMPLE rows
        picked.setdefault(r["dim"], []).append(bytes(r["vector"]))
    centres = {dim: spread_out(np.frombuffer(b"".join(sorted(v)), dtype="<f8").reshape(-1, dim),
                               -(-counts[dim] // per_block)) for dim, v in picked.items() if dim}
    placed = stored(anchors.mapInArrow(_to_cells(centres), _ROW + ", cell int"), "negatives-cells")
    n_blocks: dict[int, int] = {}
    first, pieces = [], []
    for r in placed.groupBy("dim", "cell").count().collect():  # one row per centre
        n = -(-r["count"] // per_block)
        key = F.lit(f"{r['dim']}:{r['cell']}")
        first += [key, F.lit(n_blocks.get(r["dim"], 0))]
        pieces += [key, F.lit(n)]
        n_blocks[r["dim"]] = n_blocks.get(r["dim"], 0) + n
    if not n_blocks:
        first = pieces = [F.lit(""), F.lit(1)]
    key = F.concat_ws(":", "dim", "cell")
    block = F.create_map(*first)[key] + F.pmod(F.xxhash64("row"), F.create_map(*pieces)[key]).cast("int")
    trees = placed.withColumn("block", block).groupBy("dim", "block").applyInArrow(
        _to_tree, _ROW + ", cell int, block int, place long, parent long, edge double")
    return stored(trees.drop("cell"), "negatives-trees"), n_blocks


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, per_block: int = PER_BLOCK, per_part: int = PER_PART,
                   first: int = FIRST) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Anchors are the rows whose vec_id `every` divides; positives an anchor's best other rows of
    its label; negatives the best rows of another label that score from 0.3 to 0.9 times as much
    as the positive. A component x counts as floor(256 x); where 7 divides vec_id the label is
    (label + 1) % 10. Scores are exact integers (beyond +-(2^63 - 16): that).

    Rows with a null label, a null vector, or a null or non-finite component take no part. A null
    vec_id is no anchor's and comes last among ties. Rows that repeat a vec_id all take part, an
    anchor's repetitions among its others. Vectors are compared with those of their length, empty
    ones too (all scores are 0). An empty table, or one without anchors, gives no rows; other
    columns are not read.
    """
    label = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").filter(
        "label is not null").select(
        F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), "embedding")
    rows = stored(rows.mapInArrow(cleaned(["row", "vec_id", "label"]), _ROW), "negatives-rows")
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # per length
    trees, n_blocks = _blocks(rows.filter(F.col("vec_id") % every == 0), per_block)

    def searched(windows: DataFrame, share: int, k: int, same: bool, name: str) -> DataFrame:
        """`windows`: row, low, high (arrays). Anchors without one stay, as links of the tree."""
        part = _by_dim({dim: max(1, -(-n // (share * per_part))) for dim, n in counts.items()})
        blocks = _by_dim(n_blocks)
        held = rows if share == 1 else rows.filter(F.pmod(F.xxhash64("row", F.lit("first")), F.lit(share)) == 0)
        held = held.withColumn("part", F.pmod(F.xxhash64("row"), part).cast("int")).filter(
            blocks.isNotNull()).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        none = F.array().cast("array<long>")
        asked = trees.join(windows.withColumnRenamed("row", "own"), F.col("row") == F.col("own"), "left").withColumns({
            "low": F.coalesce("low", none), "high": F.coalesce("high", none)}).drop("own").withColumn(
            "part", F.explode(F.sequence(F.lit(0), part - 1)))
        keys = ("dim", "block", "part")
        return stored(asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
            _meet(k, same), _FOUND), name)

    def raised(windows: DataFrame, found: DataFrame, k: int) -> DataFrame:
        """Windows whose lower end is the k-th score found so far."""
        floor = _best(found, k).filter(F.col("rank") == k).groupBy("anchor_row").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floor"))
        return windows.join(floor, F.col("row") == F.col("anchor_row"), "left").select(
            "row", F.transform("low", lambda x, i: F.greatest(x, F.try_element_at("floor", i))).alias("low"), "high")

    def best(windows: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        near = searched(windows, first, k, same, f"{name}-first")
        return _best(searched(raised(windows, near, k), 1, k, same, f"{name}-all"), k)

    whole = trees.select("row", F.array(F.lit(-LARGEST)).alias("low"), F.array(F.lit(LARGEST)).alias("high"))
    partner = stored(best(whole, positives, True, "positives").select(
        "anchor_row", "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # s >= 3 p / 10 and s <= 9 p / 10 in whole numbers, p = 10 tens + ones
    tens, ones = F.expr("(s.p - pmod(s.p, 10)) div 10"), F.expr("pmod(s.p, 10)")
    windows = partner.groupBy(F.col("anchor_row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("slot", F.col("positive_score").alias("p")))).alias("all")).select(
        "row", F.explode("all").alias("s")).select(
        "row", "s.slot", (3 * tens + F.expr("(3 * pmod(s.p, 10) + 9) div 10")).alias("lo"),
        (9 * tens + F.floor(9 * ones / 10)).cast("long").alias("hi"))
    windows = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("slot", "lo", "hi"))).alias("w")).select(
        "row", F.col("w.lo").alias("low"), F.col("w.hi").alias("high"))
    negative = best(stored(windows, "negatives-windows"), negatives, False, "negatives").select(
        "anchor_row", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return partner.join(negative, ["anchor_row", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


NEGATIVES_SQL = """
with ints as (
    select row_number() over () as rowno, vec_id,
           case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::double)::hugeint for x in embedding] as v
    from embeddings
    where label is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select a.rowno as anchor_row, a.vec_id as anchor_id, r.rowno, r.vec_id, a.label = r.label as same,
           coalesce(list_sum([x * r.v[i] for x, i in a.v]), 0)::bigint as score
    from ints a join ints r on a.rowno <> r.rowno and len(a.v) = len(r.v)
    where a.vec_id % 100 = 0
), positives as (
    select anchor_row, anchor_id, vec_id as positive_id, score as positive_score,
           row_number() over (partition by anchor_row order by score desc, vec_id nulls last, rowno) as place
    from scored where same
    qualify place <= 5
), ranked as (
    select p.anchor_id, p.positive_id, p.positive_score, n.vec_id as negative_id, n.score as negative_score,
           row_number() over (partition by p.anchor_row, p.place
                              order by n.score desc, n.vec_id nulls last, n.rowno) as rank
    from positives p join scored n on n.anchor_row = p.anchor_row and not n.same
     and 30 * p.positive_score::hugeint <= 100 * n.score::hugeint
     and 100 * n.score::hugeint <= 90 * p.positive_score::hugeint
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""
