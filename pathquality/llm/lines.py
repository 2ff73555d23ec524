"""Line dedup by pairwise alignment.

Documents that overlap are found through shared keys, each of which points to the earliest
document that has it, so there are never all pairs. Keys are every line (and its n-th repetition
within a document), every run of lines just long enough to be a passage, and the whole of a
document that is shorter. Of the documents a later one points to, those by a line that at most
RARE documents have, by a passage and the one most of its words point to are its candidates. It
is aligned with the whole of each: as in patience diff, lines unique in both are anchors, the
longest run of anchors in the order of both is the alignment, and equal lines next to aligned
ones join it. Aligned lines that are neighbours in both documents form a block.

Two documents are partners if a block is a passage, that is has at least COMMON words, or if the
alignment holds LARGE of the words of the later document. All blocks of partners are deleted from
the later one (those under MIN_WORDS words only in the last case). How many documents have a block
plays no part, so a passage goes however many copies there are, and a slogan that documents end
with stays where they share nothing else.

A document and the documents it is aligned with travel apart: its lines are sent once for every
PER_BLOCK partners, and the partners' lines stream past them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, put_back, set_aside, signed, stored, strings, text_key

RARE = 20
COMMON = 10
MIN_WORDS = 3     # of a block of partners
LARGE = 0.8       # share of the later document's words
PER_BLOCK = 1000  # partners of a document in one task


def line_list(text: bytes) -> list[tuple[int, int, int]]:
    """(place among all lines, hash, words) of the lines that are not blank, trimmed."""
    out = []
    for place, line in enumerate(text.split(b"\n")):
        line = line.strip()
        if line:
            out.append((place, xxhash.xxh64_intdigest(line), len(line.split())))
    return out


def counted(hashes: list[int]) -> list[tuple[int, int]]:
    """Each with how often it came before."""
    seen, out = Counter(), []
    for h in hashes:
        out.append((h, seen[h]))
        seen[h] += 1
    return out


def keys(hashes: list[int], words: list[int], common: int = COMMON) -> list[tuple[int, int, bool]]:
    """(key, number of its first line, is it a run) of lines, runs and short wholes."""
    packed = np.array(hashes, dtype="<u8").tobytes()
    digest = xxhash.xxh64_intdigest
    out = [(digest(packed[8 * i:8 * i + 8], n), i, False) for i, (_, n) in enumerate(counted(hashes))]
    stop = held = 0
    for i, w in enumerate(words):
        while stop < len(words) and held < common:
            held += words[stop]
            stop += 1
        if held < common and i:
            break
        if stop > i + 1:
            out.append((digest(packed[8 * i:8 * stop], 2**63 + (held < common)), i, True))
        held -= w
    return out


def longest_run(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    ends: list[int] = []
    before = []
    for i, p in enumerate(places):
        pile = bisect_left(tops, p)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(p)
            ends.append(i)
        else:
            tops[pile], ends[pile] = p, i
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


class Later:
    """A document that others are aligned with, one after the other."""

    def __init__(self, hashes: list[int], words: list[int]) -> None:
        self.hashes, self.words, self.total = hashes, words, sum(words)
        self.at = {k: i for i, k in enumerate(counted(hashes))}

    def align(self, earlier: list[int]) -> list[tuple[int, int]]:
        """Pairs of line numbers, increasing in both. Costs what the earlier document is long."""
        later = self.hashes
        anchors = sorted((self.at[k], j) for j, k in enumerate(counted(earlier)) if k in self.at)
        anchors = [anchors[a] for a in longest_run([j for _, j in anchors])]
        out, low = [], (-1, -1)
        for n, (i, j) in enumerate(anchors):
            before = []
            a, b = i - 1, j - 1
            while a > low[0] and b > low[1] and later[a] == earlier[b]:
                before.append((a, b))
                a, b = a - 1, b - 1
            out += [*reversed(before), (i, j)]
            top = anchors[n + 1] if n + 1 < len(anchors) else (len(later), len(earlier))
            low = (i, j)
            a, b = i + 1, j + 1
            while a < top[0] and b < top[1] and later[a] == earlier[b]:
                out.append((a, b))
                low = (a, b)
                a, b = a + 1, b + 1
        return out

    def deletions(self, earlier: list[int], common: int = COMMON, min_words: int = MIN_WORDS,
                  large: float = LARGE) -> list[int]:
        """Numbers of the lines that go because the earlier document has them."""
        blocks: list[list[int]] = []
        before = None
        for i, j in self.align(earlier):
            if before != (i - 1, j - 1):
                blocks.append([])
            blocks[-1].append(i)
            before = (i, j)
        held = [sum(self.words[i] for i in b) for b in blocks]
        most = bool(blocks) and sum(held) >= large * self.total
        if not most and max(held, default=0) < common:
            return []
        return [i for b, w in zip(blocks, held, strict=True) if most or w >= min_words for i in b]


_LISTS = "doc_id long, row_key long, hashes binary, words binary, places binary"
_KEYS = "doc_id long, row_key long, key long, at int, run boolean"


def _line_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [line_list(t) for t in strings(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"),
             *(pa.array([np.array([x[c] for x in f], dtype=t).tobytes() for f in found], pa.binary())
               for c, t in ((1, "<u8"), (2, "<i4"), (0, "<i4")))],
            ["doc_id", "row_key", "hashes", "words", "places"])


def _unpack(packed: bytes, kind: str) -> list[int]:
    return np.frombuffer(packed, dtype=kind).tolist()


def _keys(common: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [keys(_unpack(h, "<u8"), _unpack(w, "<i4"), common) for h, w in zip(
                batch.column("hashes").to_pylist(), batch.column("words").to_pylist(), strict=True)]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("row_key").take(take),
                 pa.array(signed(np.array([k for f in found for k, _, _ in f], dtype=np.uint64))),
                 pa.array([i for f in found for _, i, _ in f], pa.int32()),
                 pa.array([r for f in found for _, _, r in f], pa.bool_())],
                ["doc_id", "row_key", "key", "at", "run"])
    return run


_STREAM = "doc_id long, row_key long, block int, other long, other_key long, hashes binary, words binary, places binary"
_NAMES = [c.split()[0] for c in _STREAM.split(", ")]


def _candidates(common: int, per_block: int):
    """From the links of a document to the documents it is to be aligned with: a row for each,
    and for every `per_block` of them a row without `other` that holds the document's lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, block, other, other_key, n_blocks = [], [], [], [], []
            for row, (found, words) in enumerate(zip(
                    batch.column("found").to_pylist(), batch.column("words").to_pylist(), strict=True)):
                words = _unpack(words, "<i4")
                weight: dict[tuple, int] = defaultdict(int)
                wanted = set()
                for x in found:
                    to = x["other"], x["other_key"]
                    if x["run"] or x["rare"] or words[x["at"]] >= common:
                        wanted.add(to)
                    if not x["run"]:
                        weight[to] += words[x["at"]]
                if weight:
                    wanted.add(min(weight, key=lambda to: (-weight[to], to)))
                for n, to in enumerate(sorted(wanted)):
                    take.append(row)
                    block.append(n // per_block)
                    other.append(to[0])
                    other_key.append(to[1])
                n_blocks.append(-(-len(wanted) // per_block))
            at = pa.array(take, pa.int32())
            none = pa.nulls(len(take), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("row_key").take(at), pa.array(block, pa.int32()),
                 pa.array(other, pa.int64()), pa.array(other_key, pa.int64()), none, none, none], _NAMES)
            for n in range(max(n_blocks, default=0)):  # a batch for each, so that none grows with partners
                heads = batch.take(pa.array([row for row, m in enumerate(n_blocks) if m > n], pa.int32()))
                nobody = pa.nulls(heads.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [heads.column("doc_id"), heads.column("row_key"),
                     pa.array(np.full(heads.num_rows, n, np.int32)), nobody, nobody,
                     *(heads.column(c) for c in ("hashes", "words", "places"))], _NAMES)
    return run


def _choose(common: int, min_words: int):
    """Reads a document's lines, then those of its partners; one row for each block of partners."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, later, places, gone = None, None, [], set()

        def rows(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([d for (d, _), _ in done], pa.int64()), pa.array([k for (_, k), _ in done], pa.int64()),
                 pa.array([g for _, g in done], pa.list_(pa.int32()))], ["doc_id", "row_key", "gone"])

        for batch in batches:
            done = []
            columns = [batch.column(c) for c in ("doc_id", "row_key", "other", "hashes", "words", "places")]
            for i in range(batch.num_rows):
                doc_id, row_key, other, hashes, words, at = (c[i].as_py() for c in columns)
                if other is None:
                    if gone:
                        done.append((owner, sorted(gone)))
                    owner, gone = (doc_id, row_key), set()
                    later, places = Later(_unpack(hashes, "<u8"), _unpack(words, "<i4")), _unpack(at, "<i4")
                    continue
                gone.update(places[n] for n in later.deletions(_unpack(hashes, "<u8"), common, min_words))
            if done:
                yield rows(done)
        if gone:
            yield rows([(owner, sorted(gone))])
    return run


def overlaps(docs: DataFrame, rare: int = RARE, common: int = COMMON, min_words: int = MIN_WORDS,
             per_block: int = PER_BLOCK) -> DataFrame:
    """`doc_id`, `row_key`, `gone`: the places (from 0) of the lines to delete."""
    texts = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), text_key().alias("row_key"), "text")
    # a row that repeats has the same lines
    lists = stored(texts.mapInArrow(_line_lists, _LISTS).dropDuplicates(["doc_id", "row_key"]), "line-lists")
    found = stored(lists.mapInArrow(_keys(common), _KEYS), "line-keys")
    # written, so that both sides of the join are plain exchanges, which Spark splits if skewed
    first = stored(found.groupBy("key").agg(
        F.min(F.struct("doc_id", "row_key")).alias("first"),
        F.max("doc_id").alias("latest"), F.count(F.lit(1)).alias("n_docs"),
    ).filter("latest > first.doc_id").select(
        "key", F.col("first.doc_id").alias("other"), F.col("first.row_key").alias("other_key"),
        (F.col("n_docs") <= rare).alias("rare")), "line-owners")
    links = found.join(first, "key").filter("doc_id > other").groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("other", "other_key", "at", "run", "rare")).alias("found"))
    asked = stored(links.join(lists, ["doc_id", "row_key"]).mapInArrow(
        _candidates(common, per_block), _STREAM), "line-pairs")
    earlier = lists.select(F.col("doc_id").alias("other"), F.col("row_key").alias("other_key"), "hashes")
    pairs = asked.filter("other is not null").select("doc_id", "row_key", "block", "other", "other_key").join(
        earlier, ["other", "other_key"])
    empty = F.lit(None).cast("binary")
    stream = asked.filter("other is null").unionByName(
        pairs.withColumns({"words": empty, "places": empty}))
    block = ("doc_id", "row_key", "block")
    gone = stream.repartition(partitions(docs.sparkSession), *block).sortWithinPartitions(
        *block, F.col("other").asc_nulls_first(), "other_key").select(*_NAMES).mapInArrow(
        _choose(common, min_words), "doc_id long, row_key long, gone array<int>")
    return gone.groupBy("doc_id", "row_key").agg(
        F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_lines, n_removed = [], [], []
        gone = batch.column("gone").to_pylist()
        for text, out in zip(batch.column("text").to_pylist(), gone, strict=True):
            lines = (text or "").split("\n") if text else []
            n_lines.append(len(lines))
            n_removed.append(len(out or ()))
            if out:
                dead = set(out)
                text = "\n".join(x for i, x in enumerate(lines) if i not in dead)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c not in ("text", "gone")),
             pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
            [*(c for c in batch.schema.names if c not in ("text", "gone")), "text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, rare: int = RARE, common: int = COMMON,
               min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with `text` less the blocks that an earlier partner has, and `n_lines` (before)
    and `n_removed`; columns of these names are replaced.

    Earlier is the smaller doc_id. Null texts stay null; rows with doc_id null keep their text
    and take nothing from others; rows that repeat a doc_id do not take from each other. Lines
    that differ in white space at their ends are the same; blank lines are never deleted. An
    empty table stays empty.
    """
    docs = docs.drop("n_lines", "n_removed")
    held = set_aside(docs, "doc_id", "text").withColumn("row_key", text_key())
    gone = overlaps(held, rare, common, min_words).select(
        F.col("doc_id").alias("later"), F.col("row_key").alias("later_key"), "gone")
    joined = held.join(
        gone, (F.col("doc_id") == F.col("later")) & (F.col("row_key") == F.col("later_key")), "left")
    narrow = joined.select("doc_id", "rest", "text", "gone")
    schema = narrow.drop("gone").schema.add("n_lines", "long").add("n_removed", "long")
    return put_back(narrow.mapInArrow(_delete, schema), docs, "doc_id", "text", new=("n_lines", "n_removed"))
