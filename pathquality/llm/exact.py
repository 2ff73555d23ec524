"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of a byte string is its value as a number in base 256 modulo a prime, so two
neighbouring chunks combine as H(A) * 256^|B| + H(B). Long texts are cut into chunks that any
task may hash; a chunk only has to know how many bytes follow it. Texts with equal fingerprint
and length are then compared chunk by chunk with one of them. Those that differ after all form
groups of their own and are compared again, until every group holds one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, strings, text_key

PRIME = (1 << 61) - 31  # 2 has a large order modulo this one, unlike modulo 2^61 - 1
CHUNK = 64 << 10
PER_SALT = 500

_WHOLE = "doc_id long, row_key long, n_bytes long, sha string, part decimal(20,0)"
_PART = "doc_id long, row_key long, n_bytes long, at int, part decimal(20,0)"


def fingerprint(chunk: bytes, after: int = 0, prime: int = PRIME) -> int:
    """What a chunk adds to the fingerprint of a text in which `after` bytes follow it."""
    return int.from_bytes(chunk, "big") * pow(256, after, prime) % prime


def _decimals(values: list[int]) -> pa.Array:
    return pa.array(values, pa.int64()).cast(pa.decimal128(20, 0))


def _hash_whole(prime: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, sha, part = [], [], []
            for text in strings(batch.column("text")):
                text = text.lower()  # bytes: A-Z only
                n_bytes.append(len(text))
                sha.append(hashlib.sha256(text).hexdigest())
                part.append(fingerprint(text, 0, prime))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(n_bytes, pa.int64()),
                 pa.array(sha, pa.string()), _decimals(part)],
                ["doc_id", "row_key", "n_bytes", "sha", "part"])
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = [hashlib.sha256(t.lower()).hexdigest() for t in strings(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(sha, pa.string())],
            ["doc_id", "row_key", "sha"])


def _hash_chunks(prime: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = batch.column("after").to_pylist()
            part = [fingerprint(c.lower(), a, prime)
                    for c, a in zip(strings(batch.column("chunk")), after, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), batch.column("n_bytes"),
                 batch.column("at"), _decimals(part)],
                ["doc_id", "row_key", "n_bytes", "at", "part"])
    return run


def _chunks(rows: DataFrame, size: int) -> DataFrame:
    """One row per chunk of the column `body`; an empty body has one empty chunk."""
    starts = F.sequence(F.lit(0), F.greatest(F.col("n_bytes") - 1, F.lit(0)).cast("int"), F.lit(size))
    return rows.withColumn("at", F.explode(starts)).withColumn(
        "chunk", F.substring(F.col("body"), F.col("at") + 1, F.lit(size)))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), text_key().alias("row_key"),
        F.coalesce("text", F.lit("")).alias("text"))


def fingerprints(docs: DataFrame, chunk: int = CHUNK, prime: int = PRIME) -> DataFrame:
    """`doc_id`, `row_key`, `n_bytes`, `sha`, `fp` of every text."""
    texts = _texts(docs)
    long = F.octet_length("text") > chunk
    whole = texts.filter(~long).mapInArrow(_hash_whole(prime), _WHOLE)
    large = texts.filter(long)
    bodies = large.select(
        "doc_id", "row_key", F.octet_length("text").cast("long").alias("n_bytes"),
        F.encode("text", "UTF-8").alias("body"))
    parts = (
        _chunks(bodies, chunk).drop("body")
        .withColumn("after", F.col("n_bytes") - F.col("at") - F.octet_length("chunk"))
        .repartition("doc_id", "row_key", "at")  # chunks of one text go to many tasks
        .select("doc_id", "row_key", "n_bytes", "at", "after", "chunk")
        .mapInArrow(_hash_chunks(prime), _PART)
        .groupBy(F.col("doc_id").alias("d"), F.col("row_key").alias("k"), "n_bytes")
        # a row that repeats brings all its chunks again
        .agg((F.sum("part") / F.count_if(F.col("at") == 0)).cast("decimal(38,0)").alias("part"))
    )
    digests = large.mapInArrow(_digest, "doc_id long, row_key long, sha string")
    joined = digests.join(
        parts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k"))
    ).select("doc_id", "row_key", "n_bytes", "sha", "part")
    return whole.unionByName(joined).withColumn(
        "fp", (F.col("part") % F.lit(prime)).cast("long")).drop("part")


def _differing(docs: DataFrame, rows: DataFrame, chunk: int) -> DataFrame:
    """The rows whose text differs from that of their group's representative. Both sides are
    cut into chunks; large groups are dealt over salts, the representative to each of them."""
    group = ("fp", "n_bytes", "variant")
    # written, so that both sides of the join are plain exchanges, which Spark splits if skewed
    groups = stored(rows.groupBy(*group).agg(
        F.max(F.struct("doc_id", "row_key")).alias("rep"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").withColumn("salts", F.ceil(F.col("n") / PER_SALT).cast("int")), "exact-groups")
    held = rows.select("doc_id", "row_key", *group).join(groups, list(group))
    is_rep = (F.col("doc_id").eqNullSafe(F.col("rep.doc_id"))
              & F.col("row_key").eqNullSafe(F.col("rep.row_key")))
    held = held.dropDuplicates(["doc_id", "row_key"]).withColumn("is_rep", is_rep).drop("rep", "n")
    texts = _texts(docs).select(
        F.col("doc_id").alias("d"), F.col("row_key").alias("k"),
        F.encode(F.translate("text", _UPPER, _UPPER.lower()), "UTF-8").alias("body"))
    chunks = _chunks(held.join(
        texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k"))), chunk)
    spread = F.pmod(F.xxhash64("doc_id", "row_key"), "salts").cast("int")
    members = chunks.filter("not is_rep").select(
        "doc_id", "row_key", *group, "at", "chunk", spread.alias("salt"))
    reps = chunks.filter("is_rep").select(
        *group, "at", F.col("chunk").alias("same"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    ).dropDuplicates([*group, "at", "salt"])  # the representative's row may repeat
    return members.join(reps, [*group, "at", "salt"], "left").filter(
        F.coalesce(F.col("chunk") != F.col("same"), F.lit(True))
    ).select("doc_id", "row_key").distinct()


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def exact_duplicates(docs: DataFrame, chunk: int = CHUNK, prime: int = PRIME) -> DataFrame:
    """One row per document: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal if they are after lower-casing A-Z; null counts as empty. Of equal texts
    the largest doc_id stays, and null is below all. Rows that repeat a doc_id as well count
    in `group_size` and share its `kept`. An empty table gives no rows, other columns of
    `docs` are not read.
    """
    rows = stored(fingerprints(docs, chunk, prime).withColumn("variant", F.lit(0)), "exact-rows")
    turn, checked = 0, rows
    while True:
        bad = stored(_differing(docs, checked, chunk), "exact-differing")
        if bad.isEmpty():
            break
        turn += 1
        marked = bad.withColumnsRenamed({"doc_id": "d", "row_key": "k"}).withColumn("bad", F.lit(True))
        rows = stored(rows.join(
            marked, rows.doc_id.eqNullSafe(F.col("d")) & (rows.row_key == F.col("k")), "left"
        ).withColumn("variant", F.when(F.col("bad"), F.lit(turn)).otherwise(F.col("variant"))
                     ).drop("d", "k", "bad"), "exact-rows")
        checked = rows.filter(F.col("variant") == turn)
    group = ["fp", "n_bytes", "variant"]
    groups = stored(rows.groupBy(*group).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    return rows.join(groups, group).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


EXACT_SQL = """
with normal as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') as body
    from documents
), grouped as (
    select doc_id, sha256(body) as text_sha256,
           max(doc_id) over (partition by body) as keep_id,
           count(*) over (partition by body) as group_size
    from normal
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from grouped
"""
