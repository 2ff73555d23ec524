"""What the operators of this package share: reading, storing, row keys and packed words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathquality.session import stored, temporary  # noqa: F401  (for the operators)

# Batches handed to Python are bounded in bytes as well as in rows, so that a run of very
# long texts does not decide how much memory a worker needs.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

SPACE = b" \t\n\x0b\x0c\r"  # what bytes.split() splits at: \x20 and \x09-\x0D
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: str | Column = "text") -> Column:
    """Tells rows that share a doc_id apart: identical rows keep the same key and, as they are
    identical, the same result."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def set_aside(df: DataFrame, *used: str) -> DataFrame:
    """The columns an operator works with, and all others of the caller in one struct `rest`, so
    that their names clash with none of the operator's."""
    others = [F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns) if c not in used]
    return df.select(*used, F.struct(F.lit(0).alias("n"), *others).alias("rest"))


def put_back(df: DataFrame, like: DataFrame, *used: str, new: Iterable[str] = ()) -> DataFrame:
    """The columns of `like` from a table that `set_aside` made of it, then the new ones."""
    return df.select(*[
        F.col(c) if c in used else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(like.columns)], *new)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strings(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of every value; null is the empty text."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


# Packed words -----------------------------------------------------------------------------

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_LONG = 256


def byte_class(chars: bytes) -> np.ndarray:
    """A 256-entry mask: which bytes belong to a word, given those that do not."""
    mask = np.ones(256, dtype=bool)
    mask[list(chars)] = False
    return mask


BLANK_SEPARATED = byte_class(SPACE)


def mix(h: np.ndarray) -> np.ndarray:
    h = h * _A
    h ^= h >> np.uint64(32)
    h *= _B
    h ^= h >> np.uint64(29)
    return h


def word_spans(text: bytes, word: np.ndarray = BLANK_SEPARATED) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.zeros(len(text) + 2, dtype=np.int8)
    inside[1:-1] = word[np.frombuffer(text, dtype=np.uint8)]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, eight bytes at a time for all words at once."""
    lanes = np.lib.stride_tricks.sliding_window_view(
        np.frombuffer(text + b"\0" * 8, dtype=np.uint8), 8)
    length = ends - starts
    h = mix(length.astype(np.uint64) + np.uint64(1))
    live = np.flatnonzero(length <= _LONG)
    at = starts[live]
    while live.size:
        left = ends[live] - at
        lane = lanes[at].view("<u8").ravel() & _KEEP[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ lane)
        more = left > 8
        live, at = live[more], at[more] + 8
    for i in np.flatnonzero(length > _LONG):
        h[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]], 42)
    return h


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp: the hash of every `width` consecutive entries, from differences of one
    prefix sum of h[i] * base^i modulo 2^64, shifted back by the inverse power."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    prefix = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers(_BASE, len(h)), out=prefix[1:])
    return mix((prefix[width:] - prefix[:n]) * powers(_INVERSE, n))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
