"""Vectors of integers: cleaning, packing, exact inner products, centres from a sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCALE = 256
LARGEST = (1 << 63) - 16   # scores beyond a long are held here
_DOUBLE = np.finfo(np.float64).max


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 x), x as double. Whole numbers in double precision, so nothing is rounded."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(SCALE * values.astype(np.float64), -_DOUBLE, _DOUBLE))


def cleaned(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`columns`, then `dim` and `vector` (packed doubles) of the rows whose `embedding` is not
    null and has neither null nor non-finite components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            at = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
            wrong = np.zeros(len(values) + 1, dtype=np.int64)
            np.cumsum(~np.isfinite(values), out=wrong[1:])
            good = pc.and_(lists.is_valid(), pa.array(wrong[at[1:]] == wrong[at[:-1]]))
            whole = quantised(np.where(np.isfinite(values), values, 0.0)).astype("<f8")
            packed = pa.Array.from_buffers(
                pa.large_binary(), len(lists), [None, pa.py_buffer(8 * at), pa.py_buffer(whole)])
            out = [batch.column(c) for c in columns]
            out += [pa.array(np.diff(at).astype(np.int32)), packed.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(out, [*columns, "dim", "vector"]).filter(good)
    return run


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), dim)


def norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((x**2).sum(axis=1))


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max()) if x.size else 0.0


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `a` with all of `b` as longs, exact whatever their size:
    double precision where no partial sum passes 2^53, longs up to 2^62, then Python's integers."""
    with np.errstate(over="ignore"):
        bound = _largest(a) * _largest(b) * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if bound < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    return np.clip(_integers(a) @ _integers(b).T, -LARGEST, LARGEST).astype(np.int64)


def spread_out(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the vectors, each the furthest from those before."""
    chosen = [0]
    with np.errstate(over="ignore", invalid="ignore"):
        away = ((vectors - vectors[0]) ** 2).sum(axis=1)
        while len(chosen) < min(n, len(vectors)) and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1).astype(np.int32)
