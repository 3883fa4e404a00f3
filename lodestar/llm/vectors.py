"""Integer vectors of an embeddings table: exact scores and packed rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53
_TYPES = (b"h", "<i2"), (b"i", "<i4"), (b"d", "<f8")


def usable(vec: str) -> Column:
    """Has the row a vector without null components, all finite when scaled?"""
    whole = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)))
    return F.col(vec).isNotNull() & F.coalesce(whole, F.lit(False))


def vector_rows(rows: DataFrame, id_col: str, vec_col: str, **more: Column) -> DataFrame:
    """``(vec_id, dim, v, ...)`` of the rows that have an id and a usable vector; ``v`` is scaled, not yet rounded down."""
    kept = rows.where(F.col(id_col).isNotNull() & usable(vec_col))
    v = F.transform(vec_col, lambda x: x.cast("double") * SCALE)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.size(vec_col).alias("dim"), v.alias("v"), *(c.alias(k) for k, c in more.items()))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length of a batch with ``v``, and their vectors rounded down."""
    v = batch.column("v")
    if isinstance(v, pa.ChunkedArray):
        v = v.combine_chunks()
    flat = np.floor(v.flatten().to_numpy(zero_copy_only=False))
    sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield rows, flat[first[rows][:, None] + np.arange(dim)]


def pack(x: np.ndarray) -> bytes:
    """Whole numbers in the smallest of three types that holds them, after a letter that names it."""
    most = np.abs(x).max(initial=0)
    letter, kind = _TYPES[0 if most < 2**15 else 1 if most < 2**31 else 2]
    return letter + x.astype(kind).tobytes()


def unpack(data: bytes, dim: int, n: int) -> np.ndarray:
    kind = dict(_TYPES)[data[:1]]
    return np.frombuffer(data, kind, offset=1).astype(np.float64).reshape(n, dim)


def numbers(data: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(data, kind)


def dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows. Products that do not fit 64 bits are held at the ends of the range."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if np.sqrt((q * q).sum(1).max() * (x * x).sum(1).max()) < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(x).T, -(2**63), 2**63 - 1).astype(np.int64)


def first_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], ~scores[at]))[:k]]
