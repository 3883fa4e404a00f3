"""Latent semantic analysis: truncated SVD of an uncentred TF-IDF matrix (M2, M3, M5-M7).

Randomized subspace iteration (Halko, Martinsson & Tropp 2011) kept distributed:

* the matrix X stays in long form ``(doc_id, term, w)``;
* the Gaussian test matrix is a pure function of (seed, term), generated where needed,
  so it is never built on the driver nor broadcast;
* ``X @ M`` and ``X.T @ M`` of a fit go by blocks of documents (``Blocks``): a vector is sent once to each block
  that has its term, and the entries are multiplied and added in numpy, a batch at a time. A single
  product (``transform``) is a join on term plus a vector sum per key with ``Summarizer.sum``;
* the fit of a large X (``sliced``) deals out columns: X is stored once by term, the vectors of terms are neither moved nor written;
* only r x r Gram matrices (r = k + oversampling) reach the driver, where they are
  eigendecomposed to orthonormalise the current basis. V (terms x k) stays a
  distributed table ``(term, vec)`` and U a table ``(doc_id, vec)``.

Directions whose singular value is below ``1e-6 * sigma_1`` are dropped, so a matrix of
rank below k yields fewer components instead of noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lodestar.llm.store import BATCH_BYTES, bounded_batches, drop_stored
from lodestar.operators import sliced
from lodestar.operators.sliced import gaussian_rows, vector_rows
from lodestar.session import materialize, shuffle_partitions

OVERSAMPLE = 10
PASSES = 5
REL_TOL = 1e-6
# Partial Gram matrices that the driver adds up itself.
GRAM_GROUPS = 32
# Documents whose vectors a task holds.
BLOCK_DOCS = 16_384


@dataclass
class LsaModel:
    sigma: np.ndarray  # (k,) singular values, largest first
    components: DataFrame  # term, vec array<double>  (rows of V, k long)
    doc_vectors: DataFrame  # doc_id, vec array<double> (U * sigma: the fitted documents projected)
    k: int


def test_matrix(X: DataFrame, width: int, seed: int) -> DataFrame:
    """Omega as ``(term, vec)`` over the distinct terms of X."""

    @F.pandas_udf("array<double>")
    def omega(h: pd.Series) -> pd.Series:
        rows = gaussian_rows(h.to_numpy().astype(np.int64).view(np.uint64), width, seed)
        return pd.Series(list(rows))

    terms = X.select("term").distinct()
    return terms.select("term", omega(F.xxhash64("term")).alias("vec"))


def _scaled(vec: Column, w: Column) -> Column:
    return array_to_vector(F.transform(vec, lambda v: v * w))


@dataclass
class Blocks:
    """X by blocks of documents: ``docs(doc_id, block, pos)`` and ``packed(block, term, at, w)``, a row for a term of a block with the
    places of its documents and its weights there. A task holds the vectors of one block's documents and reads its terms one batch
    after the other, so that a product moves one vector for each term of a block, not one for each entry of X."""

    docs: DataFrame
    packed: DataFrame
    n_docs: int
    n_terms: int
    n_blocks: int


def _cut(df: DataFrame) -> DataFrame:
    rows = materialize(df)
    out = materialize(rows, reliable=True)
    rows.unpersist()
    return out


def blocks(X: DataFrame, block_docs: int = BLOCK_DOCS) -> Blocks:
    X = materialize(X.select("doc_id", "term", F.col("w").cast("double").alias("w")))
    n_docs = X.select("doc_id").distinct().count()
    n = max(1, min(n_docs, max(shuffle_partitions(X.sparkSession), -(-n_docs // block_docs))))
    at = Window.partitionBy("block").orderBy("doc_id")
    placed = X.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")).withColumn("pos", F.dense_rank().over(at) - 1)
    placed = materialize(placed)
    docs = _cut(placed.select("doc_id", "block", "pos").distinct())
    packed = placed.where("term is not null").groupBy("block", "term").agg(F.collect_list(F.struct("pos", "w")).alias("e"))
    packed = _cut(packed.select("block", "term", F.col("e.pos").alias("at"), F.col("e.w").alias("w")))
    placed.unpersist()
    X.unpersist()
    return Blocks(docs, packed, n_docs, packed.select("term").distinct().count(), n)


def _vectors(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _entries(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, at, w)`` of a batch's entries, so many at a time that their products stay small."""
    n = batch.column("at").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    at, w = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("at", "w"))
    of = np.repeat(np.arange(len(n)), n)
    step = max(1, BATCH_BYTES // max(8, 8 * width))
    for lo in range(0, len(at), step):
        yield of[lo : lo + step], at[lo : lo + step], w[lo : lo + step]


def _add_by(out: np.ndarray, to: np.ndarray, rows: np.ndarray) -> None:
    """``out[to] += rows``, where ``to`` is sorted and may repeat."""
    if len(to):
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        out[to[first]] += np.add.reduceat(rows, first)


def x_times(X: DataFrame | Blocks, M: DataFrame) -> DataFrame:
    """``X @ M``: X ``(doc_id, term, w)``, M ``(term, vec)`` -> ``(doc_id, vec)``."""
    if isinstance(X, DataFrame):
        j = X.join(M, "term").select("doc_id", _scaled(F.col("vec"), F.col("w")).alias("v"))
        return j.groupBy("doc_id").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # one block, as a rule
        for whole in batches:
            for block, batch in _runs(whole, ["block"]):
                vec = _vectors(batch.column("vec"))
                acc, seen = sums.get(block, (np.zeros((0, vec.shape[1])), np.zeros(0, bool)))
                for of, at, w in _entries(batch, vec.shape[1]):
                    if (most := int(at.max()) + 1) > len(acc):
                        more = max(most, len(acc) * 5 // 4) - len(acc)
                        acc, seen = np.vstack([acc, np.zeros((more, vec.shape[1]))]), np.append(seen, np.zeros(more, bool))
                    order = np.argsort(at, kind="stable")
                    _add_by(acc, at[order], vec[of[order]] * w[order, None])
                    seen[at] = True
                sums[block] = acc, seen
        while sums:
            block, (acc, seen) = sums.popitem()
            pos = np.flatnonzero(seen)
            yield from vector_rows(["block", "pos", "vec"], [pa.array(np.full(len(pos), block), pa.int32()), pa.array(pos, pa.int32())], acc[pos])

    bounded_batches(M)
    met = X.packed.join(M.hint("merge"), "term").select("block", "at", "w", "vec")
    rows = met.repartitionById(X.n_blocks, F.col("block")).sortWithinPartitions("block").mapInArrow(run, "block int, pos int, vec array<double>")
    return rows.join(X.docs, ["block", "pos"]).select("doc_id", "vec")


def xt_times(X: DataFrame | Blocks, D: DataFrame) -> DataFrame:
    """``X.T @ D``: D ``(doc_id, vec)`` -> ``(term, vec)``."""
    if isinstance(X, DataFrame):
        j = X.join(D, "doc_id").select("term", _scaled(F.col("vec"), F.col("w")).alias("v"))
        return j.groupBy("term").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, has = None, np.zeros((0, 0)), np.zeros(0, bool)  # vectors of the block, which come before its terms
        for whole in batches:
            for (block, kind), batch in _runs(whole, ["block", "kind"]):
                if block != now:
                    now, held, has = block, np.zeros((0, 0)), np.zeros(0, bool)
                if kind == 0:
                    vec, pos = _vectors(batch.column("vec")), batch.column("pos").to_numpy()
                    if (most := int(pos.max()) + 1) > len(held):
                        more = max(most, len(held) * 5 // 4) - len(held)
                        held = np.vstack([held.reshape(len(held), vec.shape[1]), np.zeros((more, vec.shape[1]))])
                        has = np.append(has, np.zeros(more, bool))
                    held[pos], has[pos] = vec, True
                    continue
                out, any_ = np.zeros((batch.num_rows, held.shape[1])), np.zeros(batch.num_rows, bool)
                for of, at, w in _entries(batch, held.shape[1]):
                    there = at < len(has)
                    there[there] = has[at[there]]
                    of, at, w = of[there], at[there], w[there]
                    _add_by(out, of, held[at] * w[:, None])
                    any_[of] = True
                yield from vector_rows(["term", "vec"], [batch.column("term").filter(pa.array(any_))], out[any_])

    bounded_batches(D)
    vectors = D.join(X.docs, "doc_id").select("block", F.lit(0).alias("kind"), "pos", "vec")
    both = vectors.unionByName(X.packed.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    term = StructType([X.packed.schema["term"], *StructType.fromDDL("vec array<double>").fields])
    part = both.repartitionById(X.n_blocks, F.col("block")).sortWithinPartitions("block", "kind").mapInArrow(run, term)
    return part.repartition(shuffle_partitions(D.sparkSession), "term").sortWithinPartitions("term").mapInArrow(_sum_terms, term)


def _runs(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple]:
    """The parts of a sorted batch in which the integer columns ``by`` do not change, with their value (or values)."""
    keys = np.stack([batch.column(c).to_numpy() for c in by], axis=1)
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else np.zeros(0, int)
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        value = keys[lo].tolist()
        yield value[0] if len(by) == 1 else tuple(value), batch.slice(lo, hi - lo)


def _sum_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each term; rows come sorted by term. The last term of a batch may go on in the next."""
    last, rest = None, None
    for batch in batches:
        terms, vec = batch.column("term"), _vectors(batch.column("vec"))
        if not len(terms):
            continue
        if last is not None and last[0].equals(terms[0]):
            vec = np.vstack([vec[:1] + rest, vec[1:]])
        elif last is not None:
            yield from vector_rows(["term", "vec"], [last], rest[None])
        differs = pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.append(True, differs))
        sums = np.add.reduceat(vec, first)
        yield from vector_rows(["term", "vec"], [terms.take(pa.array(first[:-1]))], sums[:-1])
        last, rest = terms[len(terms) - 1 :], sums[-1]
    if last is not None:
        yield from vector_rows(["term", "vec"], [last], rest[None])


def _stack(vecs: pd.Series, width: int) -> np.ndarray:
    if len(vecs) == 0:
        return np.zeros((0, width))
    return np.stack([np.asarray(v, dtype=np.float64) for v in vecs])


def gram(D: DataFrame, width: int) -> np.ndarray:
    """``D.T @ D`` (width x width): one BLAS product per Arrow batch and one matrix per task.

    Few tasks' matrices are added on the driver; those of many are first added in ``GRAM_GROUPS`` groups on the executors, so
    what the driver gets is bounded."""
    if width == 0:
        return np.zeros((0, 0))

    def part(batches):
        acc = np.zeros((width, width))
        for pdf in batches:
            m = _stack(pdf["vec"], width)
            acc += m.T @ m
        yield pd.DataFrame({"g": [acc.ravel()]})

    bounded_batches(D)  # else a batch is 10,000 vectors, however wide
    return _summed(D.select("vec").mapInPandas(part, "g array<double>"), width, D.rdd.getNumPartitions())


def _summed(rows: DataFrame, width: int, tasks: int) -> np.ndarray:
    """The sum of matrices ``g``, one a task."""
    if tasks > GRAM_GROUPS:
        by = F.pmod(F.spark_partition_id(), F.lit(GRAM_GROUPS))
        rows = rows.groupBy(by).agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("g")))).alias("g"))
    out = np.zeros(width * width)
    for row in rows.select("g").collect():
        out += np.asarray(row["g"])
    return out.reshape(width, width)


def times_small(D: DataFrame, key: str, M: np.ndarray) -> DataFrame:
    """Each row vector times a small dense matrix M (width x width'), one BLAS call per batch."""
    width, out_w = M.shape
    if out_w == 0:
        return D.select(key, F.array().cast("array<double>").alias("vec"))
    bm = D.sparkSession.sparkContext.broadcast(M)
    bounded_batches(D)

    @F.pandas_udf("array<double>")
    def mul(vecs: pd.Series) -> pd.Series:
        return pd.Series(list(_stack(vecs, width) @ bm.value))

    return D.select(key, mul(F.col("vec")).alias("vec"))


def orthonormalise(D: DataFrame, key: str, width: int) -> tuple[DataFrame, int]:
    """Q with orthonormal columns spanning D, via the eigendecomposition of D.T D.

    D is checkpointed (eagerly, to the shared ``spark.checkpoint.dir``) so each iterate
    starts from a short plan: iterating on an ever-growing lineage would make planning
    quadratic, and a lost executor only costs the current iterate. Q is a projection of
    the checkpointed D by one r x r literal. Negligible directions are dropped.
    """
    D = materialize(D, reliable=True)
    g = gram(D, width)
    lam, w = np.linalg.eigh(g)
    order = np.argsort(lam)[::-1]
    lam, w = lam[order], w[:, order]
    keep = lam > (lam[0] if lam.size and lam[0] > 0 else 0.0) * 1e-12
    if not keep.any():
        return times_small(D, key, np.zeros((width, 0))), 0
    return times_small(D, key, w[:, keep] / np.sqrt(lam[keep])), int(keep.sum())


def fit(X: DataFrame | sliced.TermRows, k: int, oversample: int = OVERSAMPLE, passes: int = PASSES, seed: int = 0, components: bool = True) -> LsaModel:
    """M2: truncated SVD of X ``(doc_id, term, w)``, rank ``k`` (fewer when X has lower rank).

    A large X is given as ``sliced.by_terms`` stores it: its fit writes no vectors of terms, unless V is wanted (``components``)."""
    if isinstance(X, sliced.TermRows):
        return _fit_terms(X, k, oversample, passes, seed, components)
    X = blocks(X)
    r = k + oversample
    Q, width = orthonormalise(x_times(X, test_matrix(X.packed, r, seed)), "doc_id", r)
    n_docs, n_terms = X.n_docs, X.n_terms
    for _ in range(passes):
        if width >= n_docs or r >= n_terms:
            break  # Q already spans the column space of X: further passes cannot change it
        Z, zw = orthonormalise(xt_times(X, Q), "term", width)
        Q, width = orthonormalise(x_times(X, Z), "doc_id", zw)
    Bt = materialize(xt_times(X, Q), reliable=True)  # (term, vec) = (Q.T X).T
    g = gram(Bt, width)  # B B.T
    lam, w = np.linalg.eigh(g)
    order = np.argsort(lam)[::-1]
    lam, w = np.clip(lam[order], 0.0, None), w[:, order]
    sigma = np.sqrt(lam)
    keep = sigma > (sigma[0] if sigma.size else 0.0) * REL_TOL
    keep[k:] = False
    sigma, w = sigma[keep], w[:, keep]
    # both derive from checkpointed iterates by one small product: persisting is enough
    comps = materialize(times_small(Bt, "term", w / sigma))  # V = B.T U~ / sigma
    docs = materialize(times_small(Q, "doc_id", w * sigma))  # U sigma = Q U~ sigma
    return LsaModel(sigma, comps, docs, int(keep.sum()))


def _directions(g: np.ndarray) -> np.ndarray:
    """M such that D M has orthonormal columns spanning D, from ``g`` = D.T D. Negligible directions are dropped."""
    lam, w = np.linalg.eigh((g + g.T) / 2)
    order = np.argsort(lam)[::-1]
    lam, w = lam[order], w[:, order]
    keep = lam > (lam[0] if lam.size and lam[0] > 0 else 0.0) * 1e-12
    return w[:, keep] / np.sqrt(lam[keep])


def _fit_terms(X: sliced.TermRows, k: int, oversample: int, passes: int, seed: int, components: bool) -> LsaModel:
    """The same fit by ``sliced`` products. The basis is Q = Y M, Y being stored and M small. Iterates are written to the shared ``spark.checkpoint.dir``, so each starts
    from a short plan and a lost executor costs the current one; the one before is deleted. Without ``components`` V has no
    rows, and the stored X is deleted.
    """
    r = k + oversample
    Y = sliced.start(X, r, seed)
    M = _directions(_summed(sliced.squares(Y, np.eye(r)), r, Y.rdd.getNumPartitions()))
    for _ in range(passes):
        width = M.shape[1]
        if not width or width >= X.n_docs or r >= X.n_terms:
            break  # Q already spans the column space of X: further passes cannot change it
        last, Y = Y, sliced.step(X, Y, M)
        drop_stored(last)
        # Z = X.T Q is made orthonormal first, by Z.T Z = Q.T X X.T Q, then X Z
        Z = _directions(_summed(Y.select("g").where("g is not null"), width, X.n_tasks))
        M = Z @ _directions(_summed(sliced.squares(Y, Z), Z.shape[1], Y.rdd.getNumPartitions()))
    width = M.shape[1]
    if not width:
        none = F.array().cast("array<double>").alias("vec")
        return LsaModel(np.zeros(0), X.rows.where("whole").select(F.explode("terms").alias("term"), none), X.docs.select("doc_id", none), 0)
    g = _summed(sliced.inner(X, Y, M), width, X.n_tasks)  # B B.T, B = Q.T X
    lam, w = np.linalg.eigh((g + g.T) / 2)
    order = np.argsort(lam)[::-1]
    lam, w = np.clip(lam[order], 0.0, None), w[:, order]
    sigma = np.sqrt(lam)
    keep = sigma > (sigma[0] if sigma.size else 0.0) * REL_TOL
    keep[k:] = False
    sigma, w = sigma[keep], w[:, keep]
    # both derive from stored iterates by one small product: persisting is enough
    docs = materialize(sliced.of_docs(X, Y, M @ (w * sigma)))  # U sigma = Q U~ sigma
    if components:
        comps = materialize(sliced.of_terms(X, Y, M @ (w / sigma)))  # V = B.T U~ / sigma
    else:
        comps = X.rows.sparkSession.createDataFrame([], StructType([StructField("term", X.rows.schema["terms"].dataType.elementType), *StructType.fromDDL("vec array<double>").fields]))
        drop_stored(X.rows)
    return LsaModel(sigma, comps, docs, int(keep.sum()))


def transform(model: LsaModel, X: DataFrame) -> DataFrame:
    """M3: project rows ``(doc_id, term, w)`` onto the components: ``(doc_id, vec)``.

    Rows without any known term project to the zero vector (kept, as the reference does).
    """
    proj = x_times(X.select("doc_id", "term", F.col("w").cast("double").alias("w")), model.components)
    ids = X.select("doc_id").distinct()
    zero = F.array_repeat(F.lit(0.0), model.k)
    return ids.join(proj, "doc_id", "left").select("doc_id", F.coalesce("vec", zero).alias("vec"))


def spectrum(model: LsaModel, frobenius_sq: float) -> pd.DataFrame:
    """M7 helper: rank, sigma, share of the squared Frobenius norm."""
    s = model.sigma
    return pd.DataFrame({"rank": np.arange(1, len(s) + 1), "sigma": s, "energy": s**2 / frobenius_sq if frobenius_sq else 0.0})
