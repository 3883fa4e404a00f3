"""Exact truncated SVD by block Lanczos with thick restarts (M2, M6, M7: the check of the randomised fit, or its replacement).

The iteration runs on ``A = X X'`` through the same distributed products as the randomised fit; X is never formed. A basis W of
document vectors grows by blocks: the newest block Q is multiplied (``X (X' Q)``), made orthogonal to W, twice, and
to itself. Of the basis only the small matrices ``W' A W`` and the coupling to the next block are on the driver. Their
eigenvectors give the Ritz vectors, and the coupling gives each one's residual without another product. When the basis is
``widest`` columns wide it is cut back to the best Ritz vectors (a thick restart), until the first ``k`` have residuals under the
tolerance or the basis spans the whole space.

Each block is checkpointed to ``spark.checkpoint.dir``: a lost executor costs one block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import lsa as L
from lodestar.session import materialize

OVERSAMPLE = 10
# Residual of a singular triplet, as a share of the largest singular value.
TOLERANCE = 1e-8
MAX_STEPS = 200


@dataclass
class ExactSvd:
    model: L.LsaModel  # sigma, components (V), doc_vectors (U sigma)
    residuals: np.ndarray  # of each triplet: |X' X v - sigma^2 v| / sigma, that is |X v - sigma u| for u = X v / sigma refined once
    steps: int


def _orthonormal(g: np.ndarray, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """``(M, S)``: Z M has orthonormal columns and Z = (Z M) S, from the Gram matrix of Z.

    Directions that are rounding of the others, or shorter than ``least``, are left out."""
    lam, e = np.linalg.eigh((g + g.T) / 2)
    order = np.argsort(lam)[::-1]
    lam, e = lam[order], e[:, order]
    keep = lam > max(1e-14 * lam[0] if lam.size else 0.0, least**2, 1e-300)
    root = np.sqrt(lam[keep])
    return e[:, keep] / root, (e[:, keep] * root).T


def _append(W: DataFrame, Z: DataFrame) -> DataFrame:
    """Row vectors side by side; documents that Z does not have are zero there, and the other way round."""
    return W.join(Z.withColumnRenamed("vec", "_z"), "doc_id", "full").select("doc_id", "vec", "_z")


def _joined(W: DataFrame, Z: DataFrame, w: int, z: int) -> DataFrame:
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    both = _append(W, Z)
    return both.select("doc_id", F.concat(F.coalesce("vec", zeros(w)), F.coalesce("_z", zeros(z))).alias("vec"))


def fit_exact(X: DataFrame, k: int, tolerance: float = TOLERANCE, oversample: int = OVERSAMPLE, widest: int | None = None, seed: int = 0, max_steps: int = MAX_STEPS) -> ExactSvd:
    """The ``k`` largest singular triplets of X ``(doc_id, term, w)`` to the tolerance; fewer when X has lower rank.

    An empty X has none. ``widest`` bounds the basis (columns of a document's vector and of the driver's matrices).
    """
    X = L.blocks(X)
    b = k + oversample
    widest = widest or 4 * b
    start = materialize(L.x_times(X, L.test_matrix(X.packed, b, seed)), reliable=True)
    M, _ = _orthonormal(L.gram(start, b))
    W = materialize(L.times_small(start, "doc_id", M), reliable=True)
    M, _ = _orthonormal(L.gram(W, M.shape[1]))  # once more, for what rounding has left
    W = materialize(L.times_small(W, "doc_id", M), reliable=True)
    done, new = 0, M.shape[1]  # columns of W already multiplied, and those of the newest block
    H, R = np.zeros((0, 0)), np.zeros((new, 0))
    steps, lam, u, resid = 0, np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    while new and steps < max_steps:
        width = done + new
        take = np.vstack([np.zeros((done, new)), np.eye(new)])
        Z = L.x_times(X, L.xt_times(X, L.times_small(W, "doc_id", take)))
        both = materialize(_joined(W, Z, width, new), reliable=True)
        g = L.gram(both, width + new)
        C = np.linalg.solve(g[:width, :width], g[:width, width:])
        first = materialize(L.times_small(both, "doc_id", np.block([[np.eye(width), -C], [np.zeros((new, width)), np.eye(new)]])), reliable=True)
        g = L.gram(first, width + new)
        C2 = np.linalg.solve(g[:width, :width], g[:width, width:])
        rest = g[width:, width:] - C2.T @ g[:width, :width] @ C2
        M, S = _orthonormal(rest, least=1e-11 * np.linalg.norm(C, 2))
        W = materialize(L.times_small(first, "doc_id", np.block([[np.eye(width), -C2 @ M], [np.zeros((new, width)), M]])), reliable=True)
        C = C + C2
        H = np.block([[H, C[:done]], [R, C[done:]]])
        H = (H + H.T) / 2
        R = np.hstack([np.zeros((S.shape[0], done)), S])
        done, new, steps = width, S.shape[0], steps + 1
        lam, u = np.linalg.eigh(H)
        order = np.argsort(lam)[::-1]
        lam, u = np.clip(lam[order], 0.0, None), u[:, order]
        resid = np.linalg.norm(R @ u, axis=0) if new else np.zeros(done)
        top = min(k, done)
        if not new or (done >= k and lam.size and (resid[:top] <= tolerance * lam[0]).all()):
            break
        if done + new > widest:
            kept = min(b, done)
            W = materialize(L.times_small(W, "doc_id", np.block([[u[:, :kept], np.zeros((done, new))], [np.zeros((new, kept)), np.eye(new)]])), reliable=True)
            H, R, done = np.diag(lam[:kept]), R @ u[:, :kept], kept
            u = np.eye(kept)
    sigma = np.sqrt(lam[:k])
    keep = sigma > (sigma[0] if sigma.size else 0.0) * L.REL_TOL
    sigma, u = sigma[keep], u[:, : len(keep)][:, keep]
    pick = np.vstack([u, np.zeros((new, u.shape[1]))])
    U = materialize(L.times_small(W, "doc_id", pick), reliable=True)
    V = materialize(L.times_small(materialize(L.xt_times(X, U), reliable=True), "term", np.diag(1.0 / sigma)))
    docs = materialize(L.times_small(U, "doc_id", np.diag(sigma)))
    return ExactSvd(L.LsaModel(sigma, V, docs, len(sigma)), resid[: len(keep)][keep] / np.where(sigma > 0, sigma, 1.0), steps)


def residual_table(X: DataFrame, svd: ExactSvd) -> DataFrame:
    """``(rank, sigma, residual, orthogonality)``, measured anew from U, sigma and V: the norms of ``X v - sigma u`` and
    ``X' u - sigma v``, the larger one, and how far the vector is from unit length and right angles to the others."""
    m, k = svd.model, svd.model.k
    spark: SparkSession = X.sparkSession
    schema = "rank long, sigma double, residual double, orthogonality double"
    if not k:
        return spark.createDataFrame([], schema)
    X = L.blocks(X)
    over = np.diag(1.0 / m.sigma)
    u, v = L.times_small(m.doc_vectors, "doc_id", over), m.components
    xv = _joined(L.x_times(X, v), L.times_small(u, "doc_id", np.diag(m.sigma)), k, k)
    xu = L.xt_times(X, u).withColumnRenamed("term", "doc_id")
    xu = _joined(xu, L.times_small(v, "term", np.diag(m.sigma)).withColumnRenamed("term", "doc_id"), k, k)
    minus = np.vstack([np.eye(k), -np.eye(k)])
    gap = [np.sqrt(np.clip(np.diag(L.gram(L.times_small(t, "doc_id", minus), k)), 0, None)) for t in (xv, xu)]
    off = [np.abs(L.gram(t, k) - np.eye(k)).max(axis=0) for t in (u, v)]
    rows = pd.DataFrame({"rank": np.arange(1, k + 1), "sigma": m.sigma, "residual": np.maximum(*gap), "orthogonality": np.maximum(*off)})
    return spark.createDataFrame(rows, schema)
