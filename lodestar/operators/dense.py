"""Dense-vector cosine top-k (J7, M4, K4) and vector helpers.

Exact brute force without materialising pairs: a query set within a measured bound is
broadcast and every Arrow batch of documents is scored with one matrix product in
numpy; each batch emits only its own top-k per query, and a window with a partial
``WindowGroupLimit`` merges those candidates. Larger query sets go through ``clustered``: blocks
of documents that each query reads or skips by the angle they span.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.clustered import ClusteredDocs, clustered_topk
from lodestar.session import bounded_rows, materialize

SCORE_DP = 6
QUERY_BLOCK_ROWS = 50_000
_QCHUNK = 1024


def centroids(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """Mean vector per key: ``(key, centroid array<double>)``.

    Averaged per (key, position) so a key holding a third of all rows is reduced by the
    partial aggregate; the per-key reassembly holds one value per dimension only.
    """
    cells = vectors.select(key, F.posexplode(vec).alias("pos", "x"))
    avg = cells.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return avg.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("centroid")
    )


def _unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(n > 0, m / np.where(n > 0, n, 1.0), 0.0)
    return out


def _block_top(qid: np.ndarray, qn: np.ndarray, pdf: pd.DataFrame, k: int):
    """Top-k documents of one batch for each query (unit rows ``qn``), queries in chunks."""
    pdf = pdf.sort_values("doc_id", kind="stable")
    ids = pdf["doc_id"].to_numpy(dtype=object)
    x = _unit_rows(np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vec"]]))
    kk = min(k, len(ids))
    for c0 in range(0, len(qid), _QCHUNK):
        s = np.round(x @ qn[c0:c0 + _QCHUNK].T, SCORE_DP)  # (rows, queries)
        # rows are in id order, so a stable sort gives ties to the smaller id
        best = np.argsort(-s, axis=0, kind="stable")[:kk]
        yield pd.DataFrame({
            "query_id": np.repeat(qid[c0:c0 + _QCHUNK], kk),
            "doc_id": ids[best.T.ravel()],
            "score": np.take_along_axis(s, best, axis=0).T.ravel(),
        })


def _matrix(vecs) -> np.ndarray:
    return _unit_rows(np.array([list(v) for v in vecs], dtype=np.float64))


def dense_cosine_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vec: str = "vec",
    doc_id: str = "doc_id",
    doc_vec: str = "vec",
    block_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, doc_id, rank, score)``: the k documents with the highest cosine per query.

    Zero vectors score 0. Scores are rounded before ranking; ties go to the smaller doc_id.
    """
    spark = docs.sparkSession
    q = materialize(queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("vec")))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_vec).alias("vec"))
    ids = f"query_id {q.schema['query_id'].dataType.simpleString()}, doc_id {d.schema['doc_id'].dataType.simpleString()}"
    schema = f"{ids}, score double"
    if bounded_rows(q, block_rows):
        rows = q.collect()  # one block, its size just measured
        sent = spark.sparkContext.broadcast((np.array([r["query_id"] for r in rows], dtype=object), _matrix([r["vec"] for r in rows]) if rows else None))

        def run(batches):
            qid, qn = sent.value
            for pdf in batches:
                if len(pdf) and len(qid):
                    yield from _block_top(qid, qn, pdf, k)

        cand = d.mapInPandas(run, schema)
    else:
        cand, _ = clustered_topk(q, ClusteredDocs(d), k)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (
        cand.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), "score")
    )
