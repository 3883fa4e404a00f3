"""Vectoriser-style TF-IDF in long form.

``idf = ln((1 + n) / (1 + df)) + 1`` fitted on one corpus, raw term counts, rows
L2-normalised; terms outside the fitted vocabulary are ignored on transform. Long form
``(doc_id, term, weight)`` keeps everything a join / aggregate; no driver-side vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import NON_WORD
from lodestar.operators.index import term_frequency
from lodestar.session import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, _width, bounded_rows, materialize, shuffle_partitions

SCORE_DP = 6


@dataclass
class TfidfModel:
    idf: DataFrame  # term, df, idf  (the fitted vocabulary)
    n_docs: int
    stop_words: Sequence[str] | None
    counts: DataFrame | None = None  # doc_id, term, tf of the corpus, where they are kept

    def let_go(self) -> None:
        """Kept tables are dropped; what still has to be read of them is worked out again."""
        for df in (self.idf, self.counts):
            if df is not None:
                df.unpersist()


def counts(docs: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] | None) -> DataFrame:
    return term_frequency(docs, id_col, text_col, stop_words=stop_words, separators=NON_WORD, least=2)


def _idf_from_counts(tf: DataFrame, n: int) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", "df", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")
    )


def _common_df(idf: DataFrame, max_rows: int, max_bytes: int) -> int:
    """The least power of two such that the terms of so many documents or more are within the bounds; 1 if all terms are."""
    power = F.floor(F.log2("df")).cast("int").alias("p")
    sizes = idf.groupBy(power).agg(F.count(F.lit(1)).alias("n"), F.sum(_width(idf.select("term", "idf"))).alias("b")).collect()
    rows = size = 0
    for r in sorted(sizes, key=lambda r: -r["p"]):  # at most 64
        rows, size = rows + r["n"], size + r["b"]
        if rows > max_rows or size > max_bytes:
            return 2 ** (r["p"] + 1)
    return 1


def _weights(tf: DataFrame, idf: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """tf * idf, L2-normalised per document. The vocabulary is sent to the tasks as far as its measured size allows,
    commonest terms first, so that the per-document sum is a window over doc-partitioned counts (no extra exchange). Only
    the counts of the rarer terms, few for each of them, go to their term and back to their document."""
    idf = materialize(idf.select("term", "df", "idf"))
    common = _common_df(idf, max_rows, max_bytes)
    words = F.broadcast(idf.where(F.col("df") >= common).select("term", "idf"))
    raw = lambda d: d.select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("raw"))
    w = raw(tf.join(words, "term"))
    if common > 1:
        rare = tf.join(words, "term", "left_anti").join(idf.where(F.col("df") < common).select("term", "idf").hint("merge"), "term")
        w = w.unionByName(raw(rare).repartition(shuffle_partitions(tf.sparkSession), "doc_id"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", "tf", "raw", norm.alias("norm")).select("doc_id", "term", (F.col("raw") / F.col("norm")).alias("weight"), "tf", "norm")


def fit(docs: DataFrame, id_col: str = "id", text_col: str = "description", stop_words: Sequence[str] | None = None) -> TfidfModel:
    """M1 fit: document frequencies over ``docs``; smooth idf."""
    tf = counts(docs, id_col, text_col, stop_words)
    n = docs.count()
    return TfidfModel(materialize(_idf_from_counts(tf, n)), n, stop_words)


def fit_transform(
    docs: DataFrame, id_col: str = "id", text_col: str = "description", stop_words: Sequence[str] | None = None
) -> tuple[TfidfModel, DataFrame]:
    """Fit on ``docs`` and return their vectors from the same (persisted) counts: one tokenising pass."""
    tf = materialize(counts(docs, id_col, text_col, stop_words))
    n = docs.count()
    model = TfidfModel(materialize(_idf_from_counts(tf, n)), n, stop_words, tf)
    return model, _weights(tf, model.idf)


def transform(model: TfidfModel, docs: DataFrame, id_col: str = "id", text_col: str = "description") -> DataFrame:
    """M1 transform + l2 normalise: ``(doc_id, term, weight)``; OOV terms dropped."""
    return _weights(counts(docs, id_col, text_col, model.stop_words), model.idf)


def sparse_cosine_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 1,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    hot_df: int = 1000,
    salt_buckets: int | None = None,
) -> DataFrame:
    """M4 + K5 on unit-length sparse vectors: ``(seed_id, doc_id, rank, score)``.

    Query vectors are broadcast behind a measured row bound, so the dot products of a
    document are summed inside the task that owns it; otherwise a (term, salt) shuffle
    join in which terms present in at least ``hot_df`` documents are split.
    """
    from lodestar.operators.similarity import salted_term_join

    q = materialize(queries.select(F.col("doc_id").alias("seed_id"), "term", F.col("weight").alias("qw")))
    if bounded_rows(q, broadcast_rows):
        joined = docs.join(F.broadcast(q), "term")
    else:
        dfs = docs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        joined = salted_term_join(docs.join(dfs, "term"), q.join(dfs, "term"), "df", hot_df, salt_buckets)
    dots = joined.groupBy("doc_id", "seed_id").agg(F.round(F.sum(F.col("weight") * F.col("qw")), SCORE_DP).alias("score"))
    w = Window.partitionBy("seed_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (
        dots.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("seed_id", "doc_id", F.col("rank").cast("long").alias("rank"), "score")
    )
