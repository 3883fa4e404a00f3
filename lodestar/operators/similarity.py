"""All-pairs TF-IDF cosine with explanations (A7, A8, J1, J2, J6, K1, K2; hooks U2, U3).

Two physical strategies, picked by a measured bound on the query side:

* ``doc_local`` - the query-term table (seed, term, qtf, idf, qnorm) is broadcast. Each
  task joins it against the postings of the documents it owns, so the per-(seed, doc)
  sum is complete inside the task: no exchange of the postings or of the term matches.
  Only the per-partition top-k candidates are shuffled, to the seed.
* ``term_shuffle`` - when the query side is too large to broadcast, both sides are
  hash-partitioned on (term, salt). Terms whose df passes ``hot_df`` are split over
  ``salt_buckets`` on the posting side and replicated on the query side, so a term that
  holds a third of all postings is spread over many tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.index import InvertedIndex, query_norms
from lodestar.session import DEFAULT_BROADCAST_ROWS, bounded_rows, materialize

# Fixed values of the batch build.
TOP_K = 50
KEYWORDS = 5
SCORE_DP = 6

ScoreFn = Callable[[Column, Column, Column], Column]


def dot_contribution(tf: Column, idf: Column, qtf: Column) -> Column:
    """U2 default: one term's share of the dot product, ``tf * idf * qtf * idf``."""
    return tf * idf * qtf * idf


def salted_term_join(
    docs: DataFrame,
    queries: DataFrame,
    df_col: str = "df",
    hot_df: int = 1000,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Shuffle equi-join on ``term`` that splits hot terms.

    ``docs`` and ``queries`` both carry ``term`` and the term's document frequency
    ``df_col``. A term with ``df >= hot_df`` is cut into ``df / hot_df`` buckets (or
    ``salt_buckets``, if given) by a hash of the document on the document side and
    replicated as often on the query side; other terms keep salt 0. So a bucket holds
    about ``hot_df`` postings however frequent its term. Output drops ``salt``/``df_col``.
    """
    is_hot = F.col(df_col) >= hot_df
    buckets = F.ceil(F.col(df_col) / hot_df).cast("long") if salt_buckets is None else F.lit(salt_buckets).cast("long")
    zero = F.lit(0).cast("long")
    d = docs.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("doc_id"), buckets)).otherwise(zero))
    q = queries.withColumn(
        "salt",
        F.explode(F.when(is_hot, F.sequence(zero, buckets - 1)).otherwise(F.array(zero))),
    )
    return d.drop(df_col).join(q.drop(df_col), ["term", "salt"]).drop("salt")


def term_matches(
    index: InvertedIndex,
    qterms: DataFrame,
    score_fn: ScoreFn = dot_contribution,
    strategy: str = "auto",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    hot_df: int | None = None,
    salt_buckets: int | None = None,
) -> tuple[DataFrame, str]:
    """J1 + A8: ``(seed_id, doc_id, term, contrib, qnorm)`` for every shared kept term.

    ``strategy``: ``auto`` (measure the query side), ``doc_local`` (broadcast it; still
    measured, falls back when over the bound) or ``term_shuffle``.
    """
    qn = query_norms(qterms)
    q = qterms.join(qn, "seed_id").select("seed_id", "term", "qtf", "qnorm", "idf", "df")
    if strategy in ("auto", "doc_local"):
        q = materialize(q)
        strategy = "doc_local" if bounded_rows(q, broadcast_rows) else "term_shuffle"
    if strategy == "doc_local":
        # the query terms bring their idf, so postings are not joined to the whole vocabulary first
        m = index.postings.join(F.broadcast(q.drop("df")), "term")
    elif strategy == "term_shuffle":
        hot = hot_df if hot_df is not None else max(1000, index.n_docs // 50)
        m = salted_term_join(index.weights, q.drop("idf"), "df", hot, salt_buckets)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return (
        m.select(
            "seed_id", "doc_id", "term",
            score_fn(F.col("tf"), F.col("idf"), F.col("qtf")).alias("contrib"),
            "qnorm",
        ),
        strategy,
    )


def dot_scores(matches: DataFrame) -> DataFrame:
    """``(seed_id, doc_id, dot, qnorm)``. Groups by (doc, seed) so a doc-partitioned input needs no exchange."""
    return matches.groupBy("doc_id", "seed_id").agg(
        F.sum("contrib").alias("dot"), F.first("qnorm").alias("qnorm")
    )


def cosine_scores(dots: DataFrame, norms: DataFrame, method: str | Callable[[DataFrame, DataFrame], DataFrame] = "cosine") -> DataFrame:
    """J2 + U3: ``(seed_id, doc_id, score, cosine)``; ``score`` is rounded before any
    ranking so engines agree on ties, ``cosine`` keeps the unrounded value for blending.

    ``cosine`` divides by both norms and drops pairs with a zero norm (the reference
    would emit NaN); ``dot`` keeps the raw dot product; a callable gets (dots, norms).
    """
    if callable(method):
        return method(dots, norms)
    if method == "dot":
        return dots.select("seed_id", "doc_id", F.round("dot", SCORE_DP).alias("score"), F.col("dot").alias("cosine"))
    if method != "cosine":
        raise ValueError(f"unknown method {method!r}")
    # One norm per document against many (seed, doc) rows: hash the small side instead of
    # sorting both; with doc-partitioned inputs this join needs no exchange either.
    j = dots.join(norms.hint("shuffle_hash"), "doc_id")
    denom = F.col("qnorm") * F.col("norm")
    cos = F.col("dot") / denom
    return j.where(denom > 0).select("seed_id", "doc_id", F.round(cos, SCORE_DP).alias("score"), cos.alias("cosine"))


def top_k_per_seed(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """K1: best ``k`` docs per seed by (score desc, doc_id asc); rank 1..k contiguous.

    ``row_number() <= k`` plans a partial ``WindowGroupLimit`` before the exchange, so
    at most k rows per seed and task are shuffled however many docs match.
    """
    w = Window.partitionBy("seed_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (
        scores.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("long"))
    )


def top_keywords(matches: DataFrame, pairs: DataFrame, n: int = KEYWORDS) -> DataFrame:
    """K2: the ``n`` terms that contribute most to each kept (seed, doc) pair.

    Contributions are rounded before ordering and ties go to the smaller term, so the
    order is total. Only the surviving pairs are expanded (semi join first).
    """
    kept = matches.join(pairs.select("seed_id", "doc_id"), ["doc_id", "seed_id"], "left_semi")
    w = Window.partitionBy("doc_id", "seed_id").orderBy(
        F.round("contrib", SCORE_DP).desc(), F.col("term").asc()
    )
    top = kept.withColumn("kr", F.row_number().over(w)).where(F.col("kr") <= n)
    return top.groupBy("doc_id", "seed_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("kr", "term"))), lambda s: s["term"]),
            ",",
        ).alias("keywords")
    )


def similar_documents(
    index: InvertedIndex,
    qterms: DataFrame,
    k: int = TOP_K,
    n_keywords: int = KEYWORDS,
    score_fn: ScoreFn = dot_contribution,
    method: str | Callable[[DataFrame, DataFrame], DataFrame] = "cosine",
    strategy: str = "auto",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """J6 + K1 + K2: ``(seed_id, doc_id, rank, score, keywords, cosine)`` - the batch result ``recs``."""
    matches, _ = term_matches(index, qterms, score_fn, strategy, broadcast_rows)
    scores = cosine_scores(dot_scores(matches), index.norms, method)
    # seeds x k rows: kept so the keyword pass and the final join do not rerun the scoring
    top = materialize(top_k_per_seed(scores, k))
    if n_keywords <= 0:
        return top.withColumn("keywords", F.lit("")).select("seed_id", "doc_id", "rank", "score", "keywords", "cosine")
    # only the kept pairs' terms are scored again: pairs x query terms, matched to the postings in place
    wanted = materialize(top.select("seed_id", "doc_id").join(qterms.select("seed_id", "term", "qtf", "idf"), "seed_id"))
    if bounded_rows(wanted, broadcast_rows):
        shared = index.postings.join(F.broadcast(wanted), ["doc_id", "term"])
        matches = shared.select("seed_id", "doc_id", "term", score_fn(F.col("tf"), F.col("idf"), F.col("qtf")).alias("contrib"))
    kw = top_keywords(matches, top, n_keywords)
    return top.join(kw, ["doc_id", "seed_id"]).select("seed_id", "doc_id", "rank", "score", "keywords", "cosine")
