"""Inverted index, document frequency, IDF and document norms.

Long form throughout: ``postings(doc_id, term, tf)`` has one row per posting, so every
step is a relational operator that partitions and spills. Documents are hash-partitioned
by ``doc_id`` *before* tokenising; the (doc, term) count, the idf join (broadcast behind a
measured bound) and the per-document norm then keep that partitioning and run without a
further exchange of the postings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import NON_LETTERS, between, letter_tokens
from lodestar.session import DEFAULT_BROADCAST_ROWS, broadcast_if_small, materialize, shuffle_partitions

# Fixed values of the batch build.
MIN_DF = 10
MAX_DF_RATIO = 0.95


def tokenized(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    tokenizer: Callable[[Column], Column] | None = None,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """D3: ``(doc_id, tokens array<string>)``; ``tokenizer`` overrides the default."""
    tok = tokenizer(F.col(text_col)) if tokenizer else letter_tokens(F.col(text_col), stop_words)
    return docs.select(F.col(id_col).alias("doc_id"), tok.alias("tokens"))


def term_frequency(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    tokenizer: Callable[[Column], Column] | None = None,
    stop_words: Sequence[str] | None = None,
    partitions: int | None = None,
    separators: str = NON_LETTERS,
    least: int = 1,
) -> DataFrame:
    """A1: ``(doc_id, term, tf)`` - one row per (document, distinct term).

    The raw rows are hash-partitioned on ``doc_id`` first, so the count needs no second
    exchange and downstream per-document work (norms, scoring) stays partition-local.
    Without a ``tokenizer`` terms are what lies between ``separators`` in the lower-cased text, of at least
    ``least`` characters; they are filtered as rows, in generated code, not as elements of arrays.
    """
    n_parts = partitions or shuffle_partitions(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).repartition(n_parts, "doc_id")
    tok = tokenizer(F.col("text")) if tokenizer else between(F.col("text"), separators)
    terms = d.select("doc_id", F.explode(tok).alias("term"))
    if not tokenizer:
        terms = terms.where(F.length("term") >= least)
        if stop_words:
            terms = terms.where(~F.col("term").isin(list(stop_words)))
    return terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def packed_postings(postings: DataFrame) -> DataFrame:
    """A2 packed view: ``term -> array<struct<doc_id, tf>>`` ascending by doc.

    Export/debug only: a hot term makes one giant row. Scoring uses the long form.
    """
    return postings.groupBy("term").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


def document_frequency(postings: DataFrame) -> DataFrame:
    """A3: ``(term, df)``; the partial aggregate collapses hot terms map-side."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_log2(doc_freq: DataFrame, n_docs: Column | int, min_df: int = MIN_DF, max_df_ratio: float = MAX_DF_RATIO) -> DataFrame:
    """F4 + A4: keep ``df >= min_df`` and ``df / n <= max_df_ratio``; ``idf = log2(n / (1 + df))``."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return doc_freq.where((F.col("df") >= min_df) & (F.col("df") / n <= max_df_ratio)).select(
        "term", "df", F.log2(n / (F.lit(1) + F.col("df"))).alias("idf")
    )


def doc_norms(weights: DataFrame) -> DataFrame:
    """A5: ``(doc_id, norm) = sqrt(sum((tf * idf)^2))`` over kept terms."""
    return weights.groupBy("doc_id").agg(
        F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm")
    )


@dataclass
class InvertedIndex:
    postings: DataFrame  # doc_id, term, tf           (all terms, doc-partitioned)
    n_docs: int
    doc_freq: DataFrame  # term, df                   (all terms)
    idf: DataFrame  # term, df, idf              (kept terms)
    weights: DataFrame  # doc_id, term, tf, df, idf  (kept terms, doc-partitioned)
    norms: DataFrame  # doc_id, norm               (doc-partitioned)
    idf_broadcast: bool


def build_index(
    docs: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    tokenizer: Callable[[Column], Column] | None = None,
    stop_words: Sequence[str] | None = None,
    min_df: int = MIN_DF,
    max_df_ratio: float = MAX_DF_RATIO,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    partitions: int | None = None,
) -> InvertedIndex:
    """A1-A5 in one go; the postings are computed once and persisted for reuse."""
    postings = materialize(
        term_frequency(docs, id_col, text_col, tokenizer, stop_words, partitions)
    )
    n_docs = docs.count()  # scalar on the driver: n counts token-less documents too
    doc_freq = document_frequency(postings)
    idf = materialize(idf_log2(doc_freq, n_docs, min_df, max_df_ratio))
    idf_side, is_bcast = broadcast_if_small(idf, broadcast_rows)
    weights = postings.join(idf_side, "term").select("doc_id", "term", "tf", "df", "idf")
    norms = doc_norms(weights)
    return InvertedIndex(postings, n_docs, doc_freq, idf, weights, norms, is_bcast)


def query_terms(
    queries: DataFrame,
    idf: DataFrame,
    id_col: str = "id",
    text_col: str = "description",
    tokenizer: Callable[[Column], Column] | None = None,
    stop_words: Sequence[str] | None = None,
    binary_query_tf: bool = True,
) -> DataFrame:
    """T6 + F8 + A12: ``(seed_id, term, qtf, idf, df)`` over terms that have an idf.

    With ``binary_query_tf`` (the reference's behaviour) each distinct term counts once.
    """
    tok = tokenizer(F.col(text_col)) if tokenizer else letter_tokens(F.col(text_col), stop_words)
    q = queries.select(F.col(id_col).alias("seed_id"), F.explode(tok).alias("term"))
    if binary_query_tf:
        q = q.distinct().withColumn("qtf", F.lit(1).cast("long"))
    else:
        q = q.groupBy("seed_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    return q.join(idf.select("term", "idf", "df"), "term")


def query_norms(qterms: DataFrame) -> DataFrame:
    """``(seed_id, qnorm) = sqrt(sum((qtf * idf)^2))``."""
    return qterms.groupBy("seed_id").agg(
        F.sqrt(F.sum(F.pow(F.col("qtf") * F.col("idf"), 2))).alias("qnorm")
    )
