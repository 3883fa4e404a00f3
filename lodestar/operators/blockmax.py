"""Exact top-k cosine without scoring every posting (J6, K1): upper bounds by term and by block of documents.

A posting's impact is ``u = tf * idf / norm(doc)`` and a query term's weight ``w = qtf * idf / qnorm``, so a cosine is the sum of
``u * w`` over the shared terms and no term adds more than ``w`` times its greatest impact.

1. The terms of a seed that can add most are scored first. The k-th of these partial sums is a threshold: k documents score
   that much or more.
2. Terms are ordered by what they can add. Those at the end that together stay under the threshold are left out: a document
   that shares only these cannot be among the k.
3. The other terms' postings give each document a partial sum, and the k-th of these sums a higher threshold. What the left-out terms can add is bounded by their greatest impact
   in the document's block (``block_docs`` documents or so), and documents that cannot reach the threshold go.
4. Only the postings of the documents that stay are scored in full.

Every step is a join on the term (or on seed and block), with sums that begin in the tasks that own the documents. Few seeds
and many documents, or many of both: query terms are sent to the tasks within a measured bound, else joined by salted terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.index import InvertedIndex, query_norms
from lodestar.operators.similarity import KEYWORDS, TOP_K, cosine_scores, dot_contribution, dot_scores, salted_term_join, top_k_per_seed, top_keywords
from lodestar.session import bounded_rows, materialize, shuffle_partitions

# Documents of a block, and terms of a seed that are scored for its threshold.
BLOCK_DOCS, FIRST_TERMS = 64, 6
# Scores are ranked at 6 places: what is this close to the threshold may tie with it.
ROOM = 2e-6
# Rows and bytes of a table that is sent to every task. A broadcast is built on the driver, where it takes several times its bytes.
SENT_ROWS, SENT_BYTES = 300_000, 24 << 20


@dataclass
class Pruned:
    """What is left to score, and how many postings each step has looked at (one row: ``every, first, essential, rest``)."""

    survivors: DataFrame  # seed_id, doc_id
    work: DataFrame


def _meet(impacts: DataFrame, terms: DataFrame, n_docs: int, broadcast_rows: int) -> DataFrame:
    """Postings with the query terms that they have."""
    if bounded_rows(terms, broadcast_rows, SENT_BYTES):
        return impacts.drop("df").join(F.broadcast(terms.drop("df")), "term")
    return salted_term_join(impacts, terms, "df", max(1000, n_docs // 50))


def _small(df: DataFrame, broadcast_rows: int) -> DataFrame:
    return F.broadcast(df) if bounded_rows(df, broadcast_rows, SENT_BYTES) else df.hint("merge")


def _cut(df: DataFrame) -> DataFrame:
    """Rows of ``df`` in the checkpoint folder, worked out once. Each step reads several tables made by earlier ones; if these kept
    their plans, the driver would hold every plan within every later one, many times over."""
    rows = materialize(df)
    out = materialize(rows, reliable=True)
    rows.unpersist()
    return out


def survivors(index: InvertedIndex, qterms: DataFrame, k: int = TOP_K, block_docs: int = BLOCK_DOCS, first_terms: int = FIRST_TERMS, broadcast_rows: int = SENT_ROWS) -> Pruned:
    """The (seed, document) pairs among which are the ``k`` best of each seed.

    Nothing of the size of the postings is kept or shuffled beside them: each step reads the terms it needs of them anew. A block's documents
    are in one partition of the postings (``block`` goes by the hash that deals documents out, to a multiple of its
    partitions), so the greatest impacts of its terms are found there."""
    parts = shuffle_partitions(qterms.sparkSession)
    blocks = parts * max(1, -(-index.n_docs // (block_docs * parts)))
    block = F.pmod(F.hash("doc_id"), F.lit(blocks)).cast("int").alias("block")
    norms = materialize(index.norms)
    lengths = norms.where("norm > 0").hint("shuffle_hash")

    def impacts(words: DataFrame) -> DataFrame:
        """``(doc_id, term, df, u, block)`` of the postings of ``words`` (term, df, idf)."""
        u = (F.col("tf") * F.abs("idf") / F.col("norm")).alias("u")
        return index.postings.join(_small(words.distinct(), broadcast_rows), "term").join(lengths, "doc_id").select("doc_id", "term", "df", u, block)

    seeds = query_norms(qterms).where("qnorm > 0")
    w = (F.col("qtf") * F.abs("idf") / F.col("qnorm")).alias("w")
    asked = _cut(qterms.join(seeds, "seed_id").select("seed_id", "term", "df", "idf", w))
    by_term = impacts(asked.select("term", "df", "idf")).groupBy("term").agg(F.max("u").alias("most"))
    order = Window.partitionBy("seed_id").orderBy(F.col("bound").desc(), "term")
    q = asked.join(by_term, "term").withColumn("bound", F.col("w") * F.col("most")).drop("most")
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    q = _cut(q.withColumn("place", F.row_number().over(order)).withColumn("onward", F.sum("bound").over(onward)))

    def sums(terms: DataFrame) -> DataFrame:
        """What the postings of these query terms add to each score: ``(doc_id, seed_id, block, a)``."""
        met = _meet(impacts(terms.select("term", "df", "idf")), terms.select("seed_id", "term", "w", "df"), index.n_docs, broadcast_rows)
        return met.groupBy("doc_id", "seed_id", "block").agg(F.sum(F.col("u") * F.col("w")).alias("a"))

    def kth(partial: DataFrame) -> DataFrame:
        """The k-th of these sums for each seed, which a document among the k best reaches."""
        best = top_k_per_seed(partial.select("seed_id", "doc_id", F.col("a").alias("score")), k).where(F.col("rank") == k)
        return best.select("seed_id", (F.col("score") - ROOM).alias("least"))

    least = _cut(kth(sums(q.where(F.col("place") <= first_terms))))  # none: every shared term counts
    q = _cut(q.join(least, "seed_id", "left").withColumn("needed", F.col("least").isNull() | (F.col("onward") >= F.col("least"))))

    # these sums are nearer to the scores than the first ones: their k-th is a higher threshold. There is one for most pairs of a
    # seed and a document, so they are summed once for the threshold and again to compare them with it, not kept
    some = sums(q.where("needed"))
    higher = kth(some).withColumnRenamed("least", "higher")
    least = least.join(higher, "seed_id", "left").select("seed_id", F.greatest("least", "higher").alias("least"))
    more = q.where("not needed").groupBy("seed_id").agg(F.sum("bound").alias("more"))
    limits = _cut(least.join(more, "seed_id", "left").fillna(0.0, ["more"]))
    reach = some.join(_small(limits, broadcast_rows), "seed_id", "left")
    reach = reach.where(F.col("least").isNull() | (F.col("a") + F.col("more") >= F.col("least")))
    plain = q.where("not needed")
    by_block = impacts(plain.select("term", "df", "idf")).groupBy("term", "block").agg(F.max("u").alias("most"))
    rest = by_block.join(_small(plain.select("seed_id", "term", "w"), broadcast_rows), "term")
    rest = _cut(rest.groupBy("seed_id", "block").agg(F.sum(F.col("w") * F.col("most")).alias("rest")))
    reach = reach.join(_small(rest, broadcast_rows), ["seed_id", "block"], "left")
    stay = _cut(reach.where(F.col("least").isNull() | (F.col("a") + F.coalesce("rest", F.lit(0.0)) >= F.col("least"))).select("seed_id", "doc_id"))
    work = q.agg(F.sum("df").alias("every"), F.sum(F.when(F.col("place") <= first_terms, F.col("df")).otherwise(0)).alias("first"), F.sum(F.when(F.col("needed"), F.col("df")).otherwise(0)).alias("essential"))
    every = impacts(asked.select("term", "df", "idf"))
    scored = every.join(stay.join(qterms.select("seed_id", "term"), "seed_id"), ["doc_id", "term"]).agg(F.count(F.lit(1)))
    return Pruned(stay, work.withColumn("rest", scored.scalar()))


def _matches(index: InvertedIndex, qterms: DataFrame, stay: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(seed_id, doc_id, term, contrib, qnorm)`` of the pairs that stay."""
    contrib = dot_contribution(F.col("tf"), F.col("idf"), F.col("qtf")).alias("contrib")
    terms = materialize(qterms.join(query_norms(qterms), "seed_id").select("seed_id", "term", "qtf", "qnorm", "idf"))
    if bounded_rows(terms, broadcast_rows, SENT_BYTES):
        # a document's seeds go to its postings, which stay where they are
        seeds = stay.groupBy("doc_id").agg(F.collect_set("seed_id").alias("_seeds"))
        met = index.postings.join(seeds.hint("shuffle_hash"), "doc_id").join(F.broadcast(terms), "term").where(F.array_contains("_seeds", F.col("seed_id")))
    else:
        wanted = materialize(stay.join(terms.drop("idf"), "seed_id"))
        met = index.weights.join(_small(wanted, broadcast_rows), ["doc_id", "term"])
    return met.select("seed_id", "doc_id", "term", contrib, "qnorm")


def similar_documents(index: InvertedIndex, qterms: DataFrame, k: int = TOP_K, n_keywords: int = KEYWORDS, broadcast_rows: int = SENT_ROWS, **bounds) -> DataFrame:
    """J6 + K1 + K2 with pruning: the rows of ``similarity.similar_documents``, from fewer postings.

    ``(seed_id, doc_id, rank, score, keywords, cosine)``; scores are summed and rounded as there, over the documents that stay.
    """
    stay = survivors(index, qterms, k, broadcast_rows=broadcast_rows, **bounds).survivors
    matches = _matches(index, qterms, stay, broadcast_rows)
    top = materialize(top_k_per_seed(cosine_scores(dot_scores(matches), index.norms), k))
    if n_keywords <= 0:
        return top.withColumn("keywords", F.lit("")).select("seed_id", "doc_id", "rank", "score", "keywords", "cosine")
    return top.join(top_keywords(matches, top, n_keywords), ["doc_id", "seed_id"]).select("seed_id", "doc_id", "rank", "score", "keywords", "cosine")
