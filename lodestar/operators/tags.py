"""Tag vocabulary and tag filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import tag_tokens
from lodestar.session import bounded_rows, broadcast_if_small, materialize

# Fixed values of the tag vocabulary.
NUM_TAGS = 235
MIN_TAG_DF = 0.005
MAX_TAG_DF = 0.95
# Tags that are held against a row as one array.
ARRAY_TAGS = 2000


def combine_corpora(seeds: DataFrame, works: DataFrame) -> DataFrame:
    """P10: seeds then works as one corpus ``(side, id, title, tags)``; UNION ALL."""
    s = seeds.select(F.lit("seed").alias("side"), "id", F.get(F.col("titles"), 0).alias("title"), "tags")
    w = works.select(F.lit("work").alias("side"), "id", "title", "tags")
    return s.unionByName(w)


def tag_document_frequency(
    corpus: DataFrame,
    stop_words: Sequence[str] | None = None,
    min_df: float = MIN_TAG_DF,
    max_df: float = MAX_TAG_DF,
) -> DataFrame:
    """``(tag, df)`` with ``min_df * N <= df <= max_df * N``; N counts all corpus rows.

    ``array_distinct`` before the explode makes df a document count; the partial
    aggregate collapses a tag carried by a third of all rows before the exchange.
    """
    n = corpus.select(F.count(F.lit(1))).scalar()
    toks = corpus.select(F.explode(F.array_distinct(tag_tokens(F.col("tags"), stop_words))).alias("tag"))
    df = toks.groupBy("tag").agg(F.count(F.lit(1)).alias("df"))
    return df.where((F.col("df") >= F.lit(min_df) * n) & (F.col("df") <= F.lit(max_df) * n))


def tag_vocabulary(tag_df: DataFrame, num_tags: int = NUM_TAGS) -> DataFrame:
    """K8: the first ``num_tags`` surviving tags in alphabetical order, as ``(tag_rank, tag)``.

    A global top-k: each task keeps its ``num_tags`` smallest before the single merge.
    Returns fewer rows when the vocabulary is shorter (the reference would fail).
    """
    return (
        tag_df.orderBy("tag")
        .limit(num_tags)
        .select(
            F.row_number().over(Window.orderBy("tag")).cast("long").alias("tag_rank"),
            "tag",
        )
    )


def restrict_to_vocab(works: DataFrame, vocab: DataFrame, array_rows: int = ARRAY_TAGS) -> DataFrame:
    """Works with at least one lower-cased tag in the vocabulary, all of which counts.

    A vocabulary of a measured ``array_rows`` tags or fewer is one array that each row's tags are held against, so the works
    stay where they are. Beyond it the tags of each work are exploded beside its id and semi-joined to the vocabulary, and the ids
    that are left select the works.
    """
    words = materialize(vocab.select("tag").distinct())
    lower = F.transform("tags", lambda t: F.lower(t))
    if bounded_rows(words, array_rows):
        known = words.agg(F.collect_set("tag").alias("tags")).scalar()
        return works.where(F.arrays_overlap(lower, known))
    words, _ = broadcast_if_small(words)
    kept = works.select("id", F.explode(F.array_distinct(lower)).alias("tag")).join(words, "tag", "left_semi").select("id").distinct()
    return works.join(kept, "id", "left_semi")
