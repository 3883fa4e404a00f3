"""Serving-side ranking: popularity blend, record assembly, tag filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import lower_all

# Fixed values of the recommendation endpoint.
NUM_FICS = 49
POPULARITY_SCALE = 10.0
SCORE_DP_SERVED = 4
RANK_DP = 6


def parse_tag_param(param: Column) -> Column:
    """'a,b,c' -> array; empty pieces dropped (the reference drops only the first '')."""
    return F.filter(F.split(F.coalesce(param, F.lit("")), ","), lambda x: x != F.lit(""))


def parse_weight(param: Column) -> Column:
    """Slider text "0".."100" -> weight 0..1; beyond that the nearer end, anything but a whole number null."""
    digits = F.trim(param)
    number = F.when(digits.rlike("^[+-]?[0-9]{1,9}$"), digits).cast("int")
    return F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(0)), F.lit(100)) / F.lit(100.0))


def tags_any_match(tags: Column, wanted: Column) -> Column:
    """True when lower(tags) and lower(wanted) share an element; an empty wanted list keeps all."""
    overlap = F.coalesce(F.arrays_overlap(lower_all(tags), lower_all(wanted)), F.lit(False))
    return F.when(F.size(wanted) == 0, F.lit(True)).otherwise(overlap)


def seed_lookup(seeds: DataFrame) -> DataFrame:
    """Primary title -> seed id; a duplicated title resolves to the last seed (max id)."""
    return seeds.groupBy(F.get(F.col("titles"), 0).alias("title")).agg(F.max("id").alias("seed_id"))


def blend_rerank(
    recs: DataFrame,
    popularity: DataFrame,
    requests: DataFrame,
    num_fics: int = NUM_FICS,
    popularity_scale: float = POPULARITY_SCALE,
    max_popularity: float | None = None,
) -> DataFrame:
    """K3: per request take the first ``num_fics`` recs of its seed by cosine rank, then
    score = pop / (max_pop / scale) * w + cosine * (1 - w) on the unrounded cosine, re-ranked (ties keep cosine order).

    ``requests``: request_id, seed_id, popularity_weight. ``popularity``: doc_id, popularity
    over the whole candidate corpus (its max, unless given, is a scalar subquery, not a driver round trip).
    Output: request_id, seed_id, doc_id, cos_rank, blended, keywords, rank.
    """
    max_pop = popularity.agg(F.max("popularity")).scalar() if max_popularity is None else F.lit(float(max_popularity))
    top = recs.where(F.col("rank") <= num_fics).withColumnRenamed("rank", "cos_rank")
    j = requests.join(top, "seed_id").join(popularity, "doc_id", "left")
    w = F.coalesce(F.col("popularity_weight"), F.lit(0.0))  # no weight: by similarity alone
    pop_part = F.coalesce(F.try_divide(F.coalesce(F.col("popularity"), F.lit(0.0)), max_pop / F.lit(popularity_scale)), F.lit(0.0))
    blended = pop_part * w + F.col("cosine") * (F.lit(1.0) - w)
    j = j.withColumn("blended", blended)
    win = Window.partitionBy("request_id").orderBy(F.round("blended", RANK_DP).desc(), F.col("cos_rank").asc())
    return (
        j.withColumn("rank", F.row_number().over(win))
        .where(F.col("rank") <= num_fics)
        .select(
            "request_id", "seed_id", "doc_id", "cos_rank", "blended", "keywords",
            F.col("rank").cast("long").alias("rank"),
        )
    )


def assemble(blended: DataFrame, works: DataFrame) -> DataFrame:
    """P6 + P7: attach the work record to each ranked id; score rounded to 4 places."""
    w = works.select(
        F.col("id").alias("doc_id"), "description", "title",
        F.col("authorName").alias("author"), "hits", "kudos", "tags",
    )
    return blended.join(w, "doc_id").select(
        "request_id", "rank", F.col("doc_id").alias("fanfic_id"), "description", "title", "author",
        "hits", "kudos", "tags", F.round("blended", SCORE_DP_SERVED).alias("score"),
        F.col("keywords").alias("influential_words"),
    )
