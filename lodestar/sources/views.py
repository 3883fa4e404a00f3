"""Views that give the driver tables the reference's input shapes (see FIXTURES.md).

* ``works``  - candidate documents (documents + labels + per-user event counts)
* ``seeds``  - query documents (benchmark, with part attributes as authors/genres/tags)
* ``titles`` - a title catalogue with many duplicate primary titles (part)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources.tables import read_table

# Fixed values of the fixture mapping.
WORK_TITLE_CHARS = 60
SENTENCE_BREAK = "[.!?\n]"


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user event counts, used as hits/kudos/chapters/comments/bookmarks of the work with that id."""
    ev = read_table(spark, sf_dir, "events", "user_id", "event_type")

    def n(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    return ev.groupBy(F.col("user_id").alias("id")).agg(
        n("view").alias("hits"),
        n("click").alias("kudos"),
        (F.lit(1).cast("long") + n("purchase")).alias("chapters"),
        n("signup").alias("comments"),
        n("error").alias("bookmarks"),
    )


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 work records: id, title, description, language, authorName, tags, hits, kudos, chapters, comments, bookmarks."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    # One label row per document (the largest value if a document were labelled twice).
    # Being an aggregate, it is unique on the key, so plans that do not use the tags drop
    # this join altogether (outer-join elimination), like the engagement counts.
    labels = (
        read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
        .groupBy(F.col("doc_id").alias("l_doc_id"))
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    eng = engagement(spark, sf_dir)
    base_tags = F.array(F.col("lang"), F.col("source"))
    label_tags = F.array(
        F.concat(F.lit("quality_"), F.col("quality").cast("string")),
        F.concat(F.lit("toxic_"), F.col("toxic").cast("string")),
    )
    joined = docs.join(labels, docs.doc_id == labels.l_doc_id, "left").join(
        eng, docs.doc_id == eng.id, "left"
    )
    return joined.select(
        F.col("doc_id").alias("id"),
        F.substring(F.col("text"), 1, WORK_TITLE_CHARS).alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("language"),
        F.col("source").alias("authorName"),
        F.when(F.col("l_doc_id").isNull(), base_tags)
        .otherwise(F.concat(base_tags, label_tags))
        .alias("tags"),
        F.coalesce(F.col("hits"), F.lit(0).cast("long")).alias("hits"),
        F.coalesce(F.col("kudos"), F.lit(0).cast("long")).alias("kudos"),
        F.coalesce(F.col("chapters"), F.lit(1).cast("long")).alias("chapters"),
        F.coalesce(F.col("comments"), F.lit(0).cast("long")).alias("comments"),
        F.coalesce(F.col("bookmarks"), F.lit(0).cast("long")).alias("bookmarks"),
    )


def sentences(text: Column) -> Column:
    """Non-empty, space-trimmed pieces of a text split at . ! ? or a line break."""
    pieces = F.transform(F.split(text, SENTENCE_BREAK), lambda x: F.trim(x))
    return F.filter(pieces, lambda x: x != F.lit(""))


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 seed records: id, titles (first two sentences), description, authors, genres, tags."""
    bench = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    # one attribute row per part key (an aggregate, so plans that only read the seed text
    # drop this join); a duplicated key would take the largest value of each column
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").groupBy("p_partkey").agg(
        *[F.max(c).alias(c) for c in ("p_name", "p_brand", "p_type", "p_size")]
    )
    j = bench.join(part, bench.item_id == part.p_partkey, "left")
    has_part = F.col("p_partkey").isNotNull()
    empty = F.array().cast("array<string>")
    return j.select(
        F.col("item_id").alias("id"),
        F.slice(sentences(F.col("text")), 1, 2).alias("titles"),
        F.col("text").alias("description"),
        F.when(has_part, F.array(F.col("p_brand"))).otherwise(empty).alias("authors"),
        F.when(
            has_part,
            F.concat(
                F.split(F.col("p_name"), " "),
                F.array(
                    F.col("p_type"),
                    F.col("p_brand"),
                    F.concat(F.lit("size_"), F.col("p_size").cast("string")),
                ),
            ),
        )
        .otherwise(empty)
        .alias("genres"),
        F.when(has_part, F.array(F.col("p_type"), F.col("p_brand"))).otherwise(empty).alias("tags"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title catalogue: idx, titles [name, brand + ' ' + type], primary title, description."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.select(
        F.col("p_partkey").alias("idx"),
        F.array(F.col("p_name"), F.concat_ws(" ", F.col("p_brand"), F.col("p_type"))).alias("titles"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", F.col("p_brand"), F.col("p_type"), F.lit("size"), F.col("p_size").cast("string")).alias(
            "descr"
        ),
    )


def popularity(hits: Column, kudos: Column, chapters: Column) -> Column:
    """P5: kudos * chapters / hits when hits > 0, else 0 (null counts treated as 0)."""
    h = F.coalesce(hits, F.lit(0))
    return F.when(h > 0, F.coalesce(kudos, F.lit(0)) * F.coalesce(chapters, F.lit(0)) / h).otherwise(F.lit(0.0))
