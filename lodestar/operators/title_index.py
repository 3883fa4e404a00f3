"""Stored index for title search (F1, E3): positional grams of every title, published as tables and added to by each load.

``grams(glen, gram, idx, form, at)`` has the places of every substring of 1 to ``GRAM`` characters; ``forms`` the lower-cased titles;
``gram_counts`` how often each gram is. A query of up to ``GRAM`` characters is a gram, and its rows are the answer. A longer one
takes, of the grams that cover it, the rarest two: titles that have both the right distance apart are few, and only these
are compared with the query at that place. Nothing of the titles is worked out at query time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import normalise_apostrophe
from lodestar.operators.search import GRAM, sent
from lodestar.session import materialize, shuffle_partitions
from lodestar.sources.versions import Layout, publish, read_version

TABLES = ("forms", "grams", "gram_counts", "titles")


def index_tables(titles: DataFrame) -> dict[str, DataFrame]:
    """Index of ``titles`` (idx, titles, title, descr); idx is unique over all loads."""
    titles = titles.repartition(shuffle_partitions(titles.sparkSession), "idx")  # a small Parquet file can hold a great many titles
    forms = F.array_distinct(F.transform("titles", lambda t: normalise_apostrophe(F.lower(t))))
    forms = titles.select("idx", F.posexplode(forms).alias("form", "text")).where(F.length("text") > 0)
    cut = forms.select("idx", "form", "text", F.explode(F.sequence(F.lit(1), F.least(F.lit(GRAM), F.length("text")))).alias("glen"))
    cut = cut.select("idx", "form", "glen", F.explode(F.sequence(F.lit(1), F.length("text") - F.col("glen") + 1)).alias("at"), "text")
    grams = cut.select("glen", F.substring(F.col("text"), F.col("at"), F.col("glen")).alias("gram"), "idx", "form", "at")
    counts = grams.groupBy("glen", "gram").agg(F.count(F.lit(1)).alias("n"))
    return {"forms": forms, "grams": grams, "gram_counts": counts, "titles": titles.select("idx", "title", "descr")}


def publish_titles(spark: SparkSession, path: str, titles: DataFrame, add: bool = True) -> int:
    """Publish the index of these titles, added to what is there (or in its place); returns the version's number."""
    layouts = {"grams": Layout(("gram", "idx")), "forms": Layout(("idx",)), "titles": Layout(("idx",))}
    return publish(spark, path, index_tables(titles), layouts, add_to=TABLES if add else ()).number


def search_index(index: dict[str, DataFrame], requests: DataFrame) -> DataFrame:
    """F1 from the stored index: ``(request_id, title, descr, idx)`` as ``search.title_search``.

    ``requests``: request_id, query. The query is lower-cased but its apostrophes stay; an empty one matches nothing.
    """
    q = requests.select("request_id", F.lower(F.col("query")).alias("q")).where(F.length("q") > 0)
    q = q.withColumn("m", F.length("q")).withColumn("glen", F.least(F.lit(GRAM), F.col("m")))
    begins = F.array_distinct(F.concat(F.sequence(F.lit(1), F.col("m") - F.col("glen") + 1, F.col("glen")), F.array(F.col("m") - F.col("glen") + 1)))
    cover = q.select("request_id", "q", "m", "glen", F.explode(begins).alias("begin"))
    cover = cover.withColumn("gram", F.substring(F.col("q"), F.col("begin"), F.col("glen")))
    counts = index["gram_counts"].groupBy("glen", "gram").agg(F.sum("n").alias("n"))  # of all loads
    rated = cover.join(counts, ["glen", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    pick = rated.groupBy("request_id", "q", "m", "glen").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "gram", "begin"))), 1, 2).alias("two"))
    one = lambda k: pick.where(F.size("two") > k).select("request_id", "q", "m", "glen", F.col("two")[k]["gram"].alias("gram"), F.col("two")[k]["begin"].alias("begin"))
    first, second = (sent(materialize(one(k))) for k in (0, 1))  # grams that are not asked for go nowhere
    place = lambda asked: index["grams"].join(asked, ["glen", "gram"]).select("request_id", "q", "m", "idx", "form", (F.col("at") - F.col("begin") + 1).alias("start"))
    keys = ["request_id", "idx", "form", "start"]
    short = place(first).where(F.col("m") <= GRAM)
    long = place(first).where(F.col("m") > GRAM).join(place(second).select(*keys), keys, "left_semi")
    # merge: Parquet sizes say little of how long decoded titles are, and a whole catalogue is not to be broadcast
    found = long.join(index["forms"].hint("merge"), ["idx", "form"]).where(F.substring(F.col("text"), F.col("start"), F.col("m")) == F.col("q"))
    hits = short.select("request_id", "idx").unionByName(found.select("request_id", "idx")).distinct()
    rows = hits.join(index["titles"].hint("merge"), "idx")
    return rows.groupBy("request_id", "title").agg(F.min("idx").alias("idx"), F.min_by("descr", "idx").alias("descr")).select("request_id", "title", "descr", "idx")


def load_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return read_version(spark, path)
