"""Title search (F1, K7, E3) for tables of requests.

No request is compared with every title: candidates come from an equi-join on short substrings
("grams", 1 to ``GRAM`` characters). A title that contains the query contains each of the query's grams
of ``min(GRAM, len)`` characters, so joining on one of them (the rarest) loses no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import normalise_apostrophe
from lodestar.session import bounded_rows, materialize, shuffle_partitions

# Fixed values of the searches.
GRAM = 3
SEARCH_SHOWN = 5
# Rows and bytes of the queries' grams that are sent to every task.
SENT_ROWS, SENT_BYTES = 200_000, 16 << 20


def substring_grams(strings: DataFrame, key: str | list[str], text: str, max_len: int = GRAM) -> DataFrame:
    """``(*key, glen, gram)``: every distinct substring of 1..max_len characters of ``text``."""
    keys = [key] if isinstance(key, str) else list(key)
    s = strings.select(*keys, F.col(text).alias("_s")).where(F.length("_s") > 0)
    g = s.select(*keys, "_s", F.explode(F.sequence(F.lit(1), F.lit(max_len))).alias("glen"))
    g = g.where(F.col("glen") <= F.length("_s"))
    g = g.select(*keys, "glen", F.explode(F.sequence(F.lit(1), F.length("_s") - F.col("glen") + 1)).alias("_p"), "_s")
    return g.select(*keys, "glen", F.substring(F.col("_s"), F.col("_p"), F.col("glen")).alias("gram")).distinct()


def _norm_title(c: Column) -> Column:
    return normalise_apostrophe(F.lower(c))


def _places(forms: DataFrame) -> DataFrame:
    """``(idx, form, glen, _p, gram)``: every place of every substring of up to ``GRAM`` characters."""
    g = forms.select("idx", "form", F.explode(F.sequence(F.lit(1), F.least(F.lit(GRAM), F.length("form")))).alias("glen"))
    g = g.select("idx", "form", "glen", F.explode(F.sequence(F.lit(1), F.length("form") - F.col("glen") + 1)).alias("_p"))
    return g.select("idx", "form", "glen", "_p", F.substring(F.col("form"), F.col("_p"), F.col("glen")).alias("gram"))


def sent(asks: DataFrame) -> DataFrame:
    """A persisted table of what the queries ask, for a join with all titles: broadcast within a measured bound, else merged."""
    return F.broadcast(asks) if bounded_rows(asks, SENT_ROWS, SENT_BYTES) else asks.hint("merge")


def title_search(titles: DataFrame, requests: DataFrame) -> DataFrame:
    """works whose any title (lower-cased, U+2019 -> ') contains ``lower(query)``.

    ``titles``: idx, titles, title (primary), descr. ``requests``: request_id, query.
    One row per (request, primary title): the first work in index order that matches.
    The query itself is not apostrophe-normalised; an empty query matches nothing.
    Output: request_id, title, descr, idx.
    """
    forms = titles.select("idx", F.explode(F.array_distinct(F.transform("titles", _norm_title))).alias("form")).where("length(form) > 0 and idx is not null")
    forms = forms.repartition(shuffle_partitions(titles.sparkSession), "idx")  # a small Parquet file can hold a great many titles
    req = requests.select("request_id", F.lower(F.col("query")).alias("q")).where(F.length("q") > 0)
    req = req.withColumn("glen", F.least(F.lit(GRAM), F.length("q")))
    # Every gram of the query occurs in every matching title, so any one of them is a
    # complete filter: take the rarest (fewest places). Only grams that a query asks for are counted.
    q_grams = materialize(req.select(
        "request_id", "q", "glen", F.explode(F.sequence(F.lit(1), F.length("q") - F.col("glen") + 1)).alias("_p")
    ).select("request_id", "q", "glen", F.substring(F.col("q"), F.col("_p"), F.col("glen")).alias("gram")))
    grams = _places(forms)
    asked = sent(materialize(q_grams.select("glen", "gram").distinct()))
    gram_df = grams.select("glen", "gram").join(asked, ["glen", "gram"]).groupBy("glen", "gram").agg(F.count(F.lit(1)).alias("gdf"))
    rated = q_grams.join(gram_df.hint("merge"), ["glen", "gram"], "left").withColumn("gdf", F.coalesce("gdf", F.lit(0)))
    pick = rated.groupBy("request_id", "q", "glen").agg(F.min_by("gram", F.struct("gdf", "gram")).alias("gram"))
    # a title is compared where it meets the gram (its first place), so titles without one go nowhere
    cand = grams.join(sent(materialize(pick)), ["glen", "gram"]).where(F.expr("instr(form, gram) = _p"))
    hit = cand.where(F.col("form").contains(F.col("q"))).select("request_id", "idx")
    # merge: Parquet sizes say little of how long decoded titles are, and a whole catalogue is not to be broadcast
    rows = hit.join(titles.select("idx", "title", "descr").hint("merge"), "idx")
    # First-wins dedupe on the primary title as an aggregate (partial, skew-safe).
    return rows.groupBy("request_id", "title").agg(
        F.min("idx").alias("idx"), F.min_by("descr", "idx").alias("descr")
    ).select("request_id", "title", "descr", "idx")


def first_n(matches: DataFrame, n: int = SEARCH_SHOWN) -> DataFrame:
    """K7: the first ``n`` hits per request in index order (partial WindowGroupLimit)."""
    w = Window.partitionBy("request_id").orderBy("idx")
    return matches.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n).withColumn(
        "pos", F.col("pos").cast("long")
    )
