"""Fuzzy title search (T8, J8, K6, E9): the titles nearest to each request by edit distance, whatever the distance.

Equal titles are one string with its first rows, equal requests one query. Two rounds, each complete within a radius:

* the first looks ``first_distance`` edits far, which answers requests that are nearly a title;
* the others first get a radius of their own. Titles of the lengths next to the query's are probed, and the distance
  of the ``top``-th of them is as far as the answer can reach, so each request is asked again with the radius it needs.

Within a radius k, candidates come from equi-joins only:

* pieces (where they have two characters or more): cut the query into k + 1 disjoint pieces; k edits touch k pieces at most, so a
  title within k contains one intact;
* counted characters: within k, a title of n characters shares at least max(m, n) - k characters with the query of m, each counted
  as often as both have it. So one of any m - o + 1 of the query's characters is shared if o must be; the rarest of them
  are looked up, by length of title;
* titles that share no character at all are max(m, n) away, so the first ``top`` rows of each such length are enough.

The counted characters give each candidate a least distance. Those of least bounds are compared by ``levenshtein`` first; the
``top``-th of their distances is a tighter radius, and of the others only those are compared that can be within it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.search import GRAM, substring_grams
from lodestar.session import materialize

# Fixed values of the search.
FUZZY_TOP = 10
# Edits looked for in the first round.
FUZZY_FIRST_DISTANCE = 3
# Shortest piece that is looked up.
LEAST_PIECE = 2
# Strings of least bounds that are compared first, for each row of an answer.
FIRST_COMPARED = 3


def counted_characters(text: Column) -> Column:
    """Each character of the string with its number among the equal ones: "abba" -> a1, b1, b2, a2."""
    n = F.length(text)
    signs = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(1)))
    counted = F.transform(signs, lambda c, i: F.concat(c, (F.size(F.filter(F.slice(signs, F.lit(1), i + 1), lambda x: x == c))).cast("string")))
    return F.when(n > 0, counted).otherwise(F.array().cast("array<string>"))


def title_strings(titles: DataFrame, top: int) -> DataFrame:
    """``(lt, tlen, marks, first, rows)``: every distinct lower-cased title, its counted characters, its smallest idx and its
    first ``top`` rows ``(idx, title)``, which are all that can be among the ``top`` of a request."""
    t = titles.select("idx", "title", F.lower(F.col("title")).alias("lt")).where(F.col("lt").isNotNull())
    w = Window.partitionBy("lt").orderBy("idx")
    few = t.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top)
    one = few.groupBy("lt").agg(F.sort_array(F.collect_list(F.struct("idx", "title"))).alias("rows"))
    return one.select("lt", F.length("lt").alias("tlen"), counted_characters(F.col("lt")).alias("marks"), F.col("rows")[0]["idx"].alias("first"), "rows")


class TitleTable:
    """Distinct titles with the tables that candidates are looked up in."""

    def __init__(self, titles: DataFrame, top: int) -> None:
        self.top = top
        self.strings = materialize(title_strings(titles, top))
        self.grams = materialize(substring_grams(self.strings, ["lt", "tlen"], "lt").where(F.col("glen") >= LEAST_PIECE))
        self.marks = materialize(self.strings.select("lt", "tlen", F.explode("marks").alias("mark")))
        self.mark_df = self.marks.groupBy("mark").agg(F.count(F.lit(1)).alias("df"))
        w = Window.partitionBy("tlen").orderBy("first")
        by_length = self.strings.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top).drop("_n")
        self.by_length = materialize(by_length)  # the strings that hold the first rows of each length
        self.longest = self.strings.agg(F.max("tlen")).first()[0] or 0


def queries_of(requests: DataFrame) -> DataFrame:
    """``(q, m, marks)``: the distinct lower-cased requests."""
    q = requests.select(F.lower(F.col("query")).alias("q")).where(F.col("q").isNotNull()).distinct()
    return q.select("q", F.length("q").alias("m"), counted_characters(F.col("q")).alias("marks"))


def candidates(table: TitleTable, queries: DataFrame) -> DataFrame:
    """``(q, k, lt)``: of ``queries(q, m, marks, k)``, pairs among which are all titles that can be in an answer within ``k`` edits."""
    k, m = F.col("k"), F.col("m")
    asked = queries.withColumn("plen", F.least(F.lit(GRAM), F.floor(m / (k + 1)).cast("int")))
    lengths = F.sequence(F.greatest(m - k, F.lit(1)), F.greatest(m + k, F.lit(1)))

    pieces = asked.where(F.col("plen") >= LEAST_PIECE).select("q", "m", "k", F.col("plen").alias("glen"), F.explode(F.sequence(F.lit(0), k)).alias("_i"))
    pieces = pieces.withColumn("gram", F.substring(F.col("q"), F.col("_i") * F.col("glen") + 1, F.col("glen")))
    pieces = pieces.select("q", "k", "glen", "gram", F.explode(lengths).alias("tlen")).distinct()
    by_piece = pieces.join(table.grams, ["glen", "gram", "tlen"]).select("q", "k", "lt")

    few = asked.where(F.col("plen") < LEAST_PIECE)
    rated = few.select("q", F.explode("marks").alias("mark")).join(table.mark_df, "mark")  # marks that no title has match nothing
    rated = rated.groupBy("q").agg(F.transform(F.sort_array(F.collect_list(F.struct("df", "mark"))), lambda s: s["mark"]).alias("known"))
    shared = F.greatest(F.greatest(m, F.col("tlen")) - k, F.lit(1))
    asks = few.join(rated, "q").select("q", "m", "k", "known", F.explode(lengths).alias("tlen")).where(shared <= F.least(m, F.col("tlen")))
    # of m counted characters one of any m - shared + 1 is shared; those that no title has come first among the rarest
    asks = asks.select("q", "k", "tlen", F.explode(F.slice("known", F.lit(1), F.greatest(F.size("known") - shared + 1, F.lit(0)))).alias("mark"))
    by_mark = asks.join(table.marks, ["tlen", "mark"]).select("q", "k", "lt")

    none = few.select("q", "m", "k", F.explode(F.sequence(F.lit(0), k)).alias("tlen")).where(m <= k)
    by_length = none.join(table.by_length.select("tlen", "lt"), "tlen").select("q", "k", "lt")
    return by_piece.unionByName(by_mark).unionByName(by_length).distinct()


def bounded(table: TitleTable, queries: DataFrame) -> DataFrame:
    """``(q, k, lt, least, first, rows)``: the candidates with the least distance that their counted characters allow, if that is
    within the radius."""
    pairs = candidates(table, queries).join(queries.select("q", "m", F.col("marks").alias("_marks")), "q").join(table.strings, "lt")
    least = F.greatest(F.col("m"), F.col("tlen")) - F.size(F.array_intersect("marks", "_marks"))
    return pairs.withColumn("least", least).where(F.col("least") <= F.col("k")).select("q", "k", "lt", "least", "first", "rows")


def compared(pairs: DataFrame, top: int) -> DataFrame:
    """The pairs that are compared, with their distances: of each query first those of least bounds, then such as can still be
    among the ``top`` rows by what the first have shown."""
    distance = F.levenshtein(F.col("q"), F.col("lt"))
    placed = materialize(pairs.withColumn("_p", F.row_number().over(Window.partitionBy("q").orderBy("least", "first"))))
    early = materialize(placed.where(F.col("_p") <= FIRST_COMPARED * top).withColumn("distance", distance))
    late = placed.where(F.col("_p") > FIRST_COMPARED * top).join(_kth(early.select("q", "distance", F.size("rows").alias("n")), top), "q", "left")
    late = late.where(F.col("radius").isNull() | (F.col("least") <= F.col("radius"))).drop("radius").withColumn("distance", distance)
    return early.unionByName(late).drop("_p")


def _kth(found: DataFrame, top: int) -> DataFrame:
    """``(q, radius)``: the distance within which each query has ``top`` of the rows ``(q, distance, n)``, if it has so many."""
    upto = Window.partitionBy("q").orderBy("distance").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return found.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") >= top).groupBy("q").agg(F.min("distance").alias("radius"))


def _ranked(near: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query among compared pairs within its radius."""
    near = near.where(F.col("distance") <= F.col("k"))
    strings = Window.partitionBy("q").orderBy("distance", "first")
    near = near.withColumn("_s", F.row_number().over(strings)).where(F.col("_s") <= top)
    rows = near.select("q", "distance", F.explode("rows").alias("r")).select("q", "distance", "r.idx", "r.title")
    w = Window.partitionBy("q").orderBy("distance", "idx")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def radii(table: TitleTable, queries: DataFrame) -> DataFrame:
    """``(q, radius)``: a distance within which each query has its ``top`` rows, if there are so many titles.

    Of the lengths nearest to the query's, as many as hold ``top`` rows, the first strings are compared.
    """
    rows = table.by_length.select("tlen", F.size("rows").alias("n"), "lt")
    sizes = rows.groupBy("tlen").agg(F.sum("n").alias("n")).agg(F.collect_list(F.struct("tlen", "n"))).scalar()  # one for each length
    near = queries.select("m").distinct().select("m", F.explode(sizes).alias("s")).select("m", "s.tlen", "s.n")
    w = Window.partitionBy("m").orderBy(F.abs(F.col("tlen") - F.col("m")), "tlen")
    near = near.withColumn("before", F.sum("n").over(w) - F.col("n")).where(F.col("before") < table.top).select("m", "tlen")
    probes = queries.select("q", "m").join(near, "m").join(rows, "tlen").select("q", "n", F.levenshtein(F.col("q"), F.col("lt")).alias("distance"))
    return _kth(probes, table.top)


def fuzzy_title_search(titles: DataFrame, requests: DataFrame, first_distance: int = FUZZY_FIRST_DISTANCE, top: int = FUZZY_TOP, max_distance: int | None = None) -> DataFrame:
    """Per request the ``top`` primary titles by (edit distance, idx), whatever the distance
    (unit costs, lower-cased, code points). With ``max_distance`` titles beyond that are left out.

    Output: request_id, rank, idx, title, distance.
    """
    table = TitleTable(titles, top)
    queries = materialize(queries_of(requests))
    most = F.lit(max_distance if max_distance is not None else 2**30)
    reach = F.least(F.greatest(F.col("m"), F.lit(table.longest)), most).cast("int")  # no pair is further apart
    near = queries.withColumn("k", F.least(F.lit(first_distance), reach))
    answers = materialize(_ranked(bounded(table, near).withColumn("distance", F.levenshtein(F.col("q"), F.col("lt"))), top))
    full = answers.where(F.col("rank") == top).select("q")
    left = materialize(near.join(full, "q", "left_anti").where(F.col("k") < reach))
    if not left.isEmpty():
        wider = left.join(radii(table, left), "q", "left").withColumn("k", F.least(F.coalesce("radius", reach), reach)).drop("radius")
        far = _ranked(compared(bounded(table, wider), top), top)
        answers = answers.join(left.select("q"), "q", "left_anti").unionByName(far)
    asked = requests.select("request_id", F.lower(F.col("query")).alias("q"))
    out = asked.join(answers, "q")
    return out.select("request_id", F.col("rank").cast("long").alias("rank"), "idx", "title", F.col("distance").cast("long").alias("distance"))
