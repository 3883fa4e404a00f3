"""Quality rules: base rules, then robust multivariate outliers.

Statistics of a text are transformed to a vector; in each language and source the minimum covariance
determinant gives the centre and shape of the bulk of documents, and a document is rejected for its
Mahalanobis distance from it. The estimate starts from medians and deviations and takes concentration steps:
mean and covariance of the three quarters of the rows that are nearest by the estimate before. All of it
is aggregates: medians and the nearest rows come from counts on a fixed grid, so one group may hold
any share of the rows, and the result doesn't depend on how rows are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.store import drop_stored, stored

# Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Entries of the vector and the least standard deviation that each is taken to have.
FLOORS = {"v_length": 0.10, "v_symbols": 0.03, "v_lines": 0.10, "v_repeat": 0.05, "v_upper": 0.03, "v_marks": 0.03}
VECTOR = tuple(FLOORS)
#: Share of the rows that an estimate rests on, and what makes its covariance right for normal data of 6 entries.
CORE, CONSISTENCY = 0.75, 1.36
STEPS = 3
#: Squared distance beyond which a document goes.
CUT = 60.0
#: Rows that a language and source, else a language, must have for an estimate of its own.
MIN_ROWS = 60
#: Pools whose estimates may be sent to every task.
MAX_SENT = 50_000
_SPACE = r"[\x20\x09-\x0D]+"
_GRID, _DISTANCE_GRID = 512, 64


def _let(value: Column, use) -> Column:
    """``use`` applied to a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that the text has twice or more, the first included."""
    n = F.size(words)
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.struct(F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))).alias("h"), i.alias("i"))),
    ).otherwise(F.array().cast("array<struct<h: bigint, i: int>>"))

    def twice(s: Column) -> Column:
        """Places, in order, of windows with an equal neighbour among the sorted ones."""
        same = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        """A window covers five words, fewer where the next begins before."""
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return _let(F.sort_array(windows), lambda s: _let(twice(s), covered))


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts of every document (a null text has none of anything), its group and ``base_failed``."""
    t = F.col("t")
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    without = lambda chars: F.length(t) - F.length(F.regexp_replace(t, chars, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "id", "lang", "source",
        F.filter(F.split(t, _SPACE), lambda w: w != "").alias("words"),
        F.length(F.regexp_replace(t, _SPACE, "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(lines, F.size).alias("n_lines"),
        without(r"[A-ZÀ-ÖØ-Þ]+").alias("n_upper"),
        without("!+").alias("n_marks"),
    )
    rows = rows.withColumn("n_repeat_words", _let(F.col("words"), repeated_words).cast("long")).withColumn("n_words", F.size("words").cast("long")).drop("words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vector() -> dict[str, Column]:
    """The transformed statistics: roots of shares and a logarithm; a few typical characters are added to short texts."""
    c = F.col
    return {
        "v_length": F.log((c("word_chars") + 150) / (c("n_words") + 30)),
        "v_symbols": F.sqrt(c("n_symbols") / (c("word_chars") + 100)),
        "v_lines": F.sqrt(c("n_dup_lines") / (c("n_lines") + 3)),
        "v_repeat": F.sqrt(c("n_repeat_words") / (c("n_words") + 30)),
        "v_upper": F.sqrt((c("n_upper") + 3) / (c("word_chars") + 100)),
        "v_marks": F.sqrt(c("n_marks") / (c("word_chars") + 100)),
    }


def _beside(table: DataFrame) -> DataFrame:
    """A stored table with a row for each pool, to be joined to rows of which one pool may have a third: sent to
    all tasks if it has at most ``MAX_SENT`` rows (about 250 bytes each), else left to a join that Spark can split."""
    return F.broadcast(table) if table.count() <= MAX_SENT else table


def _rank_on_grid(counts: DataFrame, keys: list[str], share: float) -> DataFrame:
    """From ``keys, bin, n``: the least bin up to which ``share`` of the rows lie."""
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin")
    ranked = counts.select(*keys, "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"))
    return ranked.where(F.col("upto") >= share * F.col("total")).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _median(rows: DataFrame, value) -> DataFrame:
    """Median of each entry in each pool, to one part of the grid: ``pool`` and a column for each entry."""
    entries = F.explode(F.array(*(F.struct(F.lit(v).alias("entry"), F.floor(value(v) * _GRID).alias("bin")) for v in VECTOR))).alias("e")
    counts = rows.select("pool", entries).select("pool", "e.entry", "e.bin").groupBy("pool", "entry", "bin").agg(F.count(F.lit(1)).alias("n"))
    low = _rank_on_grid(counts, ["pool", "entry"], 0.5)
    return low.groupBy("pool").agg(*(F.max(F.when(F.col("entry") == v, (F.col("bin") + 0.5) / _GRID)).alias(v) for v in VECTOR))


def _factor(shape: DataFrame) -> DataFrame:
    """``pool``, centre and the Cholesky factor worked out once for each pool."""
    out = shape
    for i in range(len(VECTOR)):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return out.drop(*(f"c_{i}_{j}" for i in range(len(VECTOR)) for j in range(i + 1)))


def _with_distance(rows: DataFrame, estimate: DataFrame, on: str = "pool") -> DataFrame:
    """Squared distance of each row from its pool's estimate (columns m_i and l_i_j), column ``d2``."""
    out = rows.join(_beside(estimate), on)
    for i, v in enumerate(VECTOR):
        step = F.col(v) - F.col(f"m_{i}")
        for k in range(i):
            step = step - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        out = out.withColumn(f"z_{i}", step / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") ** 2 for i in range(1, len(VECTOR))), F.col("z_0") ** 2)
    return out.withColumn("d2", d2).select(*rows.columns, "d2")


def minimum_covariance(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """``rows(pool, vector entries)`` -> for each pool its centre ``m_i`` and Cholesky factor ``l_i_j``."""
    median = stored(_median(rows, F.col), "median")
    apart = rows.alias("r").join(_beside(median).alias("c"), "pool").select("pool", *(F.abs(F.col(f"r.{v}") - F.col(f"c.{v}")).alias(v) for v in VECTOR))
    spread = stored(_median(apart, F.col), "spread")
    first = median.alias("c").join(spread.alias("s"), "pool").select(
        "pool",
        *(F.col(f"c.{v}").alias(f"m_{i}") for i, v in enumerate(VECTOR)),
        *((F.greatest(1.4826 * F.col(f"s.{VECTOR[i]}"), F.lit(FLOORS[VECTOR[i]])) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in range(len(VECTOR)) for j in range(i + 1)),
    )
    estimate = stored(first, "estimate")
    grid = F.floor(F.log1p("d2") * _DISTANCE_GRID)
    for _ in range(steps):
        near = _with_distance(rows, estimate).withColumn("bin", grid)
        counts = near.groupBy("pool", "bin").agg(F.count(F.lit(1)).alias("n"))
        edge = stored(_rank_on_grid(counts, ["pool"], CORE).withColumnRenamed("bin", "edge"), "edge")
        core = near.join(_beside(edge), "pool").where("bin <= edge")
        pairs = [(i, j) for i in range(len(VECTOR)) for j in range(i + 1)]
        shape = core.groupBy("pool").agg(
            *(F.avg(v).alias(f"m_{i}") for i, v in enumerate(VECTOR)),
            *((CONSISTENCY * F.covar_pop(VECTOR[i], VECTOR[j]) + (FLOORS[VECTOR[i]] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in pairs),
        )
        after = stored(_factor(shape), "estimate")
        for table in (estimate, edge):
            drop_stored(table)
        estimate = after
    drop_stored(median)
    drop_stored(spread)
    return estimate


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cut: float = CUT, min_rows: int = MIN_ROWS) -> DataFrame:
    """``id, lang, source``, the base statistics, ``base_failed``, ``distance`` (squared) and ``kept``.

    Estimates rest on the documents that pass the base rules. A document is held to its language and source
    if those have ``min_rows`` such documents, else to its language, else to all. Null languages and sources
    are groups like others. Documents that fail the base rules have no distance and are not kept. Null and
    empty texts fail. Repeated rows count and stay; an empty table gives none.
    """
    entries = vector()
    base = stored(base_statistics(docs, id_col, text_col, lang_col, source_col).select("*", *(e.alias(v) for v, e in entries.items())), "statistics")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))  # noqa: E731  a null is not the text "-"
    levels = F.array(F.to_json(F.array(name("lang"), name("source"))), F.to_json(F.array(name("lang"))), F.lit("all"))
    passed = base.where("not base_failed")
    pools = passed.select(F.explode(levels).alias("pool"), *VECTOR)
    sizes = pools.groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sizes.where((F.col("n") >= min_rows) | (F.col("pool") == "all")).select("pool"), "pools")
    pools = stored(pools.join(_beside(large), "pool", "left_semi"), "members")
    estimate = minimum_covariance(pools)

    # the narrowest pool that has an estimate, for each pair of language and source
    groups = passed.select("lang", "source").distinct().select("lang", "source", F.posexplode(levels).alias("level", "pool"))
    judged_by = stored(groups.join(large, "pool", "left_semi").groupBy("lang", "source").agg(F.min_by("pool", "level").alias("pool")), "judged-by")
    own = F.struct(name("lang").alias("a"), name("source").alias("b"))
    rows = passed.withColumn("own", own).join(_beside(judged_by).select(own.alias("own"), "pool"), "own").drop("own")
    judged = _with_distance(rows, estimate)
    kept = base.where("base_failed").withColumn("d2", F.lit(None).cast("double")).unionByName(judged.drop("pool"))
    return kept.withColumnRenamed("d2", "distance").withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("distance") <= cut), F.lit(False))).drop(*VECTOR)
