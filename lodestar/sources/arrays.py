"""Files that each hold one JSON array, read by many tasks (S1, S2): record ends are found inside the file.

Spark's text reader cuts a file at every closing brace, whatever tasks its blocks go to. A piece then has no closing brace but its own, and
what it does to a reader of JSON depends on one thing only: whether it begins inside a string. For both cases a piece has the
number of braces that it opens and whether it ends inside a string, so prefix sums over the blocks of a file (one row each) and over
the pieces of a block say at which pieces the outermost object closes. Pieces up to there are one record; only records are
gathered, no file is held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import materialize

_FILE, _BLOCK = ["page", "file"], ["page", "file", "block"]


def _opened(parts: Column, odd: int) -> Column:
    """Braces opened in every other part of a text cut at its quotes."""
    braces = F.transform(parts, lambda p, i: F.when(i % 2 == odd, F.length(p) - F.length(F.replace(p, F.lit("{")))).otherwise(0))
    return F.aggregate(braces, F.lit(0), lambda a, x: a + x)


def read_json_arrays(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The objects of all arrays with the fixed schema, ``page`` (position in ``paths``) and ``load_seq`` (page, file, block, place).

    Objects may have any layout and any nesting; braces and quotes in strings are no matter. A path may be a file, a folder or a
    pattern. Files of an empty array have no rows.
    """
    if not paths:
        raise ValueError("no pages given")
    texts = None
    for page, path in enumerate(paths):
        one = spark.read.option("lineSep", "}").text(path).select(
            F.lit(page).alias("page"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text"))
        texts = one if texts is None else texts.unionByName(one)
    parts = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')
    pieces = texts.withColumn("parts", parts).select(*_BLOCK, "pos", "text", ((F.size("parts") - 1) % 2).alias("turn"), _opened(F.col("parts"), 0).alias("outside"), _opened(F.col("parts"), 1).alias("inside"))
    pieces = materialize(pieces)  # the ids of places are not to be made anew

    # does a piece begin inside a string: by what its block begins in, and the quotes before it there
    here = Window.partitionBy(*_BLOCK).orderBy("pos")
    before, upto = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = Window.partitionBy(*_FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def begin(value: str, df: DataFrame) -> DataFrame:
        """The sum of ``value`` over the blocks of the file before each block."""
        sums = df.groupBy(*_BLOCK).agg(F.sum(value).alias("_s"))
        return sums.select(*_BLOCK, F.coalesce(F.sum("_s").over(blocks), F.lit(0)).alias("_at"))

    def running(df: DataFrame, value: str, window, name: str) -> DataFrame:
        placed = df.join(begin(value, df), _BLOCK)
        return placed.withColumn(name, F.col("_at") + F.coalesce(F.sum(value).over(window), F.lit(0))).drop("_at")

    pieces = running(pieces, "turn", before, "turns")
    string = F.col("turns") % 2 == 1
    ends_outside = (F.col("turns") + F.col("turn")) % 2 == 0
    step = F.when(string, F.col("inside")).otherwise(F.col("outside")) - F.when(ends_outside, 1).otherwise(0)
    pieces = running(pieces.withColumn("step", step), "step", upto, "depth")
    pieces = pieces.withColumn("last", F.when(ends_outside & (F.col("depth") == 0), 1).otherwise(0))
    pieces = running(pieces, "last", before, "record")

    gathered = pieces.groupBy(*_FILE, "record").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "text"))).alias("p"), F.max("last").alias("whole")).where("whole = 1")
    text = F.regexp_replace(F.concat(F.array_join(F.transform("p", lambda x: x["text"]), "}"), F.lit("}")), r"^[\s\[,\x{FEFF}]+", "")
    first = F.col("p")[0]
    seq = F.struct("page", "file", first["block"].alias("block"), first["pos"].alias("pos")).alias("load_seq")
    rows = gathered.select(F.from_json(text, schema).alias("r"), "page", seq)
    return rows.select("r.*", "page", "load_seq")
