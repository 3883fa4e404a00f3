"""Work on large tables dealt out in bounded tiles: queries against summaries, and against the pages that they name."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TileFn = Callable[[tuple, pa.Table, pa.Table], pa.Table]


def parts(n: int, size: int) -> int:
    """Into how many parts of about ``size`` rows ``n`` rows fall."""
    return max(1, -(-n // size))


def part_of(col: str, n: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def tiles(asks: DataFrame, n_parts: int, zones: DataFrame, n_chunks: int, fn: TileFn, schema: str) -> DataFrame:
    """``fn`` on each block of ``asks`` (rows of one ``part``) with each block of ``zones`` (rows of one ``chunk``).

    A stated set of queries meets a table of summaries in blocks: each side is sent to the other's block numbers, so
    that no task holds more than one block of each.
    """
    a = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    z = zones.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    return a.groupBy("part", "chunk").cogroup(z.groupBy("part", "chunk")).applyInArrow(fn, schema)


def visit(work: DataFrame, pages: DataFrame, key: str, fn: TileFn, schema: str) -> DataFrame:
    """``fn`` on the work of each (``key``, ``part``) with the pages of ``key``; pages that no work names are not read."""
    asked = work.select(F.col(key).alias("of_key"), F.col("part").alias("of_part")).distinct()
    named = pages.join(asked, F.col(key) == F.col("of_key"))
    return work.groupBy(key, "part").cogroup(named.groupBy("of_key", "of_part")).applyInArrow(fn, schema)


def in_parts(asks: DataFrame, key: str, by: str, size: int) -> DataFrame:
    """A ``part`` for each ask, so that those of one ``key`` and part are ``size`` or so."""
    sizes = asks.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).alias("_n"))
    return asks.join(sizes, key).withColumn("part", F.pmod(F.xxhash64(by), F.col("_n")).cast("int")).drop("_n")
