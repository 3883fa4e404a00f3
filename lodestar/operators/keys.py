"""Contiguous 0-based positions in a key order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import materialize


def assign_dense_index(df: DataFrame, order_col: str, out_col: str = "index") -> DataFrame:
    """Position of each row in ``order_col`` order (0-based, ties broken arbitrarily but stably).

    The rows are range-partitioned and sorted by the key; inside a partition
    ``monotonically_increasing_id`` is consecutive, so the index is the row's offset in
    its partition plus the number of rows in earlier partitions. Only one row per
    partition (its size) is combined globally; no task ever holds the whole table.
    """
    sorted_rows = df.orderBy(order_col).withColumn("_m", F.monotonically_increasing_id()).withColumn(
        "_p", F.spark_partition_id()
    )
    sorted_rows = materialize(sorted_rows, reliable=True)  # ids must not be recomputed differently
    sizes = sorted_rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    offsets = sizes.select(
        "_p", "_m0", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    ).fillna(0, subset=["_off"])
    out = sorted_rows.join(F.broadcast(offsets), "_p")
    return out.withColumn(out_col, (F.col("_m") - F.col("_m0") + F.col("_off")).cast("long")).drop("_p", "_m", "_m0", "_off")


def assign_input_index(df: DataFrame, seq_col: str = "load_seq", out_col: str = "index") -> DataFrame:
    """Position of each row in input order (0-based): page, file, block of the file, place in the block, as the JSON readers give
    them in ``load_seq``.

    The rows are numbered inside their block (a task's read, of bounded size) and moved up by the number of rows in the blocks before:
    prefix sums over one row per block. Rows that are gone, filtered or duplicates that lost, leave no gap.
    """
    seq = F.col(seq_col)
    block = [seq["page"].alias("_page"), seq["file"].alias("_file"), seq["block"].alias("_block")]
    rows = df.withColumns({c: seq[c[1:]] for c in ("_page", "_file", "_block")})
    keys = ["_page", "_file", "_block"]
    sizes = df.select(*block).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(*keys, F.coalesce(before, F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(seq["pos"])) - 1
    out = rows.withColumn("_place", place).join(bases, keys)
    return out.withColumn(out_col, (F.col("_base") + F.col("_place")).cast("long")).drop(*keys, "_place", "_base")
