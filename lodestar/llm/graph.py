"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.store import drop_stored, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``, root being the smallest node reachable.

    Only nodes with an edge to another node appear; loops, repeated edges, either direction and
    an empty table are fine, edges with a null end are ignored. Each round is written to the
    shared folder. The minima of a step are written before they are joined back, so that both
    sides of that join are plain exchanges and Spark can split a node with very many edges.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(now.where("a is not null and b is not null and a <> b").distinct(), "edges")
    state = _state(now)
    while True:
        # large star: every larger neighbour of a node points to the node's smallest neighbour
        both = now.union(now.select("b", "a")).toDF("u", "v")
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        # small star: the smaller neighbours of a node and the node itself point to the smallest
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(least.select("a", F.col("m").alias("b")).union(moved).distinct(), "edges")
        then = _state(after)
        for table in (now, low, large, least):
            drop_stored(table)
        now = after
        if then == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = then
