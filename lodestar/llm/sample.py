"""Bounded, reproducible samples of labelled documents to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Is the document outside the rows that may be learnt from: crc32 of the id as text, by remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fit_on: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text", size: Column | None = None, most: int = 1 << 62) -> tuple[DataFrame, dict[int, int]]:
    """``(label, text)`` of at most ``per_class`` documents for each of labels 0 and 1, and the number of
    labelled documents of each class that may be learnt from.

    Documents are taken in order of a hash of their id, so the sample does not depend on partitions. ``size`` (lines, characters) is
    what a document takes of the driver's memory: a class's documents have ``most`` together, and a larger one than a fiftieth of
    that is passed over.
    A document with several labels has the largest; null labels, ids and texts are left out.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"), fit_on.alias("fit"), F.col(text_col).isNotNull().alias("has_text"), (F.lit(0) if size is None else size).cast("long").alias("size"))
    rows = rows.where("fit and has_text").join(marks, "id").select("id", "text_key", F.col("label").cast("int").alias("label"), "size").persist()
    counts = {r["label"]: r["n"] for r in rows.where("label in (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64("id"), "id", "text_key"]
    chosen = [rows.where((F.col("label") == c) & (F.col("size") <= most // 50)).distinct().orderBy(*by_hash).limit(per_class) for c in (0, 1)]
    upto = F.sum("size").over(Window.partitionBy("label").orderBy(*by_hash).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chosen = chosen[0].union(chosen[1]).withColumn("upto", upto).where(F.col("upto") <= most).select("id", "text_key", "label")  # per_class rows a class
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("label", "text")
    return sample, counts
