"""JSON page readers (S1-S3), result bundle sink/source (S5, S6) and the catalog table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import ensure_checkpoint_dir, shuffle_partitions
from lodestar.sources.versions import Layout, publish, read_version

# A work record as stored in the JSON pages.
WORK_SCHEMA = T.StructType([
    T.StructField("rating", T.StringType()),
    T.StructField("hits", T.LongType()),
    T.StructField("kudos", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("finished", T.StringType()),
    T.StructField("chapters", T.LongType()),
    T.StructField("authorName", T.StringType()),
    T.StructField("comments", T.LongType()),
    T.StructField("words", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("bookmarks", T.LongType()),
    T.StructField("id", T.LongType()),
])

# A seed record.
SEED_SCHEMA = T.StructType([
    T.StructField("titles", T.ArrayType(T.StringType())),
    T.StructField("original_lang", T.StringType()),
    T.StructField("rank", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
])


def _read_pages(spark: SparkSession, paths: Sequence[str], schema: T.StructType, multiline: bool) -> DataFrame:
    """S3: all pages as one table (UNION ALL, duplicates kept), with ``page`` (position in
    ``paths``) and ``load_seq`` for keyed loads: page, file name, place of the block in the file, place of
    the record in the block. One scan reads all pages, however files are split and dealt out.

    A path may be a file, a folder or a pattern; no file may belong to two of them, but the same path may be
    given more than once.
    """
    if not paths:
        raise ValueError("no pages given")
    reader = spark.read.schema(schema).option("multiLine", multiline)
    files = [(re.sub(r"^(\w+):/+", r"\1:/", f), i) for i, path in enumerate(paths) for f in reader.json(path).inputFiles()]
    pages = spark.createDataFrame(files, "_file string, page int")
    rows = reader.json(list(dict.fromkeys(paths))).select(
        "*",
        F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    rows = rows.join(F.broadcast(pages), "_file")  # a row for each file of the listing
    seq = F.struct("page", F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_pos").alias("pos"))
    return rows.withColumn("load_seq", seq).drop("_file", "_block", "_pos")


def read_works(spark: SparkSession, paths: Sequence[str], multiline: bool = True) -> DataFrame:
    """Work pages (JSON arrays, or JSON lines with ``multiline=False``, which split).

    ``date`` is parsed to DATE; null hits / description are normalised (quirk 20).
    """
    df = _read_pages(spark, paths, WORK_SCHEMA, multiline)
    return df.withColumn("date", F.to_date("date", "yyyy-MM-dd")).withColumn(
        "hits", F.coalesce("hits", F.lit(0).cast("long"))
    ).withColumn("description", F.coalesce("description", F.lit("")))


def read_seeds(spark: SparkSession, paths: Sequence[str], multiline: bool = True) -> DataFrame:
    """Seed pages, in page order."""
    return _read_pages(spark, paths, SEED_SCHEMA, multiline)


def write_pages(df: DataFrame, path: str) -> None:
    """Write records as JSON lines (splittable), one folder."""
    df.write.mode("overwrite").json(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_bundle(bundle: dict[str, DataFrame], path: str, buckets: int | None = None) -> None:
    """Publish the batch result as one version. ``recs`` is bucketed by seed and sorted by rank, so a lookup by seed opens
    one bucket and the join with requests does not move it; readers see the old bundle until the new one is whole.
    """
    spark = next(iter(bundle.values())).sparkSession
    layout = Layout(("seed_id",), ("seed_id", "rank"), buckets or shuffle_partitions(spark))
    publish(spark, path, bundle, {"recs": layout} if "recs" in bundle else {})


def read_bundle(spark: SparkSession, path: str, register_views: bool = False) -> dict[str, DataFrame]:
    """Load the published bundle; optionally as temp views for SQL serving queries."""
    out = read_version(spark, path)
    if register_views:
        for name, df in out.items():
            df.createOrReplaceTempView(name)
    return out


# Fixed values of the catalog table.
TITLE_CHARS, DESCR_CHARS = 64, 1024


def create_catalog_table(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """Drop-if-exists, then create ``(id INT, title VARCHAR(64), descr VARCHAR(1024))``; returns its name.

    Without a name the table gets a fresh one, so no table of the caller's is touched. VARCHAR(n) is enforced
    on write (over-long strings are rejected).
    """
    name = name or f"episodes_{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} (id INT, title VARCHAR({TITLE_CHARS}), descr VARCHAR({DESCR_CHARS})) USING parquet{loc}")
    return name


def fill_catalog_table(rows: DataFrame, name: str) -> DataFrame:
    """Insert the rows ``(id, title, descr)`` that fit; returns the others, whole."""
    over = (F.length("title") > TITLE_CHARS) | (F.length("descr") > DESCR_CHARS)
    over = F.coalesce(over, F.lit(False))
    rows.where(~over).write.insertInto(name)
    return rows.where(over)
