"""Session construction and the few execution helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a side we are willing to ship to every executor when its size has been
# measured. 2M narrow rows (a few tens of MB) stays well inside executor memory.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "lodestar",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster the session comes from the launcher; this only fills settings
    that are unset. ``spark.checkpoint.dir`` is honoured when present and only
    defaulted to a fresh scratch folder when the session has none (local runs).
    """
    master = master or os.environ.get("LODESTAR_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LODESTAR_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if unset (local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, reliable: bool = False) -> DataFrame:
    """Keep a reused intermediate.

    ``reliable=False`` persists to memory+disk; lost blocks are recomputed from
    lineage when an executor dies. ``reliable=True`` cuts the lineage with a
    checkpoint written to the shared ``spark.checkpoint.dir``.
    """
    if reliable:
        ensure_checkpoint_dir(df.sparkSession)
        return _size_forgotten(df.checkpoint(eager=True))
    return df.persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _size_forgotten(df: DataFrame) -> DataFrame:
    """A checkpointed table without the optimizer's guess of its bytes, where this is past any that could be.

    A checkpoint keeps the guess, a join's is the product of its sides': it has twice the digits after each step of an
    iteration that joins a table to one made of it, until the number itself cannot be held."""
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 63:
        return df
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(df._jdf.queryExecution().toRdd(), df._jdf.schema(), False), spark)


def _width(df: DataFrame):
    """About how many bytes a row has: lengths of strings and arrays, eight for anything else."""
    from pyspark.sql import types as T

    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(f.name), F.lit(0)) + 8)
        elif isinstance(f.dataType, T.ArrayType):
            parts.append(F.greatest(F.size(f.name), F.lit(0)) * 8 + 8)
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]).cast("long")


def bounded_rows(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes.

    A partial aggregate in every task; callers pass a persisted ``df`` where it is not cheap to make.
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_width(df)).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast hint behind a measured bound; otherwise leave the side to a shuffle join."""
    df = materialize(df)
    if bounded_rows(df, max_rows):
        return F.broadcast(df), True
    return df, False


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lodestar`` importable in Python workers (UDF closures refer to its modules).

    Equivalent of ``--py-files``: the package is zipped once per application and added
    with ``SparkContext.addPyFile``, which distributes it to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="lodestar-pyfiles-"), "lodestar.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith((".py", ".txt")):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
