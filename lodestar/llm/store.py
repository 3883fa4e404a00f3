"""Written intermediate tables and row identity shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir

#: Order given to a null document id: after every real one.
NULL_ORDER = 2**63 - 1
#: Documents in an Arrow batch, and bytes from which it is closed.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors.

    Shuffle files that only the written plan needed become garbage here; asking the driver's
    collector to run lets Spark's cleaner remove them now instead of at some later time.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    for made in _SCOPES:
        made.append(path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.parquet(path)


_SCOPES: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that ``stored`` makes inside are deleted at the end, except those given to the function that this yields.

    For callers that have written what they want: a DataFrame that still reads a table of the scope cannot be used after it.
    """
    made: list[str] = []
    keep: set[str] = set()

    def kept(df: DataFrame) -> DataFrame:
        keep.update(f.rsplit("/", 1)[0] for f in df.inputFiles())
        return df

    _SCOPES.append(made)
    try:
        yield kept
    finally:
        _SCOPES.remove(made)
        names = {k.rsplit("/", 1)[-1] for k in keep}
        for path in made:
            if path.rsplit("/", 1)[-1] not in names:
                _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by ``stored`` once no later plan reads it."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, folder)


def bounded_batches(df: DataFrame) -> None:
    """Rows go to Python workers at most ``BATCH_ROWS`` at a time in this session: texts can be long, and a batch
    is held by the executor and its worker at once. So do the bytes of a batch. Smaller settings stay."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).lower()
        size = int(now.rstrip("bkmgi")) << {"k": 10, "m": 20, "g": 30}.get(now.strip("0123456789-")[:1], 0)
        if not 0 < size <= most:
            conf.set(key, str(most))


def row_order(id_col: str) -> Column:
    """Sort position of a document id; null ids come last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ORDER))
