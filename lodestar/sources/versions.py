"""Sets of tables that are published together (S5, S6): a reader sees the old set or the new one, never a mix.

Every publication writes its tables to a folder of its own and then one small manifest that names them; the manifest gets its
final name, one higher than the last, when it is complete. Readers take the highest manifest. Tables of an earlier version can be
kept and rows added to them: the manifest then names the folders of both. A job that dies leaves a folder that no manifest names.

A table may be bucketed. It is then read through the session's catalog, so lookups by the bucket columns open one bucket
and joins on them need no exchange of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Layout:
    """How a table is laid out: ``buckets`` of a hash of the columns ``by`` (0: none), rows sorted by ``sort``."""

    by: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    buckets: int = 0


@dataclass
class Version:
    number: int
    tables: dict[str, dict] = field(default_factory=dict)
    about: dict = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    p, fs = _path(spark, f"{path}/manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _switch(spark: SparkSession, path: str, version: Version) -> bool:
    """Give the complete manifest its name; False if another publication took the number."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    draft, fs = _path(spark, f"{path}/manifests/draft-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"tables": version.tables, "about": version.about}).encode()))
    out.close()
    final, _ = _path(spark, f"{path}/manifests/{version.number:012d}.json")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:  # a rename that replaces nothing
        files.rename(draft, final, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        fs.delete(draft, False)
        return False
    return True


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that readers see, if there is one."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    text = spark.read.text(f"{path}/manifests/{numbers[-1]:012d}.json", wholetext=True).first()[0]
    return Version(numbers[-1], **json.loads(text))


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], layouts: dict[str, Layout] | None = None, about: dict | None = None, add_to: Iterable[str] = ()) -> Version:
    """Write the tables and switch readers to them. Rows of the tables ``add_to`` join those that the current version has (tables of
    plain layout only); tables that are not given are no longer part of the set."""
    folder, layouts, add_to = f"{path}/versions/{uuid.uuid4().hex}", layouts or {}, set(add_to)
    made = {}
    for name, df in tables.items():
        layout = layouts.get(name, Layout())
        if layout.buckets:
            table = f"publish_{uuid.uuid4().hex}"
            out = df.repartition(layout.buckets, *layout.by).write.bucketBy(layout.buckets, *layout.by)
            (out.sortBy(*layout.sort) if layout.sort else out).format("parquet").option("path", f"{folder}/{name}").saveAsTable(table)
            spark.sql(f"DROP TABLE {table}")  # of the catalog; the files stay
        else:
            out = df.repartitionByRange(*layout.by).sortWithinPartitions(*(layout.sort or layout.by)) if layout.by else df
            out.write.parquet(f"{folder}/{name}")
        made[name] = {"folders": [f"{folder}/{name}"], "schema": df.schema.json(), "by": layout.by, "sort": layout.sort, "buckets": layout.buckets}
    while True:
        now = current(spark, path)
        tables_now = {n: dict(t) for n, t in made.items()}
        for name in add_to if now else ():
            if made[name]["buckets"] or now.tables.get(name, {}).get("buckets"):
                raise ValueError(f"rows cannot be added to the bucketed table {name}")
            tables_now[name]["folders"] = now.tables.get(name, {"folders": []})["folders"] + made[name]["folders"]
        version = Version((now.number if now else 0) + 1, tables_now, about or {})
        if _switch(spark, path, version):
            return version


def read_version(spark: SparkSession, path: str, version: Version | None = None) -> dict[str, DataFrame]:
    """The tables of the current (or the given) version."""
    version = version or current(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return {name: _table(spark, about) for name, about in version.tables.items()}


def _table(spark: SparkSession, about: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(about["schema"]))
    if not about["buckets"]:
        return spark.read.schema(schema).parquet(*about["folders"])
    name = f"published_{uuid.uuid5(uuid.NAMESPACE_URL, about['folders'][0]).hex}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        cluster = ", ".join(f"`{c}`" for c in about["by"])
        order = f" SORTED BY ({', '.join(f'`{c}`' for c in about['sort'])})" if about["sort"] else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({cluster}){order} INTO {about['buckets']} BUCKETS LOCATION '{about['folders'][0]}'")
    return spark.table(name)
