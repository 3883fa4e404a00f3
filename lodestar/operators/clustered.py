"""Dense cosine top-k for many queries (J7): clustered blocks of documents, skipped by the angle they span.

Documents go to the nearest of a bounded sample of pivots; those of one pivot, cut by a hash of the id where they are too many, are
blocks with a centre and the angle within which all their vectors lie. A query at angle t to the centre has no cosine above
``cos(t - angle)`` in the block. Each query reads the block of its own pivot first, and then such blocks as can hold a
score not below its k-th; copies that could only tie by a larger id are not read either. A block is sent to the
queries that name it, so neither side is replicated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestar.operators.tiling import in_parts, part_of, parts, tiles, visit
from lodestar.session import materialize

SCORE_DP = 6
# Documents of a block, queries or blocks' summaries in a task, and pivots at most.
BLOCK_ROWS, TILE_ROWS, PIVOTS = 4096, 4096, 2048
ROOM = 1e-9


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _matrix(table: pa.Table, column: str = "vec") -> np.ndarray:
    rows = table.column(column).combine_chunks() if table.num_rows else None
    return np.zeros((0, 0)) if rows is None else rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)


def _assigned(df: DataFrame, key: str, pivots: np.ndarray) -> DataFrame:
    """``(key, cell, vec)``: unit vectors and their nearest pivot (-1: a zero vector)."""
    kind = to_arrow_type(df.schema[key].dataType)

    def run(batches):
        for batch in batches:
            x = _unit(_matrix(pa.Table.from_batches([batch])))
            cell = np.argmax(x @ pivots.T, axis=1) if len(pivots) and len(x) else np.zeros(len(x), int)
            if len(x):
                cell = np.where((x != 0).any(axis=1), cell, -1)
            vec = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] if len(x) else 0), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(cell, pa.int32()), vec], [key, "cell", "vec"])

    return df.select(key, F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, cell int, vec array<double>")


def _blocked(rows: DataFrame, key: str, cells: DataFrame) -> DataFrame:
    block = F.concat_ws("/", "cell", F.pmod(F.xxhash64(key), F.coalesce("n_blocks", F.lit(1))))
    return rows.join(cells, "cell", "left").select(key, "vec", block.alias("block"))


class ClusteredDocs:
    """Blocks of documents ``(doc_id, vec)``: ids in order, unit vectors, centre and the cosine of their angle."""

    def __init__(self, docs: DataFrame, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS) -> None:
        id_type = docs.schema["doc_id"].dataType
        n = docs.count()
        sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(min(parts(n, block_rows), pivots)).collect()
        centers = _unit(np.array([list(r["vec"]) for r in sample], np.float64)) if sample else np.zeros((0, 0))
        self.pivots = centers[(centers != 0).any(axis=1)] if len(centers) else centers
        dealt = materialize(_assigned(docs, "doc_id", self.pivots), reliable=True)
        self.cells = materialize(dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("n_blocks")))
        kind = to_arrow_type(id_type)

        def pack(key, rows):
            rows = rows.sort_by("doc_id")
            x = _matrix(rows)
            center = _unit(x.sum(axis=0, keepdims=True))[0]
            cols = [pa.array([key[0].as_py()]), pa.array([rows.column("doc_id").to_pylist()], pa.list_(kind)), pa.array([x.tobytes()]), pa.array([center.tobytes()]), pa.array([float(np.clip((x @ center).min(), -1, 1))])]
            return pa.Table.from_arrays(cols, ["block", "ids", "vectors", "center", "spread"])

        schema = f"block string, ids array<{id_type.simpleString()}>, vectors binary, center binary, spread double"
        self.blocks = materialize(_blocked(dealt, "doc_id", self.cells).groupBy("block").applyInArrow(pack, schema), reliable=True)
        self.id_type = id_type


def _greatest(q: np.ndarray, zones: pa.Table) -> np.ndarray:
    """Greatest rounded cosine of each query with any vector of each block."""
    centers = np.stack([np.frombuffer(c) for c in zones.column("center").to_pylist()])
    away = np.arccos(np.clip(q @ centers.T, -1, 1)) - np.arccos(zones.column("spread").to_numpy())
    return np.round(np.cos(np.maximum(away, 0)) + ROOM, SCORE_DP)


def _search(key, asks: pa.Table, block: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    if not asks.num_rows or not block.num_rows:
        return schema.empty_table()
    q = _matrix(asks)
    ids = np.array(block.column("ids")[0].as_py(), object)
    x = np.frombuffer(block.column("vectors")[0].as_py()).reshape(len(ids), -1)
    qid, out, kk = np.array(asks.column("query_id").to_pylist(), object), [], min(k, len(ids))
    for lo in range(0, len(q), 1024):
        s = np.round(x @ q[lo : lo + 1024].T, SCORE_DP)
        best = np.argsort(-s, axis=0, kind="stable")[:kk]  # rows are in order of id: ties to the smaller
        out.append((np.repeat(qid[lo : lo + 1024], kk), ids[best.T.ravel()], np.take_along_axis(s, best, axis=0).T.ravel()))
    return pa.Table.from_arrays([pa.array(np.concatenate(c).tolist(), t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def clustered_topk(queries: DataFrame, docs: ClusteredDocs, k: int) -> tuple[DataFrame, DataFrame]:
    """``(query_id, doc_id, score)`` rows among which are the ``k`` best of each query, and ``(block, query_id)``: what was read."""
    q_type = queries.schema["query_id"].dataType
    hit = f"query_id {q_type.simpleString()}, doc_id {docs.id_type.simpleString()}, score double"
    arrow = pa.schema([("query_id", to_arrow_type(q_type)), ("doc_id", to_arrow_type(docs.id_type)), ("score", pa.float64())])
    look = lambda key, asks, block: _search(key, asks, block, k, arrow)
    asked = materialize(_blocked(_assigned(queries, "query_id", docs.pivots), "query_id", docs.cells).withColumnRenamed("block", "own"), reliable=True)
    home = asked.select("query_id", "vec", F.col("own").alias("block"))
    early = materialize(visit(in_parts(home, "block", "query_id", TILE_ROWS), docs.blocks, "block", look, hit))
    upto = early.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "doc_id"))).alias("h")).where(F.size("h") >= k)  # k a query
    kth = upto.select("query_id", (-F.col("h")[k - 1]["s"]).alias("least"), F.col("h")[k - 1]["doc_id"].alias("least_id"))
    n_parts, n_chunks = parts(asked.count(), TILE_ROWS), parts(docs.blocks.count(), TILE_ROWS)
    zones = docs.blocks.select("block", "center", "spread", F.col("ids")[0].alias("first")).withColumn("chunk", part_of("block", n_chunks))
    asks = asked.join(kth, "query_id", "left").withColumn("part", part_of("query_id", n_parts))

    def route(key, a: pa.Table, z: pa.Table) -> pa.Table:
        keep = a.select(["query_id", "vec"])
        if not a.num_rows or not z.num_rows:
            return keep.slice(0, 0).append_column("block", pa.array([], pa.string()))
        most = _greatest(_matrix(a), z)
        least = np.array([-np.inf if v is None else v for v in a.column("least").to_pylist()])[:, None]
        first, last = (np.array(t.column(c).to_pylist(), object) for t, c in ((z, "first"), (a, "least_id")))
        later = np.array([[lid is not None and f > lid for f in first] for lid in last], bool) if (most == least).any() else np.zeros(most.shape, bool)
        read = (most > least) | ((most == least) & ~later)
        read &= np.array(a.column("own").to_pylist(), object)[:, None] != np.array(z.column("block").to_pylist(), object)
        i, j = np.nonzero(read)
        return keep.take(pa.array(i)).append_column("block", z.column("block").take(pa.array(j)))

    route.__annotations__ = {}
    more = materialize(tiles(asks, n_parts, zones, n_chunks, route, f"query_id {q_type.simpleString()}, vec array<double>, block string"), reliable=True)
    late = visit(in_parts(more, "block", "query_id", TILE_ROWS), docs.blocks, "block", look, hit)
    read = home.select("block", "query_id").unionByName(more.select("block", "query_id"))
    return early.unionByName(late), read
