"""Exact top-k search by inner product: best-first search in M-trees of paged metric nodes.

Inner products become distances: with M the greatest norm of the table, a row x gets one more component
sqrt(M^2 - |x|^2) and a query q a zero, so d(q, x)^2 = |q|^2 + M^2 - 2 q.x, and the nearest rows are those of the
highest products.

The index. Rows go to the nearest of a bounded set of pivots, and the rows of a pivot, dealt by a hash of their id where they
are too many, become M-trees of ``TREE_ROWS`` rows or so. A tree is loaded in one task: routing objects from its rows, each row to the
nearest, and so on until a leaf page holds what is left. Each entry of a page has its distance to the routing object
of that page (its parent distance), those of inner pages the covering radius of what is below. Pages are rows of a
Parquet table; page 0 of a tree has one entry, its root.

The search. A query searches one tree first, which gives it a k-th best score. Then the roots' radii tell which
trees can hold better rows, and those are searched. Inside a tree the pages wait in a queue by the least distance that
their rows can have; the search ends where that is beyond the k-th best. Of an opened page, entries whose parent distance
differs from the query's by more than that (and the radius) are passed over by the triangle inequality, without a
distance of their own. Ties go to the smaller id: a page whose smallest id comes after the k-th best's cannot win a tie, so copies
of one vector in any number are read no further than their first k.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.store import bounded_batches, drop_stored, stored
from lodestar.llm.vectors import dots, first_rows, matrices, numbers, pack, unpack, vector_rows
from lodestar.operators.tiling import in_parts, part_of, parts, tiles, visit

#: Rows of a tree, rows of a leaf page, entries of an inner page, pivots (the sample on which the index is fitted), and
#: queries or roots that one task holds at a time.
TREE_ROWS, LEAF, FAN, PIVOTS, BLOCK = 8192, 256, 32, 4096, 4096

_PAGE = "tree string, dim int, page int, leaf boolean, ids binary, objects binary, parent_distance binary, radius binary, first_id binary, norm2 double"
_HIT = "query_id long, vec_id long, score long, rank int"
_NO_ID = np.iinfo(np.int64).max


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """Rows with the further component by which all have the same norm."""
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x * x).sum(1, keepdims=True), 0))])


def _distance(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - to) ** 2).sum(1))


# --- loading a tree ------------------------------------------------------------------------------------------------


def load_tree(ids: np.ndarray, x: np.ndarray, norm2: float, leaf: int = LEAF, fan: int = FAN) -> list[dict]:
    """Pages of one M-tree over the rows; page 0 has the root's entry."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    up = _lifted(x, norm2)
    pages: list[dict] = [{}]

    def page(rows: np.ndarray, center: np.ndarray) -> int:
        at = len(pages)
        pages.append({})
        if len(rows) <= leaf:
            pages[at] = {"leaf": True, "ids": ids[rows], "objects": x[rows], "parent_distance": _distance(up[rows], center), "radius": None, "first_id": None}
            return at
        entries = _cells(rows, up, min(fan, -(-len(rows) // leaf)))
        children = [page(cell, up[route]) for route, cell in entries]
        pages[at] = _inner(entries, children, center)
        return at

    def _inner(entries: list, children: list, center: np.ndarray | None) -> dict:
        routes = np.array([r for r, _ in entries])
        return {
            "leaf": False,
            "ids": np.array(children),
            "objects": x[routes],
            "parent_distance": _distance(up[routes], center) if center is not None else np.zeros(len(routes)),
            "radius": np.array([_distance(up[cell], up[route]).max() for route, cell in entries]),
            "first_id": np.array([ids[cell[0]] for _, cell in entries]),
        }

    every = np.arange(len(ids))
    root = int(np.argmin(_distance(up, up.mean(0))))  # the row in the middle
    pages[0] = _inner([(root, every)], [page(every, up[root])], None)
    return pages


def _cells(rows: np.ndarray, up: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Routing rows and the rows of each, in order of id. Where one would have most of them, as copies do, they are dealt in runs of ids."""
    routes = rows[np.linspace(0, len(rows) - 1, n).astype(int)]
    near = np.argmax(up[rows] @ up[routes].T, axis=1)
    sizes = np.bincount(near, minlength=n)
    if sizes.max() > 0.75 * len(rows):
        runs = np.array_split(rows, n)
        return [(int(run[0]), run) for run in runs]
    return [(int(routes[c]), rows[near == c]) for c in range(n) if sizes[c]]


def _load(key: tuple, rows: pa.Table, norms: dict, leaf: int, fan: int) -> pa.Table:
    tree, dim = key[0].as_py(), key[1].as_py()
    ids = rows.column("vec_id").to_numpy()
    x = np.concatenate([unpack(v, dim, 1) for v in rows.column("v").to_pylist()])
    pages = load_tree(ids, x, norms[dim], leaf, fan)
    raw = lambda v, kind: None if v is None else v.astype(kind).tobytes()
    out = [
        (tree, dim, n, p["leaf"], raw(p["ids"], "<i8"), pack(p["objects"]), raw(p["parent_distance"], "<f8"), raw(p["radius"], "<f8"), raw(p["first_id"], "<i8"), norms[dim])
        for n, p in enumerate(pages)
    ]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PAGE_TYPES)], [c.split()[0] for c in _PAGE.split(", ")])


_PAGE_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 5, pa.float64())


# --- searching a tree ----------------------------------------------------------------------------------------------


class Tree:
    """Pages of one tree in a task's memory. ``computed`` counts distances worked out, ``passed`` those avoided."""

    def __init__(self, dim: int, pages: dict[int, dict], norm2: float) -> None:
        self.dim, self.pages, self.norm2 = dim, pages, norm2
        self.computed = self.passed = 0

    @classmethod
    def of_rows(cls, rows: pa.Table) -> Tree:
        pages = {}
        dim = rows.column("dim")[0].as_py()
        for r in rows.to_pylist():
            n = len(r["ids"]) // 8
            pages[r["page"]] = {
                "leaf": r["leaf"],
                "ids": numbers(r["ids"]),
                "objects": unpack(r["objects"], dim, n),
                "parent_distance": numbers(r["parent_distance"], "<f8"),
                "radius": None if r["leaf"] else numbers(r["radius"], "<f8"),
                "first_id": None if r["leaf"] else numbers(r["first_id"]),
            }
        return cls(dim, pages, rows.column("norm2")[0].as_py())

    def search(self, q: np.ndarray, own: int, k: int, least: int | None = None, least_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but ``own``; only such as beat the row ``least_id`` of score ``least``, where one is given."""
        q2 = float(q @ q) + self.norm2
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound, bound_id = (least, least_id) if least is not None else (None, None)
        queue = [(0.0, -1, 0, None)]  # least distance, smallest id, page, distance to the page's routing object
        while queue:
            low, first, at, to_parent = heapq.heappop(queue)
            if bound is not None:
                beyond, tied = _limits(q2, bound)
                if low * low > beyond:
                    break  # all that wait are at least as far
                if low * low > tied and first > bound_id:
                    continue
            page = self.pages[at]
            n, radius = len(page["ids"]), 0.0 if page["leaf"] else page["radius"]
            open_ = np.arange(n)
            if to_parent is not None and bound is not None:
                gap = np.abs(to_parent - page["parent_distance"]) - radius
                open_ = np.flatnonzero(~((gap > 0) & (gap * gap > beyond)))
                self.passed += n - len(open_)
            found = dots(q[None], page["objects"][open_])[0]
            self.computed += len(open_)
            if page["leaf"]:
                of = page["ids"][open_]
                keep = of != own
                if bound is not None:
                    keep &= (found > bound) | ((found == bound) & (of < bound_id))
                if keep.any():
                    ids, scores = np.concatenate([ids, of[keep]]), np.concatenate([scores, found[keep]])
                    best = first_rows(scores, ids, k)
                    ids, scores = ids[best], scores[best]
                    if len(ids) == k:
                        bound, bound_id = int(scores[-1]), int(ids[-1])
            else:
                away = np.sqrt(np.maximum(q2 - 2.0 * found, 0))
                lows = np.maximum(away - page["radius"][open_], 0)
                for e, d, b in zip(open_.tolist(), away.tolist(), lows.tolist()):
                    heapq.heappush(queue, (b, int(page["first_id"][e]), int(page["ids"][e]), d))
        return ids, scores


def _limits(q2, bound):
    """Squares of distances beyond the first have scores under ``bound``, beyond the second no higher scores.

    Scores are whole numbers, so squares of distances step by two; half of one is left for rounding.
    """
    d2, room = q2 - 2.0 * bound, 1e-12 * q2
    return d2 + 0.5 + room, d2 - np.where(room < 0.5, 0.5 - room, -np.inf)


# --- on Spark ------------------------------------------------------------------------------------------------------


class Index:
    """Pages in the shared folder, with the pivots and the number of trees of each that say where a row's tree is."""

    def __init__(self, pages: DataFrame, norms: dict[int, float], pivots: dict[int, np.ndarray], cells: DataFrame) -> None:
        self.pages, self.norms, self.pivots, self.cells = pages, norms, pivots, cells


def build_index(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", tree_rows: int = TREE_ROWS, leaf: int = LEAF, fan: int = FAN, pivots: int = PIVOTS) -> Index:
    """M-trees over every row of ``rows`` that has an id and a vector without null or non-finite components.

    Rows with the same id or the same vector are rows of their own. Vectors of another length than a query's are never
    its neighbours; each length has trees of its own. At most ``pivots`` rows a length, those of least hash, are the sample
    on which the index is fitted; every row is in a tree.
    """
    bounded_batches(rows)
    given = stored(vector_rows(rows, id_col, vec_col), "vectors")
    sized = given.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + F.floor(x) * F.floor(x))).alias("norm2"))
    by_dim = {r["dim"]: r for r in sized.collect()}
    norms = {d: float(r["norm2"]) for d, r in by_dim.items()}
    centers = {}
    for d, r in by_dim.items():
        chosen = given.where(F.col("dim") == d).orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(parts(r["n"], tree_rows), pivots)).collect()
        centers[d] = np.floor(np.array([list(c["v"]) for c in chosen], np.float64).reshape(len(chosen), d))
    dealt = stored(given.mapInArrow(partial(_assign, pivots=centers, norms=norms), "vec_id long, dim int, pivot int, v binary"), "dealt")
    cells = stored(dealt.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / tree_rows).alias("n_trees")), "cells")
    pages = _in_trees(dealt, cells).groupBy("tree", "dim").applyInArrow(lambda key, rows: _load(key, rows, norms, leaf, fan), _PAGE)
    pages = stored(pages, "m-tree")
    for table in (given, dealt):
        drop_stored(table)
    return Index(pages, norms, centers, cells)


def _in_trees(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The name of each row's tree, from its length, its pivot and a hash of its id."""
    tree = F.concat_ws("-", "dim", "pivot", F.pmod(F.xxhash64("vec_id"), F.coalesce("n_trees", F.lit(1))))
    return rows.join(cells, ["dim", "pivot"], "left").select("vec_id", "dim", "v", tree.alias("tree"))


def _assign(batches, pivots: dict, norms: dict):
    """The nearest pivot of each row."""
    for batch in batches:
        ids, dims = batch.column("vec_id"), batch.column("dim")
        near, packed = np.zeros(batch.num_rows, np.int32), [b""] * batch.num_rows
        for at, x in matrices(batch):
            norm2 = norms.get(x.shape[1])
            if norm2 is not None and x.shape[1]:
                near[at] = np.argmax(_lifted(x, norm2) @ _lifted(pivots[x.shape[1]], norm2).T, axis=1)
            for r, v in zip(at.tolist(), x):
                packed[r] = pack(v)
        yield pa.RecordBatch.from_arrays([ids, dims, pa.array(near, pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "dim", "pivot", "v"])


_ASK = "query_id long, dim int, v binary, tree string, least long, least_id long"


def _route(key: tuple, asks: pa.Table, roots: pa.Table) -> pa.Table:
    """Each query of the block with each tree that can hold rows better than its k-th best, but the tree it has searched."""
    out = [asks.slice(0, 0)]
    for dim in pc.unique(roots.column("dim")).to_pylist():
        trees = roots.filter(pc.equal(roots.column("dim"), dim))
        mine = asks.filter(pc.equal(asks.column("dim"), dim))
        centers = np.concatenate([unpack(v, dim, 1) for v in trees.column("objects").to_pylist()])
        radius = np.array([numbers(v, "<f8")[0] for v in trees.column("radius").to_pylist()])
        first = np.array([numbers(v)[0] for v in trees.column("first_id").to_pylist()])
        q = np.concatenate([np.zeros((0, dim)), *(unpack(v, dim, 1) for v in mine.column("v").to_pylist())])
        q2 = (q * q).sum(1) + trees.column("norm2")[0].as_py()
        low = np.maximum(np.sqrt(np.maximum(q2[:, None] - 2.0 * dots(q, centers), 0)) - radius, 0) ** 2
        bounded = pc.is_valid(mine.column("least")).to_numpy(zero_copy_only=False)
        beyond, tied = _limits(q2, pc.fill_null(mine.column("least"), 0).to_numpy().astype(np.float64))
        kth = pc.fill_null(mine.column("least_id"), 0).to_numpy()
        out_of_reach = (low > beyond[:, None]) | ((low > tied[:, None]) & (first > kth[:, None]))
        searched = np.array(mine.column("tree").to_pylist(), object)[:, None] == np.array(trees.column("tree").to_pylist(), object)
        a, t = np.nonzero(~(out_of_reach & bounded[:, None]) & ~searched)
        named = mine.take(pa.array(a))
        out.append(named.set_column(named.schema.get_field_index("tree"), "tree", trees.column("tree").take(pa.array(t))))
    return pa.concat_tables(out).select([c.split()[0] for c in _ASK.split(", ")])


def _search(key: tuple, asks: pa.Table, pages: pa.Table, k: int) -> pa.Table:
    out: list[tuple] = []
    if asks.num_rows and pages.num_rows:
        tree = Tree.of_rows(pages)
        for a in asks.to_pylist():
            ids, scores = tree.search(unpack(a["v"], tree.dim, 1)[0], a["query_id"], k, a["least"], a["least_id"])
            out += [(a["query_id"], i, s, n + 1) for n, (i, s) in enumerate(zip(ids.tolist(), scores.tolist()))]
    cols = list(zip(*out)) or [[]] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["query_id", "vec_id", "score", "rank"])


def top_k(index: Index, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of highest inner product for each query, ties to smaller ids; all, if fewer.

    Components are ``floor(256 * x)``. A row with the query's own id is not returned. Queries without an id or a usable vector
    have no rows; a query id that comes more than once has its smallest vector. Scores beyond 64 bits are held at the
    ends of the range.
    """
    bounded_batches(queries)
    asked = vector_rows(queries, id_col, vec_col).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("m")).select("vec_id", "m.*")
    asked = asked.mapInArrow(partial(_assign, pivots=index.pivots, norms=index.norms), "vec_id long, dim int, pivot int, v binary")
    asked = stored(_in_trees(asked, index.cells).withColumnRenamed("vec_id", "query_id"), "queries")
    none = F.lit(None).cast("long")
    search = lambda key, asks, pages: _search(key, asks, pages, k)
    home = asked.withColumns({"least": none, "least_id": none})
    early = stored(visit(in_parts(home, "tree", "query_id", BLOCK), index.pages, "tree", search, _HIT), "early-hits")
    kth = early.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
    n_parts, n_chunks = parts(asked.count(), BLOCK), parts(index.cells.agg(F.sum("n_trees")).first()[0] or 0, BLOCK)
    roots = index.pages.where("page = 0").select("tree", "dim", "objects", "radius", "first_id", "norm2")
    known = asked.join(kth, "query_id", "left").withColumn("part", part_of("query_id", n_parts))
    more = stored(tiles(known, n_parts, roots.withColumn("chunk", part_of("tree", n_chunks)), n_chunks, _route, _ASK), "routed")
    late = visit(in_parts(more, "tree", "query_id", BLOCK), index.pages, "tree", search, _HIT)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    every = early.unionByName(late).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return every.select("query_id", "rank", "vec_id", "score")
