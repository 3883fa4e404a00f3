"""Exact top-k search and hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from lodestar.llm import mtree, negatives
from lodestar.llm.vectors import dots, first_rows, pack, unpack
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, part string, tree string, score string, rank string"
_EXTRA = ("v", "d", "p", "t", "s", "r")


def clusters(n: int, dim: int = 8, seed: int = 3, copies: int = 60, groups: int = 12):
    """Rows around a few middles, a group of copies among them, ids in no order."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    x = middles[rng.integers(0, groups, n)] + 0.08 * rng.normal(size=(n, dim))
    x[:copies] = x[0]
    ids = rng.permutation(n * 3)[:n]
    return [(int(i), [float(c) for c in v], int(rng.integers(0, 4))) for i, v in zip(ids, x)]


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [
        (None, [1.0] * 8, 1),
        (100, None, 1),
        (150, [nan] + [1.0] * 7, 1),
        (200, [None] + [1.0] * 7, 1),
        (250, [inf] + [0.0] * 7, 1),
        (300, [], 1),
        (350, [], 2),
        (400, [1.0, 2.0], 1),
        (450, [2.0, 2.0], 3),
        (500, [0.0] * 8, 1),
        (550, [-0.001] * 8, None),
        (600, [0.5] * 8, 1),
        (600, [0.5] * 8, 1),  # a repeated row
        (-50, [0.5] * 8, 2),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *_EXTRA) for r in rows], SCHEMA).repartition(5)


def whole(rows):
    """(id, integer vector, label) of the rows that take part, as floats of 32 bits are read."""
    out = []
    for i, v, label in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, [math.floor(256 * float(np.float32(c))) for c in v], label))
    return out


def plain_top(rows, queries, k):
    rows, out = whole(rows), []
    for q, v in sorted({q: min(v for i, v, _ in whole(queries) if i == q) for q, _, _ in whole(queries)}.items()):
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w, _ in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("tree_rows, leaf, fan, pivots", [(8192, 256, 32, 4096), (60, 4, 3, 7)])
def test_top_k_equals_brute_force(spark, tree_rows, leaf, fan, pivots, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK", 13)
    rows = clusters(700) + odd_vectors()
    queries = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [(-1, [0.1] * 8, 0), (-2, [1.0] * 5, 0)]
    index = mtree.build_index(frame(spark, rows), tree_rows=tree_rows, leaf=leaf, fan=fan, pivots=pivots)
    got = [tuple(r) for r in mtree.top_k(index, frame(spark, queries), 5).collect()]
    assert sorted(got) == plain_top(rows, queries, 5)
    pages = index.pages.collect()
    assert max(len(p["ids"]) // 8 for p in pages) <= max(leaf, fan)
    assert sum(len(p["ids"]) // 8 for p in pages if p["leaf"]) == len(whole(rows))


def test_top_k_of_empty_tables(spark):
    none = frame(spark, [])
    assert mtree.top_k(mtree.build_index(none), frame(spark, clusters(20))).count() == 0
    assert mtree.top_k(mtree.build_index(frame(spark, clusters(20))), none).count() == 0


def as_tree(rows, leaf=8, fan=4):
    ids, x = np.array([i for i, _, _ in rows]), np.array([v for _, v, _ in rows], float)
    norm2 = float((x * x).sum(1).max())
    pages = dict(enumerate(mtree.load_tree(ids, x, norm2, leaf, fan)))
    return mtree.Tree(x.shape[1], pages, norm2), ids, x


def test_bounds_of_pages_hold_and_spare_distances():
    """Radii cover what is below, parent distances are true, and most distances are never worked out."""
    tree, ids, x = as_tree(whole(clusters(4000, groups=60)))
    for i in range(0, 400, 20):
        got = tree.search(x[i], int(ids[i]), 5)
        s = dots(x[i : i + 1], x)[0]
        s[i] = -(2**62)
        best = first_rows(s, ids, 5)
        assert got[0].tolist() == ids[best].tolist() and got[1].tolist() == s[best].tolist()
    assert tree.computed < 0.35 * 20 * len(ids) and tree.passed > 0

    def below(at):
        p = tree.pages[at]
        return list(p["objects"]) if p["leaf"] else [v for c in p["ids"] for v in below(int(c))]

    up = lambda v: mtree._lifted(np.array(v), tree.norm2)
    for p in tree.pages.values():
        for e in range(0 if p["leaf"] else len(p["ids"])):
            route, child = up(p["objects"][e : e + 1])[0], tree.pages[int(p["ids"][e])]
            assert mtree._distance(up(below(int(p["ids"][e]))), route).max() <= p["radius"][e] + 1e-9
            assert np.allclose(mtree._distance(up(child["objects"]), route), child["parent_distance"])


def test_copies_are_read_no_further_than_the_first(spark):
    """Of thousands of copies of the query, only pages with the smallest ids are opened."""
    rows = [(i, [100] * 6, 0) for i in range(5000)] + [(i, [99] * 6, 0) for i in range(5000, 5100)]
    tree, ids, x = as_tree(rows, 16, 8)
    got = tree.search(x[0], 4000, 5)
    assert got[0].tolist() == [0, 1, 2, 3, 4] and tree.computed < 200


def test_numbers_beyond_doubles_are_exact():
    big = np.array([[2.0**40, 3.0, -1.0]])
    assert dots(big, np.array([[2.0**20, 5.0, 7.0]]))[0, 0] == 2**60 + 15 - 7
    assert dots(big, big * 2.0**30)[0, 0] == 2**63 - 1
    for v in ([0, -5, 7], [70_000, 1, 2], [2**40, 1, -(2**35)]):
        assert unpack(pack(np.array(v, float)), 3, 1)[0].tolist() == v


# --- hard negatives ------------------------------------------------------------------------------------------------


def plain_negatives(rows, anchors, n_positives=5, n_negatives=3):
    rows, out = [(i, v, label) for i, v, label in whole(rows) if label is not None], []
    first = {}
    for i, v, label in rows:
        if anchors(i) and (i not in first or (len(v), label) < (len(first[i][0]), first[i][1])):
            first[i] = (v, label)
    for a, (v, label) in first.items():
        found = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, w, other in rows if i != a and len(w) == len(v))
        for s, i in [(-s, i) for s, i, same in found if same][:n_positives]:
            fits = [(-t, j) for t, j, same in found if not same and 50 * s <= -100 * t <= 95 * s]
            out += [(a, i, n + 1, j, s, t) for n, (t, j) in enumerate(fits[:n_negatives])]
    return sorted(out)


@pytest.mark.parametrize("block_rows, tile, bits", [(1024, 4096, 4), (16, 9, 3), (5, 4096, 1)])
def test_hard_negatives_equal_brute_force(spark, block_rows, tile, bits, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", tile)
    rows = clusters(500) + odd_vectors()
    blocks = negatives.candidate_blocks(frame(spark, rows), F.col("label"), F.col("vec_id") % 10 == 0, block_rows=block_rows, bits=bits)
    got = sorted(tuple(r) for r in negatives.hard_negatives(blocks).collect())
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert got == want and len(got) > 100
    for b in blocks.collect():
        ids = np.frombuffer(b["ids"], "<i8")
        x = unpack(b["vectors"], b["dim"], len(ids))
        assert len(ids) <= block_rows and b["first_id"] == ids.min()
        assert b["low"] == x.min(0).tobytes() and b["high"] == x.max(0).tobytes() if b["dim"] else True


def test_hard_negatives_of_odd_tables(spark):
    none = frame(spark, [])
    one = F.col("vec_id") % 10 == 0
    assert negatives.hard_negatives(negatives.candidate_blocks(none, F.col("label"), one)).count() == 0
    alone = frame(spark, [(i, [1.0, 2.0], 3) for i in range(40)])  # one label only
    assert negatives.hard_negatives(negatives.candidate_blocks(alone, F.col("label"), one)).count() == 0
    rows = [(i, [0.0, 0.0], i % 2) for i in range(40)]  # all scores zero: ties, and windows of one score
    got = sorted(tuple(r) for r in negatives.hard_negatives(negatives.candidate_blocks(frame(spark, rows), F.col("label"), one, block_rows=4)).collect())
    assert got == plain_negatives(rows, lambda i: i % 10 == 0) and len(got) == 60
    against = [(i, [1.0 if i % 2 else -1.0, 0.0], i % 3) for i in range(60)]  # negative scores
    got = sorted(tuple(r) for r in negatives.hard_negatives(negatives.candidate_blocks(frame(spark, against), F.col("label"), one)).collect())
    assert got == plain_negatives(against, lambda i: i % 10 == 0)


@pytest.mark.parametrize("dim, bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_curve_steps_to_a_neighbour(dim, bits):
    """Along the curve, each cell is visited once and differs from the next by one in one dimension."""
    cells = np.array(np.meshgrid(*[np.arange(2**bits)] * dim, indexing="ij")).reshape(dim, -1).T
    order = np.argsort(np.array(negatives.hilbert_keys(cells, bits), object), kind="stable")
    keys = negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    steps = np.abs(np.diff(cells[order].astype(int), axis=0)).sum(1)
    assert (steps == 1).all()


def test_zone_maps_bound_scores_and_spare_blocks():
    rng = np.random.default_rng(5)
    rows = np.array([v for _, v, _ in whole(clusters(3000, copies=0, groups=30))], float)
    step = (rows.max() - rows.min()) / 16
    keys = negatives.hilbert_keys(np.clip((rows - rows.min()) // step, 0, 15), 4)
    rows = rows[sorted(range(len(rows)), key=lambda r: keys[r])]
    blocks = [rows[i : i + 50] for i in range(0, 3000, 50)]
    low, high = np.stack([b.min(0) for b in blocks]), np.stack([b.max(0) for b in blocks])
    q = rows[rng.integers(0, 3000, 40)]
    least, most = negatives.score_bounds(q, low, high)
    s = np.stack([dots(q, b) for b in blocks], 1)
    assert (s.max(2) <= most).all() and (s.min(2) >= least).all()
    fifth = np.sort(dots(q, rows), 1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.5  # most blocks cannot hold a better row
