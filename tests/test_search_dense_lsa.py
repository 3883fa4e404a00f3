"""Searches vs brute force, dense cosine vs numpy, LSA vs numpy SVD."""

import math
import random

import numpy as np
import pytest

from lodestar.operators import lsa as L
from lodestar.operators.dense import centroids, dense_cosine_topk
from lodestar.operators import fuzzy
from lodestar.operators.fuzzy import fuzzy_title_search
from lodestar.operators.search import first_n, title_search


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


TITLES = [
    ("Don’t Stop", "alt one", "d0"),
    ("Kitten", "Little Cat", "d1"),
    ("sitting", "Seat", "d2"),
    ("Kitten", "Other", "d3"),
    ("ab", "x", "d4"),
    ("The Red Ring", "rr", "d5"),
]


def titles_df(spark):
    rows = [(i, [a, b], a, d) for i, (a, b, d) in enumerate(TITLES)]
    return spark.createDataFrame(rows, "idx long, titles array<string>, title string, descr string")


def test_edit_distance_fixture():
    assert lev("kitten", "sitting") == 3


def test_title_search_rules(spark):
    reqs = spark.createDataFrame([("q1", "don't"), ("q2", ""), ("q3", "KITT"), ("q4", "cat"), ("q5", "t")], "request_id string, query string")
    got = {(r["request_id"], r["title"], r["idx"]) for r in title_search(titles_df(spark), reqs).collect()}
    assert ("q1", "Don’t Stop", 0) in got  # apostrophe normalised on the title side
    assert not any(r[0] == "q2" for r in got)  # empty query: nothing
    assert {r for r in got if r[0] == "q3"} == {("q3", "Kitten", 1)}  # dedupe, first wins
    assert ("q4", "Kitten", 1) in got  # match on a secondary title
    # brute force for a one-letter query
    want = {}
    for i, (a, b, _) in enumerate(TITLES):
        if any("t" in x.lower().replace("’", "'") for x in (a, b)):
            want.setdefault(a, i)
    assert {(t, i) for q, t, i in got if q == "q5"} == set(want.items())


def test_first_n(spark):
    reqs = spark.createDataFrame([("q", "t")], "request_id string, query string")
    top = first_n(title_search(titles_df(spark), reqs), 2).collect()
    assert sorted(r["idx"] for r in top) == [0, 1]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_fuzzy_matches_brute_force(spark, k):
    rnd = random.Random(k)
    names = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 9))) for _ in range(80)]
    t = spark.createDataFrame([(i, [n], n, "") for i, n in enumerate(names)], "idx long, titles array<string>, title string, descr string")
    queries = ["abc", "a", "ba", "eeeee", "abcdeabcd", "dd"]
    reqs = spark.createDataFrame([(q, q) for q in queries], "request_id string, query string")
    got = {}
    for r in fuzzy_title_search(t, reqs, max_distance=k, top=10).collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["idx"], r["distance"]))
    for q in queries:
        want = sorted(((lev(q, n), i) for i, n in enumerate(names) if lev(q, n) <= k))[:10]
        assert [(i, d) for _, i, d in sorted(got.get(q, []))] == [(i, d) for d, i in want], q


def test_fuzzy_far_requests_compare_few_titles(spark):
    """Requests far from every title: their answers are those of brute force, from under a twentieth of all pairs."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(400)]
    names = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 8))) for _ in range(3000)})
    rnd.shuffle(names)
    names += names[:500]  # equal titles
    t = spark.createDataFrame([(i, n.title()) for i, n in enumerate(names)], "idx long, title string")
    far = ["#7-99 xq", "0123456789", "zzzzzzzz", "qqq vvv qqq vvv", "", "é漢字", "ab"]
    reqs = spark.createDataFrame([(q, q) for q in far], "request_id string, query string")
    got = {}
    for r in fuzzy_title_search(t, reqs, top=10).collect():
        got.setdefault(r["request_id"], []).append((r["distance"], r["idx"]))
    for q in far:
        assert sorted(got[q]) == sorted((lev(q, n), i) for i, n in enumerate(names))[:10], q
    table, queries = fuzzy.TitleTable(t, 10), fuzzy.queries_of(reqs)
    wide = queries.join(fuzzy.radii(table, queries), "q").withColumnRenamed("radius", "k")
    pairs = fuzzy.compared(fuzzy.bounded(table, wide), 10).groupBy("q").count().collect()
    assert max(r["count"] for r in pairs) < 0.05 * len(names)


def test_fuzzy_ranks_every_title(spark):
    """Ten answers whatever the distance: near and far requests, and fewer titles than answers."""
    rnd = random.Random(9)
    names = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 14))) for _ in range(60)]
    queries = ["alfa sentory x", "zzzzzzzzzzzz", "", names[3], names[4][:-1] + "qqqq", "z"]
    for n, top in ((60, 10), (4, 10)):
        t = spark.createDataFrame([(i, [x], x, "") for i, x in enumerate(names[:n])], "idx long, titles array<string>, title string, descr string")
        reqs = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "request_id int, query string")
        got = {}
        for r in fuzzy_title_search(t, reqs, top=top).collect():
            got.setdefault(r["request_id"], []).append((r["rank"], r["distance"], r["idx"]))
        for i, q in enumerate(queries):
            want = sorted((lev(q, x), j) for j, x in enumerate(names[:n]))[:top]
            assert [(d, j) for _, d, j in sorted(got[i])] == want, q


def test_dense_cosine_takes_string_ids(spark):
    from lodestar.operators.dense import dense_cosine_topk

    docs = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "doc_id string, vec array<double>")
    q = spark.createDataFrame([("q1", [2.0, 0.0]), ("q2", [0.0, 0.0])], "query_id string, vec array<double>")
    for block in (10, 1):
        got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in dense_cosine_topk(q, docs, 2, block_rows=block).collect()}
        assert got == {("q1", 1): ("a", 1.0), ("q1", 2): ("b", 1.0), ("q2", 1): ("a", 0.0), ("q2", 2): ("b", 0.0)}


def test_dense_cosine_matches_numpy(spark):
    rng = np.random.default_rng(0)
    docs = rng.normal(size=(50, 8))
    docs[3] = 0.0
    qs = rng.normal(size=(4, 8))
    d = spark.createDataFrame([(i, docs[i].tolist()) for i in range(50)], "doc_id long, vec array<double>")
    q = spark.createDataFrame([(i, qs[i].tolist()) for i in range(4)], "query_id long, vec array<double>")
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in dense_cosine_topk(q, d, 3).collect()}
    dn = np.linalg.norm(docs, axis=1)
    for qi in range(4):
        cos = np.where(dn > 0, docs @ qs[qi] / (np.where(dn > 0, dn, 1) * np.linalg.norm(qs[qi])), 0.0)
        order = sorted(range(50), key=lambda i: (-round(cos[i], 6), i))[:3]
        for rank, i in enumerate(order, 1):
            assert got[(qi, rank)][0] == i and math.isclose(got[(qi, rank)][1], round(cos[i], 6), abs_tol=1e-9)


def test_dense_cosine_in_blocks(spark):
    rng = np.random.default_rng(1)
    d = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(30)], "doc_id long, vec array<double>")
    q = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(9)], "query_id long, vec array<double>")
    one = sorted(tuple(r) for r in dense_cosine_topk(q, d, 2).collect())
    blocked = sorted(tuple(r) for r in dense_cosine_topk(q, d, 2, block_rows=2).collect())
    assert one == blocked


def test_clustered_blocks_are_skipped(spark, monkeypatch):
    """Many queries over clustered vectors, zero vectors and many copies: brute force's rows, from a part of the blocks."""
    from lodestar.operators import clustered

    monkeypatch.setattr(clustered, "TILE_ROWS", 17)
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(12, 6))
    docs = middles[rng.integers(0, 12, 900)] + 0.05 * rng.normal(size=(900, 6))
    docs[100:400] = docs[100]  # copies
    docs[7] = docs[8] = 0.0
    qs = docs[rng.integers(0, 900, 80)] + 0.01 * rng.normal(size=(80, 6))
    qs[0], qs[1] = 0.0, docs[100]
    d = spark.createDataFrame([(f"d{i:04}", docs[i].tolist()) for i in range(900)], "doc_id string, vec array<double>").repartition(5)
    q = spark.createDataFrame([(i, qs[i].tolist()) for i in range(80)], "query_id long, vec array<double>")
    blocks = clustered.ClusteredDocs(d, block_rows=40, pivots=30)
    found, read = clustered.clustered_topk(q, blocks, 4)
    got: dict = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["doc_id"]))
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) > 0, np.linalg.norm(m, axis=1, keepdims=True), 1)
    s = np.round(unit(qs) @ unit(docs).T, 6)
    for i in range(80):
        want = sorted((-s[i, j], f"d{j:04}") for j in range(900))[:4]
        mine = sorted(got[i])[:4]
        assert [x for _, x in mine] == [x for _, x in want] and np.allclose([x for x, _ in mine], [x for x, _ in want], atol=1e-9)
    share = read.count() / (80 * blocks.blocks.count())
    assert share < 0.5, share
    one = sorted(tuple(r) for r in dense_cosine_topk(q, d, 4).collect())
    assert sorted(tuple(r) for r in dense_cosine_topk(q, d, 4, block_rows=1).collect()) == one


def test_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "label long, v array<double>")
    got = {r["label"]: r["centroid"] for r in centroids(df, "label", "v").collect()}
    assert got == {1: [2.0, 3.0], 2: [5.0, 6.0]}


def _long_form(m):
    return [(int(i), f"t{j}", float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j] != 0]


def test_lsa_singular_values_match_numpy(spark):
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(30, 12)))
    v, _ = np.linalg.qr(rng.normal(size=(40, 12)))
    s = np.array([10, 8, 6, 5, 4, 3, 2, 1.5, 1, 0.5, 0.2, 0.1])
    m = u @ np.diag(s) @ v.T
    X = spark.createDataFrame(_long_form(m), "doc_id long, term string, w double")
    model = L.fit(X, 5, oversample=7, passes=4)
    assert np.allclose(model.sigma, s[:5], rtol=1e-6)
    # projections reproduce U * sigma up to column sign
    proj = {r["doc_id"]: np.array(r["vec"]) for r in L.transform(model, X).collect()}
    us = u[:, :5] * s[:5]
    for i in range(30):
        assert np.allclose(np.abs(proj[i]), np.abs(us[i]), atol=1e-6)


def test_lsa_rank_deficient_returns_fewer(spark):
    m = np.outer(np.arange(1, 7), np.arange(1, 5)).astype(float)
    X = spark.createDataFrame(_long_form(m), "doc_id long, term string, w double")
    model = L.fit(X, 3, oversample=2, passes=2)
    assert model.k == 1 and math.isclose(model.sigma[0], np.linalg.norm(m), rel_tol=1e-9)


def test_gaussian_rows_deterministic():
    a = L.gaussian_rows(np.array([1, 2, 3], dtype=np.uint64), 5, 7)
    b = L.gaussian_rows(np.array([1, 2, 3], dtype=np.uint64), 5, 7)
    assert np.array_equal(a, b) and abs(a.mean()) < 1.5


def _dense(rows, row_key="doc_id", col_key="term", val="w"):
    r_ids = sorted({r[row_key] for r in rows})
    c_ids = sorted({r[col_key] for r in rows})
    ri, ci = {k: i for i, k in enumerate(r_ids)}, {k: i for i, k in enumerate(c_ids)}
    m = np.zeros((len(r_ids), len(c_ids)))
    for r in rows:
        m[ri[r[row_key]], ci[r[col_key]]] = r[val]
    return m


def test_tag_svd_on_driver_tables_matches_numpy(spark):
    from paths import SF_SMALL
    from lodestar.plans import pipelines as P
    from lodestar.sources import views

    seeds, works = views.seeds(spark, SF_SMALL), views.works(spark, SF_SMALL)
    m = _dense(P.tag_matrix(seeds, works).collect())
    want = np.linalg.svd(m, compute_uv=False)[:10]
    # converged: the subspace iteration reaches the exact values
    model, _, _ = P.tag_svd(seeds, works, k=10, passes=40)
    assert np.allclose(model.sigma, want, rtol=1e-6)
    # default passes: the leading value exact, the rest within the randomized solver's few-percent error
    quick, _, _ = P.tag_svd(seeds, works, k=10)
    assert math.isclose(quick.sigma[0], want[0], rel_tol=1e-6)
    assert np.all(quick.sigma <= want * (1 + 1e-9)) and np.all(quick.sigma >= want * 0.95)


def test_seed_spectrum_on_driver_tables_matches_numpy(spark):
    from paths import SF_SMALL
    from lodestar.operators import tfidf as TF
    from lodestar.plans import pipelines as P
    from lodestar.sources import views

    seeds = views.seeds(spark, SF_SMALL)
    _, vecs = TF.fit_transform(seeds)
    m = _dense(vecs.collect(), val="weight")
    spec = {r["rank"]: r["sigma"] for r in P.singular_spectrum(seeds, k=5, passes=40).collect()}
    want = np.linalg.svd(m, compute_uv=False)[:5]
    assert np.allclose([spec[i] for i in range(1, 6)], want, rtol=1e-6)


@pytest.mark.parametrize("n, v, k, widest", [(30, 40, 5, None), (120, 200, 8, 40), (12, 50, 20, None)])
def test_lanczos_matches_numpy(spark, n, v, k, widest):
    """Spaces that the basis spans, one for which it restarts many times, and one of lower rank than asked."""
    from lodestar.operators import lanczos

    rng = np.random.default_rng(1)
    m = rng.normal(size=(n, v)) * (rng.random((n, v)) < 0.2) * np.linspace(1, 3, v)
    X = spark.createDataFrame(_long_form(m), "doc_id long, term string, w double")
    svd = lanczos.fit_exact(X, k, widest=widest)
    want = np.linalg.svd(m, compute_uv=False)[:k]
    assert svd.model.k == min(k, n) and np.allclose(svd.model.sigma, want, rtol=1e-9)
    assert (svd.steps > 10) == (widest is not None)
    table = lanczos.residual_table(X, svd).toPandas()
    assert table["residual"].max() < 1e-6 and table["orthogonality"].max() < 1e-9
    assert (svd.residuals < 1e-6).all()


def test_lanczos_of_empty_and_rank_one(spark):
    from lodestar.operators import lanczos

    empty = spark.createDataFrame([], "doc_id long, term string, w double")
    none = lanczos.fit_exact(empty, 3)
    assert none.model.k == 0 and lanczos.residual_table(empty, none).count() == 0
    m = np.outer(np.arange(1, 7), np.arange(1, 5)).astype(float)
    one = lanczos.fit_exact(spark.createDataFrame(_long_form(m), "doc_id long, term string, w double"), 3)
    assert one.model.k == 1 and math.isclose(one.model.sigma[0], np.linalg.norm(m), rel_tol=1e-9)


def test_exact_spectra_of_driver_tables(spark):
    """What the registered queries assert in SQL, against numpy."""
    from paths import SF_SMALL
    from lodestar.plans import pipelines as P
    from lodestar.sources import views

    seeds, works = views.seeds(spark, SF_SMALL), views.works(spark, SF_SMALL)
    X, table = P.tag_svd_exact(seeds, works)
    m, got = _dense(X.collect()), table.toPandas()
    want = np.linalg.svd(m, compute_uv=False)
    want = want[want > want[0] * L.REL_TOL]
    assert np.allclose(got["sigma"], want, rtol=1e-8) and got["residual"].max() < 1e-6
    assert math.isclose((got["sigma"] ** 2).sum(), (m**2).sum(), rel_tol=1e-9)
    assert math.isclose((got["sigma"] ** 4).sum(), ((m.T @ m) ** 2).sum(), rel_tol=1e-9)
    t = P.singular_triplets(seeds).toPandas()
    assert len(t) == min(50, seeds.select("description").distinct().count()) and t["residual"].max() < 1e-6


def test_title_search_sends_no_title_to_every_task(spark, tmp_path):
    """Titles that Parquet stores in little space were broadcast whole, through the driver."""
    titles = spark.range(400).selectExpr("id as idx", "array('Red Don’t ' || id, 'aaaa') as titles", "'t' || id % 7 as title", "'d' || id as descr")
    titles.write.parquet(str(tmp_path / "titles"))
    reqs = spark.createDataFrame([("a", "aa"), ("b", "don't 39"), ("c", "D"), ("d", "none such"), ("e", "")], "request_id string, query string")
    out = title_search(spark.read.parquet(str(tmp_path / "titles")), reqs)
    first = {i % 7: i for i in reversed([i for i in range(400) if str(i).startswith("39")])}
    want = {(q, f"t{i}", f"d{i}", i) for q in "ac" for i in range(7)} | {("b", f"t{k}", f"d{i}", i) for k, i in first.items()}
    assert {(r.request_id, r.title, r.descr, r.idx) for r in out.collect()} == want
    lines = title_search(spark.read.parquet(str(tmp_path / "titles")), reqs)._jdf.queryExecution().executedPlan().toString().split("\n")
    leaves = [next(x for x in lines[i:] if "Scan" in x) for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert leaves and all("InMemoryTableScan" in x for x in leaves)


def test_products_by_blocks_match_numpy(spark):
    """A product moved one vector for each entry of X; it goes by blocks of documents, whose terms are read in batches."""
    rng = np.random.default_rng(3)
    m = rng.random((37, 23)) * (rng.random((37, 23)) < 0.3)
    m[5], m[6, :20] = 0, 1.0  # a document without terms, one with nearly all
    X = L.blocks(spark.createDataFrame(_long_form(m), "doc_id long, term string, w double"), block_docs=4)
    assert X.n_blocks >= 8 and (X.n_docs, X.n_terms) == (int((m != 0).any(axis=1).sum()), int((m != 0).any(axis=0).sum()))
    name = {float(w): t for _, t, w in _long_form(np.arange(1.0, 24.0)[None])}
    M, D = rng.random((23, 300)), rng.random((37, 300))
    vec = lambda rows, key: spark.createDataFrame(rows, f"{key}, vec array<double>")
    xm = L.x_times(X, vec([(name[j + 1.0], M[j].tolist()) for j in range(23)], "term string")).collect()
    assert sorted(r["doc_id"] for r in xm) == [i for i in range(37) if m[i].any()]
    assert max(abs(np.array(r["vec"]) - m[r["doc_id"]] @ M).max() for r in xm) < 1e-12
    place = {t: int(w) - 1 for w, t in name.items()}
    some = [i for i in range(37) if i % 3]  # documents that D does not have are zero
    xd = L.xt_times(X, vec([(i, D[i].tolist()) for i in some], "doc_id long")).collect()
    assert sorted(place[r["term"]] for r in xd) == [j for j in range(23) if m[some, j].any()]
    assert max(abs(np.array(r["vec"]) - m[some].T[place[r["term"]]] @ D[some]).max() for r in xd) < 1e-12


@pytest.mark.parametrize("counted", [False, True])
def test_sliced_products(spark, monkeypatch, counted):
    """Terms cut over many rows, blocks of few documents, a document without id, weights as they are or as counts."""
    from lodestar.operators import sliced

    monkeypatch.setattr(sliced, "ROW_ENTRIES", 7)
    monkeypatch.setattr(sliced, "BLOCK_DOCS", 4)
    rng = np.random.default_rng(5)
    n, v, width = 30, 40, 20
    tf = rng.integers(1, 300, size=(n, v)) * (rng.random((n, v)) < 0.3)
    tf[:, 0] = 1  # a term of every document, in more than one row
    scale, norm = rng.random(v) + 0.5, rng.random(n) + 0.5
    m = tf * scale / norm[:, None]
    ids = [None, *range(1, n)]
    cells = [(ids[i], f"t{j}", int(tf[i, j]), float(norm[i]), float(m[i, j])) for i, j in zip(*np.nonzero(tf))]
    rows = spark.createDataFrame(cells, "doc_id long, term string, n long, norm double, w double")
    scales = spark.createDataFrame([(f"t{j}", float(scale[j])) for j in range(v)], "term string, scale double") if counted else None
    X = sliced.by_terms(rows, scales)
    assert (X.n_docs, X.n_terms) == (n, v)
    assert X.rows.where("not whole").count() > 0
    start = sliced.start(X, width, 3)
    M = rng.normal(size=(width, 9))
    table = lambda df: {r[0]: np.array(r[1]) for r in df.collect()}
    y = table(sliced.of_docs(X, start, np.eye(width)))
    keys = {r["term"]: np.array([r["k"]]).astype(np.int64).view(np.uint64) for r in X.rows.selectExpr("explode(terms) as term").distinct().selectExpr("term", "xxhash64(term) as k").collect()}
    omega = np.vstack([sliced.gaussian_rows(keys[f"t{j}"], width, 3) for j in range(v)])
    whole = np.vstack([y[i] for i in ids])
    np.testing.assert_allclose(whole, m @ omega, rtol=1e-12, atol=1e-9)
    q = whole @ M
    known = np.vstack([np.zeros(9), q[1:]])  # a null equals no id
    g = sum(np.array(r["g"]) for r in sliced.inner(X, start, M).collect()).reshape(9, 9)
    np.testing.assert_allclose(g, known.T @ m @ m.T @ known, rtol=1e-9)
    after = table(sliced.of_docs(X, sliced.step(X, start, M), np.eye(9)))
    np.testing.assert_allclose(np.vstack([after[i] for i in ids]), m @ (m.T @ known), rtol=1e-9)
    terms = table(sliced.of_terms(X, start, M))
    np.testing.assert_allclose(np.vstack([terms[f"t{j}"] for j in range(v)]), m.T @ known, rtol=1e-9)


def test_lsa_fit_writes_no_vectors_of_terms(spark):
    """A vocabulary of many terms of one document each: what a fit writes is less than one vector for each term."""
    import pathlib
    from urllib.parse import urlparse

    from lodestar.operators import sliced

    folder = pathlib.Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    rows = [(d, f"own{d}_{j}", (0.1 + j / 100) * (1 + d / 30)) for d in range(60) for j in range(150)] + [(d, f"t{(d + j) % 20}", 0.5) for d in range(60) for j in range(5)]
    before = size()
    X = spark.createDataFrame(rows, "doc_id long, term string, w double")
    model = L.fit(sliced.by_terms(X), 20, passes=2)
    assert model.doc_vectors.count() == 60
    assert size() - before < 60 * 150 * (20 + L.OVERSAMPLE) * 8
    by_blocks = L.fit(X, 20, passes=2)
    np.testing.assert_allclose(model.sigma, by_blocks.sigma, rtol=1e-9)
    v, same = (np.vstack([r["vec"] for r in m.components.orderBy("term").collect()]) for m in (model, by_blocks))
    assert v.shape == (60 * 150 + 20, 20)
    np.testing.assert_allclose(v.T @ v, np.eye(20), atol=1e-8)
    np.testing.assert_allclose(v * model.sigma**2 @ v[:50].T, same * model.sigma**2 @ same[:50].T, atol=1e-8)


def test_joint_lsa_null_ids(spark):
    """Ids of either side that are null stay apart, and come back as null."""
    from lodestar.plans import pipelines as P

    text = ["red apple tree", "blue river stone", "green field grass"]
    seeds = spark.createDataFrame([(None, text[0]), (1, text[1])], "id long, description string")
    works = spark.createDataFrame([(None, text[1]), (1, text[0]), (7, text[2])], "id long, description string")
    got = {r["seed_id"]: (r["doc_id"], r["score"]) for r in P.joint_lsa(seeds, works, k=4).collect()}
    assert got == {None: (1, 1.0), 1: (None, 1.0)}
