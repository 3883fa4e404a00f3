"""All-pairs cosine: brute force comparison, properties, both join strategies, plan shape."""

import math
import random
from collections import Counter

import pytest

from lodestar.operators import index as I
from lodestar.operators import similarity as SIM
from lodestar.operators.rank import blend_rerank

VOCAB = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)]


def corpus(seed, n):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(VOCAB[: 5 + i % 25]) for _ in range(rnd.randint(3, 30))) for i in range(n)]


def brute(docs, queries, min_df, max_df_ratio, k):
    n = len(docs)
    tfs = [Counter(d.split()) for d in docs]
    df = Counter(t for c in tfs for t in c)
    idf = {t: math.log2(n / (1 + v)) for t, v in df.items() if v >= min_df and v / n <= max_df_ratio}
    norms = [math.sqrt(sum((c[t] * idf[t]) ** 2 for t in c if t in idf)) for c in tfs]
    out = {}
    for qi, q in enumerate(queries):
        qt = {t for t in q.split() if t in idf}
        qn = math.sqrt(sum(idf[t] ** 2 for t in qt))
        scored = []
        for di, c in enumerate(tfs):
            shared = [t for t in qt if t in c]
            if not shared or qn * norms[di] == 0:
                continue
            dot = sum(c[t] * idf[t] * idf[t] for t in shared)
            scored.append((round(dot / (qn * norms[di]), 6), di))
        scored.sort(key=lambda x: (-x[0], x[1]))
        out[qi] = scored[:k]
    return out


@pytest.mark.parametrize("strategy", ["doc_local", "term_shuffle"])
def test_top_k_matches_brute_force(spark, strategy):
    docs, queries = corpus(1, 60), corpus(2, 7)
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    q = spark.createDataFrame(list(enumerate(queries)), "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=2, max_df_ratio=0.9)
    qt = I.query_terms(q, idx.idf)
    # hot_df=1 forces every term through the salted path in the shuffle strategy
    m, used = SIM.term_matches(idx, qt, strategy=strategy, hot_df=1 if strategy == "term_shuffle" else None, salt_buckets=4)
    assert used == strategy
    top = SIM.top_k_per_seed(SIM.cosine_scores(SIM.dot_scores(m), idx.norms), 5).collect()
    got = {}
    for r in sorted(top, key=lambda r: (r["seed_id"], r["rank"])):
        got.setdefault(r["seed_id"], []).append((r["score"], r["doc_id"]))
    want = {k: v for k, v in brute(docs, queries, 2, 0.9, 5).items() if v}
    assert got == want


def test_properties_identical_doc_scores_one(spark):
    docs = ["a b c", "a b", "c d", "d e f", "a f"] * 3
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    q = spark.createDataFrame([(100, "a b c")], "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    recs = SIM.similar_documents(idx, I.query_terms(q, idx.idf), k=4).collect()
    ranks = sorted(r["rank"] for r in recs)
    assert ranks == list(range(1, len(recs) + 1))
    assert all(0.0 <= r["score"] <= 1.0 for r in recs)
    best = [r for r in recs if r["rank"] == 1][0]
    assert best["score"] == 1.0 and docs[best["doc_id"]] == "a b c"


def test_keywords_order(spark):
    docs = ["x x x y z", "x y", "q r", "y z z", "r q x"] * 4
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    q = spark.createDataFrame([(1, "x y z")], "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    recs = {r["doc_id"]: r["keywords"] for r in SIM.similar_documents(idx, I.query_terms(q, idx.idf), k=50, n_keywords=2).collect()}
    idf = {r["term"]: r["idf"] for r in idx.idf.collect()}
    c = Counter(docs[0].split())
    contrib = sorted(((round(c[t] * idf[t] ** 2, 6), t) for t in ["x", "y", "z"]), key=lambda x: (-x[0], x[1]))
    assert recs[0] == ",".join(t for _, t in contrib[:2])


def test_blend_extremes(spark):
    recs = spark.createDataFrame(
        [(1, 10, 1, 0.4, 0.4, "k"), (1, 11, 2, 0.3, 0.3, "k")],
        "seed_id long, doc_id long, rank long, score double, cosine double, keywords string",
    )
    pop = spark.createDataFrame([(10, 0.2), (11, 0.5)], "doc_id long, popularity double")
    req = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.0), (3, 1, 1.0)], "request_id long, seed_id long, popularity_weight double")
    out = {(r["request_id"], r["doc_id"]): (r["rank"], r["blended"]) for r in blend_rerank(recs, pop, req).collect()}
    assert math.isclose(out[(1, 10)][1], 0.2 / 0.05 * 0.5 + 0.4 * 0.5)  # fixture: 2.2
    assert math.isclose(out[(1, 10)][1], 2.2)
    assert out[(2, 10)][0] == 1  # w = 0 keeps cosine order
    assert out[(3, 11)][0] == 1  # w = 1 is popularity order


def test_top_k_plan_prunes_before_shuffle(spark):
    docs = corpus(3, 30)
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    q = spark.createDataFrame(list(enumerate(corpus(4, 3))), "id long, description string")
    m, _ = SIM.term_matches(idx, I.query_terms(q, idx.idf), strategy="doc_local")
    top = SIM.top_k_per_seed(SIM.cosine_scores(SIM.dot_scores(m), idx.norms), 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_sparse_cosine_shuffle_path_equals_broadcast(spark):
    from lodestar.operators import tfidf as TF

    docs = spark.createDataFrame(list(enumerate(corpus(5, 40))), "id long, description string")
    qs = spark.createDataFrame(list(enumerate(corpus(6, 5))), "id long, description string")
    model = TF.fit(docs)
    dv, qv = TF.transform(model, docs), TF.transform(model, qs)
    a = sorted(tuple(r) for r in TF.sparse_cosine_topk(qv, dv, 3).collect())
    b = sorted(tuple(r) for r in TF.sparse_cosine_topk(qv, dv, 3, broadcast_rows=0, hot_df=2, salt_buckets=3).collect())
    assert a == b and len(a) == 15


def test_blend_with_all_zero_popularity(spark):
    recs = spark.createDataFrame(
        [(1, 10, 1, 0.4, 0.4, "k"), (1, 11, 2, 0.3, 0.3, "k")],
        "seed_id long, doc_id long, rank long, score double, cosine double, keywords string",
    )
    pop = spark.createDataFrame([(10, 0.0), (11, 0.0)], "doc_id long, popularity double")
    req = spark.createDataFrame([(1, 1, 1.0)], "request_id long, seed_id long, popularity_weight double")
    out = {r["doc_id"]: (r["rank"], r["blended"]) for r in blend_rerank(recs, pop, req).collect()}
    assert out == {10: (1, 0.0), 11: (2, 0.0)}  # max popularity 0: no division error, cosine order kept


def _small(spark):
    docs, queries = corpus(11, 40), corpus(12, 4)
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    q = spark.createDataFrame(list(enumerate(queries)), "id long, description string")
    return docs, queries, d, q


def test_own_tokenizer(spark):
    """Any Column -> array of strings can take the place of the default tokens."""
    from pyspark.sql import functions as F

    docs, _, d, _ = _small(spark)
    pairs = I.term_frequency(d, stop_words=None, tokenizer=lambda c: F.transform(F.split(c, " "), lambda w: F.substring(w, 1, 2)))
    got = {(r["doc_id"], r["term"]): r["tf"] for r in pairs.collect()}
    assert got == {(i, t): n for i, x in enumerate(docs) for t, n in Counter(w[:2] for w in x.split()).items()}


def test_own_score_function_and_method(spark):
    """One term's share, and how shares become a score, can both be given."""
    from pyspark.sql import functions as F

    docs, queries, d, q = _small(spark)
    idx = I.build_index(d, stop_words=None, min_df=2, max_df_ratio=0.9)
    qt = I.query_terms(q, idx.idf)
    kept = {r["term"] for r in idx.idf.collect()}
    shared = {(s, i): sum(Counter(x.split())[t] for t in set(y.split()) & kept) for s, y in enumerate(queries) for i, x in enumerate(docs)}
    count = lambda tf, idf, qtf: tf.cast("double")
    top = SIM.similar_documents(idx, qt, 100, 2, score_fn=count, method="dot").collect()
    assert {(r["seed_id"], r["doc_id"]): r["score"] for r in top} == {k: v for k, v in shared.items() if v}
    for r in top[:20]:
        tf = Counter(docs[r["doc_id"]].split())
        words = sorted((-tf[t], t) for t in set(queries[r["seed_id"]].split()) & kept if tf[t])[:2]
        assert r["keywords"] == ",".join(t for _, t in words)
    halved = SIM.similar_documents(
        idx, qt, 100, 0, score_fn=count, method=lambda dots, norms: dots.select("seed_id", "doc_id", (F.col("dot") / 2).alias("score"), F.col("dot").alias("cosine"))
    ).collect()
    assert {(r["seed_id"], r["doc_id"]): r["score"] * 2 for r in halved} == {k: v for k, v in shared.items() if v}
    with pytest.raises(ValueError):
        SIM.cosine_scores(SIM.dot_scores(SIM.term_matches(idx, qt)[0]), idx.norms, "other")


def test_keywords_alike_on_both_paths(spark):
    """The survivors' terms are scored again in place, or, past the bound, taken from all matches."""
    _, _, d, q = _small(spark)
    idx = I.build_index(d, stop_words=None, min_df=2, max_df_ratio=0.9)
    qt = I.query_terms(q, idx.idf)
    rows = lambda **kw: sorted(tuple(r) for r in SIM.similar_documents(idx, qt, 5, 3, **kw).collect())
    assert rows() == rows(strategy="term_shuffle", broadcast_rows=0)


def test_no_exchange_between_join_and_sum(spark):
    """Cross-corpus cosine: the documents' partitioning serves the per-pair sums."""
    from lodestar.plans import pipelines as P

    _, _, d, q = _small(spark)
    plan = P.cross_corpus_nearest(q, d, stop_words=[])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan.split("InMemoryTableScan")[0]


def skewed_corpus(seed, n, vocabulary=300):
    """Words by a Zipf-like law, so that a few are in most documents."""
    rnd = random.Random(seed)
    words = [f"z{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rnd.choices(words, weights, k=rnd.randint(10, 60))) for _ in range(n)]


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_block_max_gives_the_same_rows_from_fewer_postings(spark, broadcast_rows):
    from lodestar.operators import blockmax

    docs, queries = skewed_corpus(1, 900), skewed_corpus(2, 12)
    docs[100:130] = [docs[0]] * 30  # ties
    d = spark.createDataFrame(list(enumerate(docs)), "id long, description string")
    q = spark.createDataFrame([*enumerate(queries), (90, ""), (91, "unknown words")], "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=2, max_df_ratio=0.95)
    qt = I.query_terms(q, idx.idf)
    for k in (1, 50) if broadcast_rows else (5,):
        want = sorted((r["seed_id"], r["rank"], r["doc_id"], r["score"], r["keywords"]) for r in SIM.similar_documents(idx, qt, k).collect())
        got = blockmax.similar_documents(idx, qt, k, broadcast_rows=broadcast_rows, block_docs=16)
        assert sorted((r["seed_id"], r["rank"], r["doc_id"], r["score"], r["keywords"]) for r in got.collect()) == want
    work = blockmax.survivors(idx, qt, 5, block_docs=16, broadcast_rows=broadcast_rows).work.first()
    assert work["first"] + work["essential"] + work["rest"] < 0.7 * work["every"], work


def test_block_max_with_fewer_documents_than_asked(spark):
    from lodestar.operators import blockmax

    d = spark.createDataFrame([(i, t) for i, t in enumerate(["aa bb", "aa cc", "bb cc dd", "dd"])], "id long, description string")
    q = spark.createDataFrame([(0, "aa bb"), (1, "dd")], "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    qt = I.query_terms(q, idx.idf)
    key = lambda df: sorted(tuple(r) for r in df.select("seed_id", "rank", "doc_id", "score", "keywords").collect())
    assert key(blockmax.similar_documents(idx, qt, 50)) == key(SIM.similar_documents(idx, qt, 50)) != []
    assert blockmax.similar_documents(idx, qt.limit(0), 50).count() == 0


def test_block_max_plans_stay_short(spark):
    """Each step's plan held those of all steps before it, several times over, and the driver ran out of memory."""
    from lodestar.operators import blockmax

    d = spark.createDataFrame(list(enumerate(corpus(7, 60))), "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    stay = blockmax.survivors(idx, I.query_terms(d.limit(3), idx.idf), 5).survivors
    assert stay.count() >= 15 and len(stay._jdf.queryExecution().toString()) < 5000


def test_postings_meet_the_query_terms_only(spark):
    """The broadcast query terms bring their idf; no second join of the postings to the vocabulary."""
    d = spark.createDataFrame([(i, f"alpha beta w{i % 3} v{i % 5}") for i in range(30)], "id long, description string")
    idx = I.build_index(d, stop_words=[], min_df=1, max_df_ratio=1.0)
    m, _ = SIM.term_matches(idx, I.query_terms(d.limit(4), idx.idf), strategy="doc_local")
    plan = m._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]  # above the cached postings
    assert plan.count("Join Inner") == 1


def test_large_vocabulary_leaves_common_postings_in_place(spark):
    """beyond the bounds only rare terms are moved; the weights stay the same."""
    from lodestar.operators import tfidf as TF

    d = spark.createDataFrame([(i, f"all half{i % 2} some{i % 5} rare{i} rare{i} pair{i // 2}") for i in range(40)] + [(None, "all half1 nowhere"), (99, None)], "id long, description string")
    tf = TF.counts(d, "id", "description", None)
    idf = TF._idf_from_counts(tf, 42)
    rows = lambda df: sorted((str(r[0]), r[1], round(r[2], 9)) for r in df.collect())
    whole = TF._weights(tf, idf)
    for bound in (0, 1, 8, 30):
        some = TF._weights(tf, idf, max_rows=bound)
        assert rows(some) == rows(whole)
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_block_max_keeps_no_table_of_the_postings_size(spark):
    """impacts, block maxima and the sums of every pair were kept beside the postings, and the postings were moved for the last step."""
    from lodestar.operators import blockmax

    held = lambda: {i.id(): i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    first = held()
    d = spark.createDataFrame(list(enumerate(skewed_corpus(3, 400))), "id long, description string")
    idx = I.build_index(d, stop_words=None, min_df=2, max_df_ratio=0.95)
    idx.postings.count()
    own = {i: b for i, b in held().items() if i not in first}  # postings and terms
    qt = I.query_terms(d.limit(3), idx.idf)
    stay = blockmax.survivors(idx, qt, 5, block_docs=16).survivors
    assert sum(b for i, b in held().items() if i not in first and i not in own) < sum(own.values()) / 2
    plan = blockmax._matches(idx, qt, stay, 10**6)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
