"""Inverted index, idf bounds, norms, popularity (FIXTURES.md section 3)."""

import math

from pyspark.sql import functions as F

from lodestar.operators import index as I
from lodestar.sources.views import popularity


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, description string")


def test_inverted_index_docstring_example(spark):
    d = docs(spark, ["to be or not to be", "do be do be do"])
    post = I.term_frequency(d, stop_words=None)
    packed = {r["term"]: [(p["doc_id"], p["tf"]) for p in r["postings"]] for r in I.packed_postings(post).collect()}
    assert packed["be"] == [(0, 2), (1, 2)]
    assert packed["not"] == [(0, 1)]
    assert packed["do"] == [(1, 3)]


def test_idf_bounds(spark):
    df = spark.createDataFrame([("a", 9), ("b", 10), ("c", 19), ("d", 20)], "term string, df long")
    got = {r["term"]: r["idf"] for r in I.idf_log2(df, 20).collect()}
    assert set(got) == {"b", "c"}  # 9 below min_df; 20/20 above 0.95
    assert math.isclose(got["b"], math.log2(20 / 11))
    assert got["c"] == 0.0


def test_doc_norm_and_token_less_docs_count(spark):
    texts = ["alpha beta", "alpha", ""] + ["gamma"] * 7
    idx = I.build_index(docs(spark, texts), stop_words=None, min_df=1, max_df_ratio=1.0)
    assert idx.n_docs == 10
    idf = {r["term"]: r["idf"] for r in idx.idf.collect()}
    assert math.isclose(idf["alpha"], math.log2(10 / 3))
    norms = {r["doc_id"]: r["norm"] for r in idx.norms.collect()}
    assert math.isclose(norms[0], math.sqrt(idf["alpha"] ** 2 + idf["beta"] ** 2))
    assert 2 not in norms  # no kept term -> no norm row (norm 0)


def test_popularity(spark):
    df = spark.createDataFrame([(3312, 153, 1), (0, 5, 2), (None, 1, 1)], "hits long, kudos long, chapters long")
    got = [r["p"] for r in df.select(popularity(F.col("hits"), F.col("kudos"), F.col("chapters")).alias("p")).collect()]
    assert math.isclose(got[0], 153 / 3312) and round(got[0], 6) == 0.046196
    assert got[1] == 0.0 and got[2] == 0.0


def test_query_terms_binary_tf(spark):
    d = docs(spark, ["x y"] * 3)
    idx = I.build_index(d, stop_words=None, min_df=1, max_df_ratio=1.0)
    q = spark.createDataFrame([(7, "x x x z")], "id long, description string")
    rows = I.query_terms(q, idx.idf).collect()
    assert [(r["seed_id"], r["term"], r["qtf"]) for r in rows] == [(7, "x", 1)]


def test_compact_postings_round_trip(spark):
    """Random postings, ids beyond 32 bits, large counts, hot terms over many blocks."""
    import random

    import numpy as np

    from lodestar.operators import postings as C

    rnd = random.Random(6)
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**40, 2**62, 5])
    data, size = C.pack_numbers(x)
    assert C.unpack_numbers(data).tolist() == x.tolist() and size.tolist() == [1, 1, 1, 2, 2, 3, 5, 6, 9, 1]
    assert C.unpack_numbers(C.pack_numbers(np.zeros(0))[0]).tolist() == []
    rows = {(f"t{rnd.randint(0, 30)}", rnd.choice([rnd.randint(0, 5000), 2**40 + rnd.randint(0, 99)])): rnd.randint(1, 10**6) for _ in range(3000)}
    rows |= {("hot", d): 1 + d % 3 for d in range(3000)}
    df = spark.createDataFrame([(d, t, n) for (t, d), n in rows.items()], "doc_id long, term string, tf long").repartition(5)
    blocks = C.compact(df, 256)
    assert {(r["term"], r["doc_id"]): r["tf"] for r in C.expand(blocks).collect()} == rows
    got = blocks.collect()
    assert max(r["n"] for r in got) <= 256 and sum(r["term"] == "hot" for r in got) == 12
    for r in got:
        mine = {d: n for (t, d), n in rows.items() if t == r["term"] and d // 256 == r["block"]}
        assert (r["first_id"], r["last_id"], r["n"], r["max_tf"]) == (min(mine), max(mine), len(mine), max(mine.values()))
    assert sum(len(r["data"]) for r in got if r["term"] == "hot") == 2 * 3000  # two bytes a posting
    assert C.expand(C.compact(df.limit(0))).count() == 0


def test_tokenizer_hook_on_arrow_batches_is_the_column_form(spark):
    from pyspark.sql import functions as F

    from lodestar.functions.text import default_stop_words, letter_tokens
    from lodestar.plans.queries import _arrow_letter_tokens

    stop = default_stop_words("english")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["The RED ring's 2 rings", "", None, "a I été THE", "...", "x" * 300, "İK ringing\n\nthe"])], "id long, t string")
    got = df.select("id", _arrow_letter_tokens(stop)(F.col("t")).alias("a"), letter_tokens(F.col("t"), stop).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and any(r["a"] for r in got)


def test_terms_are_rows_not_arrays(spark):
    """Terms are filtered in generated code; the same as the tokenisers' over odd characters."""
    from lodestar.functions.text import NON_WORD, letter_tokens, word_tokens_2plus

    texts = ["", " ", "a B-c the", "THE the x_1 é1 ß İK K", "".join(map(chr, range(1, 0x3000))), "\U00010400\U00010428 x\U0001d7ceb", None]
    d = docs(spark, texts)
    assert "filter(" not in I.term_frequency(d, stop_words=["the"])._jdf.queryExecution().executedPlan().toString()
    for how, tok in (({}, letter_tokens), ({"separators": NON_WORD, "least": 2}, word_tokens_2plus)):
        for stop in (None, ["the", "a"]):
            got = I.term_frequency(d, stop_words=stop, **how)
            want = I.term_frequency(d, tokenizer=lambda c: tok(c, stop))  # noqa: B023
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_compact_postings_gather_no_arrays(spark):
    """blocks are cut from sorted rows over batches of Python, and read back whole."""
    from lodestar.operators import postings as C

    rows = [(t * 7 + 5 * i, f"t{t % 40}", 1 + i % 200) for t in range(0, 400, 3) for i in range(150)]
    post = spark.createDataFrame(rows, "doc_id long, term string, tf long").groupBy("doc_id", "term").agg(F.max("tf").alias("tf"))
    blocks = C.compact(post, 64)
    assert "collect_list" not in blocks._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(tuple, post.select("term", F.floor(F.col("doc_id") / 64).alias("block"), "doc_id", "tf").collect()))
    assert sorted(map(tuple, C.expand(blocks).collect())) == want
    whole = [(r["term"], r["block"], p["doc_id"], p["tf"]) for r in C.expand(blocks, lists=True).collect() for p in r["postings"]]
    assert sorted(whole) == want
    assert blocks.select("term", "block").distinct().count() == blocks.count()
