"""Classifiers by held-out accuracy, decontamination against brute force, and the pipeline."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
import pytest
from edge import CLASHING, SCHEMA, edge_docs, edge_rows, empty_docs, sentence
from lodestar.llm import decontam, quality, toxicity
from lodestar.llm.queries import REGISTRY
from lodestar.llm.sample import held_out, labelled_sample
from pyspark.sql import functions as F

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def labels_of(name):
    return {r["doc_id"]: r[name] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}


@pytest.mark.parametrize(("query", "name", "modulus", "remainder", "least"), [("op5_quality", "quality", 4, 2, 0.93), ("op10_toxicity", "toxic", 5, 0, 0.9)])
def test_held_out_accuracy(spark, query, name, modulus, remainder, least):
    rows = REGISTRY[query](spark, SF).collect()
    labels = labels_of(name)
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) >= least


def test_machine_learns_pairs():
    """Neither word of a pair tells anything; only which two stand together does."""
    rng = random.Random(1)
    terms = toxicity.Terms()
    fill = [f"w{chr(97 + i)}{chr(97 + j)}xyz" for i in range(20) for j in range(20)]

    def rows(n):
        out = []
        for _ in range(n):
            for y, pairs in ((1, [("alpha", "bravo"), ("gamma", "delta")]), (0, [("alpha", "delta"), ("gamma", "bravo")])):
                out.append((y, *terms.of(" ".join([*rng.sample(fill, 12), *rng.choice(pairs)]))))
        return out

    model = toxicity.fit(rows(600), {0: 1.0, 1: 1.0}, epochs=30)
    held = rows(150)
    assert sum((model.score(t, v) >= 0.5) == y for y, t, v in held) / len(held) > 0.95


def test_machine_learns_pairs_of_rare_words():
    """As above, but more than a thousand other terms are in more rows than the words of the pairs."""
    rng = random.Random(2)
    terms = toxicity.Terms()
    fill = [f"{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}x{chr(97 + i)}yz" for i in range(20) for j in range(20) for k in range(2)]
    rows = []
    for n in range(1200):
        for y, pairs in ((1, [("alpha", "bravo"), ("gamma", "delta")]), (0, [("alpha", "delta"), ("gamma", "bravo")])):
            rows.append((y, *terms.of(" ".join([*rng.sample(fill, 160), *(rng.choice(pairs) if n % 5 == 0 else ())]))))
    seen = np.bincount(np.concatenate([t for _, t, _ in rows]), minlength=1 << toxicity.HASH_BITS)
    words = [int(t) for w in ("alpha", "bravo", "gamma", "delta") for t in terms.of(w)[0]]
    assert (seen > seen[words].max()).sum() > 1000
    model = toxicity.fit(rows, {0: 1.0, 1: 1.0}, epochs=30)
    assert (model.place[words] >= 0).all()
    for a, b, y in (("alpha", "bravo", 1), ("gamma", "delta", 1), ("alpha", "delta", 0), ("gamma", "bravo", 0)):
        assert (model.score(*terms.of(f"{a} {b} {' '.join(fill[:20])}")) >= 0.5) == y


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    field = quality.Field(np.zeros(4), np.ones(4), rng.normal(size=5), rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, 4))
    own = x @ field.weights[:-1] + field.weights[-1]
    total, good = 0.0, np.zeros(6)
    for code in range(64):
        y = [code >> i & 1 for i in range(6)]
        p = np.exp(sum(own[i] for i in range(6) if y[i]) + sum(field.pairs[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += p
        good += p * np.array(y)
    assert np.allclose(field.marginals(x), good / total)
    marginal, couples = quality._expected(own[None, :], field.pairs)
    assert np.allclose(marginal[0], good / total) and np.isclose(couples.sum(), 5)


def test_models_on_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, 1), (None, 1), (7, None), (99, 1)], "doc_id long, mark int")
    for module, fit in ((toxicity, toxicity.fit_machine), (quality, quality.fit_field)):
        for docs, n in ((edge_docs(spark), len(edge_rows())), (empty_docs(spark), 0)):
            model = fit(docs, labels, "mark", ~held_out("doc_id", 5, 9))
            rows = module.score(docs, model).collect()
            assert len(rows) == n and all(0 <= r["score"] <= 1 and r["row"]["score"] == "s" for r in rows)
        none = fit(edge_docs(spark), labels.limit(0), "mark", F.lit(True))
        assert {r["score"] for r in module.score(edge_docs(spark), none).collect()} == {0.5}


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, mark int")
    a, counts = labelled_sample(docs, labels, "mark", ~held_out("doc_id", 4, 2), 20)
    b, _ = labelled_sample(docs.repartition(7), labels, "mark", ~held_out("doc_id", 4, 2), 20)
    got = sorted(map(tuple, a.collect()))
    assert got == sorted(map(tuple, b.collect())) and [sum(r[0] == c for r in got) for c in (0, 1)] == [20, 20]
    assert all(zlib.crc32(t[1:].encode()) % 4 != 2 for _, t in got)
    assert sum(counts.values()) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(300))


def test_sample_is_bounded_by_size(spark):
    docs = spark.createDataFrame([(i, "x" * (10 if i % 5 else 400)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, mark int")
    sample, counts = labelled_sample(docs, labels, "mark", F.lit(True), 100, size=F.length("text"), most=600)
    got = sample.collect()
    assert [sum(len(r["text"]) for r in got if r["label"] == c) for c in (0, 1)] == [600, 600]  # by tens, none of 400
    assert counts == {0: 150, 1: 150}


def test_machine_scores_by_its_pairs():
    """The score is the bias, the linear weights and the sum over all pairs of terms, each worked out by itself; and the empty term
    of the fit is a term like any other."""
    rng = np.random.default_rng(9)
    n, k = 40, 8
    place = np.full(1 << 10, -1, np.int32)
    kept = rng.choice(1 << 10, n, replace=False)
    place[kept] = np.arange(n)
    for trial in range(30):
        w, v, bias = rng.normal(size=n + 1), rng.normal(size=(n + 1, k)) * 0.3, float(rng.normal())
        terms = rng.choice(1 << 10, 200, replace=False) if trial else np.zeros(0, int)
        values = rng.random(len(terms)) * 2
        x = {int(place[t]): float(c) for t, c in zip(terms, values) if place[t] >= 0} | {n: 1.0}  # the empty term
        z = bias + sum(w[i] * c for i, c in x.items())
        z += sum(float(v[i] @ v[j]) * x[i] * x[j] for i in x for j in x if i < j)
        machine = toxicity.Machine(place, bias + float(w[-1]), w[:-1] + v[:-1] @ v[-1], v[:-1])
        assert abs(machine.score(terms, values) - 1 / (1 + np.exp(-z))) < 1e-9


def test_pairs_are_counted_as_by_hand(monkeypatch):
    """Blocks of any size find the terms that a count of every pair by itself finds."""
    rng = np.random.default_rng(10)
    rows = []
    for i in range(400):
        label = int(rng.random() < 0.5)
        have = set(rng.choice(40, 12, replace=False).tolist())
        if label and rng.random() < 0.6:
            have |= {50, 51}
        elif rng.random() < 0.5:
            have.add(50 + int(rng.random() < 0.5))
        rows.append((label, np.array(sorted(have)), np.ones(len(have))))
    size = np.bincount([r[0] for r in rows], minlength=2)
    found = np.zeros((2, 64))
    for label, terms, _ in rows:
        found[label, terms] += 1
    able = np.flatnonzero(found.sum(0) >= 5)
    apart = lambda f, s: float(toxicity._apart(np.array(f, float)[:, None], np.array(s, float)[:, None])[0])
    want = set()
    for i in able:
        for j in able:
            both = [sum(label == c and {i, j} <= set(t.tolist()) for label, t, _ in rows) for c in (0, 1)]
            if i != j and sum(both) >= 5 and apart(both, size) >= 4 + toxicity.PAIR_STRENGTH and all(apart(both, found[:, k]) >= 4 for k in (i, j)):
                want.add(int(i))
    for block in (512, 7):
        monkeypatch.setattr(toxicity, "PAIR_BLOCK", block)
        pairs = toxicity._Pairs(rows, able, found, size, 5, 4.0)
        got = {int(t) for b in range(-(-len(able) // block)) for t in pairs.telling(b)}
        assert got == want and {50, 51} <= want


def test_alignment_by_definition():
    rng = random.Random(11)
    for _ in range(30):
        a, b = ([rng.randint(2, 5) for _ in range(n)] for n in (rng.randint(1, 9), rng.randint(1, 14)))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        best, end = decontam.align(np.array([a], np.uint64), np.array([b], np.uint64))
        assert best[0] == h.max() and h[:, end[0] + 1].max() == h.max()


def test_decontamination_finds_edited_copies(spark):
    rng = random.Random(12)
    items = [(i, sentence(500 + i, rng.choice([12, 30, 60, 150]))) for i in range(30)]
    items += [(90, items[0][1]), (91, "too short"), (92, None), (None, sentence(600, 30))]
    rows, planted = [], set()
    for i in range(200):
        words = sentence(1000 + i, rng.randint(20, 300)).split()
        if i % 4 == 0:
            item, text = items[(i // 4) % 30]
            copy = text.split()
            for _ in range(len(copy) // 10):  # edits: other words, losses, additions
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([["other"], [], [copy[k], "more"]])
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in copy]
            planted.add((i, item))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (10_000, 7):
        found = decontam.benchmark_matches(docs, bench, block=block).select("row.doc_id", F.explode("matches").alias("m")).collect()
        assert {(r["doc_id"], r["m"]["item_id"]) for r in found} == planted and len(found) == len(planted)


def test_decontamination_finds_regular_edits(spark):
    """Every n-th word replaced, or a word added after every one or two, with and without the original in the corpus."""
    words = sentence(700, 64).split()
    every = lambda n: " ".join("other" if i % n == n - 1 else w for i, w in enumerate(words))
    after = lambda n: " ".join(w + " more" * (i % n == n - 1) for i, w in enumerate(words))
    rows = [(n, f"{sentence(800 + n, 40)} {every(n)} {sentence(900 + n, 40)}") for n in (2, 3, 4, 5, 6)]
    rows += [(10 + n, f"{sentence(820 + n, 40)} {after(n)} {sentence(920 + n, 40)}") for n in (1, 2)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    for original in ([], [(20, " ".join(words))] * 9):
        docs = spark.createDataFrame(rows + original, "doc_id long, text string").repartition(3)
        found = decontam.benchmark_matches(docs, bench).where(F.size("matches") > 0).select("row.doc_id").collect()
        assert {r["doc_id"] for r in found} == {3, 4, 5, 6, 11, 12} | {i for i, _ in original}


def test_seeds_lose_no_alignment():
    """Items found by seeds are those found when every passage is aligned with the whole document."""
    rng = random.Random(13)
    for trial in range(60):
        vocabulary = [f"w{i}" for i in range(rng.choice([6, 30, 200]))]
        texts = [rng.choices(vocabulary, k=rng.randint(4, 90)) for _ in range(6)]
        docs = [rng.choices(vocabulary, k=rng.randint(0, 60)) for _ in range(8)]
        for d in docs[:6]:
            copy = list(rng.choice(texts))
            for _ in range(rng.randint(0, len(copy))):
                k = rng.randrange(len(copy) + 1)
                copy[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(vocabulary)], ["new"]])
            d[len(d) // 2 : len(d) // 2] = copy
        codes = [decontam.word_codes(" ".join(d)) for d in docs]
        rows = [(i, p) for i, t in enumerate(texts) for p in decontam.cut_passages(decontam.word_codes(" ".join(t)))]
        block = decontam.Block.of_rows([([i], p) for i, p in rows])
        found = {}
        for c in codes:
            for g in {int(g) for width in (1, 2) for g in decontam.gram_codes(c, width)}:
                found[g] = found.get(g, 0) + 1
        least = rng.choice([0.3, 0.5, 0.8, 1.0])
        seeds = block.rarest(found, least)
        seeds.prepare()
        for c in codes:
            best = {}
            for i, p in rows:
                top = int(decontam.align(p[None, :], c[None, :])[0][0]) if len(c) else 0
                if top >= max(2 * least * len(p), 8):
                    best[i] = max(best.get(i, 0), top / (2 * len(p)))
            assert {m["item_id"]: m["score"] for m in seeds.matches(c, least)} == best, trial


def test_decontamination_links_every_item(spark, tmp_path):
    """Items that share a passage, and items with the same words: a document is linked to all of them."""
    shared = sentence(710, 64)
    items = [(i, f"{shared} {sentence(720 + i, 40)}") for i in range(4)]
    items += [(8, items[0][1]), (9, items[0][1].upper())]
    docs = spark.createDataFrame([(1, f"{sentence(730, 30)} {shared}"), (2, items[3][1]), (3, sentence(731, 90))], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.benchmark_matches(docs, bench).select("row.doc_id", F.explode("matches").alias("m")).collect()
    assert sorted((r["doc_id"], r["m"]["item_id"]) for r in found) == [(d, i) for d in (1, 2) for i in range(4)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = REGISTRY["op3_decontamination"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(d, i) for d in (1, 2) for i in (0, 1, 2, 3, 8, 9)]


def test_codes_of_batches_are_those_of_words(monkeypatch):
    """Words as a pattern finds them, in texts of any signs; equal words have equal codes wherever they stand, in chunks of any size."""
    import re

    rng = random.Random(21)
    signs = ["a", "B", "_", "9", " ", "\n", "-", "é", "İ", "ß", "漢", "😀", "\u0301", "Σ", "²", "\x00", "'"]
    texts = [None, "", *("".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(300)), "x" * 5000 + " y"]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(decontam, "CHUNK", chunk)
        codes, first = decontam.batch_codes(texts)
        seen: dict = {}
        for k, t in enumerate(texts):
            words = re.findall(r"\w+", (t or "").lower())
            mine = codes[first[k] : first[k + 1]].tolist()
            assert len(mine) == len(words)
            assert all(seen.setdefault(w, c) == c for w, c in zip(words, mine))
        assert len(set(seen.values())) == len(seen) and min(seen.values()) > 1
    grams, row = decontam.batch_grams(codes, first)
    for k in range(len(texts)):
        mine = codes[first[k] : first[k + 1]]
        assert sorted(grams[row == k].tolist()) == sorted([*decontam.gram_codes(mine, 1).tolist(), *decontam.gram_codes(mine, 2).tolist()])


def test_short_items_match_documents_of_their_words(spark):
    docs = spark.createDataFrame([(1, "Two WORDS!"), (2, "two words more"), (3, "words two"), (4, "one"), (5, " two,words\n"), (6, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "two words"), (8, "one"), (9, "Two words."), (10, ""), (11, sentence(740, 20))], "item_id long, text string")
    found = decontam.benchmark_matches(docs, bench).select("row.doc_id", F.explode("matches").alias("m")).collect()
    assert sorted((r["doc_id"], r["m"]["item_id"], r["m"]["score"]) for r in found) == [(1, 7, 1.0), (4, 8, 1.0), (5, 7, 1.0)]


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, sentence(2, 80)), (2, ""), (3, None)], "item_id long, text string")
    got = decontam.benchmark_matches(edge_docs(spark), bench).collect()
    assert len(got) == len(edge_rows())
    assert sorted(r["row"]["doc_id"] for r in got if r["matches"]) == [4, 4, 5]
    assert decontam.benchmark_matches(empty_docs(spark), bench).count() == 0
    none = decontam.benchmark_matches(edge_docs(spark), bench.limit(0))
    assert none.where(F.size("matches") > 0).count() == 0 and none.count() == len(edge_rows())


def test_pipeline_stages_on_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = labels_of("toxic")
    sizes = [docs.count()]
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF).persist()
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before
        sizes.append(len(after))
        if k == 0:
            wrong = [d for d in labels if (d in after) == bool(labels[d])]
            assert len(wrong) / len(labels) < 0.05
        if k < 4:
            assert docs.columns == columns
    assert sizes[2] == sizes[3] and sizes[4] == sizes[5] and sizes[0] > sizes[1] > sizes[2] and sizes[3] > sizes[4]
    assert docs.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_run_is_its_stages_and_leaves_its_result_only(spark):
    import os

    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(root))
    got = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    key = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.collect())
    new = set(os.listdir(root)) - before
    assert key(got) == key(docs) != []
    assert sum(n.startswith("byte_bpe-") for n in new) == 1 and not any(n.startswith(f"{s}-") for n in new for s, _ in corpus_pipeline.STAGES[:-1])


def test_a_scope_deletes_what_it_is_not_asked_to_keep(spark):
    import os

    from lodestar.llm.store import scope, stored

    with scope(spark) as keep:
        one = stored(spark.range(5), "one")
        two = keep(stored(one.where("id > 2"), "two"))
        with scope(spark):
            three = stored(spark.range(3), "three").inputFiles()[0]
        gone, there = one.inputFiles()[0], two.inputFiles()[0]
    folder = lambda f: os.path.dirname(f.removeprefix("file:").replace("//", "/"))
    assert not os.path.exists(folder(gone)) and not os.path.exists(folder(three)) and os.path.exists(folder(there))
    assert two.count() == 2


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows, ties and clashing columns; then no rows at all."""
    extra = SCHEMA.replace(CLASHING, CLASHING + ", n_chars long")
    rows = [(*r, len(r[1]) if r[1] else None) for r in edge_rows()]
    for given in (rows, []):
        docs = spark.createDataFrame(given, extra)
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SMALL).persist()
            assert k == 4 or docs.columns == columns
        n = docs.count()
        assert (n == 0) == (not given)
