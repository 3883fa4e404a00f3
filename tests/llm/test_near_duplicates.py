"""Substring dedup and SimHash against brute force, and on odd rows."""

import hashlib
import random


import pyarrow as pa
import pytest
from edge import edge_docs, edge_rows, empty_docs, sentence
from lodestar.llm import graph, simhash, substring
from lodestar.llm.words import Words, window_hashes


def brute_cut(rows, k):
    """[(n_words, n_removed, kept sha256)] by the definition; a null id comes after all others."""
    place = lambda i: 2**63 - 1 if i is None else i
    low = {}
    words = [(t or "").encode().split() for _, t in rows]
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - k + 1):
            key = tuple(w[s : s + k])
            low[key] = min(low.get(key, place(i)), place(i))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - k + 1):
            if low[tuple(w[s : s + k])] < place(i):
                gone.update(range(s, s + k))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cut(spark, docs, k):
    found = substring.cut_repeats(docs, min_words=k).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_words_and_windows():
    texts = pa.array(["a b  c", None, "", "\td\x0be\n", "漢 字"])
    w = Words(texts)
    assert [w.bytes_of(i).decode() for i in range(len(w))] == ["a", "b", "c", "d", "e", "漢", "字"]
    assert w.counts().tolist() == [3, 0, 0, 2, 2]
    same = Words(pa.array(["x a b", "a b", "ab"])).hashes()
    assert same[1] == same[3] and same[2] == same[4] and len(set(same.tolist())) == 4
    assert len(window_hashes(same, 9)) == 0


@pytest.mark.parametrize("k", [4, 7, 50])
def test_cut_equals_brute_force(spark, k):
    rng = random.Random(k)
    passages = [sentence(s, k + rng.randint(0, 9)) for s in range(6)]
    rows = []
    for i in range(60):
        parts = [sentence(1000 + rng.randint(0, 80), rng.randint(1, 12)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i, " ".join(parts)))
    rows += [(100, "a " * (3 * k)), (101, "a " * (2 * k) + "b"), (102, rows[3][1]), (103, rows[3][1].replace(" ", "\n")), (2, "a " * (k + 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert cut(spark, docs, k) == brute_cut(rows, k)


def test_cut_odd_rows(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert cut(spark, edge_docs(spark), 50) == brute_cut(rows, 50)
    one = substring.cut_repeats(edge_docs(spark)).where("row.doc_id = 5").first()
    assert one["row"]["kept_text"] == "k" and one["kept_text"] == "x end" and [(s["first"], s["end"]) for s in one["removed"]] == [(1, 81)]
    empty = substring.cut_repeats(empty_docs(spark))
    assert empty.count() == 0 and empty.columns == ["row", "n_words", "n_removed", "kept_text", "kept_sha256", "removed"]


def test_repeat_lengths(spark):
    k = 4
    rng = random.Random(21)
    shared = sentence(77, 90).split()
    rows = [(0, " ".join(shared))]
    for i in range(1, 25):
        n = rng.randint(1, 85)
        at = rng.randint(0, 90 - n)
        rows.append((i, f"{sentence(300 + i, 3)} {' '.join(shared[at : at + n])} {sentence(400 + i, 3)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {}
    length = k
    while length < 200:
        low = {}
        for i, t in rows:
            w = t.split()
            for s in range(len(w) - length + 1):
                key = tuple(w[s : s + length])
                if low.setdefault(key, i) < i:
                    want[i] = length
        length *= 2
    got = {r["ord"]: r["longest"] for r in substring.repeat_lengths(docs, min_words=k).collect()}
    assert got == want and max(want.values()) >= 32
    assert substring.repeat_lengths(empty_docs(spark)).count() == 0


def components(values, bits):
    left, out = set(values), {}
    while left:
        todo = [left.pop()]
        group = []
        while todo:
            x = todo.pop()
            group.append(x)
            near = {y for y in left if bin((x ^ y) & (2**64 - 1)).count("1") <= bits}
            left -= near
            todo += near
        out.update({x: min(group) for x in group})
    return out


@pytest.mark.parametrize(("chunk", "bits"), [(1024, 3), (4, 3), (4, 1)])
def test_links_equal_brute_force(spark, chunk, bits):
    rng = random.Random(chunk + bits)
    values = set()
    for _ in range(12):  # clusters around centres, some dense; one half fixed in many
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 40])):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(32)])
            values.add(x - 2**64 if x >= 2**63 else x)
    values |= {0, -1, 1, 7}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r["node"]: r["root"] for r in simhash.linked_components(fps, bits, chunk).collect()}
    want = components(values, bits)
    assert {v: got.get(v, v) for v in values} == want


def test_fingerprint_by_definition():
    import xxhash

    for text in ["", None, "A", "a B", "The cat sat on the mat the cat sat", sentence(5, 300)]:
        words = (text or "").lower().split()
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) == want


def test_simhash_odd_rows(spark):
    got = simhash.simhash_components(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    by = lambda i: [r["component_id"] for r in got if r["row"]["doc_id"] == i]
    assert by(1) == by(2) == by(3) == [1]  # no words: fingerprint zero, with the null row of no id
    assert sorted(r["component_id"] is None for r in got if r["row"]["doc_id"] is None) == [False, True]
    assert simhash.simhash_components(empty_docs(spark)).count() == 0
    kept = simhash.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns

    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and not {2, 3} & set(ids) and ids.count(6) == 1
    assert simhash.keep_one(empty_docs(spark)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 3), (70, 71), (71, 70)]
    got = {r["node"]: r["root"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)} | {71: 70}
    assert {k: v for k, v in got.items() if k != v} == want
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_group_of_near_copies(spark):
    """A third of the rows in one group: as many links as rows, not as pairs."""
    base = sentence(7, 120).split()
    rows = []
    for i in range(300):
        w = list(base)
        w[i % 120] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, sentence(2000 + i, 60)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["row"]["doc_id"]: (r["fp"], r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    want = components({f for f, _ in got.values()}, 3)
    low = {}
    for i, (f, _) in got.items():
        low[want[f]] = min(low.get(want[f], i), i)
    assert all(c == low[want[f]] for f, c in got.values())


def test_unused_columns_are_not_read(spark, tmp_path):
    edge_docs(spark).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d")).select("doc_id", "text")
    plan = simhash.with_fingerprint(docs)._jdf.queryExecution().executedPlan().toString()
    assert "source" not in plan
