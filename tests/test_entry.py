"""Driver contract and sources/sinks on the driver tables."""

import json

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from lodestar.plans.queries import REGISTRY
from lodestar.operators.rank import seed_lookup
from lodestar.sources import io
from lodestar.sources.keyed import keyed_load_last_wins

ROWS_ONLY = {"description_search", "description_search_saved", "joint_lsa", "tag_svd", "tag_svd_works", "singular_spectrum"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["seed_id", "doc_id", "rank", "score", "keywords"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    import oracle_sql

    q, o = entry.queries(), entry.oracle_sql()
    assert set(REGISTRY) - set(oracle_sql.QUERIES) == ROWS_ONLY
    assert set(oracle_sql.QUERIES) <= set(o) <= set(q)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_queries_run_small(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0
    spark.catalog.clearCache()


def test_oracles_need_no_jars():
    """The SQL loads in a Python that has no Spark at all."""
    import subprocess
    import sys

    code = "import importlib.util as u, sys; s = u.spec_from_file_location('w', 'lodestar/functions/stopwords.py'); m = u.module_from_spec(s); s.loader.exec_module(m); print(len(m.ENGLISH))"
    said = subprocess.run([sys.executable, "-S", "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert said.stdout.strip() == "181"


def test_keyed_last_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, seq long, v string")
    got = sorted(tuple(r) for r in keyed_load_last_wins(df, "k", "seq").collect())
    assert got == [(1, 2, "b"), (2, 1, "c")]


def test_seed_lookup_last_wins(spark):
    s = spark.createDataFrame([(1, ["T"]), (5, ["T"]), (3, ["U"])], "id long, titles array<string>")
    assert sorted(tuple(r) for r in seed_lookup(s).collect()) == [("T", 5), ("U", 3)]


def test_json_pages_array_files(spark, tmp_path):
    p1, p2 = tmp_path / "pg1.json", tmp_path / "pg2.json"
    p1.write_text(json.dumps([{"id": 1, "title": "A", "hits": 3312, "kudos": 153, "chapters": 1, "tags": ["Fluff"], "date": "2019-03-31"}]))
    p2.write_text(json.dumps([{"id": 1, "title": "A2", "hits": None, "tags": []}, {"id": 2, "title": "B"}]))
    df = io.read_works(spark, [str(p1), str(p2)])
    assert df.count() == 3  # union keeps duplicates
    latest = {r["id"]: r for r in keyed_load_last_wins(df.drop("page"), "id", "load_seq").collect()}
    assert latest[1]["title"] == "A2" and latest[1]["hits"] == 0
    first = df.where(F.col("page") == 0).first()
    assert str(first["date"]) == "2019-03-31"


def test_catalog_table_rejects_long_strings(spark):
    name = io.create_catalog_table(spark, "episodes_t", io.scratch_path(spark, "episodes_t"))
    spark.createDataFrame([(1, "ok", "d")], "id int, title string, descr string").write.insertInto(name)
    assert spark.table(name).count() == 1
    with pytest.raises(Exception):
        spark.createDataFrame([(2, "x" * 65, "d")], "id int, title string, descr string").write.insertInto(name)


def test_stream_serving_equals_batch(spark):
    q = entry.queries()
    stream = sorted(tuple(r) for r in q["recommend_stream"](spark, SF_SMALL).collect())
    batch = q["recommend"](spark, SF_SMALL)
    batch = sorted(tuple(r) for r in batch.select(*q["recommend_stream"](spark, SF_SMALL).columns).collect())
    assert stream == batch and len(stream) > 0


def test_recommend_filter_first_and_found_flag(spark):
    from lodestar.plans import pipelines as P
    from lodestar.sources import views

    b = P.build_recommendations(views.seeds(spark, SF_SMALL), views.works(spark, SF_SMALL))
    req = b["seeds_dim"].where(F.col("title").isNotNull()).select(
        F.col("id").alias("request_id"), "title", F.lit(0.5).alias("popularity_weight"),
        F.array(F.lit("quality_1")).alias("tags"),
    )
    after = P.recommend(b["recs"], b["works_dim"], b["seeds_dim"], req)
    first = P.recommend(b["recs"], b["works_dim"], b["seeds_dim"], req, filter_first=True)
    has = lambda df: df.where(~F.array_contains(F.transform("tags", lambda t: F.lower(t)), "quality_1")).count()
    assert has(after) == 0 and has(first) == 0
    assert first.count() >= after.count()  # filtering first refills the 49 slots
    ranks = first.groupBy("request_id").agg(F.max("rank").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["m"] == r["n"] for r in ranks)
    ids = spark.createDataFrame([(0,), (10**12,)], "fanfic_id long")
    found = {r["fanfic_id"]: r["found"] for r in P.work_tags(b["works_dim"], ids, with_found=True).collect()}
    assert found == {0: True, 10**12: False}


def test_assign_dense_index_many_partitions(spark):
    import random

    from lodestar.operators.keys import assign_dense_index

    ids = random.Random(5).sample(range(10**6), 500)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    got = {r["id"]: r["index"] for r in assign_dense_index(df, "id").collect()}
    assert got == {v: k for k, v in enumerate(sorted(ids))}


def test_tag_vocabulary_cut_and_restrict(spark):
    from lodestar.operators import tags as T
    from lodestar.plans import pipelines as P
    from lodestar.sources import views

    seeds, works = views.seeds(spark, SF_SMALL), views.works(spark, SF_SMALL)
    full = [r["tag"] for r in P.tag_vocabulary(seeds, works).orderBy("tag_rank").collect()]
    cut = P.tag_vocabulary(seeds, works, num_tags=5).orderBy("tag_rank").collect()
    assert [r["tag"] for r in cut] == sorted(full)[:5] and [r["tag_rank"] for r in cut] == [1, 2, 3, 4, 5]
    vocab = spark.createDataFrame([(1, t["tag"]) for t in cut], "tag_rank long, tag string")
    kept = {r["id"] for r in T.restrict_to_vocab(works, vocab).collect()}
    want = {r["id"] for r in works.collect() if {t.lower() for t in r["tags"]} & {t["tag"] for t in cut}}
    assert kept == want


def test_inverted_index_chunks_are_bounded(spark):
    rows = entry.queries()["inverted_index"](spark, SF_SMALL).collect()
    assert max(len(r["postings"].split(" ")) for r in rows) <= 1024
    for r in rows:
        docs = [int(p.split(":")[0]) for p in r["postings"].split(" ")]
        assert docs == sorted(docs) and all(d // 1024 == r["chunk"] for d in docs)


def test_empty_titles_and_unknown_lookups(spark):
    from lodestar.functions.text import primary_title
    from lodestar.plans import pipelines as P

    s = spark.createDataFrame([(1, [], "d", [], []), (2, ["T"], "e", ["A"], ["g1", "g2", "g3", "g4", "g5"])],
                              "id long, titles array<string>, description string, authors array<string>, genres array<string>")
    assert [r["p"] for r in s.orderBy("id").select(primary_title(F.col("titles")).alias("p")).collect()] == [None, "T"]
    sd = s.withColumn("title", primary_title(F.col("titles")))
    req = spark.createDataFrame([(7, "T"), (8, "missing")], "request_id long, title string")
    rows = P.seed_detail(sd, req).collect()
    assert [(r["request_id"], r["author"], r["genres"]) for r in rows] == [(7, "A", ["g1", "g2", "g3", "g4"])]


def test_load_order_across_files_of_a_page(spark, tmp_path):
    """The record in the later file wins however large the files are and whatever task reads them."""
    page = tmp_path / "page"
    page.mkdir()
    old = [{"id": 1, "title": "OLD"}]
    new = [{"id": i, "title": "x" * 200} for i in range(2, 4000)] + [{"id": 1, "title": "NEW"}]
    for name, rows in (("part-00000.json", old), ("part-00001.json", new)):
        (page / name).write_text("\n".join(json.dumps(r) for r in rows))
    other = tmp_path / "other.json"
    other.write_text(json.dumps({"id": 5, "title": "LAST"}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "65536"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = io.read_works(spark, [str(page), str(other), str(page)], multiline=False)
            assert df.count() == 2 * (len(old) + len(new)) + 1
            latest = {r["id"]: r["title"] for r in keyed_load_last_wins(df.drop("page"), "id", "load_seq").collect()}
            assert latest[1] == "NEW" and latest[5] == "x" * 200
            df = io.read_works(spark, [str(page), str(other)], multiline=False)
            latest = {r["id"]: r["title"] for r in keyed_load_last_wins(df.drop("page"), "id", "load_seq").collect()}
            assert latest[1] == "NEW" and latest[5] == "LAST"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_input_index_over_shuffled_pages(spark, tmp_path):
    """Positions as the records stand in the pages, however the files are split; a lost duplicate leaves no gap."""
    import random

    from lodestar.operators.keys import assign_input_index

    ids = random.Random(3).sample(range(10**6), 4000)
    for name, part in (("one", ids[:2500]), ("two", ids[2500:] + ids[:1])):
        (tmp_path / name).mkdir()
        for k in range(0, len(part), 700):
            (tmp_path / name / f"part-{k:05}.json").write_text("\n".join(json.dumps({"id": i, "title": "t" * 60}) for i in part[k : k + 700]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "20000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            loaded = io.read_works(spark, [str(tmp_path / "one"), str(tmp_path / "two")], multiline=False)
            got = sorted((r["index"], r["id"]) for r in assign_input_index(loaded).select("index", "id").collect())
            assert got == list(enumerate(ids + ids[:1]))
            last = keyed_load_last_wins(loaded, "id", "load_seq")
            got = sorted((r["index"], r["id"]) for r in assign_input_index(last).select("index", "id").collect())
            assert got == list(enumerate(ids[1:] + ids[:1]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_array_files_are_split_at_records(spark, tmp_path):
    """One array file read by many tasks gives the records that a whole read gives, strings of braces and quotes included."""
    import random

    from lodestar.sources.arrays import read_json_arrays

    rnd = random.Random(5)
    bits = ["{", "}", '"', "\\", "[", "]", ",", "}, {", "\n", "word", "é漢", '\\"}', "  "]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
    records = [{"titles": [text() for _ in range(rnd.randint(0, 3))], "rank": i, "description": text() * rnd.choice([1, 1, 40]), "extra": {"a": {"b": text()}}} for i in range(900)]
    schema = io.SEED_SCHEMA
    dumps = [json.dumps(records[:500]), json.dumps(records[500:800], indent=2, ensure_ascii=False), "[]", "[ ]\n", json.dumps(records[800:], separators=(",", ":"))]
    paths = []
    for k, d in enumerate(dumps):
        paths.append(str(tmp_path / f"array-{k}.json"))
        with open(paths[-1], "w", encoding="utf-8") as f:
            f.write(d)
    conf = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert spark.read.option("lineSep", "}").text(paths).rdd.getNumPartitions() > 3 * len(paths)
        got = read_json_arrays(spark, paths, schema).select("rank", "page", "load_seq", "titles", "description").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = io.read_seeds(spark, paths).select("rank", "page", "titles", "description").collect()
    key = lambda r: (r["rank"], r["page"], r["titles"], r["description"])
    assert sorted(map(key, got)) == sorted(map(key, whole)) == sorted((r["rank"], {True: 0, False: 1}[r["rank"] < 500] if r["rank"] < 800 else 4, r["titles"], r["description"]) for r in records)
    assert [r["rank"] for r in sorted(got, key=lambda r: r["load_seq"])] == list(range(900))


def test_whole_vocabulary_counts(spark):
    """A vocabulary of any size is used whole."""
    from lodestar.operators import tags as T

    works = spark.createDataFrame([(i, [f"Tag{i}"]) for i in range(400)] + [(900, ["none"]), (901, []), (902, None)], "id long, tags array<string>")
    vocab = spark.createDataFrame([(i, f"tag{i}") for i in range(400)], "tag_rank long, tag string")
    assert {r["id"] for r in T.restrict_to_vocab(works, vocab).collect()} == set(range(400))
    assert T.restrict_to_vocab(works, vocab.limit(0)).count() == 0


def test_slider_weight(spark):
    from lodestar.operators.rank import parse_weight

    given = ["0", "100", " 35 ", "140", "-3", "x", "", "1.5", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string").select("i", parse_weight(F.col("v")).alias("w"))
    assert [r["w"] for r in rows.orderBy("i").collect()] == [0.0, 1.0, 0.35, 1.0, 0.0, None, None, None, None]


def test_bound_check_counts_rows_and_bytes(spark):
    from lodestar.session import bounded_rows

    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "i long, s string")
    assert bounded_rows(df, 50) and not bounded_rows(df, 49) and not bounded_rows(df, 50, max_bytes=4000)
