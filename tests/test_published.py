"""Published sets of tables, the bundle, saved models and the stored gram index."""

import pytest
from pyspark.sql import functions as F

from lodestar.sources import io, models
from lodestar.sources.versions import Layout, current, publish, read_version


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_readers_see_one_version_whole(spark, tmp_path):
    path = str(tmp_path / "set")
    one, two = (spark.createDataFrame([(v, "x")], "v int, s string") for v in (1, 2))
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert publish(spark, path, {"a": one, "b": one}).number == 1
    before = read_version(spark, path)
    broken = two.select(F.raise_error(F.lit("lost")).cast("int").alias("v"), "s")
    with pytest.raises(Exception, match="lost"):  # the first table is written, the second fails: nobody sees either
        publish(spark, path, {"a": two, "b": broken})
    now = read_version(spark, path)
    assert current(spark, path).number == 1 and rows(now["a"]) == rows(now["b"]) == [(1, "x")]
    assert publish(spark, path, {"a": two, "b": two}, about={"k": 3}).number == 2
    after = read_version(spark, path)
    assert rows(after["a"]) == rows(after["b"]) == [(2, "x")] and current(spark, path).about == {"k": 3}
    assert rows(before["a"]) == [(1, "x")]  # a reader of the old version still has it


def test_two_publications_at_once_take_two_numbers(spark, tmp_path, monkeypatch):
    from lodestar.sources import versions

    path = str(tmp_path / "set")
    df = spark.createDataFrame([(1,)], "v int")
    publish(spark, path, {"a": df})
    seen, true = [], versions.current

    def late(s, p):  # another publication ends between the look at the current version and the switch
        now = true(s, p)
        if not seen:
            seen.append(1)
            publish(s, p, {"a": df.select((F.col("v") + 10).alias("v"))})
        return now

    monkeypatch.setattr(versions, "current", late)
    assert publish(spark, path, {"a": df.select((F.col("v") + 1).alias("v"))}).number == 3
    assert rows(read_version(spark, path)["a"]) == [(2,)]


def test_added_rows_join_those_published(spark, tmp_path):
    path = str(tmp_path / "set")
    make = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    publish(spark, path, {"a": make(1, 2), "b": make(7)}, {"a": Layout(("v",))})
    publish(spark, path, {"a": make(3), "b": make(8)}, {"a": Layout(("v",))}, add_to=["a"])
    t = read_version(spark, path)
    assert rows(t["a"]) == [(1,), (2,), (3,)] and rows(t["b"]) == [(8,)]


def test_bucketed_bundle_is_not_moved(spark, tmp_path):
    """The join of requests with ``recs`` has an exchange of the requests only, and a lookup opens one bucket."""
    path = str(tmp_path / "bundle")
    recs = spark.range(400).select((F.col("id") % 40).alias("seed_id"), F.col("id").alias("doc_id"), (F.floor(F.col("id") / 40) + 1).alias("rank"))
    io.write_bundle({"recs": recs}, path, buckets=4)
    loaded = io.read_bundle(spark, path)["recs"]
    assert rows(loaded.select("seed_id", "doc_id", "rank")) == rows(recs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = spark.range(30).select(F.col("id").alias("seed_id"))
        joined = asked.join(loaded, "seed_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("FileScan") - 400 : plan.index("FileScan")]
        assert plan.count("Exchange") == 1 and "Exchange" not in side.split("\n")[-1]
        assert joined.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # by itself a lookup reads the one bucket's file as a plain scan; shown as a bucketed one the plan says so
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    look = loaded.where("seed_id = 7")
    look = spark._jvm.PythonSQLUtils.explainString(look._jdf.queryExecution(), "formatted")
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in look


def test_search_from_a_saved_model_is_the_search_after_the_fit(spark, tmp_path):
    words = "red blue green ring bolt gear plate old new small cat dog".split()
    seeds = spark.createDataFrame([(i, [f"t{i}"], " ".join(words[(i * k) % 12] for k in range(1, 6))) for i in range(30)], "id long, titles array<string>, description string")
    reqs = spark.createDataFrame([(1, "red ring and a cat"), (2, "nothing known"), (3, words[3] * 1)], "request_id long, input_text string")
    model = models.fit_descriptions(seeds, k=6)
    path = str(tmp_path / "model")
    assert models.save_descriptions(model, path) == 1
    loaded = models.load_descriptions(spark, path)
    want, found = models.search_descriptions(model, reqs), models.search_descriptions(loaded, reqs)
    assert rows(found) == rows(want) and len(rows(found)) == 15
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "description" not in plan  # the corpus is not read again
    # fitted to a tolerance instead: the same singular values
    exact = models.fit_descriptions(seeds, k=6, exact=True)
    assert abs(exact.lsa.sigma - models.fit_descriptions(seeds, k=6, passes=30).lsa.sigma).max() < 1e-6


def test_stored_title_index_finds_what_contains_finds(spark, tmp_path):
    import random

    from lodestar.operators import title_index
    from lodestar.operators.search import title_search

    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcAB’é ") for _ in range(rnd.randint(1, 7)))
    data = [(i, [word() + " " + word(), word()] if i % 7 else [], f"T{i % 40}", f"d{i}") for i in range(300)]
    titles = spark.createDataFrame(data, "idx long, titles array<string>, title string, descr string")
    queries = ["a", "ab", "abc", "abca", "abab", "cab a", "’", "a’b", "é", "aaaa", "", "zzz", "AB C", "bacab ab", None]
    reqs = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "request_id long, query string")
    path = str(tmp_path / "index")
    for load in range(3):
        assert title_index.publish_titles(spark, path, titles.where(F.col("idx") % 3 == load)) == load + 1
    index = title_index.load_index(spark, path)
    found = title_index.search_index(index, reqs)
    assert rows(found) == rows(title_search(titles, reqs)) and found.count() > 50
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "titles#" not in plan  # the arrays of titles are not read, their grams not worked out
    title_index.publish_titles(spark, path, titles.where("idx = 1"), add=False)
    assert {r["idx"] for r in title_index.load_index(spark, path)["forms"].collect()} == {1}


def test_json_pages_shuffle_only_what_is_asked_for(spark):
    """the texts of the records stay out of the keyed load's exchange."""
    from lodestar.plans import queries as Q
    from paths import SF_SMALL

    plan = Q.REGISTRY["json_pages_roundtrip"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "description" not in plan


def test_title_index_is_made_by_many_tasks(spark):
    """a catalogue of one partition is dealt out before its grams are cut; many loads, nulls and repeated rows find the same."""
    from lodestar.operators import search as S
    from lodestar.operators import title_index as TI
    from lodestar.sources import io

    rows = [(i % 7, [f"Blue Widget {i % 7}", "odd’s end", None][: 1 + i % 3], f"Blue Widget {i % 7}", f"d{i % 7}") for i in range(21)]
    rows += [(50, None, "none", "x"), (51, ["blue"], None, "y"), (52, ["ab"], "ab", None)]
    titles = spark.createDataFrame(rows, "idx long, titles array<string>, title string, descr string").coalesce(1)
    assert TI.index_tables(titles)["grams"].rdd.getNumPartitions() > 1
    asked = spark.createDataFrame([(q, q) for q in ("blue", "widget 3", "b", "d's", "ab", "odd's end", "none", "")], "request_id string, query string")
    path = io.scratch_path(spark, "index")
    for load in (0, 1):
        TI.publish_titles(spark, path, titles.where(f"idx % 2 = {load}"))
    found = lambda df: sorted(map(str, df.select("request_id", "title", "idx").collect()))
    got = found(TI.search_index(TI.load_index(spark, path), asked))
    assert got and got == found(S.title_search(titles, asked))
