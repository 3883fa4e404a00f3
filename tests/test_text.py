"""Literal fixtures for the text functions (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from lodestar.functions.text import default_stop_words, letter_tokens, tag_tokens, word_tokens_2plus
from lodestar.operators.rank import parse_tag_param, tags_any_match


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("x")).first()["x"]


def test_letter_tokens_before_stop_words(spark):
    assert one(spark, letter_tokens(F.col("t")), [("Don't STOP 42 çéa",)], "t string") == ["don", "t", "stop", "a"]


def test_letter_tokens_drop_stop_words_keep_duplicates(spark):
    sw = ["the", "a"]
    got = one(spark, letter_tokens(F.col("t"), sw), [("The cat and the cat a dog",)], "t string")
    assert got == ["cat", "and", "cat", "dog"]


def test_null_text_gives_no_tokens(spark):
    assert one(spark, letter_tokens(F.col("t")), [(None,)], "t string") == []


def test_word_tokens_unicode_two_plus(spark):
    got = one(spark, word_tokens_2plus(F.col("t")), [("Ça va, a été 42 x_y z",)], "t string")
    assert got == ["ça", "va", "été", "42", "x_y"]


def test_tag_split_on_percent(spark):
    assert one(spark, tag_tokens(F.col("t")), [(["50%off"],)], "t array<string>") == ["50", "off"]


def test_tag_tokens_lower_and_stop(spark):
    got = one(spark, tag_tokens(F.col("t"), ["the"]), [(["Fluff", "THE", ""],)], "t array<string>")
    assert got == ["fluff"]


def test_tag_filter_any_match(spark):
    df = spark.createDataFrame([(["Fluff", "Angst"],)], "tags array<string>")
    keep = df.select(tags_any_match(F.col("tags"), F.array(F.lit("fluff"))).alias("k")).first()["k"]
    drop = df.select(tags_any_match(F.col("tags"), F.array(F.lit("flu"))).alias("k")).first()["k"]
    assert keep is True and drop is False


def test_parse_tag_param(spark):
    df = spark.createDataFrame([("a,,b,",), ("",)], "p string")
    rows = [r["x"] for r in df.select(parse_tag_param(F.col("p")).alias("x")).collect()]
    assert rows == [["a", "b"], []]


def test_empty_wanted_keeps_everything(spark):
    df = spark.createDataFrame([(["x"],)], "tags array<string>")
    assert df.select(tags_any_match(F.col("tags"), parse_tag_param(F.lit(""))).alias("k")).first()["k"] is True


def test_default_stop_words_is_spark_english_list():
    sw = default_stop_words()
    assert len(sw) == 181 and "the" in sw and "t" in sw
