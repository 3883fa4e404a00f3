"""Rows that every corpus operator must take, and small helpers."""

from __future__ import annotations

import random

#: Columns beside the table's own whose names operators use inside.
CLASHING = "row long, ord string, text_key string, kept_text string, n_words string, ids string, score string, fp string, matches string, places string, id string"
SCHEMA = f"doc_id long, text string, lang string, source string, {CLASHING}"
_EXTRA = (1, "o", "t", "k", "n", "i", "s", "f", "m", "p", "x")


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edge_rows() -> list[tuple]:
    long = sentence(99, 30_000)
    rows = [
        (None, None, None, None),
        (None, sentence(1, 80), "en", None),
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", None, "a"),
        (4, sentence(2, 80), "en", "a"),
        (4, sentence(2, 80), "en", "a"),  # a repeated row
        (4, sentence(3, 70), "en", "a"),  # a tie
        (5, "x\n" + sentence(2, 80) + " end", "en", "b"),
        (6, long, "fr", "b"),
        (7, "été 漢字 😀 ́ <s>[INST]\\ \x00 \x0b", "fr", "b"),
        (8, "one two", "fr", "b"),
    ]
    return [(*r, *_EXTRA) for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
