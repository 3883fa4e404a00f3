"""Column-level text functions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.stopwords import ENGLISH

# Fixed values that must equal the reference's behaviour.
# Tokeniser of the batch index: runs of ASCII letters after lower-casing.
LETTER_RUN = "[a-z]+"
# Vectoriser default: Unicode word characters, two or more in a row.
WORD_2PLUS = "[\\p{L}\\p{N}_]{2,}"
# What lies between the tokens of either kind.
NON_LETTERS = "[^a-z]+"
NON_WORD = "[^\\p{L}\\p{N}_]+"
# Separator used to join a work's tags into one string before re-splitting.
TAG_JOIN = "%"
# Right single quotation mark, normalised to an ASCII apostrophe in title search.
RIGHT_QUOTE = "’"
APOSTROPHE = "'"

Tokenizer = Callable[[Column], Column]


def default_stop_words(language: str = "english") -> tuple[str, ...]:
    """The default stop words; callers may pass any other list instead (it is a parameter everywhere)."""
    if language != "english":
        raise ValueError(f"no stop words for {language!r}: pass a list")
    return ENGLISH


def drop_stop_words(tokens: Column, stop_words: Sequence[str] | None) -> Column:
    """Remove stop words, keeping duplicates and order (an IN-set hash lookup per token)."""
    if not stop_words:
        return tokens
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(words))


def letter_tokens(text: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Lower-case, runs of ``[a-z]``, minus stop words. Null text gives no tokens."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTER_RUN), 0)
    return drop_stop_words(toks, stop_words)


def word_tokens_2plus(text: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Lower-case Unicode words of at least two characters (vectoriser default)."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_2PLUS), 0)
    return drop_stop_words(toks, stop_words)


def between(text: Column, separators: str) -> Column:
    """The lower-cased text cut at its separators; pieces may be empty. To be exploded, where it is cheaper than matching tokens."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), separators)


def tag_tokens(tags: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Tags joined by '%', lower-cased, re-split on '%'; empties vanish.

    A tag containing '%' becomes two tokens, exactly as joining and re-splitting does.
    """
    joined = F.lower(F.array_join(F.coalesce(tags, F.array().cast("array<string>")), TAG_JOIN))
    parts = F.filter(F.split(joined, TAG_JOIN), lambda x: x != F.lit(""))
    return drop_stop_words(parts, stop_words)


def normalise_apostrophe(s: Column) -> Column:
    """T5: U+2019 to an ASCII apostrophe."""
    return F.replace(s, F.lit(RIGHT_QUOTE), F.lit(APOSTROPHE))


def primary_title(titles: Column) -> Column:
    """First title; null for an empty list (ANSI-safe ``get``)."""
    return F.get(titles, 0)


def lower_all(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.lower(x))
