"""Analyzers: text column -> array of terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a word, and the words the ``stop`` analyzer leaves out.
WORD = r"[\p{L}\p{N}]+"
LETTERS = r"\p{L}+"
NON_BLANK = r"\S+"
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
    "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
    "there", "these", "they", "this", "to", "was", "will", "with",
)


def _all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def standard(text: Column) -> Column:
    return _all_matches(F.lower(text), WORD)


def simple(text: Column) -> Column:
    return _all_matches(F.lower(text), LETTERS)


def whitespace(text: Column) -> Column:
    return _all_matches(text, NON_BLANK)


def keyword(text: Column) -> Column:
    return F.when(text.isNotNull(), F.array(text))


def stop(text: Column) -> Column:
    stop_words = F.array(*[F.lit(word) for word in STOP_WORDS])
    return F.filter(simple(text), lambda term: ~F.array_contains(stop_words, term))


ANALYZERS: dict[str, Callable[[Column], Column]] = {
    "standard": standard,
    "simple": simple,
    "whitespace": whitespace,
    "keyword": keyword,
    "stop": stop,
}


def exploding(terms: Column) -> Column:
    """An array of terms in the form to hand to ``explode``: all of it, as an expression. For a
    bare column Spark infers a filter on its size and pushes that below the analysis, which
    then runs twice per text; for an expression it infers nothing."""
    return F.slice(terms, 1, 2**31 - 1)


def analyzer(name: str) -> Callable[[Column], Column]:
    try:
        return ANALYZERS[name]
    except KeyError:
        raise ValueError(f"unknown analyzer {name!r}; known: {sorted(ANALYZERS)}") from None
