"""Marking matched terms in stored text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsearch.functions.analyzers import LETTERS, NON_BLANK, WORD

# Default tags and default fragment shape.
PRE_TAG = "<em>"
POST_TAG = "</em>"
FRAGMENT_SIZE = 100
FRAGMENTS = 5

#: for each analyzer what it takes as a word, and what lies between; the runs cover the whole text
PIECES = {
    "standard": (WORD, r"[^\p{L}\p{N}]+"),
    "simple": (LETTERS, r"\P{L}+"),
    "stop": (LETTERS, r"\P{L}+"),
    "whitespace": (NON_BLANK, r"\s+"),
    "keyword": (r"(?s).+", r"(?!)"),
}
LOWERING = ("standard", "simple", "stop")

#: decides whether a word (as written) is to be marked
WordTest = Callable[[Column], Column]


def any_of(terms: Sequence[str]) -> WordTest:
    wanted = sorted({term.lower() for term in terms})
    return lambda word: F.lower(word).isin(wanted)


def normal(how: str) -> Callable[[Column], Column]:
    """A word as the analyzer makes a term of it."""
    return F.lower if how in LOWERING else (lambda word: word)


def highlight(
    text: Column, hit: WordTest, pre: str = PRE_TAG, post: str = POST_TAG, how: str = "standard"
) -> Column:
    """The whole text with every matching word wrapped. Words are never cut, and terms
    and tags are plain values, so neither can be mistaken for a pattern."""
    pieces = F.regexp_extract_all(text, F.lit("|".join(PIECES[how])), F.lit(0))
    marked = F.transform(
        pieces,
        lambda piece: F.when(hit(piece), F.concat(F.lit(pre), piece, F.lit(post))).otherwise(piece),
    )
    return F.array_join(marked, "")


def fragments(
    text: Column,
    hit: WordTest,
    size: int = FRAGMENT_SIZE,
    count: int = FRAGMENTS,
    pre: str = PRE_TAG,
    post: str = POST_TAG,
    how: str = "standard",
) -> Column:
    """The first ``count`` pieces of at most ``size`` characters that hold a match, marked.

    Pieces end after a non-word character, so a word is cut only when it is longer than
    ``size``. ``size`` or ``count`` 0 gives the whole field as one fragment, and so does an exact
    field (``how`` names the field's analyzer).
    """
    if size <= 0 or count <= 0 or how == "keyword":
        whole = F.array(highlight(text, hit, pre, post, how))
        return F.when(_has_match(text, hit, how), whole).otherwise(F.slice(whole, 1, 0))
    cut = rf"(?s).{{1,{size}}}\z|.{{0,{size - 1}}}[^\p{{L}}\p{{N}}]|.{{1,{size}}}"
    pieces = F.regexp_extract_all(text, F.lit(cut), F.lit(0))
    matching = F.filter(pieces, lambda piece: _has_match(piece, hit, how))
    return F.transform(F.slice(matching, 1, count), lambda p: highlight(p, hit, pre, post, how))


def _has_match(text: Column, hit: WordTest, how: str) -> Column:
    return F.exists(F.regexp_extract_all(text, F.lit(PIECES[how][0]), F.lit(0)), hit)
