"""Query clauses: plain values that describe a question.

A clause tree stays on the driver and is as small as the question; ``operators.search``
turns it into one filter and one aggregate. Thousands of questions go through
``operators.batch`` instead, as a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

ALL = "_all"


@dataclass(frozen=True)
class Match:
    """Analysed text: any term matches, or every term with ``operator="all"``."""

    text: str
    field: str = ALL
    operator: str = "any"
    boost: float = 1.0


@dataclass(frozen=True)
class Term:
    """One exact term, not analysed."""

    field: str
    value: Any
    boost: float = 1.0


@dataclass(frozen=True)
class Phrase:
    """Terms next to each other, or within ``slop`` positions of that."""

    text: str
    field: str = ALL
    slop: int = 0
    boost: float = 1.0


@dataclass(frozen=True)
class Prefix:
    field: str
    value: str
    boost: float = 1.0


@dataclass(frozen=True)
class Wildcard:
    """``*`` stands for any run of characters, ``?`` for exactly one."""

    field: str
    pattern: str
    boost: float = 1.0


@dataclass(frozen=True)
class Fuzzy:
    """Terms within ``distance`` edits."""

    field: str
    value: str
    distance: int = 2
    boost: float = 1.0


@dataclass(frozen=True)
class Range:
    """A typed column between bounds; a bound that is None is open."""

    field: str
    low: Any = None
    high: Any = None
    include_low: bool = True
    include_high: bool = True
    boost: float = 1.0


@dataclass(frozen=True)
class MatchAll:
    boost: float = 1.0


@dataclass(frozen=True)
class Bool:
    """Every ``must``, no ``must_not``; ``should`` adds to the score, and at least one of
    them has to match when there is no ``must``. None entries are optional clauses left out."""

    must: Sequence = ()
    should: Sequence = ()
    must_not: Sequence = ()
    boost: float = 1.0

    def __post_init__(self):
        for name in ("must", "should", "must_not"):
            given = getattr(self, name)
            given = list(given) if isinstance(given, list | tuple) else [given]
            object.__setattr__(self, name, tuple(c for c in given if c is not None))


def plus_minus(
    required: Sequence[str] = (),
    prohibited: Sequence[str] = (),
    optional: Sequence[str] = (),
    field: str = ALL,
) -> Bool:
    """Required, prohibited and optional words of one field."""
    return Bool(
        must=[Match(word, field, "all") for word in required],
        must_not=[Match(word, field) for word in prohibited],
        should=[Match(word, field) for word in optional],
    )
