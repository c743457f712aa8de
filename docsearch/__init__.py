"""Declarative document mapping, indexing and search over Spark DataFrames."""

from docsearch.plans.clauses import (
    Bool,
    Fuzzy,
    Match,
    MatchAll,
    Phrase,
    Prefix,
    Range,
    Term,
    Wildcard,
    plus_minus,
)
from docsearch.plans.mapping import DocumentMapping, Many, One, Registry
from docsearch.settings import Settings

__all__ = [
    "Bool",
    "DocumentMapping",
    "Fuzzy",
    "Many",
    "Match",
    "MatchAll",
    "One",
    "Phrase",
    "Prefix",
    "Range",
    "Registry",
    "Settings",
    "Term",
    "Wildcard",
    "plus_minus",
]
