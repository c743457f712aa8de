"""Odd tables and small brute-force helpers for the tests of the training-data operators."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet consectetur " * 4000

ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, LONG, "fr", "b"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today", None, "a"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today", None, "a"),
    (None, "Un petit texte en français pour voir <|endoftext|> ce qui se passe", "fr", None),
    (7, " \n\t  ", "de", "c"),
    (8, "1234 5678 !!! ???", "de", "c"),
    (9, "naïve ΣΑΣ 漢字 🙂 I'LL don't x\x85y é", "es", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: names that the operators use inside
CLASHES = (
    "id", "h", "a", "b", "key", "node", "component", "first", "fingerprint", "gone", "owner", "dropped",
    "whole", "ids", "curve", "tie", "held", "lang_pred", "score", "line_no", "kept", "rank", "start",
)


def odd_docs(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows and clashing columns."""
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    for name in CLASHES:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs.selectExpr("*", "CAST(length(text) AS LONG) AS n_chars")


def no_docs(spark):
    return odd_docs(spark).where("1 = 0")


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def edits(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def smallest(nodes, linked):
    """The smallest node that each can reach, by trying all pairs."""
    nodes = sorted(nodes)
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[i + 1 :]:
            if linked(x, y):
                p, q = find(x), find(y)
                top[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}
