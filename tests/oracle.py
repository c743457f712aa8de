"""Side-by-side comparison of a registered query with its SQL."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    for name in NAMES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return base


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = (tuple(_plain(row[i]) for i in order) for row in rows)
    return sorted(plain, key=repr)


def compare(frame, base, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    found = base.execute(sql)
    sql_names = [c[0] for c in found.description]
    if sorted(frame.columns) != sorted(sql_names):
        return f"columns {sorted(frame.columns)} vs {sorted(sql_names)}"
    ours = _rows(frame.columns, frame.collect())
    theirs = _rows(sql_names, found.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    kinds = [tuple(type(v).__name__ for v in r) for r in (ours[0], theirs[0])] if ours else []
    if different:
        return f"{len(different)} of {len(ours)} rows differ, first {str(different[0])[:600]}"
    if kinds and kinds[0] != kinds[1] and None not in (*ours[0], *theirs[0]):
        return f"types {kinds[0]} vs {kinds[1]}"
    return None
