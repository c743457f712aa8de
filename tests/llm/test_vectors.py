"""Bit-sliced top-k, metric join, components."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from odd import smallest

from docsearch.llm import bit_sliced, metric_join, tables
from docsearch.llm.components import components

VECTOR = "vec_id long, embedding array<double>, label string"


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(10, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    pairs += pairs[:20]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert found == {**{i: 10 for i in range(10, 61)}, **{100 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def _best(vectors, asked, k):
    usable = sorted(
        {
            (i, tuple(math.floor(64 * x) for x in v))
            for i, v in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
        }
    )
    out = set()
    for q, qv in usable:
        if asked(q):
            scored = sorted(
                (-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(qv)
            )
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "PART_QUERIES", 3)
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.02, 0.7]) for _ in range(6)]) for i in range(150)]
    vectors += [(0, vectors[0][1]), (500, None), (501, []), (502, [None] * 6), (503, [math.nan] * 6), (504, [math.inf] * 6)]
    vectors += [(None, [1.0] * 6), (520, [1.0, 2.0]), (540, [3.0, -2.0]), (560, [0.0] * 6)]
    table = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, id string, block int")
    found = bit_sliced.top_k(table, table.where("vec_id % 20 = 0"), k=7, block_rows=40)
    assert {tuple(r) for r in found.collect()} == _best(vectors, lambda i: i % 20 == 0, 7)
    assert found.count() == len(_best(vectors, lambda i: i % 20 == 0, 7))


def test_top_k_of_few_and_of_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in bit_sliced.top_k(table, table).collect()] in (
        [(0, 1, 1, 8192), (1, 1, 0, 8192)],
        [(1, 1, 0, 8192), (0, 1, 1, 8192)],
    )
    assert bit_sliced.top_k(table.where("1 = 0"), table).count() == 0
    assert bit_sliced.top_k(table, table.where("1 = 0")).count() == 0


def test_added_bitmaps_count():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 1 << 63, size=(13, 2), dtype=np.uint64)
    total = bit_sliced.added([[maps[:5], maps[5:]], []])
    bits = np.unpackbits(maps.view(np.uint8), axis=1, bitorder="little").sum(axis=0)
    got = sum(
        np.unpackbits(t.view(np.uint8), bitorder="little").astype(int) << w for w, t in enumerate(total) if t is not None
    )
    assert (got == bits).all()


def _vector_table():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vectors = []
    for i in range(240):
        noise = rng.normal(scale=0.25, size=8)
        vectors.append((i * 3 % 251, (centres[i % 6] + noise).tolist(), [None, "a", "b", "b"][i % 4]))
    vectors += [(1000 + i, vectors[1][1], "a") for i in range(5)]
    vectors += [vectors[2], (2000, None, "a"), (2001, [0.0] * 8, "a"), (2002, [None] * 8, "a")]
    vectors += [(2003, [math.nan] * 8, "a"), (2004, vectors[1][1][:4], "a"), (2005, [x * 1e-200 for x in vectors[1][1]], "a")]
    return vectors


def _near(vectors):
    usable = {
        i: (np.array(v), label)
        for i, v, label in vectors
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }

    def linked(x, y):
        (a, p), (b, q) = usable[x], usable[y]
        if p != q or len(a) != len(b):
            return False
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.93

    top = smallest(usable, linked)
    links = {x: sum(linked(x, y) for y in usable if y != x) for x in usable}
    return [(i, links.get(i, 0), top.get(i, i), top.get(i, i) == i) for i, _, _ in vectors]


def test_metric_join_equals_brute_force(spark, monkeypatch):
    vectors = _vector_table()
    table = spark.createDataFrame([(*v, "x", 2) for v in vectors], VECTOR + ", id string, space int")
    want = sorted(_near(vectors))
    assert sum(n > 0 for _, n, _, _ in want) > 50
    assert sorted(tuple(r) for r in metric_join.near_vectors(table).collect()) == want
    # many pivots, and cells in many blocks, change nothing
    monkeypatch.setattr(metric_join, "PIVOT_ROWS", 10)
    monkeypatch.setattr(metric_join, "BLOCK_ROWS", 7)
    assert sorted(tuple(r) for r in metric_join.near_vectors(table).collect()) == want


def test_metric_join_in_rounds_equals_brute_force(spark, monkeypatch):
    vectors = _vector_table()[::4]
    for name, value in {"PIVOT_ROWS": 10, "BLOCK_ROWS": 7, "ROUND_ROWS": 1}.items():
        monkeypatch.setattr(metric_join, name, value)
    made = []
    monkeypatch.setattr(metric_join, "written", lambda rows, label: made.append(label) or tables.written(rows, label))
    found = metric_join.near_vectors(spark.createDataFrame(vectors, VECTOR))
    assert sorted(map(tuple, found.collect())) == sorted(_near(vectors))
    assert made.count("vector-links") > 1


def test_a_row_holds_its_vector_and_no_pivots():
    pivots = {"2:a": np.eye(2)}
    batch = pa.RecordBatch.from_pylist(
        [
            {"space": s, "id": i, "copies": 1, "vector": v}
            for i, (s, v) in enumerate([("2:a", [3.0, 0.1]), ("2:b", [1.0, 0.0]), ("2:a", [1.0, 1.0]), ("2:a", [0.0, 2.0])])
        ]
    )
    (found,) = metric_join._cells(0.3, pivots)([batch])
    assert found.drop_columns(["home", "cells"]).equals(batch)
    assert [(r["home"], r["cells"]) for r in found.to_pylist()] == [(0, [0]), (0, [0]), (0, [0, 1]), (1, [1])]


def test_metric_join_of_nothing_and_null_ids(spark):
    table = spark.createDataFrame([(None, [1.0], "a"), (4, [1.0], "a")], VECTOR)
    assert sorted(map(tuple, metric_join.near_vectors(table).collect()), key=repr) == [
        (4, 0, 4, True),
        (None, 0, None, None),
    ]
    assert metric_join.near_vectors(table.where("1 = 0")).count() == 0


def test_top_k_keeps_rows_with_large_components(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0**21, 0.0]), (2, [0.5, 0.0]), (3, [-(2.0**80), -3.0]), (4, [2.0**40, -1.0]), (20, [0.0, -2.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = bit_sliced.top_k(table, table.where("vec_id % 20 = 0"), k=3)

    def score(a, b):
        return sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b, strict=True))

    want = []
    for q, own in rows:
        if q % 20 == 0:
            best = sorted(((-score(own, v), i) for i, v in rows if i != q))[:3]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert found.where("vec_id = 1").count() and found.where("vec_id = 3").count()
    with pytest.raises(Exception, match="no 64-bit integer"):
        bit_sliced.top_k(table, table.where("vec_id % 20 = 0"), k=5).collect()
