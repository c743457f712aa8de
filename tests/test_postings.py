"""Postings are counted some rows at a time, without a shuffle, as one row at a time would be."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from docsearch import DocumentMapping, Registry
from docsearch.operators import postings as made
from docsearch.operators.documents import build_documents
from docsearch.operators.postings import postings, search_fields

ITEM = DocumentMapping("test.Item", "id", fields={"title": {"boost": 0.1}, "tags": {"boost": 0.7}})


def batch(texts, titles):
    n = len(texts)
    rows = [pa.array(["i"] * n), pa.array(["t"] * n), pa.array([str(i) for i in range(n)]), pa.array([0] * n, pa.int64())]
    lists = [pa.array(x, pa.list_(pa.string())) for x in (texts, titles)]
    return pa.RecordBatch.from_arrays([*rows, *lists], names=[*made.ROW, "__t0", "__t1"])


def test_slices_hold_every_row_once_and_cut_none(monkeypatch):
    monkeypatch.setattr(made, "TOKENS_AT_ONCE", 4)
    texts = [["a"] * 3, [], ["b"], ["c"] * 9, [], ["d", "e"], ["f"]]
    found = list(made._slices(batch(texts, [[]] * 7)))
    assert [row for piece in found for row in piece.column(4).to_pylist()] == texts
    assert len(found) > 2 and all(piece.num_rows == 1 or sum(map(len, piece.column(4).to_pylist())) <= 4 for piece in found)


def test_counted_postings_come_in_order_of_terms_in_small_batches(monkeypatch):
    monkeypatch.setattr(made, "POSTINGS_AT_ONCE", 2)
    texts, titles = [["b", "a", "b"], [], ["é", "z", "a"]], [["a"], ["b"], []]
    # rows of a sliced batch, as those of a slice are
    piece = batch([["x"], *texts], [["x"], *titles]).slice(1)
    found = [row for b in made._counted(piece, "_all", [(4, 0.1), (5, 0.7)], 1.0) for row in b.to_pylist()]
    assert [r["term"] for r in found] == ["a", "a", "b", "b", "z", "é"]
    held = {(r["id"], r["term"]): (r["tf"], r["len"], r["positions"]) for r in found}
    assert held == {
        ("1", "a"): (0.0 + 0.1 + 0.7, 4, [1, 3]),
        ("1", "b"): (0.0 + 0.1 + 0.1, 4, [0, 2]),
        ("2", "b"): (0.7, 1, [0]),
        ("3", "é"): (0.1, 3, [0]),
        ("3", "z"): (0.1, 3, [1]),
        ("3", "a"): (0.1, 3, [2]),
    }


def test_postings_equal_a_count_and_shuffle_nothing(spark):
    rows = [(1, "one two one", ["x y", None, "one"]), (2, None, []), (3, "", None), (4, "Two, two!", ["y"])]
    table = spark.createDataFrame(rows, "id long, title string, tags array<string>")
    registry, loaded = Registry([ITEM]), {"test.Item": table}
    found = postings(build_documents(registry, loaded, ITEM), search_fields(registry, loaded, ITEM), with_all=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan
    got = {(r.id, r.field, r.term): list(r.positions) for r in found.where(F.col("field") != "_all").collect()}
    want = {}
    for i, title, tags in rows:
        for field, text in (("title", title or ""), ("tags", " ".join(t for t in tags or [] if t))):
            for place, term in enumerate(text.lower().replace(",", "").replace("!", "").split()):
                want.setdefault((str(i), field, term), []).append(place)
    assert got == want
    totals = Counter({(r.id, r.term): r.tf for r in found.where(F.col("field") == "_all").collect()})
    assert totals[("1", "one")] == 0.0 + 0.7 + 0.1 + 0.1 or totals[("1", "one")] == 0.0 + 0.1 + 0.1 + 0.7
