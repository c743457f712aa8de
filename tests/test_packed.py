"""What takes the disk of a written index and of questions asked of it."""

import glob
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsearch import DocumentMapping, Many, Registry, Settings
from docsearch.operators import bounded, dictionary
from docsearch.operators import postings as made
from docsearch.operators.batch import batch_search
from docsearch.operators.documents import as_json, build_documents
from docsearch.operators.maintain import bulk_index, document_postings, put_documents, update_index
from docsearch.operators.space import IndexSpace
from docsearch.sources.index_tables import read_index_table
from docsearch.sources.shared import fresh_path

ITEM = DocumentMapping("test.Item", "id")
OWNER = DocumentMapping("test.Owner", "id", fields={"parts": {"component": Many("test.Part", "owner")}})
PART = DocumentMapping("test.Part", "pid", root=False, only=["word"])
TEXTS = [(i, f"w{i % 7} w{i % 5} w{i % 3} common") for i in range(60)] + [(100, ""), (101, None)]


def items(spark, rows=TEXTS):
    return {"test.Item": spark.createDataFrame(rows, "id long, text string")}


def written(spark, registry, tables, buckets=4):
    path = fresh_path(spark, "packed-index")
    bulk_index(registry, tables, path, buckets=buckets)
    return IndexSpace.over(spark, path, registry)


def files(path):
    return glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)


def test_tables_of_an_index_are_written_by_zstd(spark):
    space = written(spark, Registry([ITEM]), items(spark))
    found = files(space.path)
    assert found and all(name.endswith(".zstd.parquet") for name in found if "/layout/" not in name)


def test_postings_of_a_document_are_packed_in_one_row(spark):
    rows = [("i", "t", f"{i % 3}", 4, 1.0, i // 3, float(i)) for i in range(9)] + [("i", "t", None, 4, 1.0, 7, 1.0)]
    schema = "index string, type string, id string, len int, boost double, code int, tf double"
    flat = spark.createDataFrame(rows, schema).coalesce(1)
    found = made.packed(flat)
    assert found.count() == 4
    assert sorted(map(str, made.unpacked(found).collect())) == sorted(map(str, flat.collect()))
    assert made.packed(flat.where("1 = 0")).count() == 0


def test_questions_of_an_index_shuffle_its_postings_once(spark):
    space = written(spark, Registry([ITEM]), items(spark))
    asked = spark.createDataFrame([(1, "w1 w2 common"), (2, "w3"), (3, "")], "query_id int, text string")
    found = batch_search(space, asked, "text", 3)
    by_document = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning(index" in x]
    assert len(by_document) == 1 and "hashpartitioning(query_id" in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("query_id = 2").count() == 3


@pytest.mark.parametrize("most", [0, 1000])
def test_bounded_questions_of_an_index(spark, monkeypatch, most):
    monkeypatch.setattr(bounded, "QUESTIONS_A_ROW", most)
    space = written(spark, Registry([ITEM]), items(spark))
    asked = spark.createDataFrame([(1, "w1 w2 common"), (2, "w3 w6 common"), (3, ""), (4, "w4")], "query_id int, text string")
    found, plain = bounded.bounded_batch_search(space, asked, "text", 3), batch_search(space, asked, "text", 3)
    assert sorted(map(tuple, found.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("small", [True, False])
def test_documents_in_several_rows_hold_a_term_once(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(dictionary, "broadcast_if_small", lambda side: side)
    tables = {
        "test.Owner": spark.createDataFrame([(1,), (2,), (3,)], "id long"),
        "test.Part": spark.createDataFrame([(i, 1 + i % 2, f"w{i % 4 // 2}") for i in range(12)], "pid long, owner long, word string"),
    }
    space = written(spark, Registry([OWNER, PART], Settings(max_children=2)), tables)
    assert read_index_table(spark, space.path, "docs").where("part <> 0").count()
    found = spark.createDataFrame([("a", "w0"), ("a", "w1"), ("b", "w1"), ("b", "w1"), ("c", "no")], "word string, term string")
    held = dictionary.holding(space, "parts.word", found, "word")
    assert sorted((r.word, r.id, r.n_terms) for r in held.collect()) == [("a", "1", 2), ("a", "2", 2), ("b", "1", 1), ("b", "2", 1)]


def test_a_replaced_index_leaves_the_disk(spark):
    registry, old = Registry([ITEM]), written(spark, Registry([ITEM]), items(spark))
    target, same = fresh_path(spark, "replaced"), fresh_path(spark, "same")
    removed = spark.createDataFrame([("test", "test_item", "5")], "index string, type string, id string")
    changed = items(spark, [(7, "new words"), (200, "more common"), (7, "new words")])
    typed = build_documents(registry, changed, ITEM)
    fresh = as_json(typed).withColumn("version", F.lit(2).cast("long"))
    assert update_index(spark, old.path, same, removed.where("1 = 0"), replace=True) == old.path and files(old.path)
    update_index(spark, old.path, target, removed, fresh, document_postings(registry, changed, ITEM, typed), {"test_item": typed}, replace=True)
    assert not files(old.path)
    want = [x for x in TEXTS if x[0] not in (5, 7)] + [(7, "new words"), (200, "more common")]
    whole = written(spark, registry, items(spark, want))
    for name, columns in {"postings": ["id", "field", "term", "tf", "len", "positions"], "term_stats": ["field", "term", "df"], "docs": ["id", "source"]}.items():
        now, then = (sorted(map(str, read_index_table(spark, at, name).select(*columns).collect())) for at in (target, whole.path))
        assert now == then
    last = fresh_path(spark, "replaced")
    put_documents(registry, changed, ITEM, typed, removed, target, last, replace=True)
    assert not files(target) and read_index_table(spark, last, "docs").where("id = '7'").count() == 1


def test_batches_are_let_go_when_they_are_joined():
    held = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    (batch,) = made._joined(held)
    assert batch.column("x").to_pylist() == [0, 1, 2] and not held
