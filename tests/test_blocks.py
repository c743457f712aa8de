"""An index keeps the postings of a term that one task finds in one row, and shuffles none to write them."""

import pyarrow as pa
from pyspark.sql import functions as F

from docsearch import DocumentMapping, Many, Registry, Settings
from docsearch.operators import postings as made
from docsearch.operators.documents import build_documents
from docsearch.operators.maintain import bulk_index, document_blocks, document_postings
from docsearch.operators.postings import postings, whole_lengths
from docsearch.sources.index_tables import bucket_of, closed, opened, read_index_table
from docsearch.sources.shared import fresh_path

ITEM = DocumentMapping("test.Item", "id", fields={"title": {"boost": 0.5}})
COLUMNS = ["id", "part", "field", "term", "tf", "len", "boost", "positions"]


def items(spark):
    rows = [(i, f"one two one w{i % 5}") for i in range(40)] + [(99, None), (None, "lost")]
    return spark.createDataFrame(rows, "id long, title string").coalesce(1)


def collected(rows):
    return sorted(repr(r) for r in rows.select(*COLUMNS).collect())


def test_a_written_index_holds_few_rows_and_every_posting(spark):
    registry, loaded, path = Registry([ITEM]), {"test.Item": items(spark)}, fresh_path(spark, "blocks")
    bulk_index(registry, loaded, path)
    found = read_index_table(spark, path, "postings")
    typed = spark.read.parquet(f"{path}/typed/{ITEM.type_name}")
    assert collected(found) == collected(document_postings(registry, loaded, ITEM, typed))
    stored = spark.read.parquet(f"{path}/postings").count()
    assert stored * 2 < found.count()
    stats = read_index_table(spark, path, "term_stats").where("field = 'title'")
    assert {r.term: r.df for r in stats.collect()} == {"one": 40, "two": 40, **{f"w{i}": 8 for i in range(5)}}


def test_blocks_are_made_without_a_shuffle(spark):
    registry, loaded = Registry([ITEM]), {"test.Item": items(spark)}
    blocks = document_blocks(registry, loaded, ITEM, build_documents(registry, loaded, ITEM), 4)
    assert "Exchange" not in blocks._jdf.queryExecution().executedPlan().toString()


def test_blocks_hold_one_type_and_are_cut_at_terms(monkeypatch):
    monkeypatch.setattr(made, "POSTINGS_AT_ONCE", 3)
    columns = [["i"] * 4, ["s", "t", "s", "t"], list("0123"), [0] * 4, [["b", "a", "b"], ["b"], ["b", "c"], []]]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.string())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*made.ROW, "__t0"])
    found = [row for b in made._blocked(batch, "text", [(4, 1.0)], 1.0) for row in b.to_pylist()]
    held = sorted((r["term"], r["type"], i, t, n, p) for r in found for i, t, n, p in zip(r["ids"], r["tfs"], r["lens"], r["places"]))
    assert held == [
        ("a", "s", "0", 1.0, 3, [1]),
        ("b", "s", "0", 2.0, 3, [0, 2]),
        ("b", "s", "2", 1.0, 2, [0]),
        ("b", "t", "1", 1.0, 1, [0]),
        ("c", "s", "2", 1.0, 2, [1]),
    ]


def test_rows_closed_and_opened_again_are_the_same(spark):
    registry, loaded = Registry([ITEM]), {"test.Item": items(spark)}
    rows = document_postings(registry, loaded, ITEM, build_documents(registry, loaded, ITEM).where("id is not null"))
    again = opened(closed(rows.withColumn("bucket", bucket_of(F.col("term"), 4))))
    assert collected(again) == collected(rows)


def test_documents_in_several_rows_keep_their_whole_lengths(spark):
    line = DocumentMapping("test.Line", "no", root=False, only=["word"])
    owner = DocumentMapping("test.Owner", "id", only=["name", "lines"], fields={"lines": {"component": Many("test.Line", "owner")}})
    registry = Registry([owner, line], Settings(max_children=3))
    lines = [(i, i % 3 if i < 9 else 0, f"word w{i}") for i in range(14)]
    loaded = {
        # one owner is given twice, with names of unequal length
        "test.Owner": spark.createDataFrame([(0, "a"), (1, "b"), (2, "c d"), (2, "e f g"), (3, "h")], "id long, name string"),
        "test.Line": spark.createDataFrame(lines, "no long, owner long, word string"),
    }
    documents = build_documents(registry, loaded, owner)
    fields = made.search_fields(registry, loaded, owner)
    want = collected(whole_lengths(postings(documents, fields, True)))
    assert collected(document_postings(registry, loaded, owner, documents)) == want
    assert collected(opened(document_blocks(registry, loaded, owner, documents, 4))) == want


def test_rows_of_small_batches_are_counted_together(spark):
    registry, loaded = Registry([ITEM]), {"test.Item": items(spark)}
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    try:
        blocks = document_blocks(registry, loaded, ITEM, build_documents(registry, loaded, ITEM), 4)
        held = {(r.field, r.term): len(r.ids) for r in blocks.collect()}
        assert blocks.count() == len(held)
    finally:
        spark.conf.set(name, before)
    assert held["title", "one"] == 40 and held["title", "w3"] == 8
