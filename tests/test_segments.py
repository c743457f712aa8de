"""A segmented index: changes at their own cost, merged statistics, drops without reading."""

import os

import pytest
from pyspark.sql import functions as F

from catalog.entities import CROSS, PAGE, TURN, cross_registry
from docsearch import DocumentMapping, Many, Match, Phrase, Prefix, Range, Registry, Term
from docsearch.operators.batch import batch_search
from docsearch.operators.documents import build_documents
from docsearch.operators.maintain import bulk_index
from docsearch.operators.search import count_hits, search
from docsearch.operators.segments import SegmentedIndex, live_partitions
from docsearch.operators.space import IndexSpace
from docsearch.sources.shared import fresh_path

ITEM = DocumentMapping("test.Item", "id", fields={"tag": {"index": "not_analyzed"}})
OTHER = DocumentMapping("test.Other", "id")
REGISTRY = Registry([ITEM, OTHER])
COLUMNS = "id bigint, name string, tag string, price double"


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def items(count, word="old"):
    return [(i, f"{word} thing{i % 3} common", f"t{i % 2}", float(i)) for i in range(count)]


def keys(spark, *ids, kind="test_item"):
    return spark.createDataFrame([("test", kind, str(i)) for i in ids], "index string, type string, id string")


def put(spark, index, rows, removed=None, mapping=ITEM):
    given = {mapping.full_name: table(spark, rows)}
    index.put(given, mapping, build_documents(REGISTRY, given, mapping), removed)


def made(spark, rows):
    tables = {"test.Item": table(spark, rows), "test.Other": table(spark, [(1, "old other", "x", 1.0)])}
    return SegmentedIndex.create(REGISTRY, tables, fresh_path(spark, "s"), buckets=4)


def state(space):
    stats = {(r.type, r.field, r.term): r.df for r in space.term_stats(F.lit(True), ()).collect() if r.df}
    held = sorted((r.type, r.id) for r in space.keys().collect())
    return stats, held, space.count().first().num_docs


def fresh_state(spark, rows, others=1):
    """The same of an index written at once."""
    path = fresh_path(spark, "f")
    tables = {"test.Item": table(spark, rows)}
    if others:
        tables["test.Other"] = table(spark, [(1, "old other", "x", 1.0)])
    bulk_index(REGISTRY, tables, path, buckets=4)
    return state(IndexSpace.over(spark, path, REGISTRY))


def files(index):
    found = {}
    for folder, _, names in os.walk(index.path):
        for name in names:
            at = os.path.join(folder, name)
            found[at] = os.stat(at).st_mtime_ns, os.stat(at).st_size
    return found


def test_changes_and_merges_equal_an_index_written_at_once(spark):
    index = made(spark, items(12))
    before = files(index)
    put(spark, index, [(3, "new thing9", "t7", 3.0), (3, "new thing9", "t7", 3.0), (40, "new", None, None)], keys(spark, 5, 99))
    index.remove(keys(spark, 6, 40, 6))
    put(spark, index, [(40, "last thing0", "t0", 4.0), (None, "nobody", "t0", 1.0)])
    index.remove(keys(spark, 7))
    left = [r for r in items(12) if r[0] not in (3, 5, 6, 7)] + [(3, "new thing9", "t7", 3.0), (40, "last thing0", "t0", 4.0)]
    want = fresh_state(spark, left)
    assert state(index.space()) == want
    after = files(index)
    assert {at: after[at] for at in before} == before

    def asked(space):
        hits = search(space, Match("thing0 new last", "name")).hits.collect()
        phrase = search(space, Phrase("old thing1", "name")).hits.collect()
        priced = count_hits(space, Range("price", 2.0, 9.0)).first().n
        many = batch_search(space, spark.createDataFrame([(1, "thing1 last")], "query_id int, text string"), "name")
        best = sorted((r.query_id, r.id, r.score) for r in many.collect())
        return sorted(map(tuple, hits)), sorted(map(tuple, phrase)), priced, best, search(space, Prefix("name", "th")).total().first().total

    first = asked(index.space())
    assert first[0] and first[1] and first[3]
    assert index.merge(fan=2) >= 1
    assert len(index.space().segments()) < 5
    assert (state(index.space()), asked(index.space())) == (want, first)
    assert {at: files(index)[at] for at in before} == before
    index.compact()
    assert (state(index.space()), asked(index.space())) == (want, first)
    assert [len(rows) for rows in index.space().segments().values()] == [2]


def test_a_rejected_row_is_kept_apart(spark):
    index = made(spark, items(3))
    put(spark, index, [(None, "nobody", "t0", 1.0), (9, "kept", "t0", 1.0)])
    at = live_partitions(spark, index.path)[1][-1]["path"]
    rejects = spark.read.parquet(f"{at}/rejects").collect()
    assert [r.reason for r in rejects] == ["no id"]
    assert count_hits(index.space(), Match("nobody", "name")).first().n == 0
    assert count_hits(index.space(), Match("kept", "name")).first().n == 1


def test_merges_take_the_newest_of_a_size(spark):
    index = made(spark, items(40))
    for i in range(4):
        put(spark, index, [(100 + i, "new", "t0", 1.0)])
    assert index.merge() == 1
    sizes = [sum(r["docs"] for r in rows) for rows in index.space().segments().values()]
    assert sizes == [41, 4]
    assert index.merge() == 0


def test_a_drop_reads_no_document(spark, folder):
    index = made(spark, items(5))
    before = files(index)
    spark.sparkContext.setJobGroup("drop", "drop")
    index.drop_types([ITEM])
    spark.sparkContext.setJobGroup("", "")
    assert {at: files(index)[at] for at in before} == before
    # one more manifest, and nothing else
    assert all("/manifests/" in at for at in files(index) if at not in before)
    space = index.space()
    assert [(r.type, r.id) for r in space.keys().collect()] == [("test_other", "1")]
    assert count_hits(space, Match("old", "name")).first().n == 1
    plan = space.keys()._jdf.queryExecution().executedPlan().toString()
    assert "test_other" in plan and "PartitionFilters" in plan
    put(spark, index, [(1, "again", "t0", 1.0)])
    assert state(index.space()) == fresh_state(spark, [(1, "again", "t0", 1.0)])


def test_dropped_documents_do_not_come_back(spark):
    """A segment that goes as a whole no longer takes out what a later one puts in."""
    index = made(spark, items(2))
    put(spark, index, [(0, "second", "t0", 1.0)])
    index.drop_indices(["test"])
    assert state(index.space()) == ({}, [], 0)
    assert count_hits(index.space(), Match("second", "name")).first().n == 0
    put(spark, index, items(2))
    assert state(index.space()) == fresh_state(spark, items(2), others=0)
    index.drop_indices()
    assert index.space().count().first().num_docs == 2
    index.drop_indices(everything=True)
    assert index.space().count().first().num_docs == 0


def test_readers_keep_their_version(spark):
    index = made(spark, items(4))
    held = index.space()
    put(spark, index, [(0, "changed", "t0", 1.0)])
    index.compact()
    assert count_hits(held, Match("changed", "name")).first().n == 0
    assert count_hits(held, Match("old", "name")).first().n == 5
    assert count_hits(index.space(), Match("changed", "name")).first().n == 1


def test_few_keys_are_looked_up_by_filter(spark):
    index = made(spark, items(50))
    plan = index.space().typed(ITEM, ["7"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(id,7)" in plan


def test_owners_of_changed_children(spark):
    line = DocumentMapping("test.Line", "line", root=False)
    order = DocumentMapping("test.Order", "o", fields={"lines": {"component": Many("test.Line", "o")}})
    registry = Registry([order, line])
    lines = spark.createDataFrame([(1, 10, "red"), (2, 10, "blue"), (3, 11, "red")], "line int, o int, colour string")
    orders = spark.createDataFrame([(10,), (11,), (12,)], "o int")
    index = SegmentedIndex.create(registry, {"test.Order": orders, "test.Line": lines}, fresh_path(spark, "s"), [order])
    now = spark.createDataFrame([(1, 12, "red"), (2, 10, "blue")], "line int, o int, colour string")
    owners = spark.createDataFrame([(10,), (11,), (12,)], "owner int")
    kept = orders.where("o <> 11")
    index.put_owners({"test.Order": kept, "test.Line": now}, order, owners, {"test.Line": "o"})

    def having(colour):
        return sorted(r.id for r in search(index.space(), Match(colour, "lines.colour")).hits.collect())

    assert (having("red"), having("blue")) == (["12"], ["10"])
    index.compact()
    assert (having("red"), having("blue")) == (["12"], ["10"])
    assert index.space().count().first().num_docs == 2


def test_types_that_are_not_there(spark):
    index = made(spark, items(2))
    index.drop_types([OTHER])
    with pytest.raises(ValueError, match="no document of type"):
        index.space().typed(OTHER)
    assert search(index.space(), Term("nothing", "x")).hits.collect() == []
    assert {m.type_name for m in (PAGE, TURN)} <= {m.type_name for m in cross_registry().roots(CROSS)}
