"""Index, unindex, replace; skewed owners; folds; streaming; plans."""

import random

import pytest
from pyspark.sql import functions as F

from catalog.entities import TABLES, customers, document_space, mapping, tables
from docsearch import (
    Bool,
    DocumentMapping,
    Many,
    Match,
    Phrase,
    Prefix,
    Range,
    Registry,
    Settings,
    Term,
    Wildcard,
)
from docsearch.functions import highlights
from docsearch.functions.converters import date_in
from docsearch.operators.batch import batch_search
from docsearch.operators.documents import as_json, build_documents
from docsearch.operators.maintain import (
    bulk_index,
    check_type,
    delete_index,
    document_postings,
    fold_delete_wins,
    fold_last,
    put_documents,
    unindex,
    unindex_types,
    update_index,
    upsert,
)
from docsearch.operators.postings import field_sizes, search_fields
from docsearch.operators.search import count_hits, entity_search, search
from docsearch.operators.space import IndexSpace, TableSpace
from docsearch.sources.shared import fresh_path
from docsearch.streaming.mirror import (
    compact,
    current_changes,
    current_documents,
    fold_batch,
    mirror,
    read_log,
    settle,
)

PRODUCT = DocumentMapping("test.Product", "id")
REGISTRY = Registry([PRODUCT])


def products(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, name string, price float")


def space(spark, *rows):
    return TableSpace.over(REGISTRY, {"test.Product": products(spark, *rows)})


def found(result):
    return sorted(r.id for r in result.hits.collect())


def test_index_then_search(spark):
    assert found(search(space(spark, (1, "myTestProduct", 1.0)), "mytestproduct")) == ["1"]


def test_unindex_then_search(spark):
    path, left = fresh_path(spark, "t"), fresh_path(spark, "t")
    table = {"test.Product": products(spark, (1, "myTestProduct", 1.0), (2, "other", 2.0))}
    bulk_index(REGISTRY, table, path, [PRODUCT], buckets=2)
    removed = spark.createDataFrame([("test", "test_product", "1")], "index string, type string, id string")
    update_index(spark, path, left, removed)
    assert found(search(IndexSpace.over(spark, path, REGISTRY), "mytestproduct")) == ["1"]
    assert found(search(IndexSpace.over(spark, left, REGISTRY), "mytestproduct")) == []
    assert count_hits(IndexSpace.over(spark, left, REGISTRY), "other").first().n == 1


def test_reindex_replaces(spark):
    path, new = fresh_path(spark, "t"), fresh_path(spark, "t")
    bulk_index(REGISTRY, {"test.Product": products(spark, (1, "myTestProduct", 1.0))}, path, buckets=2)
    changed = {"test.Product": products(spark, (1, "newProductName", 1.0))}
    typed = build_documents(REGISTRY, changed, PRODUCT)
    fresh = as_json(typed).withColumn("version", F.lit(2).cast("long"))
    nothing = fresh.select("index", "type", "id").limit(0)
    update_index(spark, path, new, nothing, fresh, document_postings(REGISTRY, changed, PRODUCT, typed))
    index = IndexSpace.over(spark, new, REGISTRY)
    assert found(search(index, "mytestproduct")) == []
    assert found(search(index, "newproductname")) == ["1"]
    assert index.documents().count() == 1


def test_index_and_tables_answer_alike(spark, folder):
    registry = Registry([mapping("corpus.Document", except_="n_chars")])
    loaded = tables(spark, folder, "corpus.Document")
    path = fresh_path(spark, "t")
    bulk_index(registry, loaded, path, buckets=4)
    over_tables = TableSpace.over(registry, loaded)
    over_index = IndexSpace.over(spark, path, registry)
    for clause in (
        Match("thing esat", "text"),
        Bool(must=[Match("the", "text")], must_not=[Term("lang", "en")]),
        Phrase("of the", "text", 2),
        Prefix("text", "thi"),
        Match("thing the"),
    ):
        theirs = sorted(map(tuple, search(over_index, clause).hits.collect()))
        assert theirs == sorted(map(tuple, search(over_tables, clause).hits.collect()))
    questions = loaded["corpus.Document"].select(F.col("doc_id").alias("query_id"), "text").limit(5)
    a = batch_search(over_tables, questions, "text", 5).select("query_id", "rank", "id", "score")
    b = batch_search(over_index, questions, "text", 5).select("query_id", "rank", "id", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_only_the_buckets_of_the_terms_are_read(spark):
    path = fresh_path(spark, "t")
    bulk_index(REGISTRY, {"test.Product": products(spark, (1, "a b c d", 1.0))}, path, buckets=8)
    index = IndexSpace.over(spark, path, REGISTRY)
    plan = search(index, Match("a", "name")).hits._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1]


def test_a_search_shuffles_matches_only_and_reads_text_once(spark, folder):
    hits = search(document_space(spark, folder), Match("thing esat", "text")).hits
    hits.collect()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    for never in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert never not in plan
    assert "size(regexp_extract_all" not in final.replace(" ", "")


def test_large_owners_are_kept_in_several_rows_without_loss(spark, folder):
    loaded = tables(spark, folder, "shop.Customer", "shop.Order", "shop.LineItem")
    whole = build_documents(customers(), loaded, "shop.Customer")
    registry = Registry(customers().mappings.values(), Settings(max_children=20))
    parts = build_documents(registry, loaded, "shop.Customer")

    def lines(documents):
        orders = documents.select("id", F.explode("source.orders").alias("o"))
        rows = orders.select("id", F.col("o.id").alias("order"), F.explode("o.lines").alias("l"))
        return sorted(map(str, rows.select("id", "order", "l.l_partkey", "l.l_quantity").collect()))

    assert parts.count() > whole.count() == parts.select("id").distinct().count()
    assert parts.groupBy("id", "part").count().where("count > 1").count() == 0
    assert lines(parts) == lines(whole)


def test_a_document_in_several_rows_is_found_and_scored_as_one(spark):
    words = ["alpha", "beta", "gamma"]
    turns = spark.createDataFrame(
        [(c, t, words[(c + t) % 3]) for c in (1, 2) for t in range(30 if c == 1 else 3)],
        "conv_id bigint, turn int, text string",
    )
    loaded = {"c.Turn": turns, "c.Talk": turns.select("conv_id").distinct()}
    declared = [
        DocumentMapping("c.Talk", "conv_id", fields={"turns": {"component": Many("c.Turn", "conv_id")}}),
        DocumentMapping("c.Turn", ("conv_id", "turn"), root=False),
    ]
    answers = []
    for limit in (10_000, 4):
        registry = Registry(declared, Settings(max_children=limit))
        hits = search(TableSpace.over(registry, loaded), Match("alpha beta", "turns.text")).hits
        questions = spark.createDataFrame([(1, "alpha beta")], "query_id int, text string")
        batch = batch_search(TableSpace.over(registry, loaded), questions, "turns.text")
        answers.append(
            (sorted(map(tuple, hits.collect())), sorted(map(tuple, batch.select("id", "score").collect())))
        )
    assert answers[0] == answers[1] and len(answers[0][0]) == 2
    assert [(i, s) for _, _, i, s in answers[0][0]] == answers[0][1]


def test_bool_clauses(spark):
    s = space(spark, (1, "red ball", 1.0), (2, "red box", 2.0), (3, "blue box", 3.0))

    def ids(**clauses):
        return found(search(s, Bool(**clauses)))

    red, box, blue = (Match(w, "name") for w in ("red", "box", "blue"))
    assert ids(must=[red], must_not=[box]) == ["1"]
    assert ids(should=[red, blue]) == ["1", "2", "3"]
    assert ids(must=[red], should=[box]) == ["1", "2"]
    assert ids(must_not=[red]) == ["3"]
    assert ids(must=[red, None]) == ["1", "2"]
    with_should = {r.id: r.score for r in search(s, Bool(must=[red], should=[box])).hits.collect()}
    assert with_should["2"] > with_should["1"]


def test_wildcard_characters_are_literal_otherwise(spark):
    s = TableSpace.over(
        Registry([DocumentMapping("test.Product", "id", fields={"name": {"index": "not_analyzed"}})]),
        {"test.Product": products(spark, (1, "a.c", 1.0), (2, "abc", 1.0), (3, "a.cd", 1.0))},
    )
    assert found(search(s, Wildcard("name", "a.?"))) == ["1"]
    assert found(search(s, Wildcard("name", "a?c*"))) == ["1", "2", "3"]


def test_page_of_size_zero_and_default(spark):
    result = search(space(spark, *[(i, "same", 1.0) for i in range(70)]), "same")
    assert result.page(size=0).count() == 0
    assert result.page().count() == 60
    assert result.page(start=65).count() == 5
    assert result.total().first().total == 70


def test_a_question_without_words_finds_nothing(spark):
    s = space(spark, (1, "red", 1.0))
    assert found(search(s, "?!")) == [] and search(s, "?!").total().first().total == 0


def test_entity_search_cannot_be_redirected(spark):
    other = DocumentMapping("other.Thing", "id")
    registry = Registry([PRODUCT, other])
    table = products(spark, (1, "same", 1.0))
    everything = TableSpace.over(registry, {"test.Product": table, "other.Thing": table}, indices="other")
    assert {r.type for r in entity_search(everything, PRODUCT, "same").hits.collect()} == {"test_product"}


def test_highlight_keeps_words_whole(spark):
    text = spark.createDataFrame([("A thing, things $1 THING\nthing",)], "t string")
    hit = highlights.any_of(["thing"])
    marked = text.select(highlights.highlight(F.col("t"), hit, "<$1>", "\\")).first()[0]
    assert marked == "A <$1>thing\\, things $1 <$1>THING\\\n<$1>thing\\"
    pieces = text.select(highlights.fragments(F.col("t"), hit, 10, 2)).first()[0]
    # cut as "A thing, " + "things $1 " + "THING\\n" + "thing"; the second holds no match
    assert pieces == ["A <em>thing</em>, ", "<em>THING</em>\n"]
    assert text.select(highlights.fragments(F.col("t"), highlights.any_of(["no"]), 0)).first()[0] == []


def test_dates_by_first_pattern_that_fits(spark):
    rows = spark.createDataFrame([("2011-02-03T04:05:06.007Z",), ("2011-02-03T04:05:06Z",), ("x",), (None,)], "t string")
    got = [str(r[0]) for r in rows.select(date_in(F.col("t"))).collect()]
    assert got == ["2011-02-03 04:05:06.007000", "2011-02-03 04:05:06", "None", "None"]


def test_null_fields_stay_null_and_owners_without_children_get_an_empty_list(spark):
    declared = [
        DocumentMapping("c.Talk", "conv_id", fields={"turns": {"component": Many("c.Turn", "conv_id")}}),
        DocumentMapping("c.Turn", "turn", root=False),
    ]
    loaded = {
        "c.Talk": spark.createDataFrame([(1, None)], "conv_id int, title string"),
        "c.Turn": spark.createDataFrame([(7, 2)], "turn int, conv_id int"),
    }
    row = as_json(build_documents(Registry(declared), loaded, "c.Talk")).first()
    assert row.source == '{"title":null,"turns":[]}'


def test_document_sets(spark):
    documents = build_documents(REGISTRY, {"test.Product": products(spark, (1, "a", 1.0), (2, "b", 1.0))}, PRODUCT)
    assert unindex_types(documents, REGISTRY, [PRODUCT]).count() == 0
    assert unindex_types(documents, REGISTRY, ["nobody"]).count() == 2
    assert unindex_types(documents, REGISTRY).count() == 0
    assert delete_index(documents, REGISTRY, []).count() == 2
    assert delete_index(documents, REGISTRY, ["TEST"]).count() == 0
    assert delete_index(documents, REGISTRY, everything=True).count() == 0
    assert upsert(documents, documents).count() == 2
    assert unindex(documents, documents.limit(1)).count() == 1
    with pytest.raises(ValueError, match="only documents of type"):
        check_type(documents.withColumn("type", F.lit("other")), REGISTRY, PRODUCT)


def random_changes(seed):
    chance = random.Random(seed)
    return [
        ("test_product", str(chance.randrange(6)), seq, chance.choice(["insert", "update", "delete"]), chance.random())
        for seq in range(60)
    ]


SCHEMA = "type string, id string, seq bigint, op string, value double"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_folds_match_a_plain_loop(spark, seed):
    rows = random_changes(seed)
    changes = spark.createDataFrame(rows, SCHEMA).repartition(4)
    last, deleted = {}, {}
    for row in rows:
        last[row[1]] = row
        if row[3] == "delete":
            deleted[row[1]] = row
    key = ("type", "id")
    assert sorted(map(tuple, fold_last(changes, key, ("seq",)).collect())) == sorted(last.values())
    wins = {r.id: r.op for r in fold_delete_wins(changes, key, ("seq",)).collect()}
    assert wins == {k: "delete" if k in deleted else v[3] for k, v in last.items()}


def test_mirror_applies_batches_and_ignores_replays_and_late_changes(spark):
    source, log, state = (fresh_path(spark, x) for x in ("feed", "log", "state"))
    rows = random_changes(9)
    for begin in (40, 0, 20):  # files out of order
        spark.createDataFrame(rows[begin : begin + 20], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    feed = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    mirror(feed, log, state, REGISTRY).awaitTermination()
    schema = feed.schema
    expected = {}
    for row in rows:
        expected[row[1]] = (row[2], row[3])
    once = {r.id: (r.version, r.op) for r in current_changes(read_log(spark, log, schema)).collect()}
    assert once == expected
    # the same changes arrive again as another batch
    fold_batch(spark.createDataFrame(rows[:20], SCHEMA)).write.parquet(f"{log}/run=again/batch=99")
    again = read_log(spark, log, schema)
    assert {r.id: (r.version, r.op) for r in current_changes(again).collect()} == expected
    alive = {k for k, v in expected.items() if v[1] != "delete"}
    assert {r.id for r in current_documents(again).collect()} == alive
    base = fresh_path(spark, "base")
    compact(spark, log, schema, base)
    compacted = {r.id: (r.version, r.op) for r in current_changes(read_log(spark, base, schema)).collect()}
    assert compacted == expected


def test_mirror_skips_other_types_and_uncommitted_changes(spark):
    changes = spark.createDataFrame(
        [("test_product", "1", 1, "insert", 7), ("test_product", "2", 2, "insert", 8), ("x", "3", 3, "insert", 7)],
        "type string, id string, seq bigint, op string, tx_id int",
    )
    status = spark.createDataFrame([(7, "committed"), (8, "rolled_back")], "tx_id int, status string")
    assert [r.id for r in fold_batch(changes, REGISTRY, status).collect()] == ["1"]


def test_a_log_before_its_first_change_is_empty(spark):
    log = read_log(spark, fresh_path(spark, "log"), spark.createDataFrame([], SCHEMA).schema)
    assert {"run", "batch"} < set(log.columns)
    assert current_documents(log).count() == 0


def test_mirror_can_be_switched_off(spark):
    assert mirror(None, "", "", Registry([PRODUCT], Settings(disable_auto_index=True))) is None


def test_entity_tables_exist(spark, folder):
    assert all(tables(spark, folder, name)[name].columns for name in TABLES)


def test_a_fresh_checkpoint_never_overwrites_the_log(spark):
    source, log = fresh_path(spark, "feed"), fresh_path(spark, "log")
    for n in (1, 2):
        one = [("test_product", str(n), n, "insert", float(n))]
        spark.createDataFrame(one, SCHEMA).coalesce(1).write.parquet(f"{source}/{n}")
        feed = spark.readStream.schema(SCHEMA).parquet(f"{source}/{n}")
        mirror(feed, log, fresh_path(spark, "state"), REGISTRY).awaitTermination()
    assert sorted(r.id for r in current_documents(read_log(spark, log, feed.schema)).collect()) == ["1", "2"]


def test_a_late_commit_status_loses_no_change(spark):
    source, log, left = (fresh_path(spark, x) for x in ("feed", "log", "left"))
    schema = "type string, id string, seq bigint, op string, tx_id int"
    rows = [("test_product", str(i), i, "insert", i) for i in (1, 2, 3, 4)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    early = spark.createDataFrame([(1, "committed"), (2, "rolled_back"), (3, "open")], "tx_id int, status string")
    feed = spark.readStream.schema(schema).parquet(source)
    mirror(feed, log, fresh_path(spark, "state"), REGISTRY, early).awaitTermination()

    def known():
        return sorted(r.id for r in current_documents(read_log(spark, log, feed.schema)).collect())

    assert known() == ["1"]
    late = spark.createDataFrame([(1, "committed"), (2, "rolled_back"), (3, "committed")], "tx_id int, status string")
    settle(spark, log, feed.schema, late, left, REGISTRY)
    assert known() == ["1", "3"]
    assert [r.id for r in spark.read.parquet(f"{left}-waiting").collect()] == ["4"]


def test_changes_of_equal_seq_are_told_apart_by_the_full_order(spark):
    rows = [("test_product", "1", 5, "insert", float(i)) for i in range(20)]
    changes = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert [r.value for r in fold_batch(changes, order=("seq", "value")).collect()] == [19.0]


def test_upsert_keeps_one_document_per_key(spark):
    def documents(*rows):
        return build_documents(REGISTRY, {"test.Product": products(spark, *rows)}, PRODUCT)

    twice = documents((1, "a", 1.0), (1, "a", 1.0), (2, "b", 1.0)).withColumn("version", F.lit(1))
    newer = documents((2, "c", 1.0)).withColumn("version", F.lit(2))
    put = upsert(documents((3, "d", 1.0)).withColumn("version", F.lit(0)), twice.unionByName(newer))
    assert sorted((r.id, r.source.name) for r in put.collect()) == [("1", "a"), ("2", "c"), ("3", "d")]


def test_composite_ids_are_unambiguous(spark):
    mapped = DocumentMapping("x.Pair", ("a", "b"))
    table = spark.createDataFrame([("1_2", "3"), ("1", "2_3"), ("x", None), ("p", "q")], "a string, b string")
    ids = [r.id for r in build_documents(Registry([mapped]), {"x.Pair": table}, mapped).collect()]
    assert len(set(ids)) == 4 and None in ids and "p_q" in ids


def test_zoned_dates_are_written_in_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    table = spark.sql("SELECT 1 AS id, TIMESTAMP '2011-02-03T04:05:06Z' AS at, TIMESTAMP_NTZ '2011-02-03 04:05:06' AS plain")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = build_documents(Registry([DocumentMapping("x.At", "id")]), {"x.At": table}, "x.At").first()
        assert row.source.at == row.source.plain == "2011-02-03T04:05:06.000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_repeated_word_needs_two_places(spark):
    s = space(spark, (1, "the end of it", 1.0), (2, "the the", 1.0), (3, "the old the", 1.0), (4, "a the of the", 1.0))
    assert found(search(s, Phrase("the the", "name", 1))) == ["2", "3", "4"]
    assert found(search(s, Phrase("the the", "name", 0))) == ["2"]
    assert found(search(s, Phrase("the of the", "name", 1))) == ["4"]


def test_an_unknown_selection_says_so(spark):
    with pytest.raises(ValueError, match="no entity with a table"):
        TableSpace.over(REGISTRY, {"test.Product": products(spark)}, indices="nowhere")


def test_components_are_nested_as_deep_as_the_mappings_say(spark):
    names = [f"c.L{i}" for i in range(8)]
    below = lambda i: {"next": {"component": Many(names[i + 1], "up")}} if i < 7 else {}
    registry = Registry([DocumentMapping(n, "id", fields=below(i), root=i == 0) for i, n in enumerate(names)])
    table = spark.createDataFrame([(1, 1, "word")], "id int, up int, name string")
    loaded = {n: table.withColumn("name", F.lit(f"word{i}")) for i, n in enumerate(names)}
    assert '"name":"word7"' in as_json(build_documents(registry, loaded, names[0])).first().source
    hits = search(TableSpace.over(registry, loaded), Match("word7", ".".join(["next"] * 7) + ".name")).hits
    assert hits.count() == 1


def test_an_entity_that_nests_itself_needs_a_depth(spark):
    def declared(**options):
        return Registry([DocumentMapping("c.Node", "id", fields={"down": {"component": Many("c.Node", "up"), **options}})])

    loaded = {"c.Node": spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id int, up int")}
    with pytest.raises(ValueError, match="give a maxDepth"):
        build_documents(declared(), loaded, "c.Node")
    with pytest.raises(ValueError, match="give a maxDepth"):
        TableSpace.over(declared(), loaded).known_fields()
    assert build_documents(declared(maxDepth=2), loaded, "c.Node").count() == 3


def test_batch_search_reads_only_the_buckets_of_its_words(spark, folder):
    registry = Registry([mapping("corpus.Document", only=["text"])])
    path = fresh_path(spark, "t")
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path, buckets=8)
    questions = spark.createDataFrame([(1, "the thing"), (2, "the")], "query_id int, text string")
    found = batch_search(IndexSpace.over(spark, path, registry), questions, "text", 3)
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "bucket" in plan.split("PartitionFilters: [")[1]
    assert found.groupBy("query_id").count().collect()


def test_maintenance_of_a_written_index(spark):
    path, left, same = (fresh_path(spark, "t") for _ in range(3))
    table = {"test.Product": products(spark, (1, "red", 1.0), (2, "blue", 2.0), (None, "lost", 0.0))}
    bulk_index(REGISTRY, table, path, [PRODUCT], buckets=2)
    index = IndexSpace.over(spark, path, REGISTRY)
    assert found(search(index, "lost")) == [] and count_hits(index, "red").first().n == 1
    assert [r.reason for r in spark.read.parquet(f"{path}/rejects").collect()] == ["no id"]
    removed = spark.createDataFrame([("test", "test_product", "1")], "index string, type string, id string")
    assert update_index(spark, path, same, removed.where("id = '9'")) == path
    changed = {"test.Product": products(spark, (2, "green", 5.0), (2, "green", 5.0))}
    typed = build_documents(REGISTRY, changed, PRODUCT)
    fresh = as_json(typed).withColumn("version", F.lit(2).cast("long"))
    rows = document_postings(REGISTRY, changed, PRODUCT, typed)
    assert update_index(spark, path, left, removed, fresh, rows, {"test_product": typed}) == left
    after = IndexSpace.over(spark, left, REGISTRY)
    assert found(search(after, "red")) == [] and found(search(after, "green")) == ["2"]
    assert found(search(after, Range("price", 4, 6))) == ["2"] and after.documents().count() == 1
    assert [r.price for r in search(after, "green").sorted_page(PRODUCT, "price").collect()] == [5.0]


def test_documents_without_a_key_put_into_a_written_index_are_rejects(spark):
    path, after, only = (fresh_path(spark, "t") for _ in range(3))
    bulk_index(REGISTRY, {"test.Product": products(spark, (1, "red", 1.0))}, path, [PRODUCT], buckets=2)
    nothing = spark.createDataFrame([], "index string, type string, id string")
    changed = {"test.Product": products(spark, (None, "lost", 0.0), (2, "blue", 2.0))}
    typed = build_documents(REGISTRY, changed, PRODUCT)
    assert put_documents(REGISTRY, changed, PRODUCT, typed, nothing, path, after) == after
    index = IndexSpace.over(spark, after, REGISTRY)
    assert found(search(index, "lost")) == [] and found(search(index, "blue")) == ["2"]
    assert [r.reason for r in spark.read.parquet(f"{after}/rejects").collect()] == ["no id"]
    assert put_documents(REGISTRY, changed, PRODUCT, typed.where("id is null"), nothing, after, only) == only
    assert spark.read.parquet(f"{only}/rejects").count() == 2 and IndexSpace.over(spark, only, REGISTRY).documents().count() == 2


def split_world(spark, limit):
    """Talks of which the first has many turns, 30 of them equal, in three levels."""
    words = ["alpha", "beta", "gamma"]
    turns = [(c, t, words[(c + t) % 3]) for c in (1, 2, 3) for t in range(40 if c == 1 else 3)]
    turns += [(1, 100, "delta")] * 30
    notes = [(t, n, f"note{n % 4} alpha") for t in (0, 1) for n in range(25)]
    loaded = {
        "c.Turn": spark.createDataFrame(turns, "conv_id bigint, turn int, text string"),
        "c.Note": spark.createDataFrame(notes, "turn int, note int, remark string"),
        "c.Talk": spark.createDataFrame([(c, f"title alpha {c}", 7) for c in (1, 2, 3)], "conv_id bigint, title string, room int"),
    }
    registry = Registry(
        [
            DocumentMapping("c.Talk", "conv_id", fields={"turns": {"component": Many("c.Turn", "conv_id")}}),
            DocumentMapping("c.Turn", "turn", root=False, fields={"notes": {"component": Many("c.Note", "turn")}}),
            DocumentMapping("c.Note", "note", root=False),
        ],
        Settings(max_children=limit),
    )
    return registry, loaded


def test_answers_do_not_depend_on_how_a_large_owner_is_kept(spark):
    answers = []
    for limit in (10_000, 5):
        registry, loaded = split_world(spark, limit)
        over = TableSpace.over(registry, loaded)
        documents = build_documents(registry, loaded, "c.Talk")
        one = []
        for clause in (
            Match("alpha", "title"),
            Match("alpha title"),
            Match("alpha delta", "turns.text"),
            Match("note1", "turns.notes.remark"),
            Phrase("title alpha", "title"),
            Term("room", 7),
        ):
            result = search(over, clause)
            one.append(sorted(map(tuple, result.hits.collect())))
        one.append(sorted(map(tuple, search(over, Match("alpha title", "title")).explain().collect())))
        one.append(sorted(map(tuple, search(over, Match("delta note1")).explain().collect())))
        fields = search_fields(registry, loaded, "c.Talk")
        one.append(sorted(map(tuple, field_sizes(documents, fields).collect())))
        nested = documents.select("id", F.explode("source.turns").alias("t")).select("id", F.explode("t.notes").alias("n"))
        one.append(sorted(map(str, nested.select("id", "n.id", "n.remark").collect())))
        turns = documents.select("id", F.explode("source.turns").alias("t")).where("t.class is not null")
        one.append(sorted(map(str, turns.select("id", "t.id", "t.text").collect())))
        path = fresh_path(spark, "t")
        bulk_index(registry, loaded, path, ["c.Talk"], buckets=2)
        index = IndexSpace.over(spark, path, registry)
        one.append(sorted(map(tuple, search(index, Match("alpha title")).hits.collect())))
        one.append([r.id for r in search(index, Match("alpha")).sorted_page("c.Talk", "title").collect()])
        one.append(index.keys().count())
        answers.append(one)
        if limit < 10_000:
            sizes = documents.select("id", "part", F.size("source.turns").alias("n")).collect()
            assert max(r.n for r in sizes) <= 4 * limit and len(sizes) > 10
            assert sum(r.part in (0, 1) for r in sizes) == 3
    for number, (whole, split) in enumerate(zip(*answers, strict=True)):
        assert whole == split, number
