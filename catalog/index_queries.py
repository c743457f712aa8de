"""Index maintenance: bulk writes, upserts, removals, folds and the streaming mirror."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.entities import (
    CROSS,
    DOC_TOKENS,
    DOCUMENT,
    LINE,
    OP,
    ORDER,
    PAGE,
    TURN,
    cross_registry,
    cross_tables,
    event_changes,
    mapping,
    tables,
    tok,
)
from catalog.registry import query
from docsearch import DocumentMapping, Many, Match, Registry, Term
from docsearch.operators.documents import as_json, build_documents
from docsearch.operators.hydrate import structural_errors
from docsearch.operators.maintain import (
    bulk_index,
    committed,
    delete_index,
    document_postings,
    fold_delete_wins,
    fold_last,
    owners_of,
    put_documents,
    reindex_owners,
    reindex_owners_into,
    split_rejects,
    unindex,
    unindex_types,
    update_index,
    upsert,
)
from docsearch.operators.search import search
from docsearch.operators.space import IndexSpace, union
from docsearch.plans.mapping import One
from docsearch.sources.index_tables import read_index_table
from docsearch.sources.shared import fresh_path
from docsearch.sources.tables import read_table
from docsearch.streaming.mirror import current_changes, index_log, mirror, read_log


def index_rows(spark, path):
    """``(index, type, id, field, term, tf)`` of a written index, and its documents with no field."""
    docs = read_index_table(spark, path, "docs").select("index", "type", "id")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("field", "string"), ("term", "string"), ("tf", "double"))]
    rows = read_index_table(spark, path, "postings").where(F.col("field") != "_all")
    return rows.select("index", "type", "id", "field", "term", "tf").union(docs.select("*", *nothing))


@query(
    "bulk_index",
    f"""WITH {DOC_TOKENS}
, p AS (
         SELECT doc_id, 'text' AS field, term, CAST(count(*) AS DOUBLE) AS tf FROM t GROUP BY doc_id, term
         UNION ALL SELECT doc_id, 'lang', lang, 1 FROM documents WHERE lang IS NOT NULL
         UNION ALL SELECT doc_id, 'source', source, 1 FROM documents WHERE source IS NOT NULL
         UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents)
       SELECT 'corpus' AS index, 'corpus_document' AS type, CAST(doc_id AS VARCHAR) AS id, field, term, tf
       FROM p""",
)
def bulk_index_query(spark, folder):
    path = fresh_path(spark, "bulk-index")
    loaded = tables(spark, folder, "corpus.Document")
    bulk_index(Registry([DOCUMENT]), loaded, path, [DOCUMENT])
    return index_rows(spark, path)


@query(
    "bulk_index_all",
    f"""WITH a AS (
         SELECT 'corpus' AS index, 'corpus_document' AS type, doc_id::VARCHAR AS id, 'text' AS field,
                unnest({tok("text")}) AS term FROM documents
         UNION ALL SELECT 'corpus', 'corpus_document', doc_id::VARCHAR, 'source', source FROM documents
         UNION ALL SELECT 'corpus', 'corpus_document', doc_id::VARCHAR, 'lang', lang FROM documents
         UNION ALL SELECT 'web', 'web_page', page_id::VARCHAR, 'html', unnest({tok("html")}) FROM pages
         UNION ALL SELECT 'web', 'web_page', page_id::VARCHAR, 'url', url FROM pages
         UNION ALL SELECT 'chat', 'chat_turn', conv_id || '_' || turn, 'text', unnest({tok("text")}) FROM conversations
         UNION ALL SELECT 'chat', 'chat_turn', conv_id || '_' || turn, 'role', role FROM conversations
         UNION ALL SELECT 'shop', 'shop_part', p_partkey::VARCHAR, 'p_name', unnest({tok("p_name")}) FROM part
         UNION ALL SELECT 'shop', 'shop_part', p_partkey::VARCHAR, 'p_brand', p_brand FROM part),
       n AS (SELECT 'corpus' AS index, 'corpus_document' AS type, doc_id::VARCHAR AS id FROM documents
             UNION ALL SELECT 'web', 'web_page', page_id::VARCHAR FROM pages
             UNION ALL SELECT 'chat', 'chat_turn', conv_id || '_' || turn FROM conversations
             UNION ALL SELECT 'shop', 'shop_part', p_partkey::VARCHAR FROM part)
       SELECT index, type, id, field, term, CAST(count(*) AS DOUBLE) AS tf FROM a
       WHERE term IS NOT NULL GROUP BY ALL
       UNION ALL SELECT index, type, id, NULL, NULL, NULL FROM n""",
)
def bulk_index_all(spark, folder):
    path = fresh_path(spark, "bulk-index-all")
    bulk_index(cross_registry(), cross_tables(spark, folder), path)
    return index_rows(spark, path)


PLAIN_ORDER = mapping("shop.Order")
#: events can share a time; their number, which is also that of their transaction, tells them apart
CHANGE_ORDER = ("seq", "tx_id")


@query(
    "index_upsert",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey,
              CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS o_orderdate, o_orderpriority
       FROM orders""",
)
def index_upsert(spark, folder):
    """The index holds the orders before 1999; the orders since 1998 arrive with a new status, so
    those of 1998 are replaced and the later ones added."""
    registry = Registry([PLAIN_ORDER])
    orders = tables(spark, folder, "shop.Order")["shop.Order"]
    day = F.col("o_orderdate")
    before = orders.where(day < F.lit("1999-01-01").cast("timestamp_ntz"))
    since = orders.where(day >= F.lit("1998-01-01").cast("timestamp_ntz"))
    stored = build_documents(registry, {"shop.Order": before}, PLAIN_ORDER)
    changed = since.withColumn("o_orderstatus", F.lit("X"))
    fresh = build_documents(registry, {"shop.Order": changed}, PLAIN_ORDER)
    return upsert(stored, fresh).select("id", "source.*")


@query(
    "index_update",
    f"""WITH d AS (SELECT doc_id, text, lang, source FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
            t AS (SELECT doc_id, unnest({tok("text")}) AS term FROM d)
       SELECT 'text' AS field, term, count(DISTINCT doc_id) AS df FROM t GROUP BY term
       UNION ALL SELECT 'lang', lang, count(*) FROM d GROUP BY lang
       UNION ALL SELECT 'source', source, count(*) FROM
         (SELECT CASE WHEN lang = 'fr' THEN 'revised' ELSE source END AS source FROM d) GROUP BY source""",
)
def index_update(spark, folder):
    """A written index without the documents labelled toxic and with the French ones from
    another source: which terms it then holds."""
    registry, loaded = Registry([DOCUMENT]), tables(spark, folder, "corpus.Document")
    old, new = fresh_path(spark, "update-from"), fresh_path(spark, "update-to")
    bulk_index(registry, loaded, old, [DOCUMENT])
    toxic = read_table(spark, folder, "labels").where("toxic = 1").select("doc_id")
    removed = toxic.select(
        F.lit("corpus").alias("index"),
        F.lit("corpus_document").alias("type"),
        F.col("doc_id").cast("string").alias("id"),
    )
    table = loaded["corpus.Document"]
    revised = table.where("lang = 'fr'").join(toxic, "doc_id", "left_anti")
    changed = {"corpus.Document": revised.withColumn("source", F.lit("revised"))}
    typed = build_documents(registry, changed, DOCUMENT)
    fresh = as_json(typed).withColumn("version", F.lit(2).cast("long"))
    update_index(spark, old, new, removed, fresh, document_postings(registry, changed, DOCUMENT, typed), replace=True)
    stats = read_index_table(spark, new, "term_stats").where("field <> '_all'")
    return stats.groupBy("field", "term").agg(F.sum("df").alias("df"))


CROSS_KEYS = """WITH c AS (
  SELECT 'corpus' AS index, 'corpus_document' AS type, doc_id::VARCHAR AS id FROM documents
  UNION ALL SELECT 'web', 'web_page', page_id::VARCHAR FROM pages
  UNION ALL SELECT 'chat', 'chat_turn', conv_id || '_' || turn FROM conversations
  UNION ALL SELECT 'shop', 'shop_part', p_partkey::VARCHAR FROM part)
"""


def cross_documents(spark, folder):
    registry, loaded = cross_registry(), cross_tables(spark, folder)
    return union([as_json(build_documents(registry, loaded, m)) for m in CROSS])


@query(
    "unindex_type",
    CROSS_KEYS + "SELECT type, id FROM c WHERE type <> 'web_page'",
)
def unindex_type(spark, folder):
    left = unindex_types(cross_documents(spark, folder), cross_registry(), [PAGE])
    return left.select("type", "id")


@query(
    "unindex_keys",
    """SELECT CAST(doc_id AS VARCHAR) AS id FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def unindex_keys(spark, folder):
    registry, loaded = Registry([DOCUMENT]), tables(spark, folder, "corpus.Document")
    documents = build_documents(registry, loaded, DOCUMENT)
    toxic = read_table(spark, folder, "labels").where("toxic = 1")
    return unindex(documents, toxic.select(F.col("doc_id").cast("string").alias("id")), ["id"]).select("id")


@query(
    "delete_index",
    CROSS_KEYS + "SELECT index, id FROM c WHERE index <> 'chat'",
)
def delete_index_query(spark, folder):
    left = delete_index(cross_documents(spark, folder), cross_registry(), [TURN])
    return left.select("index", "id")


@query(
    "fold_last",
    """SELECT user_id, arg_max(value, (ts, event_id)) AS value, max(epoch_us(ts)) AS seq
       FROM events WHERE event_type <> 'error' GROUP BY user_id""",
)
def fold_last_query(spark, folder):
    requests = event_changes(spark, folder).where("op <> 'delete'").select("type", "id", "seq", "tx_id", "value")
    folded = fold_last(requests, ("type", "id"), CHANGE_ORDER)
    return folded.select(F.col("id").cast("long").alias("user_id"), "value", "seq")


@query(
    "fold_last_wins",
    f"""SELECT user_id, arg_max({OP}, (ts, event_id)) AS op, arg_max(value, (ts, event_id)) AS value
       FROM events GROUP BY user_id""",
)
def fold_last_wins(spark, folder):
    folded = fold_last(event_changes(spark, folder), ("type", "id"), CHANGE_ORDER)
    return folded.select(F.col("id").cast("long").alias("user_id"), "op", "value")


@query(
    "fold_delete_wins",
    f"""SELECT CAST(ts AS DATE) AS day, user_id,
              CASE WHEN bool_or(event_type = 'error') THEN 'delete' ELSE arg_max({OP}, (ts, event_id)) END AS op
       FROM events GROUP BY 1, 2""",
)
def fold_delete_wins_query(spark, folder):
    folded = fold_delete_wins(event_changes(spark, folder), ("day", "type", "id"), CHANGE_ORDER)
    return folded.select("day", F.col("id").cast("long").alias("user_id"), "op")


@query(
    "fold_committed",
    f"""SELECT user_id, arg_max({OP}, (ts, event_id)) AS op, max(epoch_us(ts)) AS seq
       FROM events JOIN orders ON o_orderkey = event_id
       WHERE o_orderstatus = 'F' GROUP BY user_id""",
)
def fold_committed(spark, folder):
    """Each change belongs to the transaction of the same number; finished orders stand for
    transactions that committed, pending ones for those rolled back, open ones for neither."""
    status = F.when(F.col("o_orderstatus") == "F", "committed").when(
        F.col("o_orderstatus") == "P", "rolled_back"
    )
    transactions = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("tx_id"), F.coalesce(status, F.lit("unknown")).alias("status")
    )
    changes = committed(event_changes(spark, folder), transactions)
    folded = fold_last(changes, ("type", "id"), CHANGE_ORDER)
    return folded.select(F.col("id").cast("long").alias("user_id"), "op", "seq")


@query(
    "reject_rows",
    """SELECT page_id, last AS value,
              CASE WHEN TRY_CAST(last AS INTEGER) IS NOT NULL THEN 'ok' WHEN last = '' THEN 'empty'
                   ELSE 'not a number' END AS reason
       FROM (SELECT page_id, regexp_extract(url, '[^/]*$') AS last FROM pages)""",
)
def reject_rows(spark, folder):
    pages = read_table(spark, folder, "pages")
    last = F.regexp_extract("url", "[^/]*$", 0)
    rows = pages.select("page_id", last.alias("value"))
    checks = {
        "empty": F.col("value") == "",
        "not a number": F.col("value").try_cast("int").isNull(),
    }
    good, rejected = split_rejects(rows, checks)
    return good.withColumn("reason", F.lit("ok")).unionByName(rejected)


@query(
    "reject_structure",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'customer: reference is not an object' AS reason
       FROM orders WHERE o_orderstatus = 'P'""",
)
def reject_structure(spark, folder):
    """Stored orders, of which the pending ones hold their customer's bare key where the
    mapping wants a reference."""
    order = mapping("shop.Order", fields={"customer": {"reference": One("shop.Customer", "o_custkey")}})
    registry = Registry([order, mapping("shop.Customer")])
    loaded = tables(spark, folder, "shop.Order", "shop.Customer")
    orders = loaded["shop.Order"]
    pending = F.col("o_orderstatus") == "P"
    right = as_json(build_documents(registry, {**loaded, "shop.Order": orders.where(~pending)}, order))
    wrong = orders.where(pending).select(
        F.lit("shop").alias("index"),
        F.lit("shop_order").alias("type"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.lit(0).cast("long").alias("part"),
        F.to_json(F.struct(F.col("o_custkey").alias("customer"))).alias("source"),
    )
    checks = structural_errors(registry, order, orders.schema)
    _, rejected = split_rejects(right.unionByName(wrong), checks)
    return rejected.select("id", "reason")


@query(
    "owner_reindex",
    """SELECT CAST(l_orderkey AS VARCHAR) AS id, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
       FROM lineitem WHERE l_orderkey IN
            (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
       GROUP BY l_orderkey""",
)
def owner_reindex(spark, folder):
    registry = Registry([ORDER, LINE])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    changed = loaded["shop.LineItem"].where("l_returnflag = 'R' AND l_linestatus = 'F'")
    owners = owners_of(changed, "l_orderkey")
    fresh = reindex_owners(registry, loaded, "shop.Order", owners, {"shop.LineItem": "l_orderkey"})
    quantity = F.aggregate("source.lines", F.lit(0.0), lambda total, line: total + line.l_quantity)
    return fresh.groupBy("id").agg(
        F.sum(F.size("source.lines")).alias("n_lines"), F.round(F.sum(quantity), 2).alias("quantity")
    )


def event_feed(spark, folder, files_per_batch: int = 8):
    """The events, written as one file per day and read back as a stream of files."""
    path = fresh_path(spark, "event-feed")
    changes = event_changes(spark, folder)
    changes.repartition("day").write.partitionBy("day").parquet(path)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(path)


@query(
    "stream_mirror",
    f"""SELECT user_id, arg_max({OP}, (ts, event_id)) AS op, arg_max(value, (ts, event_id)) AS value, max(epoch_us(ts)) AS version
       FROM events GROUP BY user_id""",
)
def stream_mirror(spark, folder):
    feed = event_feed(spark, folder).drop("day")
    schema = T.StructType(feed.schema.fields)
    log, checkpoint = fresh_path(spark, "mirror-log"), fresh_path(spark, "mirror-checkpoint")
    run = mirror(feed, log, checkpoint, order=CHANGE_ORDER)
    run.awaitTermination()
    state = current_changes(read_log(spark, log, schema), CHANGE_ORDER)
    return state.select(F.col("id").cast("long").alias("user_id"), "op", "value", "version")


USER = DocumentMapping("log.User", "user_id", fields={"event_type": {"index": "not_analyzed"}})


@query(
    "mirror_search",
    f"""SELECT CAST(user_id AS VARCHAR) AS id, value FROM (
         SELECT user_id, arg_max({OP}, (ts, event_id)) AS op, arg_max(value, (ts, event_id)) AS value,
                arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id)
       WHERE op <> 'delete' AND event_type = 'click'""",
)
def mirror_search(spark, folder):
    """The events mirrored as users, brought into a written index, and asked for there."""
    registry = Registry([USER])
    events = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    changes = event_changes(spark, folder).join(events, F.col("tx_id") == F.col("event_id")).drop("event_id", "day")
    feed_path = fresh_path(spark, "user-feed")
    changes.write.parquet(feed_path)
    log, checkpoint = fresh_path(spark, "user-log"), fresh_path(spark, "user-checkpoint")
    feed = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(feed_path)
    mirror(feed, log, checkpoint, registry, order=CHANGE_ORDER).awaitTermination()
    empty, full = fresh_path(spark, "user-index"), fresh_path(spark, "user-index")
    nobody = changes.select("value", "user_id", "event_type").where("1 = 0")
    bulk_index(registry, {"log.User": nobody}, empty, buckets=4)
    held = index_log(registry, read_log(spark, log, changes.schema), USER, empty, full, CHANGE_ORDER)
    space = IndexSpace.over(spark, held, registry)
    hits = search(space, Term("event_type", "click")).matching().select("type", "id")
    return space.typed(USER).join(hits, ["type", "id"]).select("id", "source.value")


@query(
    "stored_upsert",
    f"""WITH d AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN 'thing' ELSE text END AS text FROM documents
                   WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))
       SELECT CAST(doc_id AS VARCHAR) AS id FROM d WHERE list_contains({tok("text")}, 'thing')""",
)
def stored_upsert(spark, folder):
    """A written index from which the toxic documents go and into which the French ones come with
    another text, given twice; then it is searched."""
    declared = mapping("corpus.Document", only=["text", "lang"], fields={"lang": {"index": "not_analyzed"}})
    registry, loaded = Registry([declared]), tables(spark, folder, "corpus.Document")
    old, new = fresh_path(spark, "stored-from"), fresh_path(spark, "stored-to")
    bulk_index(registry, loaded, old, [declared])
    toxic = read_table(spark, folder, "labels").where("toxic = 1").select("doc_id")
    removed = toxic.select(
        F.lit("corpus").alias("index"),
        F.lit("corpus_document").alias("type"),
        F.col("doc_id").cast("string").alias("id"),
    )
    french = loaded["corpus.Document"].where("lang = 'fr'").join(toxic, "doc_id", "left_anti")
    changed = {"corpus.Document": french.union(french).withColumn("text", F.lit("thing"))}
    typed = build_documents(registry, changed, declared)
    held = put_documents(registry, changed, declared, typed, removed, old, new, version=2, replace=True)
    space = IndexSpace.over(spark, held, registry)
    return search(space, Match("thing", "text")).matching().select("id")


@query(
    "owner_moves",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
       WHERE o_orderkey IN (SELECT CASE WHEN l_orderkey % 7 = 0 THEN l_orderkey + 1 ELSE l_orderkey END
                            FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <> 3)""",
)
def owner_moves(spark, folder):
    """Lines move to the next order, and those of one number are deleted; the index of orders,
    re-indexed for the owners before and after, is asked which orders hold a returned line."""
    line = mapping(
        "shop.LineItem", root=False, only=["l_returnflag"], fields={"l_returnflag": {"index": "not_analyzed"}}
    )
    order = mapping(
        "shop.Order", only=["lines"], fields={"lines": {"component": Many("shop.LineItem", "l_orderkey")}}
    )
    registry = Registry([order, line])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    lines = loaded["shop.LineItem"].withColumn("l_id", F.xxhash64(*loaded["shop.LineItem"].columns))
    moves, goes = F.col("l_orderkey") % 7 == 0, F.col("l_linenumber") == 3
    now = lines.where(~goes).withColumn("l_orderkey", F.when(moves, F.col("l_orderkey") + 1).otherwise(F.col("l_orderkey")))
    changed = now.join(lines.where(moves & ~goes).select("l_id").distinct(), "l_id", "left_semi").select("l_id", "l_orderkey")
    deleted = lines.where(goes).select("l_id", F.lit(None).cast("bigint").alias("l_orderkey"))
    old, new = fresh_path(spark, "moves-from"), fresh_path(spark, "moves-to")
    bulk_index(registry, {**loaded, "shop.LineItem": lines}, old, [order], buckets=4)
    owners = owners_of(changed.union(deleted), "l_orderkey", ["l_id"], lines)
    held = reindex_owners_into(
        registry, {**loaded, "shop.LineItem": now}, order, owners, {"shop.LineItem": "l_orderkey"}, old, new, replace=True
    )
    space = IndexSpace.over(spark, held, registry)
    return search(space, Term("lines.l_returnflag", "R")).matching().select("id")
