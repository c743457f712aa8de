"""Hits and stored documents back to typed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.document_queries import customer_documents
from catalog.entities import (
    DOCUMENT,
    LINE,
    ORDER,
    cross_registry,
    cross_tables,
    document_space,
    mapping,
    tables,
    tok,
)
from catalog.registry import query
from docsearch import Many, Match, One, Registry
from docsearch.operators.documents import as_json, build_documents
from docsearch.operators.hydrate import (
    component_rows,
    hydrate,
    parse_documents,
    resolve_back_reference,
    resolve_reference,
)
from docsearch.operators.search import search
from docsearch.operators.space import TableSpace


@query(
    "hydrate",
    f"""SELECT doc_id, lang, source, n_chars, text FROM documents
       WHERE list_has_any({tok("text")}, ['thing', 'esat'])""",
)
def hydrate_query(spark, folder):
    """Hits of several types and of one that is not mapped; only the asked entity comes back."""
    registry, loaded = cross_registry(), cross_tables(spark, folder)
    hits = search(TableSpace.over(registry, loaded), "thing esat").hits
    strangers = hits.withColumn("type", F.lit("old_type"))
    rows = hydrate(registry, loaded, hits.unionByName(strangers), DOCUMENT)
    return rows.select("doc_id", "lang", "source", "n_chars", "text")


@query(
    "hydrate_component",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey, o_totalprice, o_orderdate,
              count(l_orderkey) AS n_lines, round(coalesce(sum(l_quantity), 0), 2) AS quantity
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def hydrate_component(spark, folder):
    """Orders with their lines stored as JSON text, parsed back to typed columns."""
    registry = Registry([ORDER, LINE])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    documents = build_documents(registry, loaded, "shop.Order")
    rows = parse_documents(as_json(documents), documents.schema["source"].dataType)
    quantity = F.aggregate("lines", F.lit(0.0), lambda total, line: total + line.l_quantity)
    return rows.select(
        "id",
        "o_custkey",
        "o_totalprice",
        F.to_timestamp("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").cast("timestamp_ntz").alias("o_orderdate"),
        F.size("lines").cast("long").alias("n_lines"),
        F.round(quantity, 2).alias("quantity"),
    )


@query(
    "hydrate_raw_component",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(n_nationkey AS VARCHAR) AS nation_id,
              'geo.Nation' AS nation_class, n_name AS nation_name
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def hydrate_raw_component(spark, folder):
    """With the rebuilding of components off, they stay maps of texts."""
    supplier = mapping(
        "shop.Supplier", fields={"nation": {"component": One("geo.Nation", "s_nationkey")}}
    )
    registry = Registry([supplier, mapping("geo.Nation")])
    documents = build_documents(registry, tables(spark, folder, "shop.Supplier", "geo.Nation"), supplier)
    schema = documents.schema["source"].dataType
    rows = parse_documents(as_json(documents), schema, components=False)
    return rows.select(
        "id",
        F.col("nation")["id"].alias("nation_id"),
        F.col("nation")["class"].alias("nation_class"),
        F.col("nation")["n_name"].alias("nation_name"),
    )


@query(
    "component_rows",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id,
              CASE WHEN l_orderkey IS NOT NULL THEN row_number() OVER (
                PARTITION BY o_orderkey ORDER BY l_orderkey || '_' || l_linenumber, l_partkey, l_suppkey,
                  l_quantity, l_extendedprice) - 1 END AS pos,
              l_partkey, l_quantity, l_extendedprice
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def component_rows_query(spark, folder):
    registry = Registry([ORDER, LINE])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    documents = build_documents(registry, loaded, "shop.Order").select("id", "source.lines")
    return component_rows(documents, "lines").select(
        "id",
        F.col("pos").cast("long").alias("pos"),
        "item.l_partkey",
        "item.l_quantity",
        "item.l_extendedprice",
    )


REFERRING = mapping(
    "shop.Order",
    fields={
        "customer": {"reference": One("shop.Customer", "o_custkey")},
        "parts": {
            "reference": Many("shop.Part", "l_orderkey", link="shop.LineItem", link_key="l_partkey")
        },
    },
)


def referring_orders(spark, folder):
    registry = Registry([REFERRING, mapping("shop.Customer"), mapping("shop.Part")])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem", "shop.Customer", "shop.Part")
    return registry, loaded, build_documents(registry, loaded, REFERRING)


@query(
    "resolve_reference",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS customer_id,
              CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS c_name
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def resolve_reference_query(spark, folder):
    """The index of customers lacks those in machinery: references to them give null."""
    registry, loaded, orders = referring_orders(spark, folder)
    indexed = dict(loaded)
    indexed["shop.Customer"] = loaded["shop.Customer"].where("c_mktsegment <> 'MACHINERY'")
    customers = build_documents(registry, indexed, "shop.Customer").select("id", "source.c_name")
    rows = orders.select("id", F.col("source.customer.id").alias("customer_id"))
    reference = F.col("customer_id").cast("string")
    return resolve_reference(rows, reference, customers, "id", ["c_name"])


@query(
    "resolve_references",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, l_partkey AS part_id, p_name
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l
            ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey""",
)
def resolve_references(spark, folder):
    registry, loaded, orders = referring_orders(spark, folder)
    parts = build_documents(registry, loaded, "shop.Part").select("id", "source.p_name")
    rows = component_rows(orders.select("id", "source.parts"), "parts")
    rows = rows.select("id", F.col("item.id").alias("part_id"))
    return resolve_reference(rows, F.col("part_id").cast("string"), parts, "id", ["p_name"])


@query(
    "resolve_backref",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'shop.Customer' AS customer_class
       FROM orders""",
)
def resolve_backref(spark, folder):
    documents = customer_documents(spark, folder)
    orders = documents.select(
        F.col("id").cast("long").alias("owner"), F.explode("source.orders").alias("o")
    ).select("owner", F.col("o.id").alias("order_id"), F.col("o.customer").alias("customer"))
    resolved = resolve_back_reference(orders, "customer", F.col("owner"), "shop.Customer")
    return resolved.select(
        "order_id",
        F.col("customer.id").alias("customer_id"),
        F.col("customer.class").alias("customer_class"),
    )


@query(
    "search_hydrated_page",
    f"""WITH t AS (SELECT doc_id, unnest({tok("text")}) AS term FROM documents),
       l AS (SELECT doc_id, count(*) AS len FROM t GROUP BY doc_id),
       m AS (SELECT doc_id, count(*) AS tf FROM t WHERE term = 'thing' GROUP BY doc_id),
       s AS (SELECT doc_id, round(sqrt(tf) * power(1 + ln((SELECT count(*) FROM documents)::DOUBLE
               / ((SELECT count(*) FROM m) + 1)), 2) / sqrt(len), 6) AS score
             FROM m JOIN l USING (doc_id))
       SELECT doc_id, lang, n_chars, score FROM s JOIN documents USING (doc_id)
       ORDER BY score DESC, doc_id::VARCHAR LIMIT 60""",
)
def search_hydrated_page(spark, folder):
    """One page of hits as typed rows: what a caller of ``search`` gets."""
    space = document_space(spark, folder)
    hits = search(space, Match("thing", "text")).page()
    rows = hydrate(space.registry, space.tables, hits, DOCUMENT)
    return rows.select("doc_id", "lang", "n_chars", "score")
