"""Nested documents. Results are exploded back to one row per nested item, so the comparison
covers every item and nothing is folded into one long value."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.entities import (
    LINE,
    ORDER,
    PART,
    customers,
    event_entity,
    mapping,
    tables,
)
from catalog.registry import query
from docsearch import DocumentMapping, Many, One, Registry
from docsearch.functions.converters import lower_case
from docsearch.operators.documents import as_json, build_documents
from docsearch.operators.hydrate import convert_in, parse_dates, parse_documents
from docsearch.sources.tables import read_table

ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"


@query(
    "doc_build",
    """SELECT 'shop' AS index, 'shop_part' AS type, CAST(p_partkey AS VARCHAR) AS id,
              p_name, p_brand, p_retailprice FROM part""",
)
def doc_build(spark, folder):
    built = build_documents(Registry([PART]), tables(spark, folder, "shop.Part"), PART)
    return built.select(
        "index", "type", "id", "source.p_name", "source.p_brand", "source.p_retailprice"
    )


def suppliers(spark, folder, *extra: DocumentMapping):
    supplier = mapping(
        "shop.Supplier",
        only=["s_name", "nation"],
        fields={"nation": {"component": One("geo.Nation", "s_nationkey")}},
    )
    registry = Registry([supplier, *extra])
    loaded = tables(spark, folder, "shop.Supplier", "geo.Nation")
    return build_documents(registry, loaded, supplier)


@query(
    "component_one",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, n_nationkey AS nation_id,
              CASE WHEN n_nationkey IS NOT NULL THEN 'geo.Nation' END AS nation_class,
              n_name AS nation_name
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def component_one(spark, folder):
    return suppliers(spark, folder, mapping("geo.Nation")).select(
        "id",
        F.col("source.nation.id").alias("nation_id"),
        F.col("source.nation.class").alias("nation_class"),
        F.col("source.nation.n_name").alias("nation_name"),
    )


@query(
    "component_stub",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_nationkey AS nation_id,
              'geo.Nation' AS nation_class, 2 AS n_nation_fields FROM supplier""",
)
def component_stub(spark, folder):
    documents = suppliers(spark, folder)
    width = len(documents.select("source.nation.*").columns)
    return documents.select(
        "id",
        F.col("source.nation.id").alias("nation_id"),
        F.col("source.nation.class").alias("nation_class"),
        F.lit(width).alias("n_nation_fields"),
    )


@query(
    "component_many",
    f"""WITH n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
       SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(n_lines, 0) AS n_lines,
              CASE WHEN l.l_orderkey IS NOT NULL THEN l.l_orderkey || '_' || l_linenumber END AS line_id,
              l_partkey, l_quantity, strftime(l_shipdate, {ISO}) AS l_shipdate
       FROM orders LEFT JOIN lineitem l ON l.l_orderkey = o_orderkey
                   LEFT JOIN n ON n.l_orderkey = o_orderkey""",
)
def component_many(spark, folder):
    registry = Registry([ORDER, LINE])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    documents = build_documents(registry, loaded, "shop.Order")
    return documents.select(
        "id",
        F.size("source.lines").cast("long").alias("n_lines"),
        F.explode_outer("source.lines").alias("line"),
    ).select(
        "id",
        "n_lines",
        F.col("line.id").alias("line_id"),
        "line.l_partkey",
        "line.l_quantity",
        "line.l_shipdate",
    )


def customer_documents(spark, folder, **options):
    loaded = tables(spark, folder, "shop.Customer", "shop.Order", "shop.LineItem")
    return build_documents(customers(**options), loaded, "shop.Customer")


@query(
    "component_nested",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, o_orderkey AS order_id,
              CASE WHEN l_orderkey IS NOT NULL THEN l_orderkey || '_' || l_linenumber END AS line_id,
              l_partkey, l_quantity
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey
                     LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def component_nested(spark, folder):
    documents = customer_documents(spark, folder)
    orders = documents.select("id", F.explode_outer("source.orders").alias("o"))
    lines = orders.select("id", F.col("o.id").alias("order_id"), F.explode_outer("o.lines").alias("l"))
    return lines.select(
        "id", "order_id", F.col("l.id").alias("line_id"), "l.l_partkey", "l.l_quantity"
    )


@query(
    "component_depth",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, count(o_orderkey) AS n_orders,
              CAST(0 AS BIGINT) AS n_lines
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def component_depth(spark, folder):
    documents = customer_documents(spark, folder, maxDepth=1)
    lines = F.aggregate("source.orders", F.lit(0), lambda n, o: n + F.size(o.lines))
    return documents.select(
        "id",
        F.size("source.orders").cast("long").alias("n_orders"),
        lines.cast("long").alias("n_lines"),
    )


@query(
    "reference_ids",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS customer_id, l_partkey AS part_id
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l
            ON l_orderkey = o_orderkey""",
)
def reference_ids(spark, folder):
    order = mapping(
        "shop.Order",
        fields={
            "customer": {"reference": One("shop.Customer", "o_custkey")},
            "parts": {
                "reference": Many("shop.Part", "l_orderkey", link="shop.LineItem", link_key="l_partkey")
            },
        },
    )
    registry = Registry([order, mapping("shop.Customer"), mapping("shop.Part")])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem", "shop.Customer", "shop.Part")
    documents = build_documents(registry, loaded, order)
    return documents.select(
        "id",
        F.col("source.customer.id").alias("customer_id"),
        F.explode_outer("source.parts").alias("part"),
    ).select("id", "customer_id", F.col("part.id").alias("part_id"))


@query(
    "component_backref",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, o_orderkey AS order_id, o_custkey AS ref_id,
              'shop.Customer' AS ref_class, '../../..' AS ref
       FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def component_backref(spark, folder):
    documents = customer_documents(spark, folder)
    orders = documents.select("id", F.explode("source.orders").alias("o"))
    return orders.select(
        "id",
        F.col("o.id").alias("order_id"),
        F.col("o.customer.id").alias("ref_id"),
        F.col("o.customer.class").alias("ref_class"),
        F.col("o.customer.ref").alias("ref"),
    )


CONVERTED = mapping(
    "shop.Order", only="o_orderpriority", fields={"o_orderpriority": {"converter": lower_case}}
)


def converted_orders(spark, folder):
    return build_documents(Registry([CONVERTED]), tables(spark, folder, "shop.Order"), CONVERTED)


@query(
    "converter_out",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, lower(o_orderpriority) AS value FROM orders",
)
def converter_out(spark, folder):
    documents = converted_orders(spark, folder)
    return documents.select("id", F.col("source.o_orderpriority").alias("value"))


@query(
    "converter_in", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS value FROM orders"
)
def converter_in(spark, folder):
    documents = converted_orders(spark, folder)
    stored = parse_documents(as_json(documents), documents.schema["source"].dataType)
    back = convert_in(stored, "o_orderpriority", lower_case)
    return back.select("id", F.col("o_orderpriority").alias("value"))


@query(
    "array_field",
    """SELECT CAST(vec_id AS VARCHAR) AS id, len(embedding) AS n,
              CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
       FROM embeddings""",
)
def array_field(spark, folder):
    vectors = mapping("vector.Embedding")
    documents = build_documents(
        Registry([vectors]), tables(spark, folder, "vector.Embedding"), vectors
    )
    value = F.col("source.embedding")
    return documents.select(
        "id",
        F.size(value).cast("long").alias("n"),
        F.element_at(value, 1).cast("double").alias("first"),
        F.element_at(value, -1).cast("double").alias("last"),
    )


@query(
    "map_field",
    """SELECT CAST(event_id AS VARCHAR) AS id, key, value
       FROM (SELECT event_id, unnest(json_keys(props)) AS key, props FROM events),
            LATERAL (SELECT json_extract_string(props, '$.' || key) AS value)""",
)
def map_field(spark, folder):
    events = mapping("log.Event", only="props")
    loaded = {"log.Event": event_entity(spark, folder)}
    documents = build_documents(Registry([events]), loaded, events)
    return documents.select("id", F.explode("source.props").alias("key", "value"))


DATED = mapping("shop.Order", only="o_orderdate")


@query(
    "date_out",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, {ISO}) AS text FROM orders",
)
def date_out(spark, folder):
    documents = build_documents(Registry([DATED]), tables(spark, folder, "shop.Order"), DATED)
    return documents.select("id", F.col("source.o_orderdate").alias("text"))


@query(
    "date_in",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS ts FROM orders""",
)
def date_in(spark, folder):
    orders = read_table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    long_form = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    short_form = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = (
        F.when(status == "F", long_form)
        .when(status == "O", short_form)
        .otherwise(F.col("o_orderpriority"))
    )
    stored = orders.select(F.col("o_orderkey").cast("string").alias("id"), text.alias("ts"))
    return parse_dates(stored, "ts")
