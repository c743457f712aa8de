"""Which columns are searchable, and where rows go."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.entities import LINE, ORDER, mapping, tables
from catalog.registry import query
from docsearch import DocumentMapping, Registry, Settings
from docsearch.functions.naming import index_name_column, type_name_column
from docsearch.operators.documents import select_mapped
from docsearch.sources.tables import read_table


def mapped(spark, folder, declared: DocumentMapping, settings: Settings | None = None):
    registry = Registry([declared], settings)
    return select_mapped(registry, tables(spark, folder, declared.full_name), declared)


@query(
    "map_default",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_brand, p_type, p_size, p_retailprice
       FROM part""",
)
def map_default(spark, folder):
    return mapped(spark, folder, mapping("shop.Part"))


@query(
    "map_default_excluded",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, c_nationkey, c_mktsegment FROM customer",
)
def map_default_excluded(spark, folder):
    settings = Settings(default_excluded_properties=("c_acctbal",))
    return mapped(spark, folder, mapping("shop.Customer"), settings)


@query("map_only", "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents")
def map_only(spark, folder):
    return mapped(spark, folder, mapping("corpus.Document", only="text"))


@query(
    "map_except",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey, o_orderstatus, o_orderpriority
       FROM orders""",
)
def map_except(spark, folder):
    return mapped(spark, folder, mapping("shop.Order", except_=["o_totalprice", "o_orderdate"]))


@query("map_inherit", "SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source FROM documents")
def map_inherit(spark, folder):
    base = DocumentMapping(
        "corpus.Text",
        "doc_id",
        except_="n_chars",
        fields={"source": {"index": "not_analyzed"}},
        properties=("source", "lang", "n_chars"),
    )
    child = mapping("corpus.Document", extends=base, fields={"text": {"boost": 3.0}})
    return mapped(spark, folder, child)


@query("map_inherit_only", "SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source FROM documents")
def map_inherit_only(spark, folder):
    base = DocumentMapping(
        "corpus.Text", "doc_id", fields={"lang": {"index": "no"}}, properties=("source", "lang")
    )
    child = mapping("corpus.Document", extends=base, only="text")
    return mapped(spark, folder, child, Settings(always_inherit_properties=True))


@query(
    "map_explicit_id",
    "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_nationkey, n_name FROM nation",
)
def map_explicit_id(spark, folder):
    declared = mapping(
        "geo.Nation", except_="n_regionkey", fields={"n_nationkey": {"index": "not_analyzed"}}
    )
    return mapped(spark, folder, declared)


@query(
    "route_rows",
    """SELECT doc_id,
              lower(coalesce(nullif(override, ''), nullif(package, ''), lang)) AS index_name,
              replace(lower(full_name), '.', '_') AS type_name
       FROM (SELECT doc_id, lang,
                    CASE WHEN lang = 'de' THEN 'German-Texts' ELSE '' END AS override,
                    CASE WHEN lang = 'es' THEN '' ELSE source END AS package,
                    upper(source) || '.' || lang AS full_name
             FROM documents)""",
)
def route_rows(spark, folder):
    documents = read_table(spark, folder, "documents")
    override = F.when(F.col("lang") == "de", "German-Texts").otherwise("")
    package = F.when(F.col("lang") == "es", "").otherwise(F.col("source"))
    full_name = F.concat(F.upper("source"), F.lit("."), F.col("lang"))
    return documents.select(
        "doc_id",
        index_name_column(override, package, F.col("lang")).alias("index_name"),
        type_name_column(full_name).alias("type_name"),
    )


@query("root_only", "SELECT 'shop_order' AS type, count(*) AS n FROM orders")
def root_only(spark, folder):
    registry = Registry([ORDER, LINE])
    loaded = tables(spark, folder, "shop.Order", "shop.LineItem")
    requests = (
        loaded["shop.Order"]
        .select(F.lit("shop_order").alias("type"))
        .unionByName(loaded["shop.LineItem"].select(F.lit("shop_lineitem").alias("type")))
        .unionByName(read_table(spark, folder, "region").select(F.lit("geo_region").alias("type")))
    )
    roots = [m.type_name for m in registry.roots()]
    return requests.where(F.col("type").isin(roots)).groupBy("type").agg(F.count("*").alias("n"))
