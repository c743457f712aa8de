"""The test tables as entities, and SQL pieces shared by the catalogue."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docsearch import DocumentMapping, Many, One, Registry, Settings
from docsearch.functions.converters import json_map
from docsearch.operators.space import TableSpace
from docsearch.sources.tables import read_table, spread

TABLES = {
    "geo.Region": "region",
    "geo.Nation": "nation",
    "shop.Customer": "customer",
    "shop.Supplier": "supplier",
    "shop.Part": "part",
    "shop.Order": "orders",
    "shop.LineItem": "lineitem",
    "corpus.Document": "documents",
    "web.Page": "pages",
    "chat.Turn": "conversations",
    "log.Event": "events",
    "vector.Embedding": "embeddings",
}
KEYS = {
    "geo.Region": "r_regionkey",
    "geo.Nation": "n_nationkey",
    "shop.Customer": "c_custkey",
    "shop.Supplier": "s_suppkey",
    "shop.Part": "p_partkey",
    "shop.Order": "o_orderkey",
    "shop.LineItem": ("l_orderkey", "l_linenumber"),
    "corpus.Document": "doc_id",
    "web.Page": "page_id",
    "chat.Turn": ("conv_id", "turn"),
    "log.Event": "event_id",
    "vector.Embedding": "vec_id",
}


def mapping(name: str, **options) -> DocumentMapping:
    return DocumentMapping(name, KEYS[name], **options)


def tables(spark: SparkSession, folder: str, *names: str):
    """Entity tables by full name."""
    return {name: read_table(spark, folder, TABLES[name]) for name in names}


def text_tables(spark: SparkSession, folder: str, *names: str):
    """The same, spread over the cores: for jobs that analyse every row."""
    return {name: spread(table) for name, table in tables(spark, folder, *names).items()}


DOCUMENT = mapping(
    "corpus.Document",
    except_="n_chars",
    fields={
        "text": {"analyzer": "standard"},
        "source": {"index": "not_analyzed"},
        "lang": {"index": "not_analyzed", "excludeFromAll": True},
    },
)
PAGE = mapping("web.Page", fields={"url": {"index": "not_analyzed", "excludeFromAll": "yes"}})
TURN = mapping("chat.Turn", fields={"role": {"index": "not_analyzed"}})
PART = mapping("shop.Part", only=["p_name", "p_brand", "p_retailprice"], fields={
    "p_brand": {"index": "not_analyzed"},
    "p_retailprice": {"index": "no"},
})

LINE = mapping("shop.LineItem", root=False)
ORDER = mapping("shop.Order", fields={"lines": {"component": Many("shop.LineItem", "l_orderkey")}})


def customers(**orders_options) -> Registry:
    """Customers that nest their orders, which nest their lines and point back."""
    return Registry(
        [
            mapping(
                "shop.Customer",
                fields={
                    "orders": {"component": Many("shop.Order", "o_custkey"), **orders_options}
                },
            ),
            mapping(
                "shop.Order",
                fields={
                    "lines": {"component": Many("shop.LineItem", "l_orderkey")},
                    "customer": {"component": One("shop.Customer", "o_custkey")},
                },
            ),
            LINE,
        ]
    )


def document_space(spark: SparkSession, folder: str, document: DocumentMapping = DOCUMENT):
    return TableSpace.over(Registry([document]), text_tables(spark, folder, "corpus.Document"))


CROSS = (DOCUMENT, PAGE, TURN, PART)


def cross_registry(settings: Settings | None = None) -> Registry:
    return Registry(CROSS, settings)


def cross_tables(spark: SparkSession, folder: str):
    texts = text_tables(spark, folder, "corpus.Document", "web.Page", "chat.Turn")
    return {**texts, **tables(spark, folder, "shop.Part")}


def event_changes(spark: SparkSession, folder: str):
    """The events as changes: who, in which order, what."""
    events = read_table(spark, folder, "events")
    kind = F.col("event_type")
    op = F.when(kind == "error", "delete").when(kind == "signup", "insert").otherwise("update")
    return events.select(
        F.lit("log_user").alias("type"),
        F.col("user_id").cast("string").alias("id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"),
        op.alias("op"),
        F.col("event_id").alias("tx_id"),
        F.col("value"),
        F.to_date("ts").alias("day"),
    )


def event_entity(spark: SparkSession, folder: str):
    return read_table(spark, folder, "events").withColumn("props", json_map(F.col("props")))


# -- SQL ---------------------------------------------------------------------------------

OP = "CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' ELSE 'update' END"


def tok(column: str) -> str:
    return rf"regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}]+')"


#: t: one row per token of the documents; l: their number per document
DOC_TOKENS = f"""
t AS (SELECT doc_id, lang, source, unnest({tok("text")}) AS term FROM documents),
l AS (SELECT doc_id, count(*) AS len FROM t GROUP BY doc_id)"""


def term_weights(terms: list[str]) -> str:
    """CTEs up to ``w``: the weight of each of the terms in each document's text."""
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"""{DOC_TOKENS},
m AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN ({listed}) GROUP BY doc_id, term),
d AS (SELECT term, count(*) AS df FROM m GROUP BY term),
w AS (SELECT m.doc_id, m.term, m.tf, d.df, l.len,
             1 + ln((SELECT count(*) FROM documents)::DOUBLE / (d.df + 1)) AS idf
      FROM m JOIN d USING (term) JOIN l USING (doc_id)),
s AS (SELECT *, sqrt(tf) * idf * idf / sqrt(len) AS weight FROM w)"""
