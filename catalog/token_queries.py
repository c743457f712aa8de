"""Analysis and token tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.entities import DOC_TOKENS, DOCUMENT, mapping, text_tables, tok
from catalog.registry import query
from docsearch import DocumentMapping, Many, Registry
from docsearch.functions.analyzers import ANALYZERS, STOP_WORDS, exploding
from docsearch.operators.documents import build_documents
from docsearch.operators.postings import (
    field_sizes,
    postings,
    search_fields,
    term_stats,
    whole_lengths,
)


def document_rows(spark, folder, declared: DocumentMapping = DOCUMENT, with_all=False, positions=True):
    registry, loaded = Registry([declared]), text_tables(spark, folder, "corpus.Document")
    documents = build_documents(registry, loaded, declared)
    return postings(documents, search_fields(registry, loaded, declared), with_all, positions)


def only(name: str, **options) -> DocumentMapping:
    return mapping("corpus.Document", only=name, fields={name: options})


@query(
    "analyze_standard",
    f"""WITH {DOC_TOKENS}
       SELECT 'text' AS field, CAST(doc_id AS VARCHAR) AS id, term, CAST(count(*) AS DOUBLE) AS tf
       FROM t GROUP BY doc_id, term""",
)
def analyze_standard(spark, folder):
    rows = document_rows(spark, folder, only("text", index="analyzed"), positions=False)
    return rows.select("field", "id", "term", "tf")


@query(
    "analyze_exact",
    """SELECT 'source' AS field, CAST(doc_id AS VARCHAR) AS id, source AS term, 1.0::DOUBLE AS tf
       FROM documents WHERE source IS NOT NULL""",
)
def analyze_exact(spark, folder):
    rows = document_rows(spark, folder, only("source", index="not_analyzed"), positions=False)
    return rows.select("field", "id", "term", "tf")


@query(
    "analyze_none",
    """SELECT CAST(doc_id AS VARCHAR) AS id, lang AS stored, source AS term, 'source' AS field
       FROM documents WHERE source IS NOT NULL""",
)
def analyze_none(spark, folder):
    hidden = mapping(
        "corpus.Document",
        only=["lang", "source"],
        fields={"lang": {"index": "no"}, "source": {"index": "not_analyzed"}},
    )
    registry, loaded = Registry([hidden]), text_tables(spark, folder, "corpus.Document")
    documents = build_documents(registry, loaded, hidden)
    rows = postings(documents, search_fields(registry, loaded, hidden), positions=False)
    stored = documents.select("id", F.col("source.lang").alias("stored"))
    return rows.join(stored, "id").select("id", "stored", "term", "field")


STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "analyze_variants",
    rf"""WITH v AS (
         SELECT 'standard' AS analyzer, unnest({tok("text")}) AS term FROM documents
         UNION ALL SELECT 'simple', unnest(regexp_extract_all(lower(text), '\p{{L}}+')) FROM documents
         UNION ALL SELECT 'whitespace', unnest(regexp_extract_all(text, '\S+')) FROM documents
         UNION ALL SELECT 'keyword', text FROM documents
         UNION ALL SELECT 'stop', term FROM
             (SELECT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS term FROM documents)
             WHERE term NOT IN ({STOP_LIST}))
       SELECT analyzer, term, count(*) AS n FROM v GROUP BY analyzer, term""",
)
def analyze_variants(spark, folder):
    documents = text_tables(spark, folder, "corpus.Document")["corpus.Document"]
    variants = F.array(
        *[
            F.struct(F.lit(name).alias("analyzer"), analyse(F.col("text")).alias("terms"))
            for name, analyse in ANALYZERS.items()
        ]
    )
    terms = documents.select(F.explode(variants).alias("v")).select(
        "v.analyzer", F.explode(exploding(F.col("v.terms"))).alias("term")
    )
    return terms.groupBy("analyzer", "term").agg(F.count("*").alias("n"))


@query(
    "postings",
    f"""WITH p AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) - 1 AS pos
                   FROM (SELECT doc_id, {tok("text")} AS x FROM documents)),
            l AS (SELECT doc_id, count(*) AS len FROM p GROUP BY doc_id)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, term, CAST(count(*) AS DOUBLE) AS tf,
              min(pos) AS first_pos, max(pos) AS last_pos, max(len) AS len
       FROM p JOIN l USING (doc_id) GROUP BY doc_id, term""",
)
def postings_query(spark, folder):
    rows = document_rows(spark, folder, only("text"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "term",
        "tf",
        F.element_at("positions", 1).cast("long").alias("first_pos"),
        F.element_at("positions", -1).cast("long").alias("last_pos"),
        F.col("len").cast("long").alias("len"),
    )


@query(
    "all_field",
    f"""WITH {DOC_TOKENS},
       a AS (SELECT doc_id, term, 1.0::DOUBLE AS weight FROM t
             UNION ALL SELECT doc_id, source, 2.0::DOUBLE FROM documents)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, term, sum(weight) AS weighted_tf, any_value(len + 1) AS len
       FROM a JOIN l USING (doc_id) GROUP BY doc_id, term""",
)
def all_field(spark, folder):
    boosted = mapping(
        "corpus.Document",
        except_="n_chars",
        fields={
            "source": {"index": "not_analyzed", "boost": 2.0},
            "lang": {"index": "not_analyzed", "excludeFromAll": True},
        },
    )
    rows = document_rows(spark, folder, boosted, with_all=True, positions=False)
    return rows.where(F.col("field") == "_all").select(
        F.col("id").alias("doc_id"),
        "term",
        F.col("tf").alias("weighted_tf"),
        F.col("len").cast("long").alias("len"),
    )


def conversations(spark, folder):
    """Conversations as root documents that nest their turns."""
    registry = Registry(
        [
            DocumentMapping(
                "chat.Conversation",
                "conv_id",
                fields={"turns": {"component": Many("chat.Turn", "conv_id")}},
            ),
            mapping("chat.Turn", root=False, fields={"role": {"index": "not_analyzed"}}),
        ]
    )
    loaded = text_tables(spark, folder, "chat.Turn")
    loaded["chat.Conversation"] = loaded["chat.Turn"].select("conv_id").distinct()
    return registry, loaded


@query(
    "nested_path",
    f"""WITH t AS (
         SELECT conv_id, 'turns.text' AS field, unnest({tok("text")}) AS term FROM conversations
         UNION ALL SELECT conv_id, 'turns.role', role FROM conversations
         UNION ALL SELECT conv_id, 'turns.id', conv_id || '_' || turn FROM conversations),
       l AS (SELECT conv_id, field, count(*) AS len FROM t GROUP BY ALL)
       SELECT CAST(conv_id AS VARCHAR) AS conv_id, field, term, CAST(count(*) AS DOUBLE) AS tf,
              CAST(any_value(len) AS BIGINT) AS len
       FROM t JOIN l USING (conv_id, field) GROUP BY conv_id, field, term""",
)
def nested_path(spark, folder):
    registry, loaded = conversations(spark, folder)
    documents = build_documents(registry, loaded, "chat.Conversation")
    fields = search_fields(registry, loaded, "chat.Conversation")
    rows = whole_lengths(postings(documents, fields, positions=False))
    return rows.groupBy(F.col("id").alias("conv_id"), "field", "term").agg(
        F.sum("tf").alias("tf"), F.max("len").cast("long").alias("len")
    )


@query(
    "term_stats",
    f"""WITH {DOC_TOKENS}
       SELECT term, count(DISTINCT doc_id) AS df FROM t GROUP BY term""",
)
def term_stats_query(spark, folder):
    rows = document_rows(spark, folder, only("text"), positions=False)
    return term_stats(rows, split=False).select("term", "df")


@query(
    "field_len",
    f"""WITH {DOC_TOKENS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, len FROM l""",
)
def field_len(spark, folder):
    declared = only("text")
    registry, loaded = Registry([declared]), text_tables(spark, folder, "corpus.Document")
    documents = build_documents(registry, loaded, declared)
    lengths = field_sizes(documents, search_fields(registry, loaded, declared), split=False)
    return lengths.select(F.col("id").alias("doc_id"), F.col("len").cast("long").alias("len"))
