"""Tables of words and patterns looked up in the dictionary of a written index."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.entities import DOC_TOKENS, mapping, tables, tok
from catalog.registry import query
from docsearch import Registry
from docsearch.functions.analyzers import analyzer
from docsearch.operators.dictionary import TermDictionary, holding
from docsearch.operators.maintain import bulk_index
from docsearch.operators.space import IndexSpace
from docsearch.sources.shared import fresh_path
from docsearch.sources.tables import read_table

TEXTS = mapping("corpus.Document", only=["text"])

#: w: the words of the benchmark that are in plain letters. SQL counts edits in bytes, so a letter that
#: is none of these becomes one byte that no such word holds
ASKED = f"""{DOC_TOKENS},
d AS (SELECT DISTINCT doc_id, term, regexp_replace(term, '[^a-z0-9]', '~', 'g') AS plain FROM t),
v AS (SELECT term, plain, count(*) AS df FROM d GROUP BY term, plain),
w AS (SELECT DISTINCT word FROM (SELECT unnest({tok("text")}) AS word FROM benchmark)
      WHERE regexp_full_match(word, '[a-z]+'))"""


def within(edits: int) -> str:
    """Words of very different length need not be compared."""
    return f"CASE WHEN abs(strlen(word) - strlen(plain)) <= {edits} THEN levenshtein(word, plain) <= {edits} ELSE false END"


def text_dictionary(spark, folder) -> tuple[IndexSpace, TermDictionary]:
    registry = Registry([TEXTS])
    path = fresh_path(spark, "dictionary-index")
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path)
    space = IndexSpace.over(spark, path, registry)
    return space, TermDictionary.write(space, fresh_path(spark, "dictionary"))


def asked_words(spark, folder):
    words = F.explode(analyzer("standard")(F.col("text"))).alias("word")
    return read_table(spark, folder, "benchmark").select(words).where(F.col("word").rlike("^[a-z]+$")).distinct()


@query(
    "fuzzy_batch",
    f"""WITH {ASKED}
       SELECT word, term, CAST(levenshtein(word, plain) AS INTEGER) AS edits, df FROM w, v
       WHERE {within(2)}""",
)
def fuzzy_batch(spark, folder):
    """The terms within two edits of each word, and how many documents hold them."""
    space, dictionary = text_dictionary(spark, folder)
    near = dictionary.similar(asked_words(spark, folder), "text")
    stats = space.term_stats(F.col("field") == "text", ()).groupBy("term").agg(F.sum("df").alias("df"))
    return near.join(stats, "term").select("word", "term", "edits", "df")


@query(
    "fuzzy_documents",
    f"""WITH {ASKED}, n AS (SELECT word, term FROM w, v WHERE {within(1)}),
       h AS (SELECT word, doc_id, count(*) AS n_terms FROM n JOIN d USING (term) GROUP BY word, doc_id)
       SELECT word, count(*) AS n_docs, CAST(sum(n_terms) AS BIGINT) AS n_terms FROM h GROUP BY word""",
)
def fuzzy_documents(spark, folder):
    """How many documents hold a term within one edit of each word, and how many such terms."""
    space, dictionary = text_dictionary(spark, folder)
    near = dictionary.similar(asked_words(spark, folder), "text", 1)
    found = holding(space, "text", near, "word")
    return found.groupBy("word").agg(F.count("*").alias("n_docs"), F.sum("n_terms").alias("n_terms"))


@query(
    "wildcard_inner",
    f"""WITH {ASKED},
       p AS (SELECT DISTINCT unnest(['*' || word[2:5] || '?*', '?' || word[2:], '*' || word[-3:]]) AS pattern
             FROM w WHERE length(word) > 4),
       n AS (SELECT pattern, term FROM p, v WHERE term LIKE translate(pattern, '*?', '%_')),
       h AS (SELECT pattern, doc_id, count(*) AS n_terms FROM n JOIN d USING (term) GROUP BY pattern, doc_id)
       SELECT pattern, count(*) AS n_docs, CAST(sum(n_terms) AS BIGINT) AS n_terms FROM h GROUP BY pattern""",
)
def wildcard_inner(spark, folder):
    """Patterns that begin with a wildcard or hold one inside: how many documents and terms fit."""
    space, dictionary = text_dictionary(spark, folder)
    patterns = asked_words(spark, folder).where(F.length("word") > 4).select(
        F.explode(
            F.array(
                F.concat(F.lit("*"), F.substring("word", 2, 4), F.lit("?*")),
                F.concat(F.lit("?"), F.expr("substring(word, 2)")),
                F.concat(F.lit("*"), F.substring("word", -3, 3)),
            )
        ).alias("pattern")
    )
    found = holding(space, "text", dictionary.fitting(patterns, "text"), "pattern")
    return found.groupBy("pattern").agg(F.count("*").alias("n_docs"), F.sum("n_terms").alias("n_terms"))
