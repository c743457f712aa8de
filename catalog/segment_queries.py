"""A written index that is changed, dropped from and merged in place, and asked after that."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.entities import CROSS, PAGE, TURN, cross_registry, cross_tables, mapping, tables, tok
from catalog.index_queries import CROSS_KEYS
from catalog.registry import query
from docsearch import Match, Registry
from docsearch.operators.documents import build_documents
from docsearch.operators.search import count_hits, search
from docsearch.operators.segments import SegmentedIndex
from docsearch.sources.shared import fresh_path
from docsearch.sources.tables import read_table

DECLARED = mapping("corpus.Document", only=["text", "lang"], fields={"lang": {"index": "not_analyzed"}})

#: the documents after the changes: no toxic ones, and the French ones with another text
CHANGED = f"""d AS (SELECT doc_id, lang, CASE WHEN lang = 'fr' THEN 'thing of ' || source ELSE text END AS text
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
t AS (SELECT doc_id, unnest({tok("text")}) AS term FROM d)"""


def changed_index(spark, folder) -> SegmentedIndex:
    """All documents; then the toxic ones go, and the French ones, with some of those that went,
    come in two changes with another text; a last change takes out again what should have stayed out."""
    registry, loaded = Registry([DECLARED]), tables(spark, folder, "corpus.Document")
    index = SegmentedIndex.create(registry, loaded, fresh_path(spark, "segments"), [DECLARED], buckets=8)
    toxic = read_table(spark, folder, "labels").where("toxic = 1").select(
        F.lit("corpus").alias("index"),
        F.lit("corpus_document").alias("type"),
        F.col("doc_id").cast("string").alias("id"),
    )
    index.remove(toxic)
    french = loaded["corpus.Document"].where("lang = 'fr'")
    revised = french.withColumn("text", F.concat(F.lit("thing of "), "source"))
    for given in (french.withColumn("text", F.lit("first esat")), revised):
        changed = {"corpus.Document": given}
        index.put(changed, DECLARED, build_documents(registry, changed, DECLARED))
    index.remove(toxic)
    return index


@query(
    "segment_search",
    f"""WITH {CHANGED}, l AS (SELECT doc_id, count(*) AS len FROM t GROUP BY doc_id),
       m AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN ('thing', 'esat') GROUP BY doc_id, term),
       f AS (SELECT term, count(*) AS df FROM m GROUP BY term),
       s AS (SELECT doc_id, sqrt(tf) * power(1 + ln((SELECT count(*) FROM d)::DOUBLE / (df + 1)), 2) / sqrt(len) AS weight
             FROM m JOIN f USING (term) JOIN l USING (doc_id))
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(sum(weight) * count(*) / 2, 6) AS score FROM s GROUP BY doc_id""",
)
def segment_search(spark, folder):
    """Scores over five segments, with statistics put together from what each change added and took."""
    space = changed_index(spark, folder).space()
    return search(space, Match("thing esat", "text")).hits.select(F.col("id").alias("doc_id"), "score")


@query(
    "segment_merge",
    f"""WITH {CHANGED}
       SELECT 'text' AS field, term, count(DISTINCT doc_id) AS df FROM t GROUP BY term
       UNION ALL SELECT 'lang', lang, count(*) FROM d WHERE lang IS NOT NULL GROUP BY lang""",
)
def segment_merge(spark, folder):
    """The changes merged into one segment, the first segment left as it was: which terms there are."""
    index = changed_index(spark, folder)
    index.merge()
    stats = index.space().term_stats(F.col("field") != "_all", ())
    return stats.where("df <> 0").select("field", "term", "df")


def cross_index(spark, folder) -> SegmentedIndex:
    path = fresh_path(spark, "segments")
    return SegmentedIndex.create(cross_registry(), cross_tables(spark, folder), path, CROSS)


@query("stored_unindex_type", CROSS_KEYS + "SELECT type, id FROM c WHERE type <> 'web_page'")
def stored_unindex_type(spark, folder):
    """A type leaves a written index by a new manifest."""
    index = cross_index(spark, folder)
    index.drop_types([PAGE])
    return index.space().keys().select("type", "id")


@query(
    "stored_delete_index",
    f"""SELECT count(*) AS n FROM (
         SELECT text FROM documents UNION ALL SELECT html FROM pages UNION ALL SELECT p_name FROM part)
       WHERE list_contains({tok("text")}, 'thing')""",
)
def stored_delete_index(spark, folder):
    """An index leaves a written one; what is left is asked for a word."""
    index = cross_index(spark, folder)
    index.drop_indices([TURN])
    return count_hits(index.space(), "thing")
