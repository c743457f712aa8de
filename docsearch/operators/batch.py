"""Many questions in one job.

The questions are a table ``(query_id, text)``. Their terms are joined to the terms of the
documents, every (question, document) pair that shares a term is scored, and each question keeps
its best hits. No text is shuffled: postings are made where the text is read, or come from the
buckets of a written index that hold the terms asked for. Only postings of those terms are brought
together, by document; grouping by (question, document) then needs no further shuffle, and the
ranking drops all but the best hits of each task before its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch.functions.analyzers import analyzer, exploding
from docsearch.operators.postings import DOC, packed, postings, search_fields, unpacked, whole_lengths
from docsearch.operators.search import SCORE_DIGITS, idf
from docsearch.operators.sizes import is_small
from docsearch.operators.space import IndexSpace, Space, spans, union
from docsearch.plans.clauses import ALL
from docsearch.sources.shared import kept

KEPT = [*DOC, "term", "tf", "norm"]
#: pairs of questions and postings that a task sums up
PAIRS_A_TASK = 1_000_000


def query_vocabulary(queries: DataFrame, how: str = "standard") -> DataFrame:
    """``(query_id, k, term)``: the distinct terms of each question and how many it has."""
    terms = F.array_distinct(analyzer(how)(F.col("text")))
    asked = queries.select("query_id", terms.alias("terms"))
    each = F.explode(exploding(F.col("terms"))).alias("term")
    return asked.select("query_id", F.size("terms").alias("k"), each)


def coded(terms: DataFrame) -> DataFrame:
    """``(term, code)``: each of a small number of terms, and a number for it."""
    few = terms.select("term").distinct().coalesce(1)
    return kept(few.withColumn("code", F.monotonically_increasing_id().cast("int")), "coded-terms")


def tasks_for(pairs: DataFrame) -> int:
    """In how many tasks the ``df`` pairs of each row are summed up. Spark would count the bytes that are
    shuffled, and these are few against what becomes of them."""
    total = pairs.agg(F.sum("df")).first()[0] or 0
    usual = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, -(-total // PAIRS_A_TASK))


def packed_rows(space: IndexSpace, field: str, codes: DataFrame) -> DataFrame:
    """Packed postings of one field for the terms of ``codes``."""
    return packed(space.vocabulary_rows(field, F.broadcast(codes)))


def unpacked_rows(rows: DataFrame, tasks: int, codes: DataFrame) -> DataFrame:
    """The postings of :func:`packed_rows`, dealt out by document, one per document and term."""
    norm = F.col("boost") / F.sqrt(F.col("len"))
    each = unpacked(rows.repartition(tasks, *DOC)).groupBy(*DOC, "code").agg(F.sum("tf").alias("tf"), F.max(norm).alias("norm"))
    return each.join(F.broadcast(codes), "code").select(*KEPT)


def _rows(space: Space, field: str, vocabulary: DataFrame) -> DataFrame:
    """Postings of one field for the terms of ``vocabulary``, one per document and term."""
    norm = (F.col("boost") / F.sqrt(F.col("len"))).alias("norm")
    if isinstance(space, IndexSpace):
        rows = space.vocabulary_rows(field, vocabulary)
        return rows.groupBy(*DOC, "term").agg(F.sum("tf").alias("tf"), F.max(norm).alias("norm"))
    found = []
    for mapping in space.mappings:
        known = search_fields(space.registry, space.tables, mapping)
        with_all = field == ALL
        wanted = [f for f in known if f.path == field or (with_all and f.in_all)]
        if not wanted:
            continue
        rows = postings(space.typed(mapping), wanted, with_all, positions=False)
        split = spans(space.registry, mapping)
        if split:
            rows = whole_lengths(rows)
        rows = rows.where(F.col("field") == field).join(vocabulary, "term", "left_semi")
        if split:
            rows = rows.groupBy(*DOC, "field", "term").agg(
                F.sum("tf").alias("tf"), F.max("len").alias("len"), F.max("boost").alias("boost")
            )
        # the few postings asked for, together by document
        found.append(rows.select(*DOC, "term", "tf", norm).repartition(*DOC))
    if not found:
        raise ValueError(f"no selected type has a field {field!r}")
    return union(found)


def batch_search(
    space: Space,
    queries: DataFrame,
    field: str = ALL,
    top: int = 10,
    analyzer_name: str = "standard",
) -> DataFrame:
    """``(query_id, rank, index, type, id, score)``: the best ``top`` hits of each question."""
    asked = query_vocabulary(queries, analyzer_name)
    # everything sent to all tasks below has at most one row per row of ``asked``
    small = is_small(asked)
    send = F.broadcast if small else (lambda side: side)
    vocabulary = send(asked.select("term").distinct())
    if isinstance(space, IndexSpace):
        counts = space.term_stats(F.col("field") == field, ()).join(vocabulary, "term", "left_semi")
        counts = counts.groupBy("term").agg(F.sum("df").alias("df"))
    if isinstance(space, IndexSpace) and small:
        codes = coded(asked)
        rows = unpacked_rows(packed_rows(space, field, codes), tasks_for(asked.join(counts, "term")), codes)
    else:
        rows = _rows(space, field, vocabulary)
    if not isinstance(space, IndexSpace):
        counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = counts.select("term", idf(space.count().scalar(), F.col("df")).alias("idf"))
    pairs = rows.join(send(asked.join(weights, "term")), "term")
    scored = pairs.groupBy("query_id", *DOC).agg(
        F.sum(F.sqrt("tf") * F.pow("idf", F.lit(2)) * F.col("norm")).alias("sum"),
        F.count(F.lit(1)).alias("matched"),
        F.max("k").alias("k"),
    )
    score = F.round(F.col("sum") * F.col("matched") / F.col("k"), SCORE_DIGITS)
    return best(scored.select("query_id", *DOC, score.alias("score")), top)


def best(scored: DataFrame, top: int, *order: Column) -> DataFrame:
    """The first ``top`` rows of each question. Spark applies the limit inside each task
    before rows of one question meet, so a question with many hits stays small."""
    ordering = order or (F.desc("score"), F.asc("type"), F.asc("id"))
    window = Window.partitionBy("query_id").orderBy(*ordering)
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)
