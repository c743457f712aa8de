"""Many questions in one job, without scoring every document that shares a word with one.

The hits are those of :func:`docsearch.operators.batch.batch_search`. Three steps leave out what
cannot be among the best, and nothing else:

1. The documents that score best by the rarest words of a question are scored by all of its words.
   The last of them is a threshold: the question's hits score that much at least.
2. The most that a word can add is known from its postings. The words that add least, as many as
   cannot reach the threshold together, bring no document in by themselves. These are the
   common words, so their long lists of postings are not paired with the questions.
3. Documents with one of the other words are candidates, unless even the most of the common words
   leaves them under the threshold. Only for candidates are the common words looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from docsearch.operators.batch import _rows, best, coded, packed_rows, query_vocabulary, tasks_for, unpacked_rows
from docsearch.operators.postings import DOC
from docsearch.operators.search import SCORE_DIGITS, idf
from docsearch.operators.sizes import broadcast_if_small, is_small
from docsearch.operators.space import IndexSpace, Space
from docsearch.plans.clauses import ALL
from docsearch.sources.shared import kept

#: the words that set the threshold have postings for so many times the hits wanted
LEAD = 4
#: scores are rounded; what is nearer to the threshold than this is not left out
NEAR = 2 * 10.0**-SCORE_DIGITS
#: up to so many questions come as one row to the postings of a document that is their candidate
QUESTIONS_A_ROW = 1000


def _weighed(space: Space, asked: DataFrame, rows: DataFrame) -> DataFrame:
    """``query_id, k, term, part, most, df``: the words of the questions, what a unit of their weight
    in a document counts, and the most that they can add to a document's sum."""
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("weight").alias("top"))
    part = F.pow(idf(space.count().scalar(), F.col("df")), F.lit(2))
    weights = counts.select("term", "df", part.alias("part"), (part * F.col("top")).alias("most"))
    return kept(asked.join(weights, "term"), "bounded-words")


def _thresholds(words: DataFrame, rows: DataFrame, top: int, send) -> DataFrame:
    """``query_id, threshold``: what the last of ``top`` documents scores, those that the rare words
    of a question find first. Questions whose rare words stand in fewer documents have none."""
    rarest = Window.partitionBy("query_id").orderBy("df", "term")
    before = F.coalesce(F.sum("df").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lead = words.withColumn("before", before).where(F.col("before") < LEAD * top)
    pairs = rows.join(send(lead.select("query_id", "k", "term", "part")), "term")
    scored = pairs.groupBy("query_id", *DOC).agg(
        (F.sum(F.col("weight") * F.col("part")) * F.count(F.lit(1)) / F.max("k")).alias("score")
    )
    first = kept(best(scored, top).select("query_id", *DOC), "bounded-first")
    hits = first.join(send(words.select("query_id", "k", "term", "part")), "query_id")
    whole = rows.join(broadcast_if_small(hits), [*DOC, "term"])
    exact = whole.groupBy("query_id", *DOC).agg(
        (F.sum(F.col("weight") * F.col("part")) * F.count(F.lit(1)) / F.max("k")).alias("score")
    )
    least = exact.groupBy("query_id").agg(F.min("score").alias("threshold"), F.count(F.lit(1)).alias("n"))
    return least.where(F.col("n") == top).select("query_id", "threshold")


def _divided(words: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The words with ``needed``: whether a document may be a hit by this word and those that add
    less; and ``rest`` and ``n_rest``, the most and the number of the words that are not needed."""
    least = Window.partitionBy("query_id").orderBy("most", "term")
    together = F.sum("most").over(least.rowsBetween(Window.unboundedPreceding, 0))
    known = words.join(thresholds, "query_id", "left")
    ranked = known.withColumn("sum", together).withColumn("place", F.row_number().over(least))
    reach = F.col("sum") * F.col("place") / F.col("k")
    needed = F.coalesce(reach >= F.col("threshold") - NEAR, F.lit(True))
    whole = Window.partitionBy("query_id")
    divided = ranked.withColumn("needed", needed)
    common = F.when(~F.col("needed"), F.col("most"))
    return divided.withColumn("rest", F.coalesce(F.sum(common).over(whole), F.lit(0.0))).withColumn(
        "n_rest", F.count(common).over(whole)
    )


def bounded_batch_search(
    space: Space,
    queries: DataFrame,
    field: str = ALL,
    top: int = 10,
    analyzer_name: str = "standard",
    paired: Observation | None = None,
    looked_up: Observation | None = None,
) -> DataFrame:
    """``(query_id, rank, index, type, id, score)``: the best ``top`` hits of each question, as
    ``batch_search`` finds them. ``paired`` counts the postings that were ``paired`` with questions,
    ``looked_up`` those that were ``found`` for candidates. The postings of tables, which are made for the asked words alone, are kept in
    the shared folder meanwhile; those of an index are read where they are.
    """
    asked = query_vocabulary(queries, analyzer_name)
    # what is sent to all tasks has at most one row per row of ``asked``
    small = is_small(asked)
    send = F.broadcast if small else (lambda side: side)
    weight = (F.sqrt("tf") * F.col("norm")).alias("weight")
    if isinstance(space, IndexSpace) and small:
        codes = coded(asked)
        of_documents = kept(packed_rows(space, field, codes), "bounded-postings")
        counts = space.term_stats(F.col("field") == field, ()).groupBy("term").agg(F.sum("df").alias("df"))
        rows = unpacked_rows(of_documents, tasks_for(asked.join(counts, "term")), codes).select(*DOC, "term", weight)
    else:
        rows = _rows(space, field, send(asked.select("term").distinct())).select(*DOC, "term", weight)
    if not isinstance(space, IndexSpace):
        rows = kept(rows, "bounded-postings")
    words = _weighed(space, asked, rows)
    divided = kept(_divided(words, _thresholds(words, rows, top, send)), "bounded-divided")

    needed = divided.where("needed").select("query_id", "k", "term", "part", "threshold", "rest", "n_rest")
    pairs = rows.join(send(needed), "term").withColumn("adds", F.col("weight") * F.col("part"))
    if paired is not None:
        pairs = pairs.observe(paired, F.count(F.lit(1)).alias("paired"))
    found = pairs.groupBy("query_id", *DOC).agg(
        F.sum("adds").alias("sum"),
        F.count(F.lit(1)).alias("matched"),
        *(F.max(c).alias(c) for c in ("k", "threshold", "rest", "n_rest")),
    )
    most = (F.col("sum") + F.col("rest")) * (F.col("matched") + F.col("n_rest")) / F.col("k")
    candidates = found.where(F.coalesce(most >= F.col("threshold") - NEAR, F.lit(True)))
    candidates = kept(candidates.select("query_id", *DOC, "sum", "matched", "k"), "bounded-candidates")

    common = divided.where("not needed").select("query_id", "term", "part")
    found_for = (F.col("weight") * F.col("part")).alias("sum"), F.lit(1).cast("long").alias("matched")
    if small and common.select("query_id").distinct().count() <= QUESTIONS_A_ROW:
        of_document = candidates.groupBy(*DOC).agg(F.collect_set("query_id").alias("of"))
        looked = rows.join(send(common.select("term").distinct()), "term", "left_semi").join(of_document, list(DOC))
        looked = looked.join(send(common), "term").where(F.array_contains("of", F.col("query_id")))
    else:
        looked = candidates.select("query_id", *DOC).join(send(common), "query_id").join(rows, [*DOC, "term"])
    more = looked.select("query_id", *DOC, *found_for)
    if looked_up is not None:
        more = more.observe(looked_up, F.count(F.lit(1)).alias("found"))
    both = candidates.select("query_id", *DOC, "sum", "matched", "k").unionByName(
        more.withColumn("k", F.lit(0)), allowMissingColumns=True
    )
    totals = both.groupBy("query_id", *DOC).agg(
        F.sum("sum").alias("sum"), F.sum("matched").alias("matched"), F.max("k").alias("k")
    )
    score = F.round(F.col("sum") * F.col("matched") / F.col("k"), SCORE_DIGITS)
    return best(totals.select("query_id", *DOC, score.alias("score")), top)
