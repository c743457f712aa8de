"""The pipeline over the documents: language ID, line dedup, near-duplicates, packing.

Each stage works on all that the one before kept, which is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.llm.line_join import without_repeated_lines
from docsearch.llm.pivot_simhash import one_of_each
from docsearch.llm.queries import WORD_BPE, table
from docsearch.llm.rank_profiles import UNKNOWN, collected, identify, learn
from docsearch.llm.registry import query
from docsearch.llm.retrieval_packing import pack
from docsearch.llm.tables import written

#: a text whose n-grams are further out of place than this in every profile is in no known language
LEAST_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which becomes their ``lang``; texts without letters go."""
    found = identify(docs, collected(learn(docs)))
    known = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are near copies of an earlier one; one with only blank lines left goes."""
    rest = without_repeated_lines(docs, least=1)
    length = F.char_length("text").cast("long")
    return rest.select(*(length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by id, of each group of texts whose SimHash fingerprints of three-word
    shingles link at two differing bits or fewer."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens of related documents, as pieces with their ids."""
    return pack(docs, WORD_BPE)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: no SQL: profiles, edit distances, fingerprints and tokens are tested against brute force
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
