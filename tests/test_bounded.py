"""Batch search with bounds finds what the plain one finds, with fewer pairs."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalog.entities import mapping, tables
from docsearch import DocumentMapping, Registry
from docsearch.operators.batch import _rows, batch_search, query_vocabulary
from docsearch.operators.bounded import bounded_batch_search
from docsearch.operators.maintain import bulk_index
from docsearch.operators.space import IndexSpace, TableSpace
from docsearch.sources.shared import fresh_path

ITEM = DocumentMapping("test.Item", "id")


def hits(frame):
    return sorted((r.query_id, r["rank"], r.type, r.id, r.score) for r in frame.collect())


@pytest.fixture(scope="module")
def uneven(spark):
    """Texts of words whose frequencies differ a lot, with many equal texts."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 3, 8, 20])))) for i in range(400)]
    rows += [(1000 + i, "w0 w1 w2") for i in range(30)] + [(2000, ""), (2001, None)]
    table = spark.createDataFrame(rows, "id long, text string")
    asked = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 2, 4, 7])))) for i in range(40)]
    asked += [(100, "w0"), (101, "w0 w1 w2"), (102, "nowhere"), (103, ""), (104, "w59 w0 w1 w2 w3"), (105, "nowhere w3")]
    return table, spark.createDataFrame(asked, "query_id int, text string")


@pytest.mark.parametrize("top", [1, 3, 10, 500])
def test_same_hits(spark, uneven, top):
    table, asked = uneven
    space = TableSpace.over(Registry([ITEM]), {"test.Item": table})
    want = hits(batch_search(space, asked, "text", top))
    assert hits(bounded_batch_search(space, asked, "text", top)) == want


def test_fewer_pairs_over_an_index(spark, folder):
    registry = Registry([mapping("corpus.Document", only=["text"])])
    path = fresh_path(spark, "t")
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path, buckets=4)
    space = IndexSpace.over(spark, path, registry)
    texts = spark.read.parquet(f"{folder}/benchmark.parquet")
    questions = texts.select(F.col("item_id").alias("query_id"), F.substring_index("text", " ", 8).alias("text"))
    paired, looked_up = Observation("a"), Observation("b")
    found = bounded_batch_search(space, questions, "text", 3, paired=paired, looked_up=looked_up)
    assert hits(found) == hits(batch_search(space, questions, "text", 3))
    asked = query_vocabulary(questions)
    plain = _rows(space, "text", asked.select("term").distinct()).join(asked, "term").count()
    assert paired.get["paired"] < 0.5 * plain
    assert paired.get["paired"] + looked_up.get["found"] < 0.9 * plain
