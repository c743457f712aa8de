"""Links of alike sets against brute force, and the pipeline's near copies."""

import random

import corpus_pipeline
import pytest
from odd import no_docs, odd_docs, rows, smallest
from test_texts import _simhash_wanted, _varied

from docsearch.llm import near_copies
from docsearch.llm.components import components


def _sets(count, seed):
    """Sets of 10 to 60 numbers, of which many differ from another in a few."""
    rng = random.Random(seed)
    found = []
    for _ in range(count):
        if found and rng.random() < 0.6:
            own = list(rng.choice(found))
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.randrange(800)
        else:
            own = [rng.randrange(800) for _ in range(rng.randrange(10, 60))]
        found.append(sorted(set(own)))
    return sorted(set(map(tuple, found)))


@pytest.mark.parametrize("block", [near_copies.BLOCK, 3])
def test_links_of_alike_sets_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    given = dict(enumerate(_sets(150, 3)))

    def alike(x, y):
        one, two = set(given[x]), set(given[y])
        return 5 * len(one & two) >= 4 * len(one | two)

    want = smallest(given, alike)
    assert len(set(want.values())) < 140
    table = spark.createDataFrame([(k, list(v)) for k, v in given.items()], "name long, shingles array<long>")
    # every number is a key, so all sets that share one meet
    distinct = table.selectExpr("name", "CAST(size(shingles) AS LONG) AS n", "0L AS sketch", "shingles AS bands")
    links = near_copies.cell_links(
        distinct, lambda a, b: f"{a}_n > 0 AND {b}_n > 0", lambda pairs: near_copies.alike_pairs(pairs, table)
    )
    found = {k: k for k in given} | dict(rows(components(links, "a", "b"), "node", "component"))
    assert found == want


def test_pipeline_keeps_the_first_of_each_group_of_fingerprints(spark):
    docs = list(enumerate(_varied(200, 6)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = {top for _, _, top in _simhash_wanted(docs)}
    assert 20 < len(want) < 195
    assert {r[0] for r in rows(corpus_pipeline.near_dedup(spark, table, ""), "doc_id")} == want


def test_pipeline_near_copies_of_odd_rows(spark):
    assert corpus_pipeline.near_dedup(spark, no_docs(spark), "").count() == 0
    rest = corpus_pipeline.near_dedup(spark, odd_docs(spark), "")
    assert rest.columns == odd_docs(spark).columns
    assert {r[0] for r in rows(rest, "doc_id")} == {1, 2, 4, 8, 9, None}
