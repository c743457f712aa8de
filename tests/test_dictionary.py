"""Words and patterns looked up in a dictionary find what a test of every term finds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docsearch import DocumentMapping, Fuzzy, Registry, Wildcard
from docsearch.operators.dictionary import TermDictionary, holding
from docsearch.operators.documents import build_documents
from docsearch.operators.maintain import bulk_index
from docsearch.operators.search import search
from docsearch.operators.segments import SegmentedIndex
from docsearch.operators.space import IndexSpace
from docsearch.sources.shared import fresh_path

ITEM = DocumentMapping("test.Item", "id", fields={"text": {"analyzer": "whitespace"}})
REGISTRY = Registry([ITEM])


def words():
    rng = random.Random(5)
    made = {"".join(rng.choices("abé", k=rng.randint(1, 12))) for _ in range(250)}
    made |= {"x" * 3000, "x" * 2999 + "y", "50%", "a_b", "a\\b", "a.b", "axb", "日本", "日本語", "a", "abcdefghijk"}
    # changes on either side of the characters that deletions are made in
    made |= {"abcdefgXhijk", "abcdefghijkXY", "bcdefghijk", "cdefghijk", "XYabcdefghijk", "badcefghijk"}
    return sorted(made)


@pytest.fixture(scope="module")
def built(spark):
    rows = [(i, " ".join(words()[i::40])) for i in range(40)] + [(90, None), (91, ""), (92, "a a axb")]
    table = spark.createDataFrame(rows, "id long, text string")
    path = fresh_path(spark, "t")
    bulk_index(REGISTRY, {"test.Item": table}, path, buckets=4)
    space = IndexSpace.over(spark, path, REGISTRY)
    return space, TermDictionary.write(space, fresh_path(spark, "t"), buckets=4)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def column(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("most", [0, 1, 2])
def test_similar_terms_equal_brute_force(spark, built, most):
    asked = [*words()[::3], "", "zz", "abcdefghijk", "日語", "x" * 3000]
    found = built[1].similar(column(spark, "word", [*asked, "zz", None]), "text", most).collect()
    want = {
        (w, t, d)
        for w in set(asked)
        for t in words()
        if abs(len(w) - len(t)) <= most and (len(w) < 100 or w[:5] == t[:5])
        for d in [distance(w, t) if len(w) < 100 else sum(a != b for a, b in zip(w, t, strict=False))]
        if d <= most
    }
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_more_edits_than_there_are_keys_for(spark, built):
    with pytest.raises(ValueError, match="up to 2 edits"):
        built[1].similar(column(spark, "word", ["a"]), "text", 3)


PATTERNS = ["*", "?", "??", "a*", "*a", "*ab*", "a?b", "*é?a*", "ab*ba", "*%", "*_*", "a\\b", "a.b", "?本*", "zz*", "", "*xy", "a*b*a*b"]


def test_fitting_terms_equal_brute_force(spark, built):
    found = built[1].fitting(column(spark, "pattern", [*PATTERNS, "*a", None]), "text").collect()
    wild = {"*": "(?s:.*)", "?": "(?s:.)"}
    tests = {p: re.compile("".join(wild.get(c) or re.escape(c) for c in p)) for p in PATTERNS}
    want = {(p, t) for p in PATTERNS for t in words() if tests[p].fullmatch(t)}
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_documents_equal_those_of_the_clauses(spark, built):
    space, dictionary = built
    near = holding(space, "text", dictionary.similar(column(spark, "word", ["abé", "axb"]), "text"), "word")
    fit = holding(space, "text", dictionary.fitting(column(spark, "pattern", ["*bé?", "a*"]), "text"), "pattern")
    for found, by, value, clause in (
        (near, "word", "abé", Fuzzy("text", "abé", 2)),
        (near, "word", "axb", Fuzzy("text", "axb", 2)),
        (fit, "pattern", "*bé?", Wildcard("text", "*bé?")),
        (fit, "pattern", "a*", Wildcard("text", "a*")),
    ):
        got = sorted((r.id, r.n_terms) for r in found.where(F.col(by) == value).collect())
        assert got == sorted((r.id, r.n_terms) for r in search(space, clause).matched_terms().collect())


def test_lookup_joins_by_key_and_prunes_buckets(spark, built):
    plan = built[1].similar(column(spark, "word", ["abab"]), "text")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "dynamicpruning" in plan.lower()


def test_terms_that_no_document_holds_any_more(spark):
    table = spark.createDataFrame([(1, "old word"), (2, "new word")], "id long, text string")
    index = SegmentedIndex.create(REGISTRY, {"test.Item": table}, fresh_path(spark, "t"), [ITEM], buckets=2)
    changed = {"test.Item": spark.createDataFrame([(1, "other word")], "id long, text string")}
    index.put(changed, ITEM, build_documents(REGISTRY, changed, ITEM))
    space = index.space()
    dictionary = TermDictionary.write(space, fresh_path(spark, "t"), buckets=2)
    found = dictionary.fitting(column(spark, "pattern", ["*"]), "text")
    assert sorted(r.term for r in found.collect()) == ["new", "other", "word"]
    held = holding(space, "text", found, "pattern").collect()
    assert sorted((r.id, r.n_terms) for r in held) == [("1", 2), ("2", 2)]


def test_an_empty_index_and_no_questions(spark, built):
    table = spark.createDataFrame([], "id long, text string")
    path = fresh_path(spark, "t")
    bulk_index(REGISTRY, {"test.Item": table}, path, buckets=2)
    space = IndexSpace.over(spark, path, REGISTRY)
    dictionary = TermDictionary.write(space, fresh_path(spark, "t"), buckets=2)
    assert dictionary.similar(column(spark, "word", ["a"]), "text").count() == 0
    assert dictionary.fitting(column(spark, "pattern", ["*"]), "text").count() == 0
    assert built[1].fitting(column(spark, "pattern", []), "text").count() == 0


def test_a_term_has_few_keys(spark, built):
    """A key for each piece, and one for each character and two."""
    terms = {r.term for r in spark.read.parquet(f"{built[1].path}/terms").where("field = 'text'").collect()}
    held = {name: built[1]._read(name).where("field = 'text'").groupBy("term").count().collect() for name in ("pieces", "grams")}
    assert {r.term for r in held["pieces"]} == {r.term for r in held["grams"]} == terms
    assert all(r["count"] == 3 for r in held["pieces"])
    assert all(r["count"] <= len(r.term) + 2 for r in held["grams"])


def test_found_terms_are_not_looked_up_again_for_their_documents(spark, built):
    space, dictionary = built
    found = holding(space, "text", dictionary.similar(column(spark, "word", ["abé"]), "text"), "word")
    assert "levenshtein" not in found._jdf.queryExecution().toString().lower()


def test_a_document_given_twice_holds_a_term_once_and_is_shuffled_once(spark):
    table = spark.createDataFrame([(1, "word ward"), (1, "word ward"), (2, "word")], "id long, text string")
    path = fresh_path(spark, "t")
    bulk_index(REGISTRY, {"test.Item": table}, path, buckets=2)
    space = IndexSpace.over(spark, path, REGISTRY)
    near = spark.createDataFrame([("word", "word"), ("word", "ward")], "word string, term string")
    found = holding(space, "text", near, "word")
    # before the plan has run it is printed once
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert len([line for line in plan if "Exchange hashpartitioning" in line and "id#" in line]) == 1
    assert sorted((r.id, r.n_terms) for r in found.collect()) == [("1", 2), ("2", 1)]
