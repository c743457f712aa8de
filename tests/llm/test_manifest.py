"""The Merkle manifest against SQL and against a tree made by hand."""

import hashlib
import random
import zlib

from odd import no_docs, odd_docs, rows
from oracle import compare, connect
from pyspark.sql import functions as F

from docsearch.llm import merkle_manifest as merkle
import docsearch.llm.queries  # noqa: F401
from docsearch.llm.registry import QUERIES, SQL

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(digests):
    """The root, and of every leaf the steps of its proof."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, place in enumerate(at):
            first = place - place % 8
            proofs[leaf].append((digests[first:place], digests[place + 1 : first + 8]))
        digests = [_h(digests[i : i + 8]) for i in range(0, len(digests), 8)]
        at = [place // 8 for place in at]
    return digests[0], proofs


def _leaf(row):
    return _h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def _wanted(docs):
    """``docs`` are rows of FIELDS."""
    by_lang = {}
    for row in docs:
        by_lang.setdefault(row[2], []).append(row)
    trees = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    found = []
    for lang in trees:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        found.append((own, *_tree([_leaf(r) for r in own])))
    if not found:
        return []
    root, above = _tree([subroot for _, subroot, _ in found])
    want = []
    for (own, subroot, proofs), top in zip(found, above, strict=True):
        for row, proof in zip(own, proofs, strict=True):
            steps = proof + top
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                shown = (*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4]))
            folded = _leaf(shown)
            for left, right in steps:
                folded = _h([*left, folded, *right])
            proved = _h(x for left, right in steps for x in (*left, *right))
            want.append((row[0], _leaf(row), subroot, root, proved, folded, folded == root))
    return sorted(want, key=repr)


def _run(spark, docs, tmp_path):
    docs = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return QUERIES["op11_merkle_manifest"](spark, str(tmp_path))


def test_sweeps_in_one_task():
    for n in (1, 2, 7, 8, 9, 64, 65, 600):
        digests = [_h([str(i)]) for i in range(n)]
        levels = merkle.forward(digests, None)
        root, proofs = _tree(digests)
        assert levels[-1] == [root]
        joined = [[("".join(a), "".join(b)) for a, b in p] for p in proofs]
        assert merkle.reversed_sweep(levels, []) == joined
    assert [len(x) for x in merkle.forward(["a"], 3)] == [1, 1, 1, 1]


def test_query_matches_sql(spark, folder):
    assert compare(QUERIES["op11_merkle_manifest"](spark, folder), connect(folder), SQL["op11_merkle_manifest"]) is None


def test_rounds_equal_brute_force(spark, tmp_path):
    # 600 rows of one language need two rounds of blocks of 512
    docs = [(i, None, "en" if i < 1200 else random.Random(i).choice(["fr", None, "é", "z"]), i, f"Text {i}") for i in range(1300)]
    found = _run(spark, docs, tmp_path)
    assert found.columns == NAMES
    assert rows(found, *NAMES) == _wanted(docs)


def test_many_languages(spark, tmp_path):
    docs = [(i, "s", f"l{i % 700}", i, f"Text {i}") for i in range(1000)]
    assert rows(_run(spark, docs, tmp_path), *NAMES) == _wanted(docs)


def test_odd_rows(spark, tmp_path):
    docs = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (5, "s", "en", 1, "Copy"),
        (5, "s", "en", 1, "Copy"),
        (5, "s", "en", 2, "Other"),
        (6, "", "", 0, ""),
        (7, "s", "en", 3, "LONG " * 30000),
    ]
    assert rows(_run(spark, docs, tmp_path), *NAMES) == _wanted(docs)
    one = [(1, None, None, None, "A")]
    assert rows(_run(spark, one, tmp_path / "one"), *NAMES) == _wanted(one)


def test_empty_and_clashing_columns(spark):
    assert merkle.merkle_manifest(no_docs(spark)).collect() == []
    docs = odd_docs(spark).withColumn("tree", F.lit("x")).withColumn("index", F.lit(1)).withColumn("digest", F.lit("x"))
    found = merkle.merkle_manifest(docs)
    want = _wanted([tuple(r) for r in docs.select(*FIELDS).collect()])
    assert found.select("leaf", "proof_sha256").count() == len(want)
    assert rows(found, "doc_id", "leaf", "subroot", "root", "proof_sha256") == [w[:5] for w in sorted(want, key=lambda w: repr(w[:5]))]
    assert found.where("not verified").count() == 0


def test_a_changed_field_is_noticed(spark):
    docs = odd_docs(spark)
    found = merkle.merkle_manifest(docs, presented={"source": F.lit("other")})
    assert found.where("verified").count() == 0
