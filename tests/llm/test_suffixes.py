"""Removal of long repeated strings against every string looked up by hand."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from odd import no_docs, odd_docs, rows

from docsearch.llm import suffix_levels
from docsearch.llm.queries import op12_suffix_levels
from docsearch.llm.suffix_levels import SuffixLevels, anchors, cut, merged, repeated_bytes


def _wanted(docs, length):
    datas = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[p : p + length] for _, d in datas for p in range(len(d) - length + 1))
    want = []
    for i, d in datas:
        gone = np.zeros(len(d), dtype=bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone])
        want.append((i, len(d), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(want, key=repr)


def _found(frame, id_col="doc_id"):
    return sorted(
        ((r[id_col], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in frame.collect()), key=repr
    )


def _prose(rng, words):
    return " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) + rng.choice(["é", "x", "yz", "漢"]) for _ in range(words))


def _varied(count, length, seed):
    """Texts with passages about ``length`` long at their start, middle or end, cut at any byte."""
    rng = random.Random(seed)
    passages = [_prose(rng, length // 2) for _ in range(6)]
    docs = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(passages) if rng.random() < 0.6 else _prose(rng, rng.randrange(length))
            if rng.random() < 0.5:
                at = rng.randrange(len(own) + 1)
                own = own[at:] if rng.random() < 0.5 else own[:at]
            parts.append(own)
        docs.append((i, rng.choice(["", " "]).join(parts)))
    docs += [(1000, "ab" * length), (1001, "z" * (3 * length)), (1002, "z" * (length - 1)), (1003, "ab" * (length // 2))]
    docs += [(1004, docs[0][1]), (1004, docs[0][1]), (None, docs[1][1]), (1005, None), (1006, ""), (1007, "z")]
    return docs


@pytest.mark.parametrize("length", [7, 25, 48, 100])
def test_equals_brute_force(spark, length):
    docs = _varied(150, length, length)
    want = _wanted(docs, length)
    assert 20 < sum(0 < w[2] < w[1] for w in want)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert _found(repeated_bytes(table, length=length)) == want


def test_texts_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(suffix_levels, "STARTS", 64)
    data = _prose(random.Random(4), 400).encode()
    found = list(anchors(data, 48))
    low, high = (np.concatenate([f[k] for f in found]) for k in (2, 3))
    assert len(found) > 10 and low[0] == 0 and high[-1] == len(data) - 48
    assert (low[1:] == high[:-1] + 1).all()
    whole = dict(zip(low.tolist(), np.concatenate([f[1] for f in found]).tolist(), strict=True))
    monkeypatch.setattr(suffix_levels, "STARTS", 1 << 20)
    for at, lo, hi in zip(*(np.concatenate(x).tolist() for x in list(zip(*anchors(data, 48), strict=True))[1:]), strict=True):
        assert all(whole[x] == at for x in whole if lo <= x <= hi)


def test_query_with_production_length(spark, tmp_path):
    docs = _varied(60, 400, 2)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_suffix_levels(spark, str(tmp_path))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert found.columns == names
    assert rows(found, *names) == _wanted(docs, 400)


def test_real_documents(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = _wanted(docs, 400)
    assert any(0 < w[2] < w[1] for w in want)
    assert rows(op12_suffix_levels(spark, folder), "*") == want


def test_levels_merge_like_a_counter(spark):
    family = SuffixLevels()
    heads = [[1, 2], [2, 3], [4, 1], [5], [5, 6]]
    ranks = []
    for number, own in enumerate(heads):
        family.add(spark.createDataFrame([(h, 10 * number + h) for h in own], "head long, entry long"))
        ranks.append(sorted(family.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2]]
    assert {r[0] for r in family.repeated_heads().collect()} == {1, 2, 5}
    assert family.levels[2].count() == 5


def test_odd_rows(spark):
    docs = odd_docs(spark)
    want = _wanted([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], 400)
    assert _found(repeated_bytes(docs)) == want
    assert repeated_bytes(no_docs(spark)).collect() == []


def test_spans():
    assert merged([(5, 5), (0, 1), (3, 3), (20, 20)], 3) == [(0, 8), (20, 23)]
    assert cut(b"0123456789", [(0, 2), (4, 5)]) == b"2356789"
