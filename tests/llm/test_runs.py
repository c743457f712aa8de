"""Periodic runs against every stretch tried by hand."""

import hashlib
import random
import zlib

import numpy as np
from odd import CLASHES, LONG, ODD_ROWS, no_docs, odd_docs, rows

from docsearch.llm.periodic_runs import periodic_runs, runs_of, words_of
from docsearch.llm.queries import planted_run
from docsearch.llm.registry import QUERIES


def _runs(words):
    """Every maximal stretch of every period, kept where no smaller period holds."""
    found = set()
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start < len(words):
            end = min(start + q, len(words))
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(6, 4 * q):
                smaller = any(
                    all(words[i] == words[i - p] for i in range(start + p, end)) for p in range(1, q)
                )
                if not smaller:
                    found.add((start, end - start, q))
            start = max(start + 1, end - q + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def _sequences():
    rng = random.Random(5)
    for size in range(0, 40):
        yield [0] * size
    for _ in range(600):
        words = []
        while len(words) < rng.randrange(1, 160):
            stretch = [rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 16, 17]))]
            words += (stretch * rng.randrange(1, 7))[: rng.randrange(1, 90)]
        yield words


def test_runs_equal_brute_force():
    seen = 0
    for words in _sequences():
        want = _runs(words)
        seen += len(want)
        assert runs_of(np.array(words, dtype=np.int64)) == want
    assert seen > 500


def test_long_periods_and_words_that_occur_once():
    block = list(range(1000))
    words = [-1, *block * 4, *block[:7], -2, *block[:500]]
    assert runs_of(np.array(words, dtype=np.int64)) == [(1, 4007, 1000)]
    assert runs_of(np.arange(5000)) == []


def test_query_equals_brute_force(spark, tmp_path):
    docs = [(i, " ".join("abcdefghi"[w] for w in words)) for i, words in enumerate(_sequences())]
    docs += [(None, "x " * 9), (1300, None), (1301, ""), (1301, ""), (1302, "\t a\x0b\x0c b\r\n a  b é é é é é é")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for i, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = _runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        want.append(
            (
                i,
                len(runs),
                *best,
                1000 * best[1] // best[2] if runs else None,
                sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                sha(b" ".join(_collapsed(words, runs)).decode()),
            )
        )
    found = QUERIES["op13_basic_factor_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names
    assert rows(found, *names) == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 100


def test_planted_words_repeat():
    words = [str(i).encode() for i in range(100)]
    changed = [i for i in range(200) if planted_run(i, words) != words]
    assert 5 < len(changed) < 40 and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)


def test_odd_rows(spark):
    assert periodic_runs(no_docs(spark)).count() == 0
    found = {(r[0], r[1], len(r[2])) for r in periodic_runs(odd_docs(spark)).collect()}
    texts = [(r[0], len(words_of(r[1]))) for r in ODD_ROWS]
    assert found == {(i, n, int(n == len(LONG.split()))) for i, n in texts}
    assert periodic_runs(odd_docs(spark)).count() == len(ODD_ROWS)
    assert set(CLASHES) <= set(odd_docs(spark).columns)
