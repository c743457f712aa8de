"""Near copies of long lines, short lines, and what is left of a text without its repeated lines."""

import random

import corpus_pipeline
import pytest
from odd import no_docs, rows, smallest

from docsearch.llm import line_join
from docsearch.llm.registry import QUERIES


def _runs(line):
    words = line.lower().split()
    return set(zip(*(words[i:] for i in range(5)), strict=False))


@pytest.mark.parametrize("common", [line_join.COMMON, 3])
def test_long_lines_with_a_word_changed_are_near_copies(spark, monkeypatch, common):
    monkeypatch.setattr(line_join, "COMMON", common)
    rng = random.Random(4)
    lines = []
    for _ in range(120):
        own = rng.choice(lines).split() if lines and rng.random() < 0.6 else [f"word{rng.randrange(900)}" for _ in range(60)]
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = f"changed{rng.randrange(900)}"
        lines.append(" ".join(own))
    runs = {i: _runs(line) for i, line in enumerate(lines)}
    want = smallest(runs, lambda x, y: 5 * len(runs[x] & runs[y]) >= 4 * len(runs[x] | runs[y]))
    assert len(set(want.values())) < 110
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in line_join.line_classes(table).collect()}
    assert found == want


def test_words_of_scripts_without_spaces_are_characters(spark):
    line = "".join(chr(0x4E00 + 7 * i) for i in range(80))
    other = line[:40] + "一丁七" + line[43:]
    table = spark.createDataFrame([(1, line), (2, other), (3, line[::-1])], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in line_join.line_classes(table).collect()} == {1: 1, 2: 1, 3: 3}


def test_short_lines_of_its_own_keep_a_document(spark):
    line = "this header stands at the top of more than one document"
    docs = [(0, line), (1, f"{line}\nmilk\neggs\nflour"), (2, f"{line}\n\n  \t")]
    table = spark.createDataFrame([(*d, len(d[1])) for d in docs], "doc_id long, text string, n_chars long")
    rest = corpus_pipeline.line_dedup(spark, table, "")
    assert rows(rest, "doc_id", "text") == [(0, line), (1, "milk\neggs\nflour")]


def test_short_lines_are_classed(spark, tmp_path):
    texts = ["Les.\nReleased under the MIT License.\n\nA", "Les.\nReleased under the MIT License\nB", "Les\n \nA"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op4_line_join"](spark, str(tmp_path))
    want = [(0, 0, 0, 0), (0, 1, 0, 1), (0, 3, 0, 3), (1, 0, 0, 0), (1, 1, 0, 1), (1, 2, 1, 2), (2, 0, 2, 0), (2, 2, 0, 3)]
    assert rows(found, "doc_id", "line_no", "class_id", "class_line_no") == want
    assert line_join.line_classes(no_docs(spark), least=1).count() == 0


def test_lines_meet_under_rare_runs_of_a_common_passage(spark, monkeypatch):
    """Lines that share a passage of half their words are no near copies and share no key."""
    monkeypatch.setattr(line_join, "COMMON", 8)
    passage = [f"passage{i}" for i in range(40)]
    texts = [" ".join(passage + [f"own{d}x{i}" for i in range(40)]) for d in range(30)]
    texts.append(texts[7].replace("own7x39", "other"))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_join._lines(table, "doc_id", "text")
    keys = line_join._run_keys(lines).groupBy("key").count().where("count > 1")
    assert {r["count"] for r in keys.collect()} == {2}
    found = {r["doc_id"]: r["class_id"] for r in line_join.line_classes(table).collect()}
    assert found == {d: d for d in range(30)} | {30: 7}
