"""Hilbert shards, link graph, the registered queries and the pipeline."""

import itertools
import os
import random

import duckdb
import numpy as np
import pytest
from odd import ODD_ROWS, no_docs, odd_docs, rows
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from docsearch.llm.hilbert import curve_index, hilbert_shards, write_shards
from docsearch.llm.link_graph import DAMPING, Rule, host_links, page_verdicts, spread_ranks
from docsearch.llm.queries import URL_RULES
from docsearch.llm.registry import QUERIES, SQL
from docsearch.llm.line_join import line_classes
from docsearch.llm.tables import SHUFFLE_CLEANUP, step, written
from docsearch.sources.shared import fresh_path, shared_folder


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    places = curve_index(list(cells.T), bits)
    assert sorted(places) == list(range(len(cells)))
    path = cells[np.argsort(places)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_and_gapless(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    placed = hilbert_shards(docs, ("lang", "source", "n_chars", "doc_id"), "doc_id").collect()
    by_shard = {}
    for r in placed:
        by_shard.setdefault(r["shard"], []).append((r["slot"], r["curve"], r["doc_id"]))
    assert sorted(by_shard) == list(range(16))
    sizes = {len(v) for v in by_shard.values()}
    assert max(sizes) - min(sizes) <= 1
    order = [x for s in range(16) for x in sorted(by_shard[s])]
    assert all([x[0] for x in sorted(v)] == list(range(len(v))) for v in by_shard.values())
    assert [x[1:] for x in order] == sorted(x[1:] for x in order)
    # a shard covers a small part of what the columns span together
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert sum(len({langs[d] for _, _, d in v}) for v in by_shard.values()) < 16 * len(set(langs.values()))


def test_shards_of_odd_rows(spark):
    docs = odd_docs(spark)
    placed = hilbert_shards(docs, ("lang", "source", "n_chars"), "doc_id", {"size": F.length("text")}, shards=4)
    assert placed.columns == ["doc_id", "size", "curve", "shard", "slot"]
    found = rows(placed, "shard", "slot")
    assert len(found) == len(set(found)) == len(ODD_ROWS)
    assert hilbert_shards(no_docs(spark), ("lang", "source"), "doc_id").count() == 0
    with pytest.raises(ValueError):
        hilbert_shards(docs, ("lang",) * 13, "doc_id")


def test_written_shards_hold_all_rows(spark):
    docs = odd_docs(spark).dropDuplicates(["doc_id"]).withColumn("shard", F.lit("own")).withColumn("run", F.lit(1))
    path = fresh_path(spark, "shards")
    write_shards(docs, hilbert_shards(docs, ("lang", "n_chars"), "doc_id", shards=3), "doc_id", path, rows=2)
    back = spark.read.parquet(path)
    assert rows(back, "doc_id", "text") == rows(docs, "doc_id", "text")
    assert {r["shard"] for r in back.collect()} == {0, 1, 2}


PAGES = [
    (1, "http://Good.Org/a/b?x=1", '<a href="http://Friend.net/x"> <a HREF=//other.net>'),
    (2, "https://friend.net/", "<a href='http://far.net/?q'>x</a><a href=/own>"),
    (3, "http://spam.com/de/1", "nothing"),
    (4, "http://shill.net/p#t", '<a href="http://spam.com/de/1"><a href="http://spam.com/2">'),
    (5, "http://far.net", None),
    (6, None, "<a href=http://far.net>"),
    (7, "no address", ""),
    (8, "http://sub.example.org/en/15", ""),
    (9, "http://sub.example.org/en/2", ""),
    (9, "http://sub.example.org/en/2", ""),
    (10, "http://org", ""),
    (None, "http://notorg/x", ""),
]


def _pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, host string, rule string")


def test_verdicts_by_rule_and_by_links(spark):
    found = rows(page_verdicts(_pages(spark), URL_RULES), "*")
    assert found == sorted(
        [
            (1, "good.org", "/a/b", "org/", "allow"),
            (2, "friend.net", "/", None, "allow"),
            (3, "spam.com", "/de/1", "com/de/", "block"),
            (4, "shill.net", "/p", None, "block"),
            (5, "far.net", "", None, "allow"),
            (6, "", "", None, "allow"),
            (7, "", "", None, "allow"),
            (8, "sub.example.org", "/en/15", "example.org/en/1", "block"),
            (9, "sub.example.org", "/en/2", "org/", "allow"),
            (9, "sub.example.org", "/en/2", "org/", "allow"),
            (10, "org", "", None, "allow"),
            (None, "notorg", "/x", None, "allow"),
        ],
        key=repr,
    )
    assert page_verdicts(_pages(spark).where("1 = 0"), URL_RULES).count() == 0
    # two pages by the rule, and the one whose host links to theirs
    judged = page_verdicts(_pages(spark), [Rule("block", "net", "/")]).where("verdict = 'block'")
    assert rows(judged, "page_id", "rule") == [(1, None), (2, "net/"), (4, "net/")]


def test_links_name_hosts(spark):
    pages = spark.createDataFrame([(p[1].split("/")[2].lower(), p[2]) for p in PAGES[:5]], "host string, html string")
    found = rows(host_links(pages), "*")
    assert found == [("friend.net", "far.net", 1), ("good.org", "friend.net", 1), ("good.org", "other.net", 1), ("shill.net", "spam.com", 2)]


def test_ranks_equal_plain_iteration(spark):
    rng = random.Random(2)
    hosts = [f"h{i}" for i in range(12)]
    links = {(rng.choice(hosts), rng.choice(hosts)): rng.randrange(1, 5) for _ in range(30)}
    links = {k: v for k, v in links.items() if k[0] != k[1]}
    trusted, blocked = {"h0": 3, "h1": 1}, {"h5": 2}
    seeds = [(h, trusted.get(h, 0), blocked.get(h, 0)) for h in hosts]
    found = spread_ranks(
        spark.createDataFrame(seeds, "host string, trusted long, blocked long"),
        spark.createDataFrame([(*k, v) for k, v in links.items()], "source string, target string, links long"),
    ).collect()

    def spread(start, edges):
        total, out = sum(start.values()), {}
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        rank = {h: (1 - DAMPING) * start.get(h, 0) / total for h in hosts}
        for _ in range(300):
            rank = {
                h: (1 - DAMPING) * start.get(h, 0) / total
                + DAMPING * sum(rank[a] * n / out[a] for (a, b), n in edges.items() if b == h)
                for h in hosts
            }
        return rank

    trust = spread(trusted, links)
    distrust = spread(blocked, {(b, a): n for (a, b), n in links.items()})
    for r in found:
        assert r["trust"] == pytest.approx(trust[r["host"]], abs=1e-9)
        assert r["distrust"] == pytest.approx(distrust[r["host"]], abs=1e-9)


def _linked_pages(spark, tmp_path):
    """A trusted host before a chain of 25, whose last links to a blocked host as 120 others do; and a ring."""
    def page(url, *links):
        return url, " ".join(f'<a href="http://{x}/">x</a>' for x in links)

    chain = ["good.org", *(f"c{i}.net" for i in range(25))]
    pages = [page(f"http://{a}/1", b) for a, b in zip(chain, chain[1:])]
    pages += [page(f"http://{host}/1", "bad.com") for host in (chain[-1], *(f"x{i}.net" for i in range(120)))]
    pages += [page("http://bad.com/de/1"), page("http://spam.net/1", "bad.com", "ring.net"), page("http://ring.net/1", "spam.net")]
    pages += [page("http://x3.net/1", "ring.net"), (None, None), ("nowhere", "")]
    rows = [(i, *p) for i, p in enumerate(pages)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")


def test_links_reach_as_far_as_they_go(spark, tmp_path):
    _linked_pages(spark, tmp_path)
    QUERIES["op6_link_graph"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/verdicts")
    verdicts = spark.read.parquet(f"{tmp_path}/verdicts")
    found = {r.host: r.verdict for r in verdicts.collect()}
    # 20 steps would not bring any trust to the last of the chain
    assert found["c24.net"] == "allow" and found["x0.net"] == "block" and found["ring.net"] == "block"
    base = duckdb.connect()
    base.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert compare(verdicts, base, SQL["op6_link_graph"]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_pipeline_stages_keep_columns_and_take_odd_rows(spark, folder):
    for docs in (odd_docs(spark), no_docs(spark)):
        names, before = docs.columns, docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == names
            assert docs.count() <= before
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns[0] == "doc_id"


def test_pipeline_drops_what_its_stages_reject(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = [(10_001, "12 34 !!", "en", "s", 8), (10_002, None, "en", "s", None)]
    first = docs.where("doc_id = 1").first()
    more.append((10_003, first["text"], "en", "s", first["n_chars"]))
    both = docs.union(spark.createDataFrame(more, docs.schema))
    known = corpus_pipeline.language_id(spark, both, folder)
    ids = {r["doc_id"] for r in known.select("doc_id").collect()}
    assert ids.isdisjoint({10_001, 10_002}) and 10_003 in ids and len(ids) >= docs.count() - 1
    alone = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, known, folder).select("doc_id").collect()}
    assert 1 in alone and 10_003 not in alone
    rest = corpus_pipeline.line_dedup(spark, known, folder).collect()
    assert 10_003 not in {r["doc_id"] for r in rest}
    assert all(r["n_chars"] == len(r["text"]) for r in rest)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in pieces} <= {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f for f in files.split(",") if f.endswith(".data")}

    before, setting = shuffles(), spark.conf.get(SHUFFLE_CLEANUP)
    found = written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "shuffled")
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert rows(found, "*") == [(k, 100) for k in range(10)]


def _left(spark, before=()):
    return sorted(name.rpartition("-")[0] for name in set(os.listdir(shared_folder(spark))).difference(before))


def test_a_step_leaves_only_its_result(spark):
    def inner():
        return written(spark.range(9), "passing").where("id > 4")

    def outer():
        return step(inner, "within").where("id > 6")

    before = os.listdir(shared_folder(spark))
    found = step(outer, "found")
    assert _left(spark, before) == ["found"]
    assert rows(found, "id") == [(7,), (8,)]


def test_line_classes_leave_no_tables_of_their_steps(spark):
    line = "one line of so many words that it takes part in all of the joins"
    docs = spark.createDataFrame([(1, line), (2, line + "s"), (3, "short one of all")], "doc_id long, text string")
    before = os.listdir(shared_folder(spark))
    found = line_classes(docs, least=1)
    assert _left(spark, before) == ["line-components", "lines"]
    assert rows(found, "doc_id", "class_id") == [(1, 1), (2, 1), (3, 3)]
