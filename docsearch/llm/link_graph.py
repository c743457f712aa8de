"""Verdicts on pages by rules, and by trust and distrust that spread along links of hosts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch.llm.tables import written

DAMPING = 0.85
#: steps of a round, after which the ranks are written
STEPS = 5
#: a round that moves less than this in all ends the spreading
SETTLED = 1e-9
#: a step moves DAMPING of what the one before moved at most, and the first one no more than 2
MOST_STEPS = STEPS * math.ceil((1 + math.log(SETTLED / (4 * STEPS), DAMPING)) / STEPS)
#: a host is blocked if its distrust is over so many times its trust
RATIO = 1.0

# Patterns of an address and of a link in a page.
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict, ``allow`` or ``block``, for a host with its subdomains and the start of a path."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _ruled(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Pages with ``rule`` and ``ruled``, the longest rule that fits and its verdict, or nulls.

    Rules meet the distinct hosts, by the host's own name and those it is below; a page then
    chooses among the rules of its host.
    """
    spark = pages.sparkSession
    listed = spark.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "of string, start string, said string"
    )
    parts = F.split("name", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    fitting = (
        pages.select(F.col("host").alias("name"))
        .distinct()
        .select("name", F.explode(above).alias("above"))
        .join(listed, F.col("above") == F.col("of"))
        .groupBy("name")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.struct(
                        F.char_length(F.concat("of", "start")).alias("size"),
                        F.char_length("of").alias("host_size"),
                        "of",
                        "start",
                        "said",
                    )
                ),
                asc=False,
            ).alias("rules")
        )
    )
    return (
        pages.join(fitting, F.col("host") == F.col("name"), "left")
        .withColumn("chosen", F.expr("get(filter(rules, r -> startswith(path, r.start)), 0)"))
        .withColumn("rule", F.concat("chosen.of", "chosen.start"))
        .withColumn("ruled", F.col("chosen.said"))
        .drop("name", "rules", "chosen")
    )


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``source, target, links``: links between different hosts, counted.

    An absolute link names a host after ``://``, one that starts with ``//`` right there; any other
    stays on its host.
    """
    found = F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1)
    away = F.filter(found, lambda x: F.contains(x, F.lit("//")))
    address = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), F.col("link"))).otherwise(
        F.col("link")
    )
    return (
        pages.select(F.col("host").alias("source"), F.explode(away).alias("link"))
        .select("source", host_of(address).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("links"))
    )


def spread_ranks(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """``host, trust, distrust`` of every host of ``seeds``, which has ``trusted, blocked`` weights.

    Trust is a personalised PageRank from the trusted weights along links; distrust is one from
    the blocked weights along links reversed, so that who links to blocked hosts is distrusted.
    What reaches a host without links on is not handed back. Hosts that only links name count too.
    Spreading ends when a round moves less than SETTLED in all, however long the chains of links are.
    """
    totals = seeds.agg(F.sum("trusted").alias("trusted"), F.sum("blocked").alias("blocked")).first()
    named = seeds.select("host").union(links.select("source")).union(links.select("target")).distinct()

    def share(column: str) -> Column:
        whole = totals[column] or 0
        part = F.coalesce(F.col(column), F.lit(0)).cast("double")
        return part / float(whole) if whole else F.lit(0.0)

    start = written(
        named.join(seeds.select(F.col("host").alias("seed"), "trusted", "blocked"), F.col("host") == F.col("seed"), "left")
        .select("host", share("trusted").alias("t"), share("blocked").alias("d")),
        "hosts",
    )
    sent = links.groupBy(F.col("source").alias("from")).agg(F.sum("links").alias("sent"))
    received = links.groupBy(F.col("target").alias("to")).agg(F.sum("links").alias("received"))
    edges = written(
        links.join(sent, F.col("source") == F.col("from"))
        .join(received, F.col("target") == F.col("to"))
        .select(
            "source",
            "target",
            (F.col("links") / F.col("sent")).alias("ahead"),
            (F.col("links") / F.col("received")).alias("back"),
        ),
        "host-links",
    )
    # (1 - damping) is applied once, at the start, to keep the sums plain
    ranks = start.select(
        "host", "t", "d", (F.col("t") * (1 - DAMPING)).alias("trust"), (F.col("d") * (1 - DAMPING)).alias("distrust")
    )
    if edges.isEmpty():
        return ranks.select("host", "trust", "distrust")
    for _ in range(MOST_STEPS // STEPS):
        before = ranks
        for _ in range(STEPS):
            ahead = edges.join(ranks, F.col("source") == F.col("host")).select(
                F.col("target").alias("at"), (F.col("trust") * F.col("ahead")).alias("in_t"), F.lit(0.0).alias("in_d")
            )
            back = edges.join(ranks, F.col("target") == F.col("host")).select(
                F.col("source").alias("at"), F.lit(0.0).alias("in_t"), (F.col("distrust") * F.col("back")).alias("in_d")
            )
            sums = ahead.union(back).groupBy("at").agg(F.sum("in_t").alias("in_t"), F.sum("in_d").alias("in_d"))
            ranks = start.join(sums, F.col("host") == F.col("at"), "left").select(
                "host",
                "t",
                "d",
                (F.col("t") * (1 - DAMPING) + DAMPING * F.coalesce("in_t", F.lit(0.0))).alias("trust"),
                (F.col("d") * (1 - DAMPING) + DAMPING * F.coalesce("in_d", F.lit(0.0))).alias("distrust"),
            )
        ranks = written(ranks, "ranks")
        old = before.select(F.col("host").alias("was"), F.col("trust").alias("old_t"), F.col("distrust").alias("old_d"))
        moved = (
            ranks.join(old, F.col("host") == F.col("was"))
            .agg(F.sum(F.abs(F.col("trust") - F.col("old_t")) + F.abs(F.col("distrust") - F.col("old_d"))))
            .first()[0]
        )
        if (moved or 0) < SETTLED:
            break
    else:
        raise RuntimeError("the ranks did not settle")
    return ranks.select("host", "trust", "distrust")


def page_verdicts(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every page.

    The longest rule that fits decides. Where none does, the host's trust and distrust do, with the
    pages that rules allow or block as seeds: the verdict is ``block`` if distrust is over RATIO
    times trust, else ``allow``, so a host nobody speaks of is allowed. A null url, or one
    without ``://``, has an empty host and path, which no rule fits and no link names: allowed. A
    null page text has no links. Repeated rows each return a row and each count as a page; an empty
    table gives an empty result.
    """
    narrow = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    ).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    # written, so that neither join of pages with hosts is tied to the count by host: Spark can then
    # split the pages of one busy host
    ruled = written(_ruled(narrow.drop("html"), rules), "ruled-pages")
    links = written(host_links(narrow), "links-of-hosts")
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("trusted"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
    )
    ranks = spread_ranks(seeds, links).select(F.col("host").alias("ranked"), "trust", "distrust")
    verdict = F.when(F.col("distrust") > RATIO * F.col("trust"), "block").otherwise("allow")
    return ruled.join(ranks, F.col("host") == F.col("ranked"), "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", verdict).alias("verdict")
    )
