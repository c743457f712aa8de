"""Links of sets that share a key and are alike by exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch.llm.components import components
from docsearch.llm.tables import written

SHINGLE = 5
#: texts link at this Jaccard similarity of their shingles or more
ALIKE = 0.8
#: rows of a cell that are compared with all others of it in one task
BLOCK = 1024
#: so many of a set's keys put it beside sets that share them
LEAD = 3
#: so many keys or names are broadcast; beyond it both sides are shuffled
BROADCAST_NAMES = 1_000_000


def small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_NAMES else frame


def _members(distinct: DataFrame) -> DataFrame:
    """``key, blocks, block`` and the set's columns for every place in a cell of two or more sets."""
    lead = F.slice(F.array_sort("bands"), 1, LEAD).alias("lead")
    cells = distinct.select("name", "n", "sketch", lead, F.explode("bands").alias("key"))
    counts = cells.groupBy(F.col("key").alias("cell")).count().where("count > 1")
    counts = written(
        counts.select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "near-cells"
    )
    found = cells.join(small(counts), F.col("key") == F.col("cell")).drop("cell")
    return written(found.withColumn("block", F.expr("pmod(xxhash64(name, key), blocks)")), "near-members")


def cell_links(distinct: DataFrame, like: Callable[[str, str], str], verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``a, b``: verified links between the names of ``distinct`` whose components are those of all links.

    ``distinct`` has ``name, n, sketch`` and ``bands``, the keys of the cells where a name is; ``like``
    says in SQL whether two may link, ``verified`` which pairs do. Neighbours in a block of a cell, by
    size and by their lowest keys, are tried first. Of the other pairs of a cell only those remain that their links have not brought
    together, so a large group of near copies costs a chain of links in each of its cells and not the
    square of its size.
    """
    members = _members(distinct)
    cell = Window.partitionBy("key", "block")

    def chain(*order: str) -> DataFrame:
        row = cell.orderBy(*order)
        chained = members.select(
            F.col("name").alias("x"),
            F.col("n").alias("x_n"),
            F.col("sketch").alias("x_sketch"),
            *(F.lag(c).over(row).alias(f"y_{c}") for c in ("name", "n", "sketch")),
        )
        return chained.where(f"y_name is not null AND {like('x', 'y')}").select(
            F.least("x", "y_name").alias("a"), F.greatest("x", "y_name").alias("b")
        )

    tried = written(chain("n", "name").union(chain("lead", "n", "name")).distinct(), "near-pairs")
    links = written(verified(tried), "near-links")

    joined = components(links, "a", "b")
    placed = members.join(small(joined), F.col("name") == F.col("node"), "left").withColumn(
        "group", F.coalesce("component", "name")
    )
    placed = written(placed.drop("node", "component", "lead"), "near-placed")
    open_ = placed.groupBy(F.col("key").alias("cell")).agg(F.min("group").alias("low"), F.max("group").alias("high"))
    open_ = written(open_.where("low <> high").select("cell"), "near-open")
    left_over = placed.join(small(open_), F.col("key") == F.col("cell"), "left_semi")

    def side(which: str, salt: Column) -> DataFrame:
        columns = (F.col(c).alias(f"{which}_{c}") for c in ("key", "name", "n", "sketch", "group"))
        return left_over.select(*columns, salt.alias(f"{which}_salt"))

    # a row meets the rows of each block of its cell in another task
    pairs = side("a", F.explode(F.expr("sequence(0L, blocks - 1L)"))).join(
        side("b", F.col("block")),
        F.expr("a_key = b_key AND a_salt = b_salt AND a_name < b_name AND a_group <> b_group AND " + like("a", "b")),
    )
    pairs = pairs.select(F.col("a_name").alias("a"), F.col("b_name").alias("b")).distinct()
    pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
    return links.union(written(verified(pairs), "near-links"))


def alike_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` of names whose ``shingles`` in ``sets`` are as alike as ALIKE."""

    def side(which: str) -> DataFrame:
        return sets.select(F.col("name").alias(f"{which}_name"), F.col("shingles").alias(f"{which}_set"))

    both = pairs.join(side("a"), F.col("a") == F.col("a_name")).join(side("b"), F.col("b") == F.col("b_name"))
    shared = "size(array_intersect(a_set, b_set))"
    return both.where(f"{shared} >= {ALIKE} * (size(a_set) + size(b_set) - {shared}) - 1e-6").select("a", "b")
