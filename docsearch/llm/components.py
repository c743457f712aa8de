"""Connected components of a link table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsearch.llm.tables import written

MAX_ROUNDS = 60


def _stars(links: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones, move to its minimum.

    Both steps join a link with one aggregated row per node, so a node with very many links is
    pre-aggregated where its links lie and adaptive execution may split its side of the join.
    """
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    up = (
        both.where("low > high")
        .join(least, F.col("high") == F.col("node"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .distinct()
    )
    least = up.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    down = up.join(least, F.col("high") == F.col("node"))
    moved = down.where("low <> least").select(
        F.greatest("low", "least").alias("high"), F.least("low", "least").alias("low")
    )
    return moved.union(down.select("high", F.col("least").alias("low"))).distinct()


def _state(links: DataFrame):
    return links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("sum")
    ).first()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node with a link: the smallest node it can reach.

    Links to itself and links with a null end are ignored; a repeated link counts once; an empty
    table gives an empty table. Each round is written to the shared folder, and the rounds, of
    which there are about as many as the logarithm of the longest path, end when nothing moves.
    """
    now = written(
        links.select(
            F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
        )
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("high") != F.col("low")))
        .distinct(),
        "links",
    )
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state["n"]:
            break
        now = written(_stars(now), "links")
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError("the components did not settle")
    nodes = now.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.union(roots)
