"""Deciding from measured size whether one side of a join may be sent to every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: what a broadcast may weigh, well below executor memory
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 500_000


def is_small(side: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``side`` has at most ``rows`` rows of at most ``size`` bytes together. Every task
    counts its own rows, and only the counts meet."""
    measured = side.select(F.octet_length(F.to_json(F.struct("*"))).cast("long").alias("size"))
    found = measured.agg(F.count("size").alias("n"), F.sum("size").alias("size")).first()
    return found["n"] <= rows and (found["size"] or 0) <= size


def broadcast_if_small(side: DataFrame) -> DataFrame:
    """``side`` marked for broadcast when counted and weighed to be small; else as it is, so
    that Spark shuffles both sides and splits skewed partitions."""
    return F.broadcast(side) if is_small(side) else side
