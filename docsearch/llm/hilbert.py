"""Shards along a Hilbert curve through several quantised columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.tables import free_name, written

SHARDS = 16
BITS = 5
#: bytes of a text value that decide its place among the others
PREFIX_BYTES = 7
PART_SHIFT = 33


def curve_index(axes: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """The place along the Hilbert curve of points with ``bits`` bits an axis (Skilling 2004)."""
    x = [np.asarray(a, dtype=np.int64).copy() for a in axes]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inverted, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def ordinal(frame: DataFrame, column: str) -> Column:
    """A column as a number of the same order: numbers as they are, text by its first bytes."""
    kind = frame.schema[column].dataType
    if isinstance(kind, T.NumericType):
        number = F.col(column).cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(F.col(column).cast("timestamp")).cast("double")
    head = F.substring(F.encode(F.col(column).cast("string"), "utf-8"), 1, PREFIX_BYTES)
    return F.conv(F.rpad(F.hex(head), 2 * PREFIX_BYTES, "0"), 16, 10).cast("double")


def quantised(frame: DataFrame, columns: dict[str, Column], bits: int) -> dict[str, Column]:
    """Each column as one of ``2 ** bits`` steps of about equal row counts; null is the lowest.

    The steps' limits come from one aggregate over all rows; the driver gets only them.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    limits = frame.agg(
        *(F.percentile_approx(c, shares, 10_000).alias(name) for name, c in columns.items())
    ).first()
    steps = {}
    for name, column in columns.items():
        step = F.lit(0)
        for limit in sorted(set(limits[name] or ())):
            step = step + F.coalesce((column >= F.lit(limit)).cast("int"), F.lit(0))
        steps[name] = step
    return steps


def hilbert_shards(
    table: DataFrame,
    dimensions: Sequence[str],
    tie: str,
    carried: dict[str, Column] | None = None,
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """``tie``, the ``carried`` columns, ``curve``, ``shard`` and ``slot`` of every row.

    Rows are sorted by their place on the curve through ``dimensions``, then by ``tie``, and the
    order is cut into ``shards`` runs whose counts differ by one at most; ``slot`` counts from 0
    in each. Only the narrow columns asked for are sorted, never a text. Nulls in a dimension or
    in ``tie`` come first; repeated rows lie side by side in any order and each gets its own slot;
    an empty table gives an empty result. A range partition is at most as large as the sort makes
    it: rows with equal dimensions still differ in ``tie``, so one busy cell is spread as well.
    """
    if not 1 <= bits * len(dimensions) <= 62:
        raise ValueError("bits times dimensions must lie between 1 and 62")
    steps = quantised(table, {f"d{i}": ordinal(table, c) for i, c in enumerate(dimensions)}, bits)

    @F.pandas_udf("long")
    def place(axes: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index([axes[c].to_numpy() for c in axes.columns], bits))

    kept = {f"c{i}": column for i, column in enumerate((carried or {}).values())}
    narrow = table.select(
        F.col(tie).alias("tie"),
        *(column.alias(name) for name, column in kept.items()),
        F.struct(*(step.cast("long").alias(name) for name, step in steps.items())).alias("axes"),
    ).select("tie", *kept, place("axes").alias("curve"))
    # the place of a row is fixed once, by writing it: a range sort done twice may cut differently
    order = written(
        narrow.repartitionByRange("curve", "tie")
        .sortWithinPartitions("curve", "tie")
        .withColumn("at", F.monotonically_increasing_id()),
        "curve",
    )
    part = F.shiftright("at", PART_SHIFT)
    sizes = order.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):  # one entry a partition
        starts.append((row["part"], total))
        total += row["rows"]
    start = order.sparkSession.createDataFrame(starts, "part long, start long")
    ranked = order.join(F.broadcast(start), part == F.col("part")).withColumn(
        "rank", F.col("start") + F.col("at").bitwiseAND((1 << PART_SHIFT) - 1)
    )
    named = [F.col(a).alias(b) for a, b in zip(kept, carried or {}, strict=True)]
    return ranked.withColumn(
        "shard", F.expr(f"CAST(rank * {shards} DIV {max(total, 1)} AS INT)")
    ).select(
        F.col("tie").alias(tie),
        *named,
        "curve",
        "shard",
        F.expr(f"rank - (shard * {total}L + {shards - 1}) DIV {shards}").alias("slot"),
    )


def write_shards(table: DataFrame, placed: DataFrame, key: str, path: str, rows: int = 1_000_000) -> None:
    """Write ``table`` by shard, in curve order inside files of about ``rows`` rows.

    ``placed`` is what :func:`hilbert_shards` gave for it; ``key`` must be unique. Columns
    ``shard`` and ``slot`` of ``table`` are replaced. Each file covers
    a short run of the curve, so its Parquet statistics bound every dimension at once.
    """
    rest = table.drop("shard", "slot")
    owner, run = free_name(rest, "owner"), free_name(rest, "run")
    place = placed.select(F.col(key).alias(owner), "shard", "slot")
    (
        rest.join(place, F.col(key).eqNullSafe(F.col(owner)))
        .drop(owner)
        .withColumn(run, F.expr(f"slot DIV {rows}"))
        .repartition("shard", run)
        .sortWithinPartitions("shard", "slot")
        .drop(run)
        .write.partitionBy("shard")
        .parquet(path)
    )
