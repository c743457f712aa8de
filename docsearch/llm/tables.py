"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.sources.shared import SHUFFLE_CLEANUP, fresh_path, remove

#: the paths written in the step that runs, where a step is to leave nothing but its result
_STEP: ContextVar[list[str] | None] = ContextVar("step", default=None)


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` kept as Parquet in the shared folder and read again.

    Cuts the lineage: what has been computed survives a lost executor, and is not computed twice. The
    shuffles that made it are of no more use and leave the disk at once, not when the driver's memory is cleaned.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if (paths := _STEP.get()) is not None:
        paths.append(path)
    return spark.read.parquet(path)


def step(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` gives, ``written``; the tables that were written to make it leave the disk.

    Steps may lie in steps. Where one fails, its tables stay.
    """
    inner: list[str] = []
    before = _STEP.set(inner)
    try:
        result = written(make(), label)
    finally:
        _STEP.reset(before)
    *passing, kept = inner
    for path in passing:
        remove(result.sparkSession, path)
    if (outer := _STEP.get()) is not None:
        outer.append(kept)
    return result


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, or the first variation of it that is no column of ``frame``."""
    taken = {c.lower() for c in frame.columns}
    name, n = wanted, 0
    while name in taken:
        n += 1
        name = f"{wanted}{n}"
    return name


def field_of(frame: DataFrame, column: str, name: str) -> T.StructField:
    """The type of ``column`` under a new name, for the schema of an Arrow function."""
    return T.StructField(name, frame.schema[column].dataType, True)


def finite_vector(column: str):
    """Whether an array column holds a vector: not null, not empty, no null or non-finite part."""
    value = F.col(column)
    odd = F.exists(
        value,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return value.isNotNull() & (F.size(value) > 0) & ~F.coalesce(odd, F.lit(True))
