"""Entity tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet entity table; Spark prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(table: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer tasks than there are cores.

    Breaking text into terms is CPU-bound; a small table would use a few cores. A large table is
    read by as many tasks as its files can be split into, and is returned as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
