"""Places on storage that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: has Spark remove the files of a query's shuffles when the query has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SETTING = "spark.checkpoint.dir"
#: a session whose executors are threads of the driver
ONE_PROCESS = re.compile(r"local(\[.*\])?")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own; a cluster
    session without the setting is an error, since a machine-local folder is lost with its machine.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not named:
        if not ONE_PROCESS.fullmatch(spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="docsearch-")
        spark.conf.set(SETTING, named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def put(frame: DataFrame, path: str, by: Sequence[str] = (), rows_per_file: int = 0) -> None:
    """Write ``frame`` to a path that nothing is written to, by zstd, which takes two thirds of the space of the
    usual codec. The shuffles that made it leave the disk when it is written."""
    spark = frame.sparkSession
    writer = frame.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (writer.partitionBy(*by) if by else writer).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def kept(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read from there, for what is used several times."""
    path = fresh_path(frame.sparkSession, label)
    put(frame, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
