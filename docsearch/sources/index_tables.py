"""Index tables on storage: plain Parquet that any Spark job can read.

========================  =====================================================  =============
table                     columns                                                partitions
========================  =====================================================  =============
``docs``                  id, part, version, source (JSON)                       index, type
``typed/<type>``          index, type, id, part, source (struct)                 --
``postings``              field, term, boost, ids, parts, tfs, lens, places       index, type, bucket
``term_stats``            field, term, df                                        index, type, bucket
``index_stats``           num_docs                                               index, type
``fields``                how each searchable field became terms                 --
``rejects``               documents without an id, and why they are left out     --
``gone``                  documents of earlier segments that are no longer held  index, type
========================  =====================================================  =============

A row of ``postings`` holds postings of one term of a field, as lists of equal length: the document, its
part, how often the term stands there, the length of the field and the places. A term has many such
rows. :func:`read_index_table` gives one row per posting, ``(id, part, field, term, tf, len, boost,
positions)``; a filter on terms is applied before the lists are opened, and lists that are not asked
for are not read.

``bucket`` is a hash of the term, so a question reads only the buckets of its terms; rows are
sorted by term within a file, so row-group statistics prune further. A directory is written once
and never changed: maintenance jobs read one and write another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.sources.shared import put

BUCKETS = 16
#: rows of one file at most, so that no reader gets a file it cannot share
ROWS_PER_FILE = 20_000_000

SCHEMAS = {
    "docs": "id string, part long, version long, source string, index string, type string",
    "postings": (
        "field string, term string, boost double, ids array<string>, parts array<bigint>, tfs array<double>,"
        " lens array<int>, places array<array<int>>, index string, type string, bucket int"
    ),
    "term_stats": "field string, term string, df long, index string, type string, bucket int",
    "index_stats": "num_docs long, index string, type string",
    "layout": "buckets int",
    "gone": "id string, index string, type string",
    "fields": (
        "index string, type string, path string, analyzer string, boost double, in_all boolean, kind string"
    ),
    "rejects": "index string, type string, reason string, source string",
}
PARTITIONS = {
    "docs": ["index", "type"],
    "postings": ["index", "type", "bucket"],
    "term_stats": ["index", "type", "bucket"],
    "index_stats": ["index", "type"],
    "layout": [],
    "gone": ["index", "type"],
    "fields": [],
    "rejects": [],
}


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_table(rows: DataFrame, path: str, name: str, gathered: bool = True) -> None:
    """Write one index table. Rows are brought together by partition so that files are few and
    large; ``rebalance`` lets Spark split a partition that a frequent term makes too large. With
    ``gathered`` False each task writes the rows it has, and nothing is shuffled: for what comes in
    few large tasks."""
    parts = PARTITIONS[name]
    columns = [f.name for f in T.StructType.fromDDL(SCHEMAS[name])]
    rows = rows.select(*columns)
    if parts:
        order = [*parts, "term"] if "term" in columns else parts
        rows = rows.hint("rebalance", *parts) if gathered else rows
        rows = rows.sortWithinPartitions(*order)
    put(rows, f"{path}/{name}", parts, ROWS_PER_FILE)


def read_index_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One index table, with its declared types: ids and names may look like numbers."""
    table = spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}")
    return opened(table) if name == "postings" else table


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``postings`` as they are stored."""
    return spark.read.schema(SCHEMAS["postings"]).parquet(f"{path}/postings")


def opened(blocks: DataFrame, *more: str) -> DataFrame:
    """One row per posting of stored blocks, with the columns ``more`` of its block."""
    kept = ["field", "term", "boost", "index", "type", "bucket", "parts", "tfs", "lens", "places", *more]
    each = blocks.select(*kept, F.posexplode("ids").alias("__at", "id"))
    lists = {"parts": "part", "tfs": "tf", "lens": "len", "places": "positions"}
    one = {name: F.get(of, F.col("__at")).alias(name) for of, name in lists.items()}
    return each.select(
        "id", one["part"], "field", "term", one["tf"], one["len"], "boost", one["positions"], "index", "type", "bucket", *more
    )


def closed(rows: DataFrame) -> DataFrame:
    """Blocks of postings that come one per row. Those of a term that follow each other are put
    together where they are, so rows in the order of terms give large blocks."""
    keys = ["field", "term", "boost", "index", "type", "bucket"]
    lists = {"id": "ids", "part": "parts", "tf": "tfs", "len": "lens", "positions": "places"}
    columns = [f.name for f in T.StructType.fromDDL(SCHEMAS["postings"])]

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows + 1, bool)
            new[[0, -1]] = True
            for key in keys:
                codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:-1] |= codes[1:] != codes[:-1]
            heads = np.flatnonzero(new)
            ends, first = pa.array(heads.astype(np.int32)), pa.array(heads[:-1])
            made = {key: batch.column(key).take(first) for key in keys}
            made |= {of: pa.ListArray.from_arrays(ends, batch.column(name)) for name, of in lists.items()}
            yield pa.RecordBatch.from_arrays([made[c] for c in columns], names=columns)

    typed = rows.withColumn("len", F.col("len").cast("int"))
    return typed.select(*keys, *lists).mapInArrow(each, SCHEMAS["postings"])


def gathered_rows(rows: DataFrame) -> DataFrame:
    """Blocks of postings that come one per row in any order: brought together by partition and
    put in the order of terms before."""
    parts = PARTITIONS["postings"]
    return closed(rows.hint("rebalance", *parts).sortWithinPartitions(*parts, "field", "term"))


def write_layout(spark: SparkSession, path: str, buckets: int) -> None:
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(f"{path}/layout")


def bucket_count(spark: SparkSession, path: str) -> int:
    """The number of term buckets an index was written with: one row, read by the driver."""
    return read_index_table(spark, path, "layout").first()["buckets"]
