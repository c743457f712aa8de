"""Keeping documents and index tables in step with their entities.

Every job reads one state and returns (or writes) another; nothing is changed in place. The
joins are on unique document keys, so they cannot be skewed; the folds combine on the map
side, so a key with very many changes is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.operators.documents import Tables, as_json, build_documents, id_column
from docsearch.operators.postings import (
    DOC,
    block_term_stats,
    in_one_row,
    index_stats,
    posting_blocks,
    postings,
    search_fields,
    whole_lengths,
)
from docsearch.operators.sizes import broadcast_if_small, is_small
from docsearch.operators.space import spans, union
from docsearch.plans.mapping import DocumentMapping, Registry
from docsearch.sources.index_tables import (
    BUCKETS,
    SCHEMAS,
    bucket_count,
    bucket_of,
    closed,
    gathered_rows,
    read_blocks,
    read_index_table,
    write_layout,
    write_table,
)
from docsearch.sources.shared import kept, put, remove
from docsearch.sources.tables import spread

DELETE = "delete"


# -- folds of changes --------------------------------------------------------------------


def fold_last(changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: its last change by ``order``. An index cancels an earlier delete of the
    same key, and the reverse."""
    rest = [c for c in changes.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__last")
    return changes.groupBy(*key).agg(last).select(*key, "__last.*")


def fold_delete_wins(
    changes: DataFrame, key: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """One row per key: a delete if any change of the key is one, else its last change."""
    rest = [c for c in changes.columns if c not in key]
    deleted = F.col(op) == DELETE
    last = F.max_by(F.struct(*rest), F.struct(deleted, *order)).alias("__last")
    return changes.groupBy(*key).agg(last).select(*key, "__last.*")


def committed(
    changes: DataFrame, transactions: DataFrame, key: str = "tx_id", status: str = "status"
) -> DataFrame:
    """Changes of transactions that committed; those rolled back or in any other state go."""
    done = transactions.where(F.col(status) == "committed").select(key)
    return changes.join(done, key, "left_semi")


def owners_of(
    changed_children: DataFrame, fk: str, key: Sequence[str] = (), before: DataFrame | None = None
) -> DataFrame:
    """``(owner)``: the owners whose documents hold a changed child.

    A child that was moved or deleted also changes the owner it had: give ``before``, the children
    as they were, and the ``key`` by which a changed one is found among them.
    """
    owners = changed_children.select(F.col(fk).alias("owner"))
    if before is not None:
        earlier = before.join(changed_children.select(*key).distinct(), list(key), "left_semi")
        owners = owners.unionByName(earlier.select(F.col(fk).alias("owner")))
    return owners.where(F.col("owner").isNotNull()).distinct()


def reindex_owners(
    registry: Registry,
    tables: Tables,
    entity: str | DocumentMapping,
    owners: DataFrame,
    children: Mapping[str, str],
) -> DataFrame:
    """Fresh documents of the owners in ``owners`` only. ``children`` names the child tables and
    the column that holds the owner key; both sides are reduced before anything is nested."""
    mapping = registry.require(entity)
    key = mapping.keys[0]
    owners = broadcast_if_small(owners)
    reduced = dict(tables)
    reduced[mapping.full_name] = tables[mapping.full_name].join(
        owners.withColumnRenamed("owner", key), key, "left_semi"
    )
    for child, fk in children.items():
        reduced[child] = tables[child].join(owners.withColumnRenamed("owner", fk), fk, "left_semi")
    return build_documents(registry, reduced, mapping)


# -- document sets -----------------------------------------------------------------------


def newest(documents: DataFrame, key: Sequence[str] = DOC, order: Sequence[str] = ()) -> DataFrame:
    """One document per key: the last by ``order`` (``version`` where there is one), and of equal
    ones always the same. All parts of a document that is kept in several rows stay."""
    by = [*key, *(["part"] if "part" in documents.columns and "part" not in key else [])]
    ranks = list(order) or [c for c in ("version",) if c in documents.columns]
    rest = [c for c in documents.columns if c not in by]
    tie = F.xxhash64(F.to_json(F.struct(*rest)))
    last = F.max_by(F.struct(*rest), F.struct(*ranks, tie)).alias("__last")
    return documents.groupBy(*by).agg(last).select(*by, "__last.*").select(*documents.columns)


def upsert(
    stored: DataFrame, fresh: DataFrame, key: Sequence[str] = DOC, order: Sequence[str] = ()
) -> DataFrame:
    """``stored`` with the documents of ``fresh`` put in: same key replaces, new key adds. Of several
    fresh documents with one key the last by ``order`` counts."""
    return unindex(stored, fresh, key).unionByName(newest(fresh, key, order))


def unindex(stored: DataFrame, keys: DataFrame, key: Sequence[str] = DOC) -> DataFrame:
    """``stored`` without the documents named in ``keys``. Few keys are sent to the stored rows,
    which then stay where they are; many are shuffled with them."""
    return stored.join(broadcast_if_small(keys.select(*key)), list(key), "left_anti")


def unindex_types(
    stored: DataFrame, registry: Registry, entities: Iterable | None = None
) -> DataFrame:
    """``stored`` without whole types; all root types when none is named. Reading a partitioned
    table, Spark skips the partitions of the dropped types."""
    dropped = [m.type_name for m in registry.roots(entities)]
    return stored.where(~F.col("type").isin(dropped)) if dropped else stored


def delete_index(
    stored: DataFrame, registry: Registry, targets: Iterable | None = None, everything: bool = False
) -> DataFrame:
    """``stored`` without whole indices, by name or by mapping. Naming none drops nothing;
    ``everything`` has to be asked for."""
    if everything:
        return stored.limit(0)
    wanted = list(targets or [])
    names = {t.lower() for t in wanted if isinstance(t, str)}
    names |= {registry.index_of(m) for m in wanted if not isinstance(m, str) and registry.get(m)}
    return stored.where(~F.col("index").isin(sorted(names))) if names else stored


def check_type(rows: DataFrame, registry: Registry, entity: str | DocumentMapping) -> DataFrame:
    """``rows``, or an error when any row is of another type than the one asked for."""
    expected = registry.require(entity).type_name
    if not rows.where(~F.col("type").eqNullSafe(F.lit(expected))).isEmpty():
        raise ValueError(f"only documents of type {expected} may be passed")
    return rows


def split_rejects(rows: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others with the first ``reason`` that failed."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    judged = rows.withColumn("reason", reason)
    good = judged.where(F.col("reason").isNull()).drop("reason")
    return good, judged.where(F.col("reason").isNotNull())


# -- index tables ------------------------------------------------------------------------


def document_postings(
    registry: Registry, tables: Tables, mapping: DocumentMapping, documents: DataFrame
) -> DataFrame:
    """Postings, including ``_all``, of documents of one type."""
    fields = search_fields(registry, tables, mapping)
    with_all = any(f.in_all for f in fields)
    if not spans(registry, mapping):
        return postings(documents, fields, with_all)
    alone, several = in_one_row(documents)
    return postings(alone, fields, with_all).unionByName(whole_lengths(postings(several, fields, with_all)))


def document_blocks(
    registry: Registry, tables: Tables, mapping: DocumentMapping, documents: DataFrame, buckets: int, once: bool = False
) -> DataFrame:
    """The same as rows of the stored table. Only postings of documents that have several rows are
    shuffled; with ``once`` those of a document given more than once count once. ``documents`` are read
    more than once."""
    fields = search_fields(registry, tables, mapping)
    with_all = any(f.in_all for f in fields)
    bucket = bucket_of(F.col("term"), buckets)
    if not once and not spans(registry, mapping):
        return posting_blocks(documents, fields, with_all).withColumn("bucket", bucket)
    alone, several = in_one_row(documents)
    rows = postings(several, fields, with_all)
    rows = whole_lengths(rows) if spans(registry, mapping) else rows
    if once:
        # the same document given twice has the same postings twice
        rows = rows.dropDuplicates([*DOC, "part", "field", "term"])
    blocks = posting_blocks(alone, fields, with_all).withColumn("bucket", bucket)
    return blocks.unionByName(gathered_rows(rows.withColumn("bucket", bucket)))


def put_documents(
    registry: Registry,
    tables: Tables,
    entity: str | DocumentMapping,
    typed: DataFrame,
    removed: DataFrame,
    path: str,
    target: str,
    version: int | Column = 1,
    replace: bool = False,
) -> str:
    """:func:`update_index` with typed documents of one entity: their JSON form, postings and typed
    twin go in, what ``removed`` names goes out. Documents without a whole key go to ``rejects``."""
    mapping = registry.require(entity)
    spark = typed.sparkSession
    typed, bad = split_rejects(kept(typed, "put-documents"), {"no id": F.col("id").isNull()})
    number = version if isinstance(version, Column) else F.lit(version)
    fresh = newest(as_json(typed).withColumn("version", number.cast("long")))
    blocks = document_blocks(registry, tables, mapping, typed, bucket_count(spark, path), once=True)
    own = {mapping.type_name: typed}
    return update_index(spark, path, target, removed, fresh, None, own, as_json(bad), blocks, replace)


def reindex_owners_into(
    registry: Registry,
    tables: Tables,
    entity: str | DocumentMapping,
    owners: DataFrame,
    children: Mapping[str, str],
    path: str,
    target: str,
    version: int = 1,
    replace: bool = False,
) -> str:
    """Documents of ``owners`` as the tables now have them, put into a written index. An owner that
    is gone leaves it."""
    mapping = registry.require(entity)
    owners = kept(owners.select("owner"), "owners")
    typed = reindex_owners(registry, tables, mapping, owners, children)
    named = owners.select(
        F.lit(registry.index_of(mapping)).alias("index"),
        F.lit(mapping.type_name).alias("type"),
        F.col("owner").cast("string").alias("id"),
    )
    return put_documents(registry, tables, mapping, typed, named, path, target, version, replace)


def bulk_index(
    registry: Registry,
    tables: Tables,
    path: str,
    entities: Iterable | None = None,
    buckets: int = BUCKETS,
    version: int = 1,
) -> list[DocumentMapping]:
    """Index every row of the given root entities (all that have a table when None) into a new
    directory. Each stage is written before the next reads it, so none is computed twice. Rows
    without a whole key go to ``rejects`` instead."""
    mappings = [m for m in registry.roots(entities) if m.full_name in tables]
    if not mappings:
        return []
    spark = tables[mappings[0].full_name].sparkSession
    rejected = [spark.createDataFrame([], SCHEMAS["rejects"])]
    for m in mappings:
        documents = build_documents(registry, tables, m)
        nested = spans(registry, m)
        # asking for the number of partitions of documents that are put together by a shuffle would run it
        documents, bad = split_rejects(documents if nested else spread(documents), {"no id": F.col("id").isNull()})
        put(documents, f"{path}/typed/{m.type_name}")
        if not nested or not tables[m.full_name].where(id_column(m).isNull()).isEmpty():
            rejected.append(as_json(bad).select(*rejected[0].columns))
    write_table(union(rejected), path, "rejects")
    known = [
        (registry.index_of(m), m.type_name, f.path, f.analyzer, f.boost, f.in_all, f.kind)
        for m in mappings
        for f in search_fields(registry, tables, m)
    ]
    write_table(spark.createDataFrame(known, SCHEMAS["fields"]).coalesce(1), path, "fields")
    typed = [(m, spark.read.parquet(f"{path}/typed/{m.type_name}")) for m in mappings]
    docs = union([as_json(d) for _, d in typed]).withColumn("version", F.lit(version).cast("long"))
    write_table(docs, path, "docs", gathered=False)
    blocks = union([document_blocks(registry, tables, m, d, buckets) for m, d in typed])
    _write_tokens(spark, path, blocks, buckets)
    return mappings


def _write_tokens(spark: SparkSession, path: str, blocks: DataFrame, buckets: int, written=lambda: None) -> None:
    write_layout(spark, path, buckets)
    write_table(blocks, path, "postings", gathered=False)
    written()
    docs = read_index_table(spark, path, "docs")
    split = not docs.where(F.col("part") != 0).isEmpty()
    stats = block_term_stats(read_blocks(spark, path), split).withColumn("bucket", bucket_of(F.col("term"), buckets))
    write_table(stats, path, "term_stats")
    write_table(index_stats(docs), path, "index_stats")


def update_index(
    spark: SparkSession,
    path: str,
    target: str,
    removed: DataFrame,
    fresh_docs: DataFrame | None = None,
    fresh_postings: DataFrame | None = None,
    fresh_typed: Mapping[str, DataFrame] | None = None,
    rejected: DataFrame | None = None,
    fresh_blocks: DataFrame | None = None,
    replace: bool = False,
) -> str:
    """Write to ``target`` the index at ``path`` without the documents ``removed`` names
    ``(index, type, id)``, and with the fresh ones put in; gives the path that holds the result.

    Fresh documents come one per key (:func:`newest`), with their postings, as rows or as blocks in
    the buckets of the index, and, by type, their typed form. Postings that stay are shuffled only if
    there are too many keys to send to them. Statistics are counted anew. ``rejected`` joins the rejects that are there. With
    nothing to remove, add or reject nothing is written, and the result is ``path`` itself.
    ``replace`` is for an index that nobody else reads: each of its tables leaves the disk as soon as the new
    one is written, so that there are never two whole indexes.
    """

    def replaced(name: str) -> None:
        if replace:
            remove(spark, f"{path}/{name}")

    keys = [removed.select(*DOC)] + ([fresh_docs.select(*DOC)] if fresh_docs is not None else [])
    named = kept(reduce(DataFrame.unionByName, keys).distinct(), "update-keys")
    if named.isEmpty() and (rejected is None or rejected.isEmpty()):
        return path
    buckets = bucket_count(spark, path)
    few = is_small(named)
    gone = F.broadcast(named) if few else named
    write_table(read_index_table(spark, path, "fields"), target, "fields")
    rejects = read_index_table(spark, path, "rejects")
    if rejected is not None:
        rejects = rejects.unionByName(rejected.select(*rejects.columns))
    write_table(rejects, target, "rejects")
    fresh_typed = fresh_typed or {}
    kinds = {r["type"] for r in read_index_table(spark, path, "fields").select("type").distinct().collect()}
    for kind in sorted(kinds):
        stored = spark.read.parquet(f"{path}/typed/{kind}").join(gone, list(DOC), "left_anti")
        if kind in fresh_typed:
            stored = stored.unionByName(newest(fresh_typed[kind]), allowMissingColumns=True)
        put(stored, f"{target}/typed/{kind}")
        replaced(f"typed/{kind}")
    docs = read_index_table(spark, path, "docs").join(gone, list(DOC), "left_anti")
    rows = read_index_table(spark, path, "postings").join(gone, list(DOC), "left_anti")
    blocks = [closed(rows) if few else gathered_rows(rows)]
    if fresh_docs is not None:
        docs = docs.unionByName(newest(fresh_docs))
    if fresh_postings is not None:
        # the same document given twice has the same postings twice. Dealt out by document they are shuffled
        # only here, and each task makes the blocks of its own
        once = fresh_postings.repartition(*DOC).dropDuplicates([*DOC, "part", "field", "term"])
        once = once.withColumn("bucket", bucket_of(F.col("term"), buckets))
        blocks.append(closed(once.sortWithinPartitions("index", "type", "bucket", "field", "term")))
    if fresh_blocks is not None:
        blocks.append(fresh_blocks)
    write_table(docs, target, "docs", gathered=False)
    replaced("docs")
    _write_tokens(spark, target, union(blocks), buckets, lambda: replaced("postings"))
    replaced("")
    return target
