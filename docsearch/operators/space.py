"""What a search runs over: a set of entity tables, or an index written earlier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.operators.documents import Tables, as_json, build_documents, id_column, is_first
from docsearch.functions.converters import date_in
from docsearch.operators.postings import (
    DATE_KINDS,
    DOC,
    ROW,
    SearchField,
    postings,
    search_fields,
    tokens,
    whole_lengths,
)
from docsearch.operators.sizes import broadcast_if_small
from docsearch.plans.clauses import ALL
from docsearch.plans.mapping import DocumentMapping, Many, Registry
from docsearch.sources.index_tables import bucket_count, bucket_of, opened, read_blocks, read_index_table


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass
class TableSpace:
    """Entity tables searched directly; terms are made while the tables are read."""

    registry: Registry
    tables: Tables
    mappings: list[DocumentMapping]

    @classmethod
    def over(cls, registry: Registry, tables: Tables, indices=None, types=None) -> TableSpace:
        """The root entities that have a table, narrowed by index and type."""
        chosen_indices = registry.resolve_indices(indices)
        chosen_types = registry.resolve_types(types)
        mappings = [
            m
            for m in registry.roots()
            if m.full_name in tables
            and (chosen_indices is None or registry.index_of(m) in chosen_indices)
            and (chosen_types is None or m.type_name in chosen_types)
        ]
        if not mappings:
            raise ValueError(f"no entity with a table is in indices {indices} and types {types}")
        return cls(registry, tables, mappings)

    def documents(self) -> DataFrame:
        """``(index, type, id, part, source)`` with ``source`` as JSON, so that types mix."""
        return union([as_json(self.typed(m)) for m in self.mappings])

    def typed(self, mapping: DocumentMapping) -> DataFrame:
        return build_documents(self.registry, self.tables, mapping)

    def entity(self, mapping: DocumentMapping) -> DataFrame:
        """The entity's own columns plus ``index, type, id``."""
        return self.tables[mapping.full_name].select(
            F.lit(self.registry.index_of(mapping)).alias("index"),
            F.lit(mapping.type_name).alias("type"),
            id_column(mapping).alias("id"),
            F.struct("*").alias("row"),
        )

    def known_fields(self) -> list[tuple[str, SearchField]]:
        """Every searchable field with the type it belongs to."""
        return [
            (m.type_name, f) for m in self.mappings for f in search_fields(self.registry, self.tables, m)
        ]

    def only(self, mapping: DocumentMapping) -> TableSpace:
        """The same tables, narrowed to one entity."""
        return TableSpace.over(self.registry, self.tables, self.registry.index_of(mapping), mapping)

    def keys(self) -> DataFrame:
        """``(index, type, id)`` of every document; reads key columns only."""
        return union([self.entity(m).select(*DOC) for m in self.mappings])

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.tables.values())).sparkSession

    def count(self) -> DataFrame:
        """One row ``(num_docs)``."""
        return self.keys().agg(F.count(F.lit(1)).alias("num_docs"))

    def where(self, column: str, condition) -> DataFrame | None:
        """Keys of documents whose typed column satisfies ``condition``, a column function. Only
        fields that are mapped and searchable count."""
        having = {type_name for type_name, f in self.known_fields() if f.path == column}
        found = [
            self.entity(m).where(condition(F.col(f"row.{column}"))).select(*DOC)
            for m in self.mappings
            if m.type_name in having and column in self.tables[m.full_name].columns
        ]
        return union(found) if found else None

    def term_rows(
        self, terms: Column, fields: set[str], exact: Sequence[str] | None, positions: bool
    ) -> DataFrame:
        """Rows whose ``tf`` adds up to how often a term stands in a field, for the terms of the
        named fields that satisfy ``terms``. ``exact`` lists the only terms that can, if known;
        tables have no use for it."""
        found = []
        for mapping in self.mappings:
            known = search_fields(self.registry, self.tables, mapping)
            with_all = ALL in fields and any(f.in_all for f in known)
            wanted = [f for f in known if f.path in fields or (with_all and f.in_all)]
            if not wanted:
                continue
            documents = self.typed(mapping)
            if spans(self.registry, mapping):
                rows = whole_lengths(postings(documents, wanted, with_all, positions)).where(terms)
            else:
                rows = tokens(documents, wanted, with_all).where(terms)
                rows = rows.withColumnRenamed("weight", "tf")
                rows = rows.withColumn("positions", F.array("pos")) if positions else rows
            found.append(rows.select(*_term_columns(positions)))
        if not found:
            raise ValueError(f"no selected type has a field among {sorted(fields)}")
        return union(found)

    def term_stats(self, terms: Column, exact: Sequence[str] | None) -> None:
        """Not known before the tables are read."""
        return None


def spans(registry: Registry, mapping: DocumentMapping) -> bool:
    """Whether documents of this entity may be kept in several rows."""
    seen, todo = set(), [mapping]
    while todo:
        current = todo.pop()
        if current is None or current.full_name in seen:
            continue
        seen.add(current.full_name)
        for level in current.lineage:
            for given in level.fields.values():
                association = given.get("component") or given.get("reference")
                if isinstance(association, Many):
                    return True
                if given.get("component"):
                    todo.append(registry.get(association.target))
    return False


@dataclass
class IndexSpace:
    """Index tables on storage; index, type and term bucket prune the files that are read."""

    spark: SparkSession
    path: str
    registry: Registry
    indices: list[str] | None = None
    types: list[str] | None = None

    @classmethod
    def over(cls, spark, path, registry: Registry, indices=None, types=None) -> IndexSpace:
        chosen = registry.resolve_indices(indices), registry.resolve_types(types)
        return cls(spark, path, registry, *chosen)

    def only(self, mapping: DocumentMapping) -> IndexSpace:
        """The same index, narrowed to one entity."""
        return type(self).over(self.spark, self.path, self.registry, self.registry.index_of(mapping), mapping)

    def known_fields(self) -> list[tuple[str, SearchField]]:
        """The fields the index was written with: as many rows as the mappings have fields."""
        rows = self._fields().collect()
        return [
            (r["type"], SearchField(r["path"], r["analyzer"], r["boost"], r["in_all"], r["kind"]))
            for r in rows
            if (self.types is None or r["type"] in self.types)
            and (self.indices is None or r["index"] in self.indices)
        ]

    def _fields(self) -> DataFrame:
        return read_index_table(self.spark, self.path, "fields")

    def buckets(self) -> int:
        return bucket_count(self.spark, self.path)

    def typed(self, mapping: DocumentMapping) -> DataFrame:
        """Documents of one entity with their fields as columns of ``source``."""
        return self.spark.read.parquet(f"{self.path}/typed/{mapping.type_name}")

    def entity(self, mapping: DocumentMapping) -> DataFrame:
        """The entity's mapped fields plus ``index, type, id``."""
        own = self.typed(mapping).where(is_first(F.col("part")))
        return own.select(*DOC, F.col("source").alias("row"))

    def _table(self, name: str) -> DataFrame:
        return self._chosen(read_index_table(self.spark, self.path, name))

    def _chosen(self, table: DataFrame) -> DataFrame:
        if self.indices is not None:
            table = table.where(F.col("index").isin(self.indices))
        if self.types is not None:
            table = table.where(F.col("type").isin(self.types))
        return table

    def documents(self) -> DataFrame:
        return self._table("docs").select(*ROW, "source")

    def keys(self) -> DataFrame:
        return self._table("docs").where(is_first(F.col("part"))).select(*DOC)

    def count(self) -> DataFrame:
        return self._table("index_stats").agg(F.sum("num_docs").alias("num_docs"))

    def where(self, column: str, condition) -> DataFrame | None:
        """Keys of documents whose typed field satisfies ``condition``; a scan of that column."""
        kinds = {type_name: f.kind for type_name, f in self.known_fields() if f.path == column}
        found = []
        for mapping in self.registry.roots():
            if mapping.type_name in kinds:
                value = F.col(f"source.{column}")
                if kinds[mapping.type_name] in DATE_KINDS:
                    value = date_in(value)
                    if kinds[mapping.type_name] == "timestamp":
                        value = F.convert_timezone(F.lit("UTC"), F.current_timezone(), value).cast("timestamp")
                found.append(self.typed(mapping).where(condition(value)).select(*DOC))
        return union(found).distinct() if found else None

    def term_rows(self, terms, fields, exact, positions) -> DataFrame:
        rows = self._bucket(self._table("postings"), exact)
        rows = rows.where(F.col("field").isin(sorted(fields)) & terms)
        if exact is None:
            # which terms fit is looked up in the far smaller dictionary; its buckets prune the scan
            place = ["bucket", "field", "term"]
            fitting = self._table("term_stats").where(terms).select(*place).distinct()
            rows = rows.join(broadcast_if_small(fitting), place, "left_semi")
        return rows.select(*_term_columns(positions))

    def vocabulary_rows(self, field: str, vocabulary: DataFrame) -> DataFrame:
        """Postings of one field for the terms of a table, with its other columns. Each term stands there once.
        Joined by bucket as well, so that a vocabulary small enough to be sent to all tasks also says which
        buckets are read at all."""
        buckets = self.buckets()
        # the comparison lets Spark expect that the vocabulary leaves something out
        wanted = vocabulary.where(F.length("term") > 0).withColumn("bucket", bucket_of(F.col("term"), buckets))
        return self._asked(field, wanted).select(*_term_columns(False), *(c for c in vocabulary.columns if c != "term"))

    def _asked(self, field: str, wanted: DataFrame) -> DataFrame:
        # lists are opened after the join: what is shuffled, if anything, is blocks
        blocks = self._chosen(read_blocks(self.spark, self.path)).where(F.col("field") == field)
        more = [c for c in wanted.columns if c not in ("bucket", "term")]
        return opened(blocks.join(wanted, ["bucket", "term"]), *more)

    def term_stats(self, terms, exact) -> DataFrame:
        rows = self._bucket(self._table("term_stats"), exact).where(terms)
        return rows.groupBy("type", "field", "term").agg(F.sum("df").alias("df"))

    def _bucket(self, table: DataFrame, exact: Sequence[str] | None) -> DataFrame:
        """Only the partitions that can hold the terms, and within them the row groups."""
        if not exact:
            return table
        buckets = self.buckets()
        wanted = [bucket_of(F.lit(term), buckets) for term in exact]
        return table.where(F.col("bucket").isin(wanted) & F.col("term").isin(list(exact)))


def _term_columns(positions: bool) -> list[str]:
    return [*ROW, "field", "term", "tf", "len", "boost", *(["positions"] if positions else [])]


Space = TableSpace | IndexSpace
