"""A written index that changes at the cost of the change.

An index is a list of segments, each a directory of index tables that is written once. A change
is a new segment: the fresh documents with their postings, the keys it takes out of earlier
segments (``gone``), and signed statistics, which is what the change adds to the counts of the
index and what it takes from them. A reader puts the live segments together: it joins documents
and postings against the later ``gone`` keys and sums the statistics.

Which segments are live, and which types of each, says a manifest. It is a few rows, and a new
version of it is one new file, so a reader sees a change whole or not at all, and a type or an
index is dropped without reading a row of it. Small segments are merged into one when there are
:data:`FAN` of a size, so there are as many as the logarithm of the number of changes, and a document
is written again as often as that; large segments stay as they are.

One job at a time may write; readers keep the version they began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docsearch.operators.documents import Tables, as_json, build_documents, is_first
from docsearch.operators.maintain import bulk_index, document_blocks, newest, reindex_owners, split_rejects
from docsearch.operators.postings import DOC, SearchField, block_term_stats, index_stats, postings, stored_term_stats
from docsearch.operators.sizes import BROADCAST_ROWS
from docsearch.operators.space import IndexSpace, union
from docsearch.plans.mapping import DocumentMapping, Registry
from docsearch.sources.index_tables import (
    BUCKETS,
    SCHEMAS,
    bucket_of,
    gathered_rows,
    opened,
    read_blocks,
    read_index_table,
    write_table,
)
from docsearch.sources.shared import put

MANIFEST = "number int, path string, index string, type string, docs long, gone long, buckets int, version long"
#: segments of about one size that are merged into one
FAN = 4
#: up to so many keys are named in the filter of a scan, which skips the row groups without them
POINT_KEYS = 256
#: the row that every manifest has, so that one without segments can be told from none
NOTHING = -1


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifests")


def live_partitions(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """The newest version and its rows, one per segment and type: read by the driver."""
    rows = _manifest(spark, path)
    version = rows.agg(F.max("version").alias("version")).first()["version"]
    held = rows.where(F.col("version") == version).collect()
    return version, sorted((r for r in held if r["number"] != NOTHING), key=lambda r: (r["number"], r["type"]))


def _publish(spark: SparkSession, path: str, version: int, rows: Iterable[Row]) -> None:
    own = [(r["number"], r["path"], r["index"], r["type"], r["docs"], r["gone"], r["buckets"]) for r in rows]
    own.append((NOTHING, "", "", "", 0, 0, 0))
    frame = spark.createDataFrame(own, MANIFEST.rsplit(",", 1)[0])
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifests/version={version}")


@dataclass
class SegmentSpace(IndexSpace):
    """One version of a segmented index, to search like any other space."""

    live: list[Row] = field(default_factory=list)
    _known: list[tuple[str, SearchField]] | None = None

    @classmethod
    def over(cls, spark, path, registry: Registry, indices=None, types=None) -> SegmentSpace:
        chosen = registry.resolve_indices(indices), registry.resolve_types(types)
        return cls(spark, path, registry, *chosen, live=live_partitions(spark, path)[1])

    def _partitions(self) -> list[Row]:
        return [
            r
            for r in self.live
            if (self.types is None or r["type"] in self.types)
            and (self.indices is None or r["index"] in self.indices)
        ]

    def segments(self) -> dict[int, list[Row]]:
        """The live partitions by number of their segment, oldest first."""
        found: dict[int, list[Row]] = {}
        for row in self._partitions():
            found.setdefault(row["number"], []).append(row)
        return dict(sorted(found.items()))

    def buckets(self) -> int:
        return self.live[0]["buckets"] if self.live else BUCKETS

    def _fields(self) -> DataFrame:
        paths = sorted({r["path"] for r in self.live if r["docs"]})
        parts = [read_index_table(self.spark, p, "fields") for p in paths]
        return union(parts).distinct() if parts else self._nothing("fields")

    def _nothing(self, name: str) -> DataFrame:
        nothing = self.spark.createDataFrame([], SCHEMAS[name])
        return opened(nothing) if name == "postings" else nothing

    def _part(self, rows: list[Row], name: str) -> DataFrame:
        """One table of one segment, with its live partitions only."""
        table = read_index_table(self.spark, rows[0]["path"], name)
        return table.where(_of_partitions(rows))

    def _left(self, table: DataFrame, number: int, kind: str | None = None) -> DataFrame:
        """Rows of a segment whose documents no later one has taken out."""
        later = [
            r
            for n, rows in self.segments().items()
            for r in rows
            if n > number and r["gone"] and (kind is None or r["type"] == kind)
        ]
        if not later:
            return table
        by_path: dict[str, list[Row]] = {}
        for row in later:
            by_path.setdefault(row["path"], []).append(row)
        keys = union([self._part(rows, "gone").select(*DOC) for rows in by_path.values()])
        # how many there are is known without a job
        if sum(r["gone"] for r in later) <= BROADCAST_ROWS:
            keys = F.broadcast(keys.distinct())
        return table.join(keys, list(DOC), "left_anti")

    def _table(self, name: str) -> DataFrame:
        """One table over all segments. A segment that only takes documents out has none of its own."""
        held = {"docs": "docs", "postings": "docs", "gone": "gone"}.get(name)
        parts = []
        for number, rows in self.segments().items():
            rows = [r for r in rows if held is None or r[held]]
            if rows:
                part = self._part(rows, name)
                parts.append(self._left(part, number) if held == "docs" else part)
        return union(parts) if parts else self._nothing(name)

    def _asked(self, field: str, wanted: DataFrame) -> DataFrame:
        return self._table("postings").where(F.col("field") == field).join(wanted, ["bucket", "term"])

    def count(self) -> DataFrame:
        total = F.coalesce(F.sum("num_docs"), F.lit(0)).alias("num_docs")
        return self._table("index_stats").agg(total)

    def _typed_part(self, row: Row, keys: list[str] | None = None) -> DataFrame:
        found = self.spark.read.parquet(f"{row['path']}/typed/{row['type']}")
        return self._left(found if keys is None else found.where(F.col("id").isin(keys)), row["number"], row["type"])

    def typed(self, mapping: DocumentMapping, keys: list[str] | None = None) -> DataFrame:
        """Documents of one entity with their fields as columns of ``source``; with ``keys``, those
        of a few ids, for which the scans skip what cannot hold them."""
        rows = [r for r in self._partitions() if r["type"] == mapping.type_name and r["docs"]]
        if not rows:
            raise ValueError(f"the index holds no document of type {mapping.type_name}")
        parts = [self._typed_part(r, keys) for r in rows]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def where(self, column: str, condition) -> DataFrame | None:
        held = {r["type"] for r in self._partitions() if r["docs"]}
        if not any(t in held and f.path == column for t, f in self.known_fields()):
            return None
        return super().where(column, condition)

    def known_fields(self) -> list[tuple[str, SearchField]]:
        if self._known is None:
            held = {r["type"] for r in self._partitions() if r["docs"]}
            self._known = [(t, f) for t, f in super().known_fields() if t in held]
        return self._known


def _of_partitions(rows: list[Row]) -> Column:
    """Index and type of the partitions; Spark reads no other directories."""
    tests = [(F.col("index") == r["index"]) & (F.col("type") == r["type"]) for r in rows]
    return reduce(Column.__or__, tests)


class SegmentedIndex:
    """Writes to a segmented index below ``path``."""

    def __init__(self, spark: SparkSession, path: str, registry: Registry):
        self.spark, self.path, self.registry = spark, path, registry

    @classmethod
    def create(
        cls,
        registry: Registry,
        tables: Tables,
        path: str,
        entities: Iterable | None = None,
        buckets: int = BUCKETS,
    ) -> SegmentedIndex:
        """Index every row of the given root entities as the first segment."""
        spark = next(iter(tables.values())).sparkSession
        index, at = cls(spark, path, registry), f"{path}/segments/0"
        bulk_index(registry, tables, at, entities, buckets)
        docs = read_index_table(spark, at, "docs").where(is_first(F.col("part")))
        counts = docs.groupBy("index", "type").agg(F.count("*").alias("docs")).collect()
        _publish(spark, path, 0, [_live(0, at, buckets, r["index"], r["type"], r["docs"], 0) for r in counts])
        return index

    def space(self, indices=None, types=None) -> SegmentSpace:
        return SegmentSpace.over(self.spark, self.path, self.registry, indices, types)

    # changes

    def put(
        self,
        tables: Tables,
        entity: str | DocumentMapping,
        typed: DataFrame,
        removed: DataFrame | None = None,
        version: int = 1,
    ) -> None:
        """Put typed documents of one entity in, replacing those of the same key, and take out what
        ``removed`` names ``(index, type, id)``. Of several documents with one key one counts; rows
        without a key go to ``rejects`` of the segment."""
        mapping = self.registry.require(entity)
        at = self._fresh()
        good, bad = split_rejects(typed, {"no id": F.col("id").isNull()})
        # in the order of their ids, so that a few can be looked up without reading the others
        put(newest(good).repartitionByRange("id").sortWithinPartitions("id"), f"{at}/typed/{mapping.type_name}")
        write_table(as_json(bad), at, "rejects")
        fresh = self.spark.read.parquet(f"{at}/typed/{mapping.type_name}")
        write_table(as_json(fresh).withColumn("version", F.lit(version).cast("long")), at, "docs")
        blocks = document_blocks(self.registry, tables, mapping, fresh, self.space().buckets())
        keys = fresh.select(*DOC)
        named = keys if removed is None else keys.union(removed.select(*DOC))
        self._write_change(at, blocks, named)

    def put_owners(
        self, tables: Tables, entity: str | DocumentMapping, owners: DataFrame, children: dict[str, str]
    ) -> None:
        """Documents of ``owners`` as the tables now have them; an owner that is gone leaves the index."""
        mapping = self.registry.require(entity)
        typed = reindex_owners(self.registry, tables, mapping, owners, children)
        self.put(tables, mapping, typed, _named(self.registry, mapping, owners.select(F.col("owner").alias("id"))))

    def put_rows(self, tables: Tables, entity: str | DocumentMapping, version: int = 1) -> None:
        """Documents of all rows of the entity's table in ``tables``: the changed rows alone."""
        mapping = self.registry.require(entity)
        self.put(tables, mapping, build_documents(self.registry, tables, mapping), version=version)

    def remove(self, keys: DataFrame) -> None:
        """Take out the documents ``keys`` names ``(index, type, id)``."""
        self._write_change(self._fresh(), None, keys.select(*DOC))

    def _fresh(self) -> str:
        return f"{self.path}/segments/{uuid.uuid4().hex}"

    def _write_change(self, at: str, blocks: DataFrame | None, named: DataFrame) -> None:
        """The tables of a segment whose documents, if it has any, are written already."""
        version, live = live_partitions(self.spark, self.path)
        spark = self.spark
        space = SegmentSpace(spark, self.path, self.registry, live=live)
        buckets = space.buckets()
        write_table(named.where(F.col("id").isNotNull()).distinct(), at, "gone")
        gone = read_index_table(spark, at, "gone")
        out = {(r["index"], r["type"]): r["n"] for r in gone.groupBy("index", "type").agg(F.count("*").alias("n")).collect()}
        more, terms, counts = {}, [], []
        if blocks is not None:
            write_table(space._fields().coalesce(1), at, "fields")
            write_table(blocks, at, "postings", gathered=False)
            split = not read_index_table(spark, at, "docs").where(F.col("part") != 0).isEmpty()
            terms.append(block_term_stats(read_blocks(spark, at), split))
            counts.append(index_stats(read_index_table(spark, at, "docs")))
            more = {(r["index"], r["type"]): r["num_docs"] for r in counts[0].collect()}
        held = {r["type"] for r in live if r["docs"]}
        for (index, kind), n in out.items():
            mapping = next((m for m in self.registry.roots() if m.type_name == kind), None)
            if mapping is None or kind not in held:
                continue
            own = gone.where((F.col("index") == index) & (F.col("type") == kind))
            few = [r["id"] for r in own.select("id").collect()] if n <= POINT_KEYS else None
            own = F.broadcast(own) if n <= BROADCAST_ROWS else own
            old = space.typed(mapping, few).join(own, list(DOC), "left_semi")
            fields = [f for t, f in space.known_fields() if t == kind]
            found = postings(old, fields, any(f.in_all for f in fields), positions=False)
            terms.append(stored_term_stats(found).withColumn("df", -F.col("df")))
            counts.append(index_stats(old).withColumn("num_docs", -F.col("num_docs")))
        if not terms:
            terms, counts = [space._nothing("term_stats").drop("bucket")], [space._nothing("index_stats")]
        _write_statistics(terms, counts, at, buckets)
        number = 1 + max((r["number"] for r in live), default=0)
        own_rows = [
            _live(number, at, buckets, *key, more.get(key, 0), out.get(key, 0)) for key in sorted({*out, *more})
        ]
        _publish(spark, self.path, version + 1, [*live, *own_rows])

    # drops

    def drop_types(self, entities: Iterable | None = None) -> None:
        """Take whole types out; all root types when none is named. No document is read."""
        dropped = {m.type_name for m in self.registry.roots(entities)}
        self._keep(lambda r: r["type"] not in dropped)

    def drop_indices(self, targets: Iterable | None = None, everything: bool = False) -> None:
        """Take whole indices out, by name or by mapping. Naming none drops nothing; ``everything``
        has to be asked for. No document is read."""
        wanted = list(targets or [])
        names = {t.lower() for t in wanted if isinstance(t, str)}
        names |= {self.registry.index_of(m) for m in wanted if not isinstance(m, str) and self.registry.get(m)}
        self._keep(lambda r: not everything and r["index"] not in names)

    def _keep(self, wanted) -> None:
        version, live = live_partitions(self.spark, self.path)
        kept = [r for r in live if wanted(r)]
        if len(kept) < len(live):
            _publish(self.spark, self.path, version + 1, kept)

    # merging

    def merge(self, fan: int = FAN) -> int:
        """Merge the newest segments while ``fan`` of them are of a size or smaller; gives how many
        merges there were. Older and larger segments are not touched."""
        merges = 0
        while chosen := _to_merge(self.space().segments(), fan):
            self._merged(chosen)
            merges += 1
        return merges

    def compact(self) -> None:
        """Merge all segments into one."""
        numbers = list(self.space().segments())
        if len(numbers) > 1:
            self._merged(numbers)

    def _merged(self, numbers: list[int]) -> None:
        version, live = live_partitions(self.spark, self.path)
        spark, at = self.spark, self._fresh()
        chosen = [r for r in live if r["number"] in numbers]
        rest = [r for r in live if r["number"] not in numbers]
        own = SegmentSpace(spark, self.path, self.registry, live=chosen)
        buckets = own.buckets()
        write_table(own._table("docs"), at, "docs")
        write_table(gathered_rows(own._table("postings")), at, "postings", gathered=False)
        # what lies before the merged segments may still hold documents they take out
        before = any(r["number"] < min(numbers) for r in rest)
        gone = own._table("gone").distinct()
        write_table(gone if before else gone.limit(0), at, "gone")
        write_table(own._fields().coalesce(1), at, "fields")
        paths = sorted({r["path"] for r in chosen if r["docs"]})
        rejects = [read_index_table(spark, p, "rejects") for p in paths]
        write_table(union(rejects) if rejects else own._nothing("rejects"), at, "rejects")
        for kind in sorted({r["type"] for r in chosen if r["docs"]}):
            mapping = next(m for m in self.registry.roots() if m.type_name == kind)
            typed = own.typed(mapping).repartitionByRange("id").sortWithinPartitions("id")
            put(typed, f"{at}/typed/{kind}")
        _write_statistics([own._table("term_stats").drop("bucket")], [own._table("index_stats")], at, buckets)
        docs = index_stats(read_index_table(spark, at, "docs"))
        held = docs.select("index", "type", F.col("num_docs").alias("docs"), F.lit(0).cast("long").alias("gone"))
        out = read_index_table(spark, at, "gone").groupBy("index", "type").agg(F.count("*").alias("gone"))
        both = held.union(out.select("index", "type", F.lit(0).cast("long"), "gone"))
        sums = both.groupBy("index", "type").agg(F.sum("docs").alias("docs"), F.sum("gone").alias("gone")).collect()
        now = [_live(max(numbers), at, buckets, r["index"], r["type"], r["docs"], r["gone"]) for r in sums]
        _publish(spark, self.path, version + 1, [*rest, *now])


def _live(number: int, path: str, buckets: int, index: str, type_name: str, docs: int, gone: int) -> Row:
    return Row(number=number, path=path, index=index, type=type_name, docs=docs, gone=gone, buckets=buckets)


def _named(registry: Registry, mapping: DocumentMapping, ids: DataFrame) -> DataFrame:
    return ids.select(
        F.lit(registry.index_of(mapping)).alias("index"),
        F.lit(mapping.type_name).alias("type"),
        F.col("id").cast("string").alias("id"),
    )


def _write_statistics(of_terms: list[DataFrame], of_docs: list[DataFrame], at: str, buckets: int) -> None:
    """Signed statistics, summed; what adds up to nothing is left out."""
    terms, counts = union(of_terms), union(of_docs)
    terms = terms.groupBy("index", "type", "field", "term").agg(F.sum("df").alias("df")).where("df <> 0")
    write_table(terms.withColumn("bucket", bucket_of(F.col("term"), buckets)), at, "term_stats")
    counts = counts.groupBy("index", "type").agg(F.sum("num_docs").alias("num_docs")).where("num_docs <> 0")
    write_table(counts, at, "index_stats")


def _tier(rows: list[Row], fan: int) -> int:
    size, tier = sum(r["docs"] + r["gone"] for r in rows), 0
    while size >= fan:
        size, tier = size // fan, tier + 1
    return tier


def _to_merge(segments: dict[int, list[Row]], fan: int) -> list[int]:
    """Numbers of the newest segments that are no larger than a tier, if there are ``fan`` of them."""
    tiers = {number: _tier(rows, fan) for number, rows in segments.items()}
    for most in sorted(set(tiers.values())):
        newest_ones: list[int] = []
        for number in sorted(tiers, reverse=True):
            if tiers[number] > most:
                break
            newest_ones.append(number)
        if len(newest_ones) >= fan:
            return newest_ones
    return []
