"""Entity rows and their associations -> nested documents.

A document row is ``(index, type, id, part, source)``. ``part`` is 0 for a document that fits
one row. An owner with more than ``Settings.max_children`` nested children is stored as several
rows: the one with ``part`` FIRST_PART holds its own fields, each other holds a share of the
children, so no task ever assembles an unbounded group, no child is dropped, and nothing is
held twice. Equal children are counted before they are dealt out, so that many of them do not
land in one share.

All to-many fields of an owner are gathered by one shuffle on the owner's key; to-one fields
are equi-joins whose strategy Spark picks by size.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.functions.converters import date_out
from docsearch.plans.mapping import DocumentMapping, Field, Many, One, Registry, check_endless, tighter

Tables = Mapping[str, DataFrame]

PART = "__part"
FIRST = "__first"
COPIES = "__copies"
#: the row of a document in several that holds what is not a share of its children
FIRST_PART = 1
OWNER = "__owner"
CHILD = "__child"
WEIGHT = "__weight"

STUB = T.StructType([T.StructField("id", T.StringType()), T.StructField("class", T.StringType())])


@dataclass(frozen=True)
class Hop:
    """How the walk reached an entity: its owner, and the association that was followed."""

    owner: DocumentMapping
    via: One | Many
    #: full names from the root down to the owner
    path: tuple[str, ...]


def id_column(mapping: DocumentMapping) -> Column:
    """The document id: the key as text, the parts of a composite key joined by ``_``.

    Inside a part ``_`` and ``\\`` are escaped, so different keys never share an id. A key with a
    null part is null, which no index takes.
    """
    keys = [F.col(k).cast("string") for k in mapping.keys]
    if len(keys) == 1:
        return keys[0]
    parts = [F.regexp_replace(k, r"([\\_])", r"\\$1") for k in keys]
    return F.concat(*[piece for part in parts for piece in (F.lit("_"), part)][1:])


def key_column(mapping: DocumentMapping) -> Column:
    return F.col(mapping.keys[0]) if len(mapping.keys) == 1 else id_column(mapping)


def build_documents(registry: Registry, tables: Tables, entity: str | DocumentMapping) -> DataFrame:
    """Documents of one root entity: ``(index, type, id, part, source)``."""
    mapping = registry.require(entity)
    if not mapping.root:
        raise ValueError(f"{mapping.full_name} is not a root entity")
    fields = registry.compile(mapping, tables[mapping.full_name].schema)
    rows = _with_associations(registry, tables, mapping, fields, hop=None, depth=None)
    return rows.select(
        F.lit(registry.index_of(mapping)).alias("index"),
        F.lit(mapping.type_name).alias("type"),
        id_column(mapping).alias("id"),
        F.col(PART).alias("part"),
        F.struct(*_held_once(fields)).alias("source"),
    )


def is_first(part: Column) -> Column:
    """Whether a row is the only one of its document or the one with the document's own fields."""
    return part.isin(0, FIRST_PART)


def select_mapped(registry: Registry, tables: Tables, entity: str | DocumentMapping) -> DataFrame:
    """``id`` and the mapped plain columns as they are: the scan reads nothing else."""
    mapping = registry.require(entity)
    table = tables[mapping.full_name]
    fields = [f for f in registry.compile(mapping, table.schema) if f.association is None]
    return table.select(id_column(mapping).alias("id"), *[f.name for f in fields])


def as_json(documents: DataFrame) -> DataFrame:
    """Documents with ``source`` as JSON text; null fields stay visible as null."""
    return documents.withColumn("source", F.to_json("source", {"ignoreNullFields": "false"}))


def scalar_column(field: Field) -> Column:
    """Document value of a plain column: converted, normalised date, or as it is."""
    value = F.col(f"`{field.name}`")
    if field.converter is not None:
        return field.converter.out(value)
    if field.is_date:
        if isinstance(field.data_type, T.ArrayType):
            zoned = isinstance(field.data_type.elementType, T.TimestampType)
            return F.transform(value, lambda item: date_out(item, zoned))
        return date_out(value, isinstance(field.data_type, T.TimestampType))
    return value


def _field_columns(fields: list[Field]) -> list[Column]:
    return [
        (F.col(f"`{f.name}`") if f.association else scalar_column(f)).alias(f.name) for f in fields
    ]


def _held_once(fields: list[Field]) -> list[Column]:
    """The columns of an entity, of which plain ones and references stand in its first row alone."""
    columns = _field_columns(fields)
    if not any(f.component for f in fields):
        return columns
    return [
        c if f.component else F.when(F.col(FIRST), c).alias(f.name) for f, c in zip(fields, columns, strict=True)
    ]


def _with_associations(registry, tables, mapping, fields, hop, depth) -> DataFrame:
    """The entity's own rows plus one column per association field, and ``__part``.

    ``depth`` is how many more component levels may be nested, None for as many as there are; each
    field may bring a tighter limit of its own.
    """
    path = (*(hop.path if hop else ()), mapping.full_name)
    rows = tables[mapping.full_name].withColumn(PART, F.lit(0).cast("long")).withColumn(FIRST, F.lit(True))
    joined: list[Field] = []
    pieces: list[tuple[Field, DataFrame]] = []
    for field in fields:
        if field.association is None:
            continue
        room = tighter(depth, field.max_depth)
        if field.reference is not None:
            if isinstance(field.reference, One):
                rows = rows.withColumn(
                    field.name, _reference(field.reference, nested=hop is not None)
                )
            else:
                pieces.append((field, _reference_rows(registry, tables, mapping, field.reference)))
        elif _is_back_reference(mapping, field.component, hop):
            rows = rows.withColumn(field.name, _back_reference(field.component, hop))
        elif room is not None and room <= 0:
            nothing = F.lit(None).cast(STUB)
            if isinstance(field.component, Many):
                nothing = F.array().cast(T.ArrayType(STUB))
            rows = rows.withColumn(field.name, nothing)
        elif isinstance(field.component, One):
            rows = _join_one(registry, tables, rows, field, Hop(mapping, field.component, path), room, joined)
            joined.append(field)
        else:
            nested = _child_rows(registry, tables, Hop(mapping, field.component, path), room)
            pieces.append((field, nested))
    if pieces:
        rows = _join_many(registry, tables, rows, mapping, fields, pieces, depth, joined)
    return rows


def _united(rows: DataFrame, weight: Column, lead: Column, earlier: list[Field], added: list[str]) -> DataFrame:
    """Rows of an owner after a join that may have met several with several.

    A row stays if either side is the first of its own; what was there before stands in rows whose
    new side is first, and what was added in rows whose old side is.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    whole = rows.where(F.col(FIRST) | lead).withColumn("__lead", lead).withColumn("__old", F.col(FIRST))
    for name in [f.name for f in earlier] + added:
        keep = F.col("__old") if name in added else F.col("__lead")
        if isinstance(kinds[name], T.ArrayType):
            nothing = F.array().cast(kinds[name])
            whole = whole.withColumn(name, F.when(keep, F.coalesce(F.col(name), nothing)).otherwise(nothing))
        else:
            whole = whole.withColumn(name, F.when(keep, F.col(name)))
    first = F.col("__old") & F.col("__lead")
    label = (
        F.when((F.col(PART) == 0) & (weight == 0), F.lit(0).cast("long"))
        .when(first, F.lit(FIRST_PART).cast("long"))
        .otherwise(F.xxhash64(PART, weight))
    )
    return whole.withColumn(PART, label).withColumn(FIRST, first).drop("__lead", "__old")


# -- references and back-references ------------------------------------------------------


def _reference(reference: One, nested: bool) -> Column:
    parts = [F.col(reference.fk).alias("id")]
    if nested:
        parts.append(F.lit(reference.target).alias("class"))
    return F.when(F.col(reference.fk).isNotNull(), F.struct(*parts))


def _reference_rows(registry, tables, mapping, reference: Many) -> DataFrame:
    target = registry.require(reference.target)
    if reference.link is not None:
        pairs = tables[reference.link].select(
            F.col(reference.fk).alias(OWNER), F.col(reference.link_key).alias("id")
        )
    else:
        pairs = tables[target.full_name].select(
            F.col(reference.fk).alias(OWNER), key_column(target).alias("id")
        )
    # a to-many association is a set; the map side of ``distinct`` drops repeats before the shuffle
    pairs = pairs.where(F.col(OWNER).isNotNull()).distinct()
    return pairs.select(OWNER, F.struct("id").alias(CHILD))


def _is_back_reference(mapping, association, hop: Hop | None) -> bool:
    """The child's to-one field that reads the very column the owner collected it by."""
    return (
        hop is not None
        and isinstance(association, One)
        and isinstance(hop.via, Many)
        and hop.via.link is None
        and association.target == hop.owner.full_name
        and association.fk == hop.via.fk
    )


def _back_reference(association: One, hop: Hop) -> Column:
    """``id`` and ``class`` of the owner, and the path up to it: one ``..`` for the entity, one
    for the collection that holds it, one for the owner."""
    return F.struct(
        F.col(association.fk).alias("id"),
        F.lit(hop.owner.full_name).alias("class"),
        F.lit("../../..").alias("ref"),
    )


# -- components --------------------------------------------------------------------------


def _nested(registry, tables, target_name: str, hop: Hop, room: int | None):
    """Rows of a nested entity with ``__child`` = ``{id, class, fields...}``."""
    target = registry.get(target_name)
    if target is None:
        return None, None
    check_endless(hop.path, target.full_name, room)
    fields = registry.compile(target, tables[target.full_name].schema)
    below = None if room is None else room - 1
    rows = _with_associations(registry, tables, target, fields, hop, below)
    several = any(f.component for f in fields)
    marked = F.lit(target.full_name)
    child = F.struct(
        key_column(target).alias("id"),
        # further shares of a large child name it, and are marked by having no class
        (F.when(F.col(FIRST), marked) if several else marked).alias("class"),
        *[c for f, c in zip(fields, _held_once(fields), strict=True) if f.name != "id"],
    )
    return target, rows.withColumn(CHILD, child)


def _join_one(registry, tables, rows, field: Field, hop: Hop, room, earlier: list[Field]) -> DataFrame:
    one = field.component
    target, nested = _nested(registry, tables, one.target, hop, room)
    if target is None:
        stub = F.struct(F.col(one.fk).alias("id"), F.lit(one.target).alias("class"))
        return rows.withColumn(field.name, F.when(F.col(one.fk).isNotNull(), stub))
    nested = nested.select(
        key_column(target).alias(OWNER),
        F.col(CHILD).alias(field.name),
        F.col(PART).alias(WEIGHT),
        F.col(FIRST).alias("__child_first"),
    )
    joined = rows.join(nested, rows[one.fk] == nested[OWNER], "left")
    lead = F.coalesce("__child_first", F.lit(True))
    united = _united(joined, F.coalesce(WEIGHT, F.lit(0)), lead, earlier, [field.name])
    return united.drop(OWNER, WEIGHT, "__child_first")


def _child_rows(registry, tables, hop: Hop, room) -> DataFrame:
    many = hop.via
    target, nested = _nested(registry, tables, many.target, hop, room)
    if many.link is None:
        return nested.select(F.col(many.fk).alias(OWNER), CHILD).where(F.col(OWNER).isNotNull())
    pairs = tables[many.link].select(
        F.col(many.fk).alias(OWNER), F.col(many.link_key).alias("__target")
    )
    nested = nested.select(key_column(target).alias("__key"), CHILD)
    return pairs.join(nested, F.col("__target") == F.col("__key")).select(OWNER, CHILD)


def _join_many(registry, tables, rows, mapping, fields, pieces, depth, earlier) -> DataFrame:
    """Gather every to-many field with one shuffle on the owner key, then join the owners."""
    schemas = {f.name: df.schema[CHILD].dataType for f, df in pieces}
    children = reduce(
        DataFrame.unionByName,
        [
            df.select(
                OWNER,
                *[
                    (F.col(CHILD) if name == f.name else F.lit(None).cast(kind)).alias(name)
                    for name, kind in schemas.items()
                ],
            )
            for f, df in pieces
        ],
    )
    sizes = _owner_sizes(registry, tables, mapping, fields, depth)
    large = sizes.where(F.col(WEIGHT) > registry.settings.max_children)
    if large.isEmpty():
        children = children.withColumn(PART, F.lit(0).cast("long")).withColumn(COPIES, F.lit(1))
        grouping = [OWNER]
    else:
        children = _dealt(children, large, schemas, registry.settings.max_children)
        grouping = [OWNER, PART]
    gathered = children.groupBy(*grouping).agg(
        *[_collect(name, kind, PART in grouping) for name, kind in schemas.items()],
        *([] if PART in grouping else [F.lit(0).cast("long").alias(PART)]),
    )
    if PART in grouping:
        # the row of a large owner that holds its own fields and no child
        alone = large.select(
            OWNER,
            F.lit(FIRST_PART).cast("long").alias(PART),
            *[F.array().cast(T.ArrayType(kind)).alias(name) for name, kind in schemas.items()],
        )
        gathered = gathered.unionByName(alone)
    gathered = gathered.withColumnRenamed(PART, WEIGHT)
    joined = rows.join(gathered, key_column(mapping) == F.col(OWNER), "left")
    weight = F.coalesce(WEIGHT, F.lit(0))
    return _united(joined, weight, is_first(weight), earlier, list(schemas)).drop(OWNER, WEIGHT)


def _dealt(children: DataFrame, large: DataFrame, schemas: dict[str, T.DataType], most: int) -> DataFrame:
    """Children with the share of their owner they belong to, and how many equal ones a row stands for.

    The children of a large owner are counted by content where they lie; a count beyond ``most`` is
    cut into several, and each piece goes to a share by its content, so that a task run again sends
    it to the same one.
    """
    shares = large.select(
        F.col(OWNER).alias("__large"), F.ceil(F.col(WEIGHT) / most).cast("long").alias("__shares")
    )
    marked = children.join(shares, F.col(OWNER) == F.col("__large"), "left")
    few = marked.where("__shares is null").select(
        OWNER, *schemas, F.lit(0).cast("long").alias(PART), F.lit(1).alias(COPIES)
    )
    many = marked.where("__shares is not null")
    spread = F.xxhash64(*[F.to_json(n) if _has_map(kind) else F.col(n) for n, kind in schemas.items()])
    if any(_has_map(kind) for kind in schemas.values()):  # no equality, so no counting
        counted = many.withColumn("__n", F.lit(1).cast("long"))
    else:
        counted = many.groupBy(OWNER, *schemas, "__shares").agg(F.count(F.lit(1)).alias("__n"))
    pieces = counted.select(
        "*", spread.alias("__spread"), F.explode(F.expr(f"sequence(0L, (__n - 1) DIV {most})")).alias("__piece")
    )
    dealt = pieces.select(
        OWNER,
        *schemas,
        (F.pmod(F.col("__spread") + F.col("__piece"), F.col("__shares")) + FIRST_PART + 1).alias(PART),
        F.least(F.lit(most), F.col("__n") - F.col("__piece") * most).cast("int").alias(COPIES),
    )
    return few.unionByName(dealt)


def _collect(name: str, kind: T.DataType, copied: bool) -> Column:
    """Children of one owner in a stable order (maps have no order, so those stay as read)."""
    if copied:
        repeated = F.when(F.col(name).isNotNull(), F.array_repeat(F.col(name), F.col(COPIES)))
        items = F.flatten(F.collect_list(repeated))
    else:
        items = F.collect_list(name)
    return (items if _has_map(kind) else F.sort_array(items)).alias(name)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _owner_sizes(registry, tables, mapping, fields, depth) -> DataFrame:
    """``(owner, weight)``: how many entities are nested below each owner through its to-many
    fields. Reads key columns only."""
    parts = []
    for field in fields:
        many = field.association
        if not isinstance(many, Many):
            continue
        room = tighter(depth, field.max_depth)
        target = registry.require(many.target)
        if field.component is not None and room is not None and room <= 0:
            continue
        if field.reference is not None or many.link is not None:
            source = tables[many.link or target.full_name]
            parts.append(source.select(F.col(many.fk).alias(OWNER), F.lit(1).cast("long").alias(WEIGHT)))
            continue
        source = tables[target.full_name]
        below = registry.compile(target, source.schema)
        owned = source.select(F.col(many.fk).alias(OWNER), key_column(target).alias(CHILD))
        deeper = [f for f in below if isinstance(f.association, Many)]
        if deeper and (room is None or room > 1):
            inner = _owner_sizes(registry, tables, target, below, None if room is None else room - 1)
            inner = inner.select(F.col(OWNER).alias("__inner"), WEIGHT)
            owned = owned.join(inner, F.col(CHILD) == F.col("__inner"), "left")
            weight = F.lit(1) + F.coalesce(WEIGHT, F.lit(0))
        else:
            weight = F.lit(1).cast("long")
        parts.append(owned.select(OWNER, weight.cast("long").alias(WEIGHT)))
    return (
        reduce(DataFrame.unionByName, parts)
        .where(F.col(OWNER).isNotNull())
        .groupBy(OWNER)
        .agg(F.sum(WEIGHT).alias(WEIGHT))
    )
