"""Hits and stored documents -> typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.functions.converters import Converter, date_in
from docsearch.operators.documents import Tables, id_column
from docsearch.plans.mapping import DocumentMapping, Registry
from docsearch.settings import Settings


def known_hits(registry: Registry, hits: DataFrame) -> DataFrame:
    """Hits of mapped types; hits of a type nobody maps are dropped."""
    return hits.where(F.col("type").isin([m.type_name for m in registry.mappings.values()]))


def hydrate(
    registry: Registry, tables: Tables, hits: DataFrame, entity: str | DocumentMapping
) -> DataFrame:
    """Hits of one entity joined to its rows: every entity column, plus ``score``. A simple key
    is compared in its own type, so the join can use the table's layout."""
    mapping = registry.require(entity)
    table = tables[mapping.full_name]
    mine = known_hits(registry, hits).where(F.col("type") == mapping.type_name)
    if len(mapping.keys) == 1:
        key = mapping.keys[0]
        typed = F.col("id").try_cast(table.schema[key].dataType)
        found = mine.select(typed.alias("__hit"), "score").where(F.col("__hit").isNotNull())
        return table.join(found, table[key] == found["__hit"]).drop("__hit")
    found = mine.select(F.col("id").alias("__hit"), "score")
    return table.join(found, id_column(mapping) == F.col("__hit")).drop("__hit")


def parse_documents(
    documents: DataFrame,
    schema: T.StructType,
    components: bool | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """JSON ``source`` back to columns. With ``components`` off (by default as ``settings`` say), nested objects stay raw maps of
    texts and collections of them arrays of such maps."""
    if components is None:
        components = (settings or Settings()).unmarshall_components
    wanted = schema if components else T.StructType([_raw(f) for f in schema.fields])
    parsed = documents.withColumn("__doc", F.from_json("source", wanted))
    return parsed.select("id", *[F.col(f"__doc.`{f.name}`").alias(f.name) for f in wanted])


def _raw(field: T.StructField) -> T.StructField:
    raw = T.MapType(T.StringType(), T.StringType())
    kind = field.dataType
    if isinstance(kind, T.StructType):
        return T.StructField(field.name, raw)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return T.StructField(field.name, T.ArrayType(raw))
    return field


def component_rows(documents: DataFrame, collection: str, keep: Sequence[str] = ("id",)) -> DataFrame:
    """One row per item of a nested collection, with its place; null items are dropped, and a
    document without items keeps one row with a null item."""
    items = F.filter(F.col(collection), lambda item: item.isNotNull())
    return documents.select(*keep, F.posexplode_outer(items).alias("pos", "item"))


def resolve_reference(
    owners: DataFrame, reference: Column, target: DataFrame, target_id: str, columns: Sequence[str]
) -> DataFrame:
    """Owners with ``columns`` of what they refer to, by one left join; null when the target
    is missing. For a collection of references, explode it with :func:`component_rows` first."""
    wanted = target.select(F.col(target_id).alias("__target"), *columns)
    return owners.withColumn("__ref", reference).join(
        wanted, F.col("__ref") == F.col("__target"), "left"
    ).drop("__ref", "__target")


def resolve_back_reference(
    items: DataFrame, marker: str, owner_id: Column, owner_class: str, levels: int = 3
) -> DataFrame:
    """Replace a ``{id, class, ref}`` marker by the owner it points at. ``ref`` has one ``..``
    per level; a path of another length points elsewhere and gives null."""
    path = "/".join([".."] * levels)
    points_up = (F.col(f"{marker}.ref") == path) & (F.col(f"{marker}.class") == owner_class)
    owner = F.struct(owner_id.alias("id"), F.lit(owner_class).alias("class"))
    return items.withColumn(marker, F.when(points_up, owner))


def convert_in(documents: DataFrame, column: str, converter: Converter) -> DataFrame:
    return documents.withColumn(column, converter.into(F.col(column)))


def parse_dates(
    documents: DataFrame,
    column: str,
    formats: Sequence[str] | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """A text column as timestamps, by ``formats`` or those of ``settings``."""
    chosen = formats or (settings or Settings()).date_formats
    return documents.withColumn(column, date_in(F.col(column), chosen))


def structural_errors(registry: Registry, entity: str | DocumentMapping, schema: T.StructType) -> dict[str, Column]:
    """Conditions under which a stored JSON document does not fit its mapping, by reason: a
    reference that is not an object, or an object with a class where no component is mapped."""
    mapping = registry.require(entity)
    checks: dict[str, Column] = {}
    for f in registry.compile(mapping, schema):
        raw = F.get_json_object("source", f"$.{f.name}")
        is_object = raw.startswith("{") | raw.startswith("[")
        if f.reference is not None:
            checks[f"{f.name}: reference is not an object"] = raw.isNotNull() & ~is_object
        elif f.component is None:
            nested = F.get_json_object("source", f"$.{f.name}.class")
            checks[f"{f.name}: not mapped as component"] = nested.isNotNull()
    return checks
