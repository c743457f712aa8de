"""What is searchable and how: mappings, their validation and their registry.

Everything here is small and lives on the driver. A mapping is compiled against the schema
of its entity table into a list of :class:`Field`, which the operators turn into columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from docsearch.functions.analyzers import analyzer
from docsearch.functions.converters import Converter
from docsearch.functions.naming import index_name, property_name, type_name
from docsearch.settings import Settings

# The options a field may carry, and the ways a field can be indexed.
FIELD_OPTIONS = (
    "boost", "index", "analyzer",
    "component", "converter", "reference", "excludeFromAll", "maxDepth",
)
INDEX_MODES = ("analyzed", "not_analyzed", "no")

# Index type of each column type; anything else is an object.
INDEX_TYPES = {
    T.StringType: "string",
    T.IntegerType: "integer",
    T.LongType: "long",
    T.ShortType: "short",
    T.ByteType: "byte",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.TimestampType: "date",
    T.TimestampNTZType: "date",
}


@dataclass(frozen=True)
class One:
    """A to-one association: the owner's column ``fk`` holds the target's key."""

    target: str
    fk: str


@dataclass(frozen=True)
class Many:
    """A to-many association: ``fk`` holds the owner's key in the target's table, or in
    ``link``, a table of pairs whose ``link_key`` holds the target's key."""

    target: str
    fk: str
    link: str | None = None
    link_key: str | None = None


Association = One | Many


@dataclass(frozen=True)
class DocumentMapping:
    """Declaration for one entity.

    ``searchable`` False leaves the entity unmapped. ``only``/``except_`` narrow the columns,
    ``fields`` gives options per field name; association fields need not be columns.
    ``properties`` names the columns this level declares, which matters to entities that
    ``extends`` it (None: every column of the table).
    """

    full_name: str
    key: str | tuple[str, ...]
    searchable: bool = True
    only: str | Sequence[str] | None = None
    except_: str | Sequence[str] | None = None
    fields: dict[str, dict[str, Any]] = field(default_factory=dict)
    root: bool = True
    all: bool = True
    extends: DocumentMapping | None = None
    properties: tuple[str, ...] | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,) if isinstance(self.key, str) else tuple(self.key)

    @property
    def type_name(self) -> str:
        return type_name(self.full_name)

    @property
    def lineage(self) -> list[DocumentMapping]:
        """Ancestors first; an ancestor that is not searchable ends the walk."""
        chain = [self]
        while (above := chain[0].extends) is not None and above.searchable:
            chain.insert(0, above)
        return chain


@dataclass(frozen=True)
class Field:
    """One mapped field, with every option resolved."""

    name: str
    data_type: T.DataType | None
    index_type: str
    index: str = "analyzed"
    analyzer: str = "standard"
    boost: float = 1.0
    in_all: bool = True
    converter: Converter | None = None
    component: Association | None = None
    reference: Association | None = None
    #: how many levels of components may be nested below; None: as many as the mappings say
    max_depth: int | None = None

    @property
    def association(self) -> Association | None:
        return self.component or self.reference

    @property
    def is_date(self) -> bool:
        return self.index_type == "date"


def names(value: str | Iterable[str] | None) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def mapped_columns(mapping: DocumentMapping, schema: T.StructType, settings: Settings) -> list[str]:
    """The columns of ``schema`` that ``mapping`` makes searchable, in table order."""
    columns = schema.fieldNames()
    keep = [c for c in columns if c not in mapping.keys]
    inherited: set[str] = set()
    for level in mapping.lineage:
        only, dropped = names(level.only), names(level.except_)
        if only and dropped:
            raise ValueError(f"{level.full_name}: give either 'only' or 'except_', not both")
        for name in (*only, *dropped):
            if name not in columns and name not in level.fields:
                raise ValueError(f"{level.full_name}: unknown property {name!r}")
        if only:
            held = inherited if settings.always_inherit_properties else set()
            keep = [c for c in columns if c in only or (c in held and c in keep)]
        elif dropped:
            keep = [c for c in keep if c not in dropped]
        elif not level.fields and level is mapping:
            keep = [c for c in keep if c not in settings.default_excluded_properties]
        inherited.update(level.properties or ())
    explicit = {name for level in mapping.lineage for name, given in level.fields.items() if given}
    keys = [c for c in columns if c in mapping.keys and c in explicit]
    return keys + [c for c in keep if c not in keys]


def index_type_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.ArrayType):
        return index_type_of(data_type.elementType)
    return INDEX_TYPES.get(type(data_type), "object")


def _options(mapping: DocumentMapping) -> dict[str, dict[str, Any]]:
    merged: dict[str, dict[str, Any]] = {}
    for level in mapping.lineage:
        for name, given in level.fields.items():
            unknown = sorted(set(given) - set(FIELD_OPTIONS))
            if unknown:
                raise ValueError(f"{level.full_name}.{name}: invalid option {unknown[0]!r}")
            merged.setdefault(name, {}).update(given)
    return merged


def tighter(one: int | None, other: int | None) -> int | None:
    """The smaller of two depth limits, of which each may be missing."""
    return other if one is None else one if other is None else min(one, other)


def check_endless(path: Sequence[str], target: str, room: int | None) -> None:
    """An entity that nests itself needs a depth; without one it would never end."""
    if room is None and target in path:
        raise ValueError(f"{' > '.join([*path, target])} nests itself: give a maxDepth")


class Registry:
    """The mappings of an application, looked up by full name or by type name."""

    def __init__(self, mappings: Iterable[DocumentMapping], settings: Settings | None = None):
        self.settings = settings or Settings()
        self.mappings = {m.full_name: m for m in mappings if m.searchable}

    def get(self, entity: str | DocumentMapping) -> DocumentMapping | None:
        if isinstance(entity, DocumentMapping):
            return self.mappings.get(entity.full_name)
        if entity in self.mappings:
            return self.mappings[entity]
        wanted = [
            m
            for m in self.mappings.values()
            if entity in (m.type_name, property_name(m.full_name))
        ]
        return wanted[0] if len(wanted) == 1 else None

    def require(self, entity: str | DocumentMapping) -> DocumentMapping:
        found = self.get(entity)
        if found is None:
            raise ValueError(f"Unknown object type: {entity}")
        return found

    def roots(self, entities: Iterable[str | DocumentMapping] | None = None) -> list[DocumentMapping]:
        """Root mappings among ``entities`` (all when None); others are skipped."""
        asked = self.mappings.values() if entities is None else map(self.get, entities)
        return [m for m in asked if m is not None and m.root]

    def index_of(self, entity: str | DocumentMapping) -> str:
        full_name = self.require(entity).full_name
        return index_name(full_name, self.settings.index_names.get(full_name))

    def resolve_indices(self, targets) -> list[str] | None:
        """Index names from a name, a mapping or a mixed list; None means every index."""
        if not targets:
            return None
        chosen = [targets] if isinstance(targets, str | DocumentMapping) else list(targets)
        resolved = [t.lower() if isinstance(t, str) else self.index_of(t) for t in chosen]
        return sorted(set(resolved))

    def resolve_types(self, targets) -> list[str] | None:
        """Type names from names or mappings; None means every type, unknown is an error."""
        if not targets:
            return None
        chosen = [targets] if isinstance(targets, str | DocumentMapping) else list(targets)
        return sorted({self.require(t).type_name for t in chosen})

    def compile(self, entity: str | DocumentMapping, schema: T.StructType) -> list[Field]:
        """Validated fields of an entity over its table schema."""
        mapping = self.require(entity)
        options = _options(mapping)
        columns = mapped_columns(mapping, schema, self.settings)
        dropped = {n for level in mapping.lineage for n in names(level.except_)}
        only = names(mapping.only)
        associations = [
            name
            for name, given in options.items()
            if (given.get("component") or given.get("reference"))
            and name not in columns
            and name not in dropped
            and (not only or name in only)
        ]
        for name, given in options.items():
            association = given.get("component") or given.get("reference")
            if name not in schema.fieldNames() and not association:
                raise ValueError(f"{mapping.full_name} has options for {name!r}, which is no column")
        return [
            self._field(mapping, name, options.get(name, {}), schema)
            for name in [*columns, *associations]
        ]

    def _field(
        self, mapping: DocumentMapping, name: str, given: dict[str, Any], schema: T.StructType
    ) -> Field:
        where = f"{mapping.full_name}.{name}"
        component = given.get("component") or None
        reference = given.get("reference") or None
        if component and reference:
            raise ValueError(f"{where} is declared both nested and referenced; choose one")
        association = component or reference
        if association is not None and not isinstance(association, One | Many):
            raise ValueError(f"{where}: association must be One(...) or Many(...)")
        if reference:
            target = self.get(reference.target)
            if target is None:
                raise ValueError(f"{where}: reference to non-searchable {reference.target}")
            if not target.root:
                raise ValueError(f"{where}: reference to non-root {reference.target}")
        if isinstance(component, Many) and self.get(component.target) is None:
            raise ValueError(f"{where}: component needs a mapping of {component.target}")
        mode = given.get("index", "analyzed")
        if mode not in INDEX_MODES:
            raise ValueError(f"{where}: index must be one of {INDEX_MODES}")
        chosen = given.get("analyzer", "standard")
        analyzer(chosen)
        data_type = schema[name].dataType if name in schema.fieldNames() else None
        converter = given.get("converter")
        if association:
            kind = "object"
        elif converter is not None:
            kind = "string"
        else:
            kind = index_type_of(data_type)
        hidden = given.get("excludeFromAll", False)
        if not isinstance(hidden, bool):
            hidden = str(hidden).lower() == "yes"
        return Field(
            name=name,
            data_type=data_type,
            index_type=kind,
            index=mode,
            analyzer=chosen,
            boost=float(given.get("boost", 1.0)),
            in_all=kind != "object" and mapping.all and not hidden,
            converter=converter,
            component=component,
            reference=reference,
            max_depth=given.get("maxDepth"),
        )

    def mapping_rows(self, entity: str | DocumentMapping, schema: T.StructType) -> list[tuple]:
        """``(type, field, data_type, index, include_in_all, term_vector, boost)`` per field."""
        mapping = self.require(entity)
        rows = []
        for f in self.compile(mapping, schema):
            vectors = f.index_type == "string" and f.index == "analyzed"
            rows.append(
                (mapping.type_name, f.name, f.index_type, f.index, f.in_all, vectors, f.boost)
            )
            if f.association:
                rows.append((mapping.type_name, f"{f.name}.id", "long", "not_analyzed", False, False, 1.0))
                for part in ("class", "ref"):
                    rows.append((mapping.type_name, f"{f.name}.{part}", "string", "no", False, False, 1.0))
        return rows
