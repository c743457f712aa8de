"""Documents -> token tables.

A posting is ``(index, type, id, part, field, term, tf, len, boost, positions)``: how often and
where a term stands in a field, together with the length and boost of that field, so that
scoring needs no join with a length table. The pseudo-field ``_all`` holds the terms of every
included field, its ``tf`` weighted by the boost of the field they come from.

A document is one row, so its postings are made where that row is and nothing is shuffled to
index it. A task counts the terms of some rows together and gives them in the order of terms, so
that what is later sorted by term comes in long runs. To answer a question over tables, terms are filtered where the text is read, and only
the few that remain are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.functions.analyzers import analyzer, exploding
from docsearch.operators.documents import Tables, is_first
from docsearch.operators.sizes import broadcast_if_small
from docsearch.plans.clauses import ALL
from docsearch.plans.mapping import DocumentMapping, Field, Many, Registry, check_endless, tighter

DOC = ("index", "type", "id")
ROW = (*DOC, "part")
ALL_ANALYZER = "standard"
#: tokens whose terms are counted together, and rows of one batch of postings
TOKENS_AT_ONCE, POSTINGS_AT_ONCE = 2_000_000, 50_000
#: postings that a task puts together by document
PACKED_AT_ONCE = 500_000
POSTING = (
    "index string, type string, id string, part long, field string, term string, tf double, len int,"
    " boost double, positions array<int>"
)
BLOCK = (
    "index string, type string, field string, term string, boost double, ids array<string>, parts array<bigint>,"
    " tfs array<double>, lens array<int>, places array<array<int>>"
)
BLOCK_COLUMNS = ["index", "type", "field", "term", "boost", "ids", "parts", "tfs", "lens", "places"]
DATE_KINDS = ("date", "timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class SearchField:
    """A field as it is searched: its dotted path and how its value becomes terms."""

    path: str
    analyzer: str = "standard"
    boost: float = 1.0
    in_all: bool = True
    #: type of the values, by which a question's literal becomes the text of a term
    kind: str = "string"


def search_fields(
    registry: Registry,
    tables: Tables,
    entity: str | DocumentMapping,
    prefix: str = "",
    depth: int | None = None,
    path: tuple[str, ...] = (),
) -> list[SearchField]:
    """Every searchable path of an entity, component fields as ``field.child``. Hidden fields,
    plain objects and the ``class``/``ref`` markers give none."""
    mapping = registry.require(entity)
    found = []
    path = (*path, mapping.full_name)
    for f in registry.compile(mapping, tables[mapping.full_name].schema):
        name = prefix + f.name
        if f.association is not None:
            found += _association_fields(registry, tables, mapping, f, name, depth, path)
        elif f.index != "no" and f.index_type != "object":
            found.append(_plain_field(f, name))
    return found


def _plain_field(f: Field, path: str) -> SearchField:
    analysed = f.index == "analyzed" and f.index_type == "string"
    kind = f.data_type
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
    text = kind is None or f.converter is not None
    how = f.analyzer if analysed else "keyword"
    return SearchField(path, how, f.boost, f.in_all, "string" if text else kind.simpleString())


def _association_fields(registry, tables, mapping, f, name, depth, path) -> list[SearchField]:
    found = [SearchField(f"{name}.id", "keyword", 1.0, False)]
    target = registry.get(f.association.target)
    points_up = not isinstance(f.association, Many) and _points_up(registry, mapping, f)
    room = tighter(depth, f.max_depth)
    if f.component is None or target is None or points_up or (room is not None and room <= 0):
        return found
    check_endless(path, target.full_name, room)
    below = None if room is None else room - 1
    return found + search_fields(registry, tables, target, f"{name}.", below, path)


def _points_up(registry: Registry, mapping: DocumentMapping, f: Field) -> bool:
    """Whether a to-one field reads the column its target collects this entity by."""
    target = registry.get(f.association.target)
    if target is None:
        return False
    for level in target.lineage:
        for given in level.fields.values():
            up = given.get("component")
            if isinstance(up, Many) and (up.target, up.fk) == (mapping.full_name, f.association.fk):
                return True
    return False


def terms_of(value: Column, data_type: T.DataType, how: str) -> Column:
    """Array of terms of one field value; the items of an array follow each other."""
    analyse = analyzer(how)
    if isinstance(data_type, T.ArrayType):
        value = _some(value)  # an item that is null has no terms, and takes none from the others
        if how == "keyword":
            return F.transform(value, lambda item: item.cast("string"))
        return F.flatten(F.transform(value, lambda item: analyse(item.cast("string"))))
    return analyse(value.cast("string"))


def _some(items: Column) -> Column:
    return F.filter(items, lambda item: item.isNotNull())


def path_value(source: str, schema: T.StructType, path: str) -> tuple[Column, T.DataType]:
    """The value at a dotted path and its type. Through collections the values of all items are
    taken, as one flat array."""
    value, kind = F.col(source), schema
    for name in path.split("."):
        if name == "id":
            value = _whole_items(value, kind)
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.ArrayType):
                value, kind = F.flatten(_some(value)), kind.elementType
            value, kind = value.getField(name), T.ArrayType(kind.elementType[name].dataType)
        else:
            value, kind = value.getField(name), kind[name].dataType
    while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        value, kind = F.flatten(_some(value)), kind.elementType
    return value, kind


def _whole_items(value: Column, kind: T.DataType) -> Column:
    """Nested entities without the further shares of large ones, which have no class."""
    item = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if not isinstance(item, T.StructType) or "class" not in item.fieldNames() or item.fieldNames()[0] != "id":
        return value
    if isinstance(kind, T.ArrayType):
        return F.filter(value, lambda x: x.getField("class").isNotNull())
    return F.when(value.getField("class").isNotNull(), value)


def tokens(documents: DataFrame, fields: Sequence[SearchField], with_all: bool = False) -> DataFrame:
    """``(index, type, id, part, field, term, pos, weight, len, boost)``: one row per token. For
    callers that keep few tokens and shuffle those alone."""
    wanted = _present(documents, fields)
    analysed, arrays, included = _analysed(documents, wanted, with_all)
    runs = [
        _run(f.path, name, F.lit(1.0), F.lit(0), F.size(name), f.boost)
        for name, f in arrays.items()
    ]
    if included:
        total = sum((F.size(name) for name, _ in included), F.lit(0))
        base = F.lit(0)
        for name, f in included:
            runs.append(_run(ALL, name, F.lit(f.boost), base, total, 1.0))
            base = base + F.size(name)
    run = runs[0] if len(runs) == 1 else F.explode(F.array(*runs))
    # the terms leave the struct before they are exploded, so that no row carries all of them
    flat = analysed.select(*ROW, run.alias("run")).select(*ROW, "run.*")
    kept = [c for c in flat.columns if c != "terms"]
    pieces = flat.select(*kept, F.posexplode(exploding(F.col("terms"))).alias("pos", "term"))
    return pieces.select(
        *ROW,
        "field",
        "term",
        (F.col("pos") + F.col("base")).alias("pos"),
        "weight",
        "len",
        "boost",
    )


def _run(
    path: str, array: str, weight: Column, base: Column, length: Column, boost: float
) -> Column:
    return F.struct(
        F.lit(path).alias("field"),
        F.col(array).alias("terms"),
        weight.alias("weight"),
        base.alias("base"),
        length.alias("len"),
        F.lit(boost).alias("boost"),
    )


def _has_path(schema: T.StructType, path: str) -> bool:
    kind: T.DataType = schema
    for name in path.split("."):
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def postings(
    documents: DataFrame,
    fields: Sequence[SearchField],
    with_all: bool = False,
    positions: bool = True,
) -> DataFrame:
    """Postings of ``documents``, counted where the rows are, some at a time: no text is shuffled."""
    rows = _positional(documents, fields, with_all)
    return rows if positions else rows.drop("positions")


def _positional(
    documents: DataFrame, fields: Sequence[SearchField], with_all: bool
) -> DataFrame:
    return _made(documents, fields, with_all, _counted, POSTING)


def posting_blocks(documents: DataFrame, fields: Sequence[SearchField], with_all: bool = False) -> DataFrame:
    """The postings of ``documents`` as an index keeps them: those that some rows of one index and type
    have of a term of a field together in one row, as lists of equal length. Nothing is shuffled."""
    return _made(documents, fields, with_all, _blocked, BLOCK)


def _made(documents: DataFrame, fields: Sequence[SearchField], with_all: bool, make, schema: str) -> DataFrame:
    analysed, arrays, included = _analysed(documents, _present(documents, fields), with_all)
    names = analysed.columns
    runs = [(f.path, [(names.index(name), 1.0)], f.boost) for name, f in arrays.items()]
    if included:
        runs.append((ALL, [(names.index(name), f.boost) for name, f in included], 1.0))

    def each(batches):
        for batch in _gathered(batches):
            for piece in _slices(batch):
                for path, columns, boost in runs:
                    yield from make(piece, path, columns, boost)

    return analysed.mapInArrow(each, schema)


def _token_ends(batch: pa.RecordBatch) -> np.ndarray:
    """How many tokens the rows of ``batch`` up to each one hold."""
    ends = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns[len(ROW) :]:
        ends += np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    return ends


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, those that follow each other put together up to about TOKENS_AT_ONCE tokens: rows
    of short texts come in batches of few tokens, and the fewer are counted together, the fewer
    postings of a term meet."""
    held, tokens = [], 0
    for batch in batches:
        more = int(_token_ends(batch)[-1]) if batch.num_rows else 0
        if held and tokens + more > TOKENS_AT_ONCE:
            yield from _joined(held)
            tokens = 0
        held.append(batch)
        tokens += more
    if held:
        yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """The batches in one, and no longer in ``held``: nobody else holds them while postings are counted."""
    table = pa.Table.from_batches(held).combine_chunks()
    held.clear()
    return table.to_batches()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about TOKENS_AT_ONCE tokens; a row is never cut."""
    ends = _token_ends(batch)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, done + TOKENS_AT_ONCE, "right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


@dataclass(frozen=True)
class _Counts:
    """Postings of one field of some rows, ordered by term and then by row, as columns."""

    terms: pa.Array
    #: the term of each posting, by its place in ``terms``, and its row
    term: np.ndarray
    row: np.ndarray
    tf: np.ndarray
    #: number of tokens of each row
    lengths: np.ndarray
    #: places of all postings one after the other, and where those of each begin and end
    places: pa.Array
    bounds: np.ndarray

    def positions(self, start: int, end: int) -> pa.ListArray:
        ends = self.bounds[start : end + 1]
        return pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), self.places[ends[0] : ends[-1]])


def _count(piece: pa.RecordBatch, path: str, columns: list[tuple[int, float]]) -> _Counts | None:
    """What the rows hold. The field is the tokens of ``columns``, one column after the other, each
    with the weight its tokens have."""
    lengths = np.zeros(piece.num_rows, np.int64)
    terms, rows, places, weights = [], [], [], []
    for at, weight in columns:
        sizes = pc.fill_null(pc.list_value_length(piece.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(piece.num_rows, dtype=np.int32), sizes)
        shift = (lengths - np.cumsum(sizes) + sizes).astype(np.int32)
        terms.append(piece.column(at).flatten())
        rows.append(row)
        places.append(np.arange(len(row), dtype=np.int32) + shift[row])
        weights.append((weight, len(row)))
        lengths += sizes
    row, place = np.concatenate(rows), np.concatenate(places)
    del rows, places
    if not len(row):
        return None
    coded = pa.chunked_array(terms).combine_chunks().dictionary_encode()
    words = coded.dictionary
    order = pc.sort_indices(words).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    key = rank[coded.indices.to_numpy()]
    del coded, terms
    key *= piece.num_rows
    key += row
    del row
    # stable, so that the places of a term in a row ascend
    by_key = np.argsort(key, kind="stable")
    key = key[by_key]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    bounds = np.append(first, len(key))
    if path == ALL:
        # adds the weights one after the other
        weight = np.repeat(*map(np.array, zip(*weights)))
        tf = np.bincount(np.repeat(np.arange(len(first)), np.diff(bounds)), weight[by_key])
    else:
        tf = np.diff(bounds).astype(np.float64)
    word, of = np.divmod(key[first], piece.num_rows)
    return _Counts(words, order[word], of, tf, lengths, pa.array(place[by_key]), bounds)


def _counted(
    piece: pa.RecordBatch, path: str, columns: list[tuple[int, float]], boost: float
) -> Iterator[pa.RecordBatch]:
    """Postings of one field of some rows, ordered by term."""
    found = _count(piece, path, columns)
    for start in range(0, len(found.row) if found else 0, POSTINGS_AT_ONCE):
        end = min(start + POSTINGS_AT_ONCE, len(found.row))
        here = pa.array(found.row[start:end])
        yield pa.RecordBatch.from_arrays(
            [
                *(piece.column(i).take(here) for i in range(len(ROW))),
                pa.repeat(pa.scalar(path), len(here)),
                found.terms.take(pa.array(found.term[start:end])),
                pa.array(found.tf[start:end]),
                pa.array(found.lengths[found.row[start:end]].astype(np.int32)),
                pa.array(np.full(len(here), float(boost))),
                found.positions(start, end),
            ],
            names=[*ROW, "field", "term", "tf", "len", "boost", "positions"],
        )


def _blocked(
    piece: pa.RecordBatch, path: str, columns: list[tuple[int, float]], boost: float
) -> Iterator[pa.RecordBatch]:
    """The same postings, those of a term together in one row."""
    found = _count(piece, path, columns)
    if found is None:
        return
    kind = np.zeros(piece.num_rows, np.int64)
    for i in range(2):  # index and type
        codes = piece.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy()
        kind = kind * (piece.num_rows + 1) + codes
    of = kind[found.row]
    new = (found.term[1:] != found.term[:-1]) | (of[1:] != of[:-1])
    heads = np.flatnonzero(np.concatenate(([True], new, [True])))
    at = 0
    while at < len(heads) - 1:
        until = max(int(np.searchsorted(heads, heads[at] + POSTINGS_AT_ONCE, "right")) - 1, at + 1)
        start, end = int(heads[at]), int(heads[until])
        ends = pa.array((heads[at : until + 1] - start).astype(np.int32))
        first, here = heads[at:until], pa.array(found.row[start:end])
        lists = (
            piece.column(2).take(here),
            piece.column(3).take(here),
            pa.array(found.tf[start:end]),
            pa.array(found.lengths[found.row[start:end]].astype(np.int32)),
            found.positions(start, end),
        )
        yield pa.RecordBatch.from_arrays(
            [
                *(piece.column(i).take(pa.array(found.row[first])) for i in range(2)),
                pa.repeat(pa.scalar(path), len(first)),
                found.terms.take(pa.array(found.term[first])),
                pa.array(np.full(len(first), float(boost))),
                *(pa.ListArray.from_arrays(ends, x) for x in lists),
            ],
            names=BLOCK_COLUMNS,
        )
        at = until


def _present(documents: DataFrame, fields: Sequence[SearchField]) -> list[SearchField]:
    schema = documents.schema["source"].dataType
    wanted = [f for f in fields if _has_path(schema, f.path)]
    if not wanted:
        raise ValueError("no searchable field")
    return wanted


def _analysed(
    documents: DataFrame, fields: Sequence[SearchField], with_all: bool
) -> tuple[DataFrame, dict[str, SearchField], list[tuple[str, SearchField]]]:
    """Documents with one array of terms per field, which field each array is of, and the arrays
    that make up ``_all``: that is one analysed field, whatever the fields it takes in are."""
    schema = documents.schema["source"].dataType
    arrays = {f"__t{i}": f for i, f in enumerate(fields)}

    def terms(name: str, f: SearchField, how: str) -> Column:
        found = terms_of(*path_value("source", schema, f.path), how)
        return F.coalesce(found, F.array().cast("array<string>")).alias(name)

    columns = [terms(name, f, f.analyzer) for name, f in arrays.items()]
    included = []
    for name, f in arrays.items():
        if with_all and f.in_all:
            if f.analyzer != ALL_ANALYZER:
                columns.append(terms(f"{name}a", f, ALL_ANALYZER))
            included.append((name if f.analyzer == ALL_ANALYZER else f"{name}a", f))
    return documents.select(*ROW, *columns), arrays, included


def in_one_row(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are the only ones of their document, and the others. Only keys are shuffled to tell."""
    counted = documents.select(*DOC, "part").groupBy(*DOC).agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
    several = broadcast_if_small(counted.where((F.col("n") > 1) | (F.col("part") != 0)).select(*DOC))
    return documents.join(several, list(DOC), "left_anti"), documents.join(several, list(DOC), "left_semi")


def whole_lengths(rows: DataFrame) -> DataFrame:
    """Postings whose ``len`` counts every part of a document that is kept in several rows."""
    lengths = (
        rows.groupBy(*ROW, "field")
        .agg(F.max("len").alias("part_len"))
        .groupBy(*DOC, "field")
        .agg(F.sum("part_len").cast("int").alias("len"))
    )
    return rows.drop("len").join(lengths, [*DOC, "field"])


def term_stats(rows: DataFrame, split: bool = True) -> DataFrame:
    """``(field, term, df)`` of fresh postings: in how many documents a term occurs. A document
    in several parts counts once; where there are none (``split`` False) a posting is a document,
    and only counts are shuffled."""
    if split:
        rows = rows.groupBy(*DOC, "field", "term").agg(F.lit(1).alias("one"))
    return rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def stored_term_stats(rows: DataFrame) -> DataFrame:
    """``(index, type, field, term, df)`` of postings. Only documents in several parts need their
    parts brought together; all others are counted where they are. The postings are read once."""
    by = ["index", "type", "field", "term"]
    whole = F.count(F.when(F.col("part") == 0, F.lit(1)))
    # the rows of documents in one part are one group, those of the others one for each document
    counted = rows.groupBy(*by, F.when(F.col("part") != 0, F.col("id")).alias("__split")).agg(whole.alias("df"))
    split = F.when(F.col("__split").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return counted.groupBy(*by).agg(F.sum(F.col("df") + split).alias("df"))


def block_term_stats(blocks: DataFrame, split: bool = True) -> DataFrame:
    """The same of stored blocks, which are opened only where documents in several parts (``split``)
    have to be brought together."""
    by = ["index", "type", "field", "term"]
    whole = F.size(F.filter("parts", lambda part: part == 0)).cast("long")
    counts = blocks.select(*by, whole.alias("df"))
    if split:
        opened = blocks.where(F.exists("parts", lambda part: part != 0)).select(*by, F.posexplode("ids").alias("at", "id"), "parts")
        shares = opened.where(F.get("parts", F.col("at")) != 0).select(*by, "id").distinct()
        counts = counts.unionByName(shares.select(*by, F.lit(1).cast("long").alias("df")))
    return counts.groupBy(*by).agg(F.sum("df").alias("df"))


def field_lengths(rows: DataFrame) -> DataFrame:
    """``(index, type, id, field, len)`` from postings."""
    per_part = rows.groupBy(*ROW, "field").agg(F.max("len").alias("len"))
    return per_part.groupBy(*DOC, "field").agg(F.sum("len").alias("len"))


def field_sizes(documents: DataFrame, fields: Sequence[SearchField], split: bool = True) -> DataFrame:
    """``(index, type, id, field, len)`` straight from documents: the number of terms of each field
    that has any. Nothing is shuffled but the sizes of documents in several parts."""
    analysed, arrays, _ = _analysed(documents, _present(documents, fields), False)
    sizes = [F.struct(F.lit(f.path).alias("field"), F.size(name).alias("len")) for name, f in arrays.items()]
    rows = analysed.select(*DOC, F.explode(F.array(*sizes)).alias("x")).select(*DOC, "x.*")
    rows = rows.where(F.col("len") > 0)
    return rows.groupBy(*DOC, "field").agg(F.sum("len").cast("int").alias("len")) if split else rows


def packed(rows: DataFrame) -> DataFrame:
    """Rows ``(index, type, id, len, boost, code, tf)``, those that a task has of a document together in one, with
    ``codes`` and ``tfs`` as lists: to be dealt out by document, where a row for each posting would weigh
    several times as much."""

    def each(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACKED_AT_ONCE:
                yield from _packed(held)
                held, n = [], 0
        if n:
            yield from _packed(held)

    kinds = f"array<{rows.schema['code'].dataType.simpleString()}>"
    schema = f"index string, type string, id string, len int, boost double, codes {kinds}, tfs array<double>"
    return rows.select(*DOC, "len", "boost", "code", "tf").mapInArrow(each, schema)


def _packed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    (batch,) = pa.Table.from_batches(batches).combine_chunks().to_batches()
    key = np.zeros(batch.num_rows, np.int64)
    for name in (*DOC, "len", "boost"):
        coded = batch.column(name).dictionary_encode(null_encoding="encode")
        key = np.unique(key * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.diff(key[order], prepend=-1))
    ends = pa.array(np.append(heads, len(order)).astype(np.int32))
    batch = batch.take(pa.array(order))
    first = batch.select([*DOC, "len", "boost"]).take(pa.array(heads))
    lists = [pa.ListArray.from_arrays(ends, batch.column(name)) for name in ("code", "tf")]
    yield pa.RecordBatch.from_arrays([*first.columns, *lists], [*first.schema.names, "codes", "tfs"])


def unpacked(rows: DataFrame) -> DataFrame:
    """``(index, type, id, len, boost, code, tf)`` of packed rows."""
    each = rows.select(*DOC, "len", "boost", "tfs", F.posexplode("codes").alias("__at", "code"))
    return each.select(*DOC, "len", "boost", "code", F.get("tfs", F.col("__at")).alias("tf"))


def index_stats(documents: DataFrame) -> DataFrame:
    """``(index, type, num_docs)``."""
    return documents.where(is_first(F.col("part"))).groupBy("index", "type").agg(F.count("*").alias("num_docs"))
