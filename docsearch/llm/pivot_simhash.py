"""SimHash near-duplicates by tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.components import components
from docsearch.llm.tables import field_of, free_name, written

SEED = 42
SHINGLE = 3
#: fingerprints link at this many differing bits or fewer, unless a caller asks for another radius
RADIUS = 2
#: beyond it the keys of cells say too little
MAX_RADIUS = 4
BITS = 64
#: the base reference; reference i differs from it in the STEP bits of place i
BASE = 0x9E3779B97F4A7C15
STEP = 2
REFERENCES = [BASE] + [BASE ^ (((1 << STEP) - 1) << at) for at in range(0, BITS, STEP)]
#: groups of neighbouring coordinates; a linked pair agrees in all groups but as many as its bits
GROUPS = 8
_REFERENCES = np.array(REFERENCES, dtype=np.uint64)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """A hash for every run of ``shingle`` words, or for all words if there are fewer; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(run, SEED) for run in runs], dtype="<u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 for a text without words or null."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fingerprint`` (a signed long) of every row; whole texts, one row at a time."""
    schema = T.StructType([field_of(docs, id_col, "id"), T.StructField("fingerprint", T.LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch.column(1)]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        each, schema
    )


def _keys(radius: int):
    """A key for each choice of groups that may agree: the coordinates of those groups.

    A coordinate is the distance to a reference less that to the base, one of three values. Two
    fingerprints within ``radius`` bits differ in ``radius`` coordinates at most, so they agree in
    all groups but ``radius``, and meet under the key of those.
    """
    print_ = F.col("fingerprint")

    def distance(reference: int):
        signed = int(np.uint64(reference).astype(np.int64))
        return F.bit_count(print_.bitwiseXOR(F.lit(signed)))

    base = distance(REFERENCES[0])
    places = (len(REFERENCES) - 1) // GROUPS
    groups = []
    for g in range(GROUPS):
        code = F.lit(0).cast("long")
        for reference in REFERENCES[1 + g * places : 1 + (g + 1) * places]:
            code = code * 3 + F.shiftright(distance(reference) - base + STEP, 1)
        groups.append(code.alias(f"g{g}"))
    return groups, [kept for kept in combinations(range(GROUPS), GROUPS - radius)]


def _united(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after the links left-right: in a component all have its smallest."""
    while True:
        a, b = labels[left], labels[right]
        if (a == b).all():
            return labels
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def cell_links(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link the rows of each run of equal keys as all pairs within ``radius`` would.

    Row i meets row i + 1, i + 2, ... of its run. A pair whose coordinates differ by more than
    ``radius`` anywhere is discarded, since distances to one reference differ by no more than the
    distance of the two; the survivors' own distance decides. A pair that earlier links have
    already brought together is not returned: at most one link a row and step is new.
    """
    table = np.bitwise_count(prints[:, None] ^ _REFERENCES[None, :]).astype(np.int8)
    labels = np.arange(len(keys))
    lefts, rights = [], []
    alive, step = np.arange(len(keys)), 1
    while len(alive):
        alive = alive[alive + step < len(keys)]
        alive = alive[keys[alive] == keys[alive + step]]
        near = alive
        for at in range(0, table.shape[1], 8):
            apart = np.abs(table[near, at : at + 8] - table[near + step, at : at + 8])
            near = near[apart.max(axis=1, initial=0) <= radius]
        near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= radius]
        near = near[labels[near] != labels[near + step]]
        if len(near):
            lefts.append(near)
            rights.append(near + step)
            labels = _united(labels, near, near + step)
        step += 1
    if not lefts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(lefts), np.concatenate(rights)


def _linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of the runs of equal keys in sorted rows; the last run waits for the next batch."""
    held = None

    def links(table: pa.Table) -> pa.RecordBatch:
        keys, prints = table.column("key").to_numpy(), table.column("fingerprint").to_numpy()
        left, right = cell_links(keys, prints.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(prints[left]), pa.array(prints[right])], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        keys = table.column("key").to_numpy()
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        held = table.slice(last)
        if last:
            yield links(table.slice(0, last))
    if held is not None and held.num_rows > 1:
        yield links(held)


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links between distinct fingerprints whose components are those of all links."""
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"the radius must lie between 0 and {MAX_RADIUS}")
    groups, choices = _keys(radius)
    coded = prints.select("fingerprint", *groups)
    width = 3 ** ((len(REFERENCES) - 1) // GROUPS)
    keys = []
    for number, kept in enumerate(choices):
        key = F.lit(number).cast("long")
        for g in kept:
            key = key * width + F.col(f"g{g}")
        keys.append(key)
    cells = coded.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    return (
        cells.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: _linked(batches, radius), "a long, b long")
        .distinct()
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Words are runs of bytes that are no ASCII white space, with A-Z lower-cased; fingerprints at
    ``radius`` bits or fewer link; ``component_id`` is the smallest id reachable, the own included.
    A null or empty text has fingerprint zero and links like any other. Repeated rows each return
    a row; a null id keeps its row and never becomes a component's id, unless all ids of the
    component are null. An empty table gives an empty result.

    Only distinct fingerprints meet, so exact copies cost one row. Their keys spread them over
    cells; a cell holds fingerprints that agree in all groups of coordinates but ``radius``.
    """
    found = written(fingerprints(docs, id_col, text_col, shingle), "prints")
    distinct = written(
        found.groupBy("fingerprint").agg(F.min("id").alias("first")), "distinct-prints"
    )
    linked = components(near_links(distinct, radius), "a", "b")
    grouped = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("root")
    )
    smallest = grouped.groupBy(F.col("root").alias("top")).agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, F.col("root") == F.col("top")).select(
        F.col("fingerprint").alias("print"), "component_id"
    )
    return found.join(named, F.col("fingerprint") == F.col("print"), "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``docs`` without the near-duplicates of a row with a smaller id.

    Of repeated rows with the id that stays, all stay; rows without an id are left as they are.
    """
    groups = simhash_components(docs, id_col, text_col, radius=radius)
    drop = free_name(docs, "dropped")
    dropped = groups.where(F.col(id_col) > F.col("component_id")).select(F.col(id_col).alias(drop))
    return docs.join(dropped.distinct(), F.col(id_col) == F.col(drop), "left_anti")
