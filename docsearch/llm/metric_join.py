"""Exact near-duplicate vectors: a metric range join over pivot cells."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docsearch.llm.components import components
from docsearch.llm.tables import finite_vector, step, written
from docsearch.operators.sizes import broadcast_if_small

MIN_COSINE = 0.93
#: a label gets a pivot for so many vectors, and no more than MAX_PIVOTS
PIVOT_ROWS = 4096
MAX_PIVOTS = 64
#: rows of either side in one task's block of a cell
BLOCK_ROWS = 4096
CHUNK = 256
#: rows that are brought together at once, unless there are more vectors than that
ROUND_ROWS = 1_000_000
#: what rounding may add to a distance
SLACK = 1e-6
CLASS = ["space", "id", "copies", "vector"]


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that no square over- or underflows
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cells(radius: float, pivots: dict[str, np.ndarray]):
    """Home cell of each vector, and all cells it belongs to: its own and those whose border is near enough.

    x lies in the cell of its nearest pivot p. If y of the cell of q is within ``radius`` of x,
    d(x, q) <= d(y, q) + radius <= d(y, p) + radius <= d(x, p) + 2 radius, so x goes to all
    cells for which that holds. A space without ``pivots`` is one cell.
    """

    def assign(batches):
        for batch in batches:
            home = np.zeros(batch.num_rows, np.int32)
            sizes, cells = np.ones(batch.num_rows, np.int64), {}
            spaces = batch.column("space").dictionary_encode()
            codes = spaces.indices.to_numpy()
            for code, space in enumerate(spaces.dictionary.to_pylist()):
                if space not in pivots:
                    continue
                rows = np.flatnonzero(codes == code)
                vectors = _unit(_vectors(batch.column("vector").take(pa.array(rows))))
                away = np.sqrt(np.maximum(2 - 2 * (vectors @ pivots[space].T), 0))
                home[rows] = away.argmin(axis=1)
                near = away <= away.min(axis=1)[:, None] + 2 * radius + SLACK
                sizes[rows] = near.sum(axis=1)
                cells[code] = rows, np.nonzero(near)[1]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            of = np.zeros(ends[-1], np.int32)
            for rows, found in cells.values():
                own = np.cumsum(sizes[rows]) - sizes[rows]
                of[np.arange(len(found)) + np.repeat(ends[rows] - own, sizes[rows])] = found
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(of))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in CLASS), pa.array(home), lists], [*CLASS, "home", "cells"]
            )

    return assign


def _forest(labels: np.ndarray, left: np.ndarray, right: np.ndarray):
    """The links that join different components one after the other, and the labels after them."""
    lefts, rights = [], []
    while True:
        a, b = labels[left], labels[right]
        new = a != b
        if not new.any():
            break
        left, right = left[new], right[new]
        high, low = np.maximum(a[new], b[new]), np.minimum(a[new], b[new])
        # one link for each component that is not the smaller end
        _, first = np.unique(high, return_index=True)
        lefts.append(left[first])
        rights.append(right[first])
        labels[high[first]] = low[first]
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return lefts, rights, labels


def _by_distance(table: pa.Table) -> pa.Table:
    """The rows in the order of their distance ``away`` from one of them."""
    vectors = _unit(_vectors(table.column("vector")))
    first = pc.index(table.column("id"), pc.min(table.column("id"))).as_py()
    away = np.sqrt(np.maximum(2 - 2 * (vectors @ vectors[first]), 0))
    return table.append_column("away", pa.array(away)).sort_by("away")


def _meet(radius: float, min_cosine: float):
    def meet(table: pa.Table) -> pa.Table:
        table = _by_distance(table)
        side = table.column("side").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy().astype(np.int64)
        copies = table.column("copies").to_numpy().astype(np.int64)
        away = table.column("away").to_numpy()
        vectors = _unit(_vectors(table.column("vector")))
        homes, others = np.flatnonzero(side), np.flatnonzero(~side)
        counts = np.zeros(len(homes), dtype=np.int64)
        # a class is one node, on whichever side it stands
        nodes, node = np.unique(ids, return_inverse=True)
        labels = np.arange(len(nodes))
        a, b = [], []
        for at in range(0, len(homes), CHUNK):
            rows = homes[at : at + CHUNK]
            # distances to a third vector differ by no more than the distance of two vectors
            first = np.searchsorted(away[others], away[rows[0]] - radius - SLACK, "left")
            last = np.searchsorted(away[others], away[rows[-1]] + radius + SLACK, "right")
            cols = others[first:last]
            near = vectors[rows] @ vectors[cols].T >= min_cosine
            near &= ids[rows][:, None] != ids[cols][None, :]
            counts[at : at + CHUNK] = near @ copies[cols]
            i, j = np.nonzero(near)
            left, right, labels = _forest(labels, node[rows[i]], node[cols[j]])
            a += left
            b += right
        some = counts > 0
        left = np.concatenate([ids[homes[some]], *(nodes[x] for x in a)])
        right = np.concatenate([ids[homes[some]], *(nodes[x] for x in b)])
        links = np.zeros(len(left), dtype=np.int64)
        links[: some.sum()] = counts[some]
        return pa.table({"a": left, "b": right, "links": links})

    return meet


def _pivots(packed: DataFrame) -> dict[str, np.ndarray]:
    """The pivots of each space that has several: at most one for half of PIVOT_ROWS vectors, so few
    that every task can hold them. A copy in each row would weigh more than the vectors."""
    sizes = packed.groupBy("space").agg(F.count("*").alias("rows"))
    wanted = F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("rows") / PIVOT_ROWS))
    large = sizes.select("space", wanted.alias("wanted")).where("wanted > 1")
    by_hash = Window.partitionBy("space").orderBy(F.xxhash64("vector"), "id")
    ranked = packed.join(large, "space").select("space", "wanted", "id", F.row_number().over(by_hash).alias("place"), "vector")
    chosen = ranked.where((F.col("place") <= MAX_PIVOTS) & (F.col("place") <= F.col("wanted")))
    found: dict[str, list] = {}
    for row in sorted(chosen.select("space", "place", "vector").collect()):
        found.setdefault(row["space"], []).append(row["vector"])
    return {space: _unit(np.array(vectors, np.float64)) for space, vectors in found.items()}


def _placed(rows: DataFrame, radius: float, kind: str) -> DataFrame:
    """``space, id, copies, vector, home, cells``: a row for each class of equal vectors of a space."""
    packed = written(
        rows.distinct().groupBy("space", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")),
        "vector-classes",
    )
    return packed.select(*CLASS).mapInArrow(
        _cells(radius, _pivots(packed)),
        f"space string, id long, copies long, vector {kind}, home int, cells array<int>",
    )


def _met(placed: DataFrame, radius: float, min_cosine: float) -> DataFrame:
    """``a, b, links`` of all blocks. A vector is copied for each block it meets; the blocks are joined in
    as many rounds as keep the copies of one to about as many as there are vectors."""
    each = placed.select("space", F.explode("cells").alias("cell"), "home")
    counts = each.groupBy("space", "cell").agg(
        F.expr(f"greatest(1, ceil(count_if(home = cell) / {BLOCK_ROWS}))").alias("home_blocks"),
        F.expr(f"ceil(count(*) / {BLOCK_ROWS})").alias("blocks"),
        F.count_if(F.col("home") == F.col("cell")).alias("homes"),
        F.count(F.lit(1)).alias("members"),
    )
    counts = written(counts, "cell-counts")
    copies = counts.agg(F.sum(F.expr("homes * blocks + members * home_blocks"))).first()[0] or 0
    rounds = max(1, math.ceil(copies / max(ROUND_ROWS, placed.count()))) if copies else 1
    counts = broadcast_if_small(counts.select("space", "cell", "home_blocks", "blocks"))
    spread = F.xxhash64("id")

    def now(cell: str, block: str, number: int) -> Column:
        return F.expr(f"pmod(xxhash64(space, {cell}, {block}), {rounds}) = {number}") if rounds > 1 else F.lit(True)

    found = []
    for number in range(rounds):
        at_home = placed.select(*CLASS, F.col("home").alias("cell")).join(counts, ["space", "cell"])
        home = at_home.withColumn("home_block", F.pmod(spread, F.col("home_blocks"))).where(now("cell", "home_block", number))
        home = home.select(
            *CLASS, "cell", F.lit(True).alias("side"), "home_block", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block")
        )
        member = placed.select(*CLASS, F.explode("cells").alias("cell")).join(counts, ["space", "cell"])
        member = member.select(
            *CLASS, "cell", F.lit(False).alias("side"),
            F.explode(F.expr("sequence(0L, home_blocks - 1)")).alias("home_block"),
            F.pmod(spread, F.col("blocks")).alias("block"),
        ).where(now("cell", "home_block", number))
        blocks = home.union(member).groupBy("space", "cell", "home_block", "block")
        found.append(written(blocks.applyInArrow(_meet(radius, min_cosine), "a long, b long, links long"), "vector-links"))
    return reduce(DataFrame.union, found)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row.

    Two vectors link if their labels are equal and their cosine is ``min_cosine`` or more.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id that
    can be reached, the own included, and ``kept`` whether that is the own.

    A vector that is null, empty, zero or holds a null or non-finite component, or has a null
    label or id, links with nothing; vectors link only with those of their own length. Repeated
    rows count once and each returns a row; the rows of one id are one node. A row with a null id
    has ``component_id`` and ``kept`` null. An empty table gives an empty result.

    Equal vectors are one class with a count. Within a label, pivots cut the classes into cells by
    Euclidean distance of unit vectors, the triangle inequality says which border vectors a cell
    needs besides its own, and each block of a cell is joined in a task of its own, so many blocks at a
    time that the copies of vectors on disk stay about as many as the vectors. A block returns
    counts and at most a spanning forest of its links, never all pairs. Pivots are the vectors of
    least hash, at most MAX_PIVOTS a label: they only set the layout, never the result.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    base = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("raw"),
    )
    usable = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & finite_vector("raw")
        & F.exists("raw", lambda x: x != 0)
    )
    # single floats stay as they are, at half the size, until they are multiplied
    item = base.schema["raw"].dataType.elementType
    exact = F.col("raw") if isinstance(item, T.FloatType) else F.transform("raw", lambda x: x.cast("double"))
    kind = f"array<{'float' if isinstance(item, T.FloatType) else 'double'}>"
    # a label and a length make a space of their own
    space = F.concat_ws(":", F.size("raw").cast("string"), "label")
    rows = base.select("id", space.alias("space"), F.when(usable, exact).alias("vector"))
    placed = step(lambda: _placed(rows.where("vector is not null"), radius, kind), "cells")
    met = _met(placed, radius, min_cosine)
    linked = components(met.where("a <> b").select("a", "b"), "a", "b")
    degree = met.where("links > 0").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    classes = (
        placed.join(degree, F.col("id") == F.col("class"), "left")
        .join(linked, F.col("id") == F.col("node"), "left")
        .select(
            F.col("space").alias("class_space"),
            F.col("vector").alias("class_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    same = (F.col("space") == F.col("class_space")) & (F.col("vector") == F.col("class_vector"))
    component = F.coalesce("component_id", "id")
    return rows.join(classes, same, "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
