"""Exact top-k by inner product over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsearch.llm.tables import finite_vector, written

SCALE = 64
K = 20
BLOCK_ROWS = 65_536
PART_QUERIES = 128
MAX_TASKS = 20_000
#: quantised components up to here are counted as 64-bit integers, larger ones as Python's
LARGEST = 1 << 61
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: doubles from here on are whole numbers
WHOLE = float(1 << 53)


def _integers(values: np.ndarray, width: int) -> np.ndarray:
    """Whole doubles as integers, of Python's kind if some are large."""
    if len(values) and np.abs(values).max() > LARGEST:
        return np.array([int(x) for x in values.tolist()], dtype=object).reshape(-1, width)
    return values.astype(np.int64).reshape(-1, width)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def sliced(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``low`` of every column, and bitmaps ``[column, bit, word]`` over the rows of ``values - low``."""
    low = values.min(axis=0)
    lifted = (values - low).T
    bits = max(1, int(lifted.max()).bit_length())
    words = -(-lifted.shape[1] // 64)
    maps = np.zeros((lifted.shape[0], bits, words * 8), dtype=np.uint8)
    for bit in range(bits):
        packed = np.packbits(((lifted >> bit) & 1).astype(np.uint8), axis=1, bitorder="little")
        maps[:, bit, : packed.shape[1]] = packed
    return low, maps.view(np.uint64)


def added(groups: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The sum of bitmaps, each worth the power of two of its group, as slices from low to high.

    Full adders take three bitmaps of one weight to one of that weight and one carry.
    """
    total, weight = [], 0
    while weight < len(groups):
        rest = np.concatenate(groups[weight]) if groups[weight] else None
        carried: list[np.ndarray] = []
        while rest is not None and len(rest) > 1:
            third = len(rest) // 3
            if third:
                a, b, c = rest[:third], rest[third : 2 * third], rest[2 * third : 3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                rest = np.concatenate([half ^ c, rest[3 * third :]])
            else:
                carried.append(rest[:1] & rest[1:])
                rest = rest[:1] ^ rest[1:]
        if carried:
            if weight + 1 == len(groups):
                groups.append([])
            groups[weight + 1].extend(carried)
        total.append(None if rest is None else rest[0])
        weight += 1
    return total


def _set_rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(total: list[np.ndarray], eligible: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` largest sums, from the most significant slice down; ties by row number."""
    sure, even = np.zeros_like(eligible), eligible
    for piece in reversed(total):
        if piece is None:
            continue
        ahead = even & piece
        found = sure | ahead
        count = int(np.bitwise_count(found).sum())
        if count > k:
            even = ahead
        else:
            sure, even = found, even & ~piece
            if count == k:
                break
    rows = _set_rows(sure)
    if len(rows) < k:
        rows = np.concatenate([rows, _set_rows(even)[: k - len(rows)]])
    return rows


class Block:
    """The index of one block of rows, in ascending order of id."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, maps: np.ndarray):
        self.ids, self.low = ids, low
        self.bits = maps.shape[1]
        self.maps = np.stack([maps, ~maps])  # the second for negative factors
        self.rows = np.zeros(maps.shape[2] * 64, dtype=np.uint8)
        self.rows[: len(ids)] = 1

    def best(self, own, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        negative = (query < 0).astype(np.int64)
        size = np.abs(query)
        longest = int(size.max()).bit_length()
        groups: list[list[np.ndarray]] = [[] for _ in range(self.bits + longest)]
        for bit in range(longest):
            dims = np.flatnonzero(((size >> bit) & 1).astype(bool))
            if len(dims):
                chosen = self.maps[negative[dims], dims]
                for place in range(self.bits):
                    groups[bit + place].append(chosen[:, place])
        total = added(groups)
        rows = self.rows.copy()
        rows[: len(self.ids)][self.ids == own] = 0
        found = top_rows(total, np.packbits(rows, bitorder="little").view(np.uint64), k)
        # a complement counts (2 ** bits - 1 - value) for a negative factor
        constant = sum(q * c for q, c in zip(query.tolist(), self.low.tolist(), strict=True))
        constant -= sum(size[query < 0].tolist()) * ((1 << self.bits) - 1)
        scores = [constant] * len(found)
        word, shift = found // 64, (found % 64).astype(np.uint64)
        for weight, piece in enumerate(total):
            if piece is not None:
                bits = ((piece[word] >> shift) & np.uint64(1)).tolist()
                scores = [score + (bit << weight) for score, bit in zip(scores, bits, strict=True)]
        # one that is no long becomes the nearest, which is an error if it is among the best of all
        return self.ids[found], np.array([min(max(x, LEAST), MOST) for x in scores], dtype=np.int64)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vectors`` for each of ``queries``.

    A component x counts as ``floor(64 * x)``; the score is the integer inner product; equal scores
    go to the smaller id. A row is no answer to a query of its own id. Rows with a null id and
    vectors that are null, empty, or hold a null or non-finite component take no part; vectors
    meet only those of their own length; repeated rows count once; empty tables give an empty
    result. Components may be as large as doubles are; a score among the best that is no 64-bit
    integer is an error.

    Rows are dealt into blocks by a hash, each block is indexed once, and every part of the query
    set meets every block in a task of its own, which returns ``k`` rows a query at most. Ids must
    be integers.
    """

    def whole(frame: DataFrame) -> DataFrame:
        # whole doubles: exact, however large
        def scaled_one(x):
            value = SCALE * x.cast("double")
            return F.when(F.abs(value) < WHOLE, F.floor(value).cast("double")).otherwise(value)

        scaled = F.transform(F.col("vector"), scaled_one)
        return (
            frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
            .where(F.col("id").isNotNull() & finite_vector("vector"))
            .select("id", F.size("vector").alias("width"), scaled.alias("vector"))
            .distinct()
        )

    rows = written(whole(vectors), "topk-rows")
    asked = written(whole(queries), "topk-asked")
    blocks = max(1, -(-rows.count() // block_rows))
    parts = max(1, -(-asked.count() // PART_QUERIES))

    def index(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        table = table.sort_by("id")
        low, maps = sliced(_integers(_flat(table.column("vector")), width))
        ids = table.column("id").to_numpy().astype(np.int64)
        return pa.table(
            {
                "block": table.column("block")[:1],
                "width": table.column("width")[:1],
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "low": pa.array([low.astype(np.float64).tobytes()], pa.binary()),
                "bits": pa.array([maps.shape[1]], pa.int32()),
                "maps": pa.array([maps.tobytes()], pa.binary()),
            }
        )

    spread = F.xxhash64("id", "vector")
    indexed = (
        rows.withColumn("block", F.pmod(spread, F.lit(blocks)))
        .groupBy("block", "width")
        .applyInArrow(index, "block long, width int, ids binary, low binary, bits int, maps binary")
    )

    def packed(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        ids = table.column("id").to_numpy().astype(np.int64)
        return pa.table(
            {
                "part": table.column("part")[:1],
                "asked_width": table.column("width")[:1],
                "asked_ids": pa.array([ids.tobytes()], pa.binary()),
                "asked": pa.array([_flat(table.column("vector")).tobytes()], pa.binary()),
            }
        )

    questions = (
        asked.withColumn("part", F.pmod(spread, F.lit(parts)))
        .groupBy("part", "width")
        .applyInArrow(packed, "part long, asked_width int, asked_ids binary, asked binary")
        .withColumn("asked_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    )
    pairs = indexed.join(
        questions, (F.col("block") == F.col("asked_block")) & (F.col("width") == F.col("asked_width"))
    )

    def answer(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        width, bits = row["width"], row["bits"]
        maps = np.frombuffer(row["maps"], dtype=np.uint64).reshape(width, bits, -1)
        block = Block(
            np.frombuffer(row["ids"], dtype=np.int64),
            _integers(np.frombuffer(row["low"], dtype=np.float64), width)[0],
            maps,
        )
        asked_ids = np.frombuffer(row["asked_ids"], dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = [
            block.best(own, query, k)
            for own, query in zip(
                asked_ids,
                _integers(np.frombuffer(row["asked"], dtype=np.float64), width),
                strict=True,
            )
        ]
        counts = [len(ids) for ids, _ in found]
        return pa.table(
            {
                "query_id": np.repeat(asked_ids, counts),
                "vec_id": np.concatenate([ids for ids, _ in found]),
                "score": np.concatenate([scores for _, scores in found]),
            }
        )

    # a pair is much work for few bytes, so their number and not their size sets that of the tasks
    dealt = pairs.repartition(min(MAX_TASKS, blocks * parts), "block", "part", "width")
    best = dealt.groupBy("block", "part", "width").applyInArrow(
        answer, "query_id long, vec_id long, score long"
    )
    beyond = F.raise_error(F.lit("a score is no 64-bit integer")).cast("long")
    checked = F.when(F.col("score").isin(LEAST, MOST), beyond).otherwise(F.col("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", checked.alias("score"))
    )
