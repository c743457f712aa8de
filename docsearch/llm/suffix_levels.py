"""Exact removal of long repeated byte strings by a logarithmic family of sparse suffix arrays.

Every string of ``length`` bytes holds an anchor: the place where the hash of the next ``head``
bytes is least. Equal strings have their anchors at the same offset, so two occurrences of a string
show as two suffixes, those at their anchors, that begin alike. Only suffixes at anchors are kept, about
one in ``(length - head) / 2`` bytes. They are ordered by the hash of their head in place of
its bytes: equal heads are neighbours either way, and frequent ones are dealt out evenly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.tables import written

#: a string of so many bytes that starts anywhere else is removed
LENGTH = 400
#: batches a table is added in
BATCHES = 4
#: starts of strings looked at in one go, which bounds memory whatever the size of a text
STARTS = 1 << 20
#: starts next to each other that are decided together before each is on its own
STEP = 16
#: bits of the filters sent to all tasks, as a power of two (4 MB); a filter that is full lets all rows pass
FILTER_POWER = 25
#: about so many bytes of results are handed on at once
BATCH_BYTES = 8 << 20

_SEED = 20_260_301
_PLACE = (1 << 24) - 1


def head_length(length: int) -> int:
    return max(1, length * 8 // 25)


def step_size(length: int) -> int:
    """STEP, or less where strings are short: those of one step must have bytes in common."""
    return max(1, min(STEP, length // 4))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, the powers of an odd base modulo 2^64 and their inverses."""
    base = 0x9E3779B97F4A7C15
    codes = np.random.default_rng(_SEED).integers(0, 1 << 63, 256, dtype=np.uint64)
    up = np.full(size, base, dtype=np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return codes, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every stretch of ``size`` bytes, rolled over the data by sums of powers."""
    codes, up, down = _powers(1 << (len(data) | STARTS).bit_length())
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    found = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    for _ in range(2):
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values next to each other."""
    padded = np.full(-(-len(values) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: len(values) - width + 1], ahead[width - 1 : len(values)])


def anchors(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``head, at, low, high``: the suffixes of a text, the hash of their head, and the first and last
    start of the strings of ``length`` bytes whose anchor they are."""
    head = head_length(length)
    raw = np.frombuffer(data, dtype=np.uint8)
    for first in range(0, len(raw) - length + 1, STARTS):
        hashes = _gram_hashes(raw[first : first + STARTS + length - 1], head)
        # of equal hashes the first one is the least
        ordered = (hashes & ~np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(ordered, length - head + 1) & np.uint64(_PLACE)).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        low = np.concatenate([[0], cut])
        high = np.concatenate([cut - 1, [len(at) - 1]])
        yield hashes[at[low]].view(np.int64), first + at[low], first + low, first + high


def _digest(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_SUFFIXES = "heads array<long>, entries array<long>, whole array<long>, whole2 array<long>, at array<long>, low array<long>, high array<long>"


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """``id, text, n_bytes, own_sha256`` of every row of ``id, content``, and its suffixes as arrays.

    ``text`` is a digest of the text. ``entries`` names each suffix, ``whole`` and ``whole2`` are a digest
    of all bytes of the strings it is the anchor of.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text", "n_bytes", "own_sha256", *(p.split()[0] for p in _SUFFIXES.split(", "))]
        longs = pa.list_(pa.int64())

        def row(own: pa.Array, text: str | None) -> pa.RecordBatch:
            data = (text or "").encode("utf-8", "surrogatepass")
            name = _digest(data)
            parts = list(anchors(data, length))
            parts = parts or [(np.empty(0, dtype=np.int64),) * 4]
            head, at, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
            places = at.tolist()
            entries = [_long(xxhash.xxh3_64_intdigest(name, a)) for a in places]
            both = b"".join(
                xxhash.xxh3_128_digest(data[a : b + length], c - a)
                for c, a, b in zip(places, low.tolist(), high.tolist(), strict=True)
            )
            both = np.frombuffer(both, dtype="<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [
                    own,
                    pa.array([name], pa.binary()),
                    pa.array([len(data)], pa.int64()),
                    pa.array([sha256(data).hexdigest()], pa.string()),
                    *(pa.array([x], longs) for x in (head, entries, both[:, 0], both[:, 1], at, low, high)),
                ],
                names,
            )

        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(1)):
                held.append(row(batch.column(0).slice(i, 1), text.as_py()))
                size += held[-1].nbytes
                if size > BATCH_BYTES:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    id_field = T.StructField("id", docs.schema[0].dataType)
    schema = T.StructType(
        [id_field, *T.StructType.fromDDL("text binary, n_bytes long, own_sha256 string"), *T.StructType.fromDDL(_SUFFIXES)]
    )
    return docs.mapInArrow(each, schema)


def _scanned(arrays: list[DataFrame]) -> DataFrame:
    """``head, entry, other``: the least and greatest entry of each head of some suffix arrays."""
    rows = arrays[0].select("head", "entry")
    for array in arrays[1:]:
        rows = rows.union(array.select("head", "entry"))
    return rows.groupBy("head").agg(F.min("entry").alias("entry"), F.max("entry").alias("other"))


class SuffixLevels:
    """A family of suffix arrays whose sizes grow geometrically, and the heads met twice.

    ``add`` takes the suffixes of a new batch, ``head, entry``. Its array is scanned together with the
    existing levels, in one sorted pass, for heads that come again; levels of equal rank merge
    into one of the next rank in that same pass, like the carries of a binary counter. So a
    suffix is written again as often as the logarithm of the number of batches. A level keeps one row for each
    head, which is all that a later scan needs. Levels are Parquet in the shared folder.
    """

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.met: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        rank, merging = 0, []
        while rank in self.levels:
            merging.append(self.levels.pop(rank))
            rank += 1
        rest = list(self.levels.values())
        array = written(_scanned([batch, *merging]).sortWithinPartitions("head"), "suffix-level")
        self.met.append(array.where("entry <> other").select("head"))
        self.levels[rank] = array.select("head", "entry")
        if rest:
            met = _scanned([array, *rest]).where("entry <> other").select("head")
            self.met.append(written(met, "suffix-met"))

    def repeated_heads(self) -> DataFrame:
        """``head`` of all suffixes that begin as another one does; a head may come more than once."""
        found = self.met[0]
        for more in self.met[1:]:
            found = found.union(more)
        return found


def _filter(longs: DataFrame):
    """A bitmap of the hashes in the one column of ``longs``, sent to all tasks.

    It has 2^FILTER_POWER bits whatever the number of rows. It lets through all rows with one of the
    hashes and few others, so it saves shuffles and decides nothing. The lowest bits of a hash are its
    place: anchors are least in the highest.
    """
    slot = F.col(longs.columns[0]).bitwiseAND(F.lit((1 << FILTER_POWER) - 1).cast("long")).alias("slot")
    maps = (
        longs.select(slot)
        .groupBy(F.shiftright("slot", 15).alias("map"))
        .agg(F.bitmap_construct_agg(F.expr("slot & 32767L")).alias("bits"))
    )
    bits = np.zeros((1 << FILTER_POWER) // 8, dtype=np.uint8)
    for row in maps.collect():
        bits[row["map"] * 4096 : (row["map"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return longs.sparkSession.sparkContext.broadcast(bits)


def _passing(bits: np.ndarray, longs: np.ndarray) -> np.ndarray:
    slot = longs & ((1 << FILTER_POWER) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


_ROW = "text binary, n_bytes long, head long, entry long, whole long, whole2 long, at long, low long, high long"


def _met_suffixes(found: DataFrame, met: DataFrame) -> DataFrame:
    """A row for each suffix whose head comes twice, and for few others; a task gives a text once."""
    sent = _filter(met)
    names = [part.split()[0] for part in _ROW.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            new = [i for i, text in enumerate(batch.column("text").to_pylist()) if not (text in seen or seen.add(text))]
            batch = batch.take(pa.array(new, pa.int64()))
            lists = [batch.column(f"{c}").flatten() for c in ("heads", "entries", "whole", "whole2", "at", "low", "high")]
            counts = np.diff(batch.column("heads").offsets.to_numpy())
            keep = np.flatnonzero(_passing(sent.value, lists[0].to_numpy(zero_copy_only=False)))
            owner = np.repeat(np.arange(batch.num_rows), counts)[keep]
            for at in range(0, len(keep), 1 << 16):
                part, own = pa.array(keep[at : at + (1 << 16)]), pa.array(owner[at : at + (1 << 16)])
                columns = [batch.column("text").take(own), batch.column("n_bytes").take(own)]
                yield pa.RecordBatch.from_arrays([*columns, *(x.take(part) for x in lists)], names)

    columns = ("text", "n_bytes", "heads", "entries", "whole", "whole2", "at", "low", "high")
    return found.select(*columns).mapInArrow(each, _ROW)


def _classes(rows: DataFrame, key: list[str], own: list[str], label: str) -> DataFrame:
    """``*key, *own, first, same, open``: the classes of rows that agree in ``key`` and ``own``.

    ``first`` is their least entry and ``same`` whether there are two. A class is ``open`` if another
    class has its key. Left out are classes that are neither, which match nothing.
    """
    grouped = rows.groupBy(*key, *own).agg(F.min("entry").alias("first"), F.max("entry").alias("last"))
    grouped = written(grouped, f"{label}-classes")
    ends = [f(c).alias(f"{name}_{c}") for c in own for f, name in ((F.min, "least"), (F.max, "most"))]
    keys = grouped.groupBy(*key).agg(*ends)
    keys = keys.where(" OR ".join(f"least_{c} <> most_{c}" for c in own)).select(*(F.col(c).alias(f"of_{c}") for c in key))
    keys = written(keys, f"{label}-open")
    matches = [F.col(c) == F.col(f"of_{c}") for c in key]
    states = grouped.join(keys, matches, "left").select(
        *key, *own, "first", F.expr("first <> last").alias("same"), F.col(f"of_{key[0]}").isNotNull().alias("open")
    )
    return written(states.where("same OR open"), f"{label}-states")


def _stated(rows: DataFrame, states: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with the ``same``, ``open`` and ``first`` of their class."""
    states = states.select(*(F.col(c).alias(f"of_{c}") for c in key), "first", "same", "open")
    return rows.join(states, [F.col(c) == F.col(f"of_{c}") for c in key])


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text, data`` of the ``wanted`` texts, each once, and of few others."""
    sent = _filter(wanted.select(_front("text")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            names, texts, size = [], [], 0
            for text in batch.column(0):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                name = _digest(data)
                if name in seen or not _passing(sent.value, np.frombuffer(name[:8], dtype=">i8").astype(np.int64))[0]:
                    continue
                seen.add(name)
                names.append(name)
                texts.append(data)
                size += len(data)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.binary())], ["text", "data"])
                    names, texts, size = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.binary())], ["text", "data"])

    found = docs.mapInArrow(each, "text binary, data binary")
    return found.groupBy("text").agg(F.first("data").alias("data"))


def _front(column: str):
    """The first eight bytes of a digest as a long."""
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long").alias("front")


def _surroundings(needed: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """A row for each of the ``needed`` suffixes with the bytes of all strings in its steps."""
    schema = "text binary, n_bytes long, head long, entry long, at long, low long, high long, decide boolean, origin long, data binary"
    width = step_size(length)
    names = [part.split()[0] for part in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), *(pa.int64(),) * 6, pa.bool_(), pa.int64(), pa.binary()]
        for batch in batches:
            rows, size = [], 0
            for text, n_bytes, items, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                text, n_bytes, data = text.as_py(), n_bytes.as_py(), data.as_py()
                for x in items.as_py():
                    first = max(0, x["at"] - (x["at"] - x["low"]) // width * width - width + 1)
                    last = min(n_bytes, x["at"] - (x["at"] - x["high"]) // width * width + length)
                    part = data[first:last]
                    rows.append((text, n_bytes, *(x[c] for c in ("head", "entry", "at", "low", "high", "decide")), first, part))
                    size += len(part)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    both = texts.withColumnRenamed("text", "held").join(needed, F.col("held") == F.col("text"))
    return both.select("text", "n_bytes", "needed", "data").mapInArrow(each, schema)


_STEP = "key long, key2 long, own long, entry long, low long, step long, decide boolean"
_START = "key long, key2 long, entry long, text binary, start long, decide boolean"


def _halves(data: bytes, seed: int) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(data, seed)
    return _long(both >> 64), _long(both & 0xFFFFFFFFFFFFFFFF)


def _steps(around: DataFrame, length: int) -> DataFrame:
    """A row for each step of offsets from an anchor.

    ``key, key2`` is a digest of the bytes that all strings at those offsets share, and ``own`` of the bytes that
    they cover together; offsets are part of both. Where one string would leave the text ``own`` is the entry.
    """
    width = step_size(length)
    names = [part.split()[0] for part in _STEP.split(", ")]
    types = (*(pa.int64(),) * 6, pa.bool_())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, entry, at, low, high, decide, origin, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for step in range((at - high) // width, (at - low) // width + 1):
                    last = at - step * width
                    first = last - width + 1
                    keys = _halves(data[last - origin : first + length - origin], step)
                    whole = first >= 0 and last + length <= n
                    own = xxhash.xxh3_64_intdigest(data[first - origin : last + length - origin], step) if whole else entry
                    rows.append((*keys, _long(own) if whole else own, entry, low, step, decide))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names)

    return around.select("n_bytes", "entry", "at", "low", "high", "decide", "origin", "data").mapInArrow(each, _STEP)


def _starts(around: DataFrame, length: int) -> DataFrame:
    """A row for each start of a string in a step that is still open, with a digest of the string and its offset."""
    width = step_size(length)
    names = [part.split()[0] for part in _START.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, entry, at, low, high, origin, data, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for x in steps:
                    last = at - x["step"] * width
                    for start in range(max(low, last - width + 1), min(high, last) + 1):
                        keys = _halves(data[start - origin : start + length - origin], at - start)
                        rows.append((*keys, entry, text, start, x["decide"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names)

    return around.select("text", "entry", "at", "low", "high", "origin", "data", "steps").mapInArrow(each, _START)


def merged(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes, ``start, end``, of strings that start within ``ranges``, ends included."""
    found: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], high + length))
        else:
            found.append((low, high + length))
    return found


def _decided(found: DataFrame, docs: DataFrame, length: int, batches: int) -> DataFrame:
    """``text, n_bytes, ranges``: the starts of repeated strings of each text that has some."""
    family, width = SuffixLevels(), step_size(length)
    pairs = found.select("text", F.explode(F.arrays_zip("heads", "entries")).alias("x"))
    pairs = pairs.select(F.expr(f"pmod(xxhash64(text), {batches})").alias("batch"), F.col("x.heads").alias("head"), F.col("x.entries").alias("entry"))
    for number in range(batches):
        family.add(pairs.where(F.col("batch") == number))
    rows = _met_suffixes(found, family.repeated_heads())
    states = _classes(rows, ["head"], ["whole", "whole2"], "suffix")
    known = _stated(rows, states, ["head", "whole", "whole2"])
    per_text = known.groupBy("text", "n_bytes").agg(
        F.collect_set(F.expr("IF(same, struct(low, high), NULL)")).alias("ranges"),
        F.collect_set(
            F.expr("IF(open AND (NOT same OR entry = first), struct(head, entry, at, low, high, NOT same AS decide), NULL)")
        ).alias("needed"),
    )
    per_text = written(per_text, "suffix-texts")
    needed = per_text.where("size(needed) > 0").select("text", "n_bytes", "needed")
    around = written(_surroundings(needed, _texts(docs, needed), length), "suffix-around")

    steps = _steps(around, length)
    states = _classes(steps, ["key", "key2"], ["own"], "step")
    known = _stated(steps, states, ["key", "key2", "own"])
    per_suffix = known.groupBy(F.col("entry").alias("of"), F.col("low").alias("of_low")).agg(
        F.collect_set(F.expr("IF(same AND decide, step, NULL)")).alias("done"),
        F.collect_set(
            F.expr("IF(open AND (NOT same OR entry = first), struct(step, decide AND NOT same AS decide), NULL)")
        ).alias("steps"),
    )
    per_suffix = written(per_suffix, "suffix-steps")
    stepped = written(
        around.join(per_suffix, (F.col("entry") == F.col("of")) & (F.col("low") == F.col("of_low"))), "suffix-stepped"
    )

    starts = _starts(stepped.where("size(steps) > 0"), length)
    twice = starts.groupBy("key", "key2").agg(F.min("entry").alias("first"), F.max("entry").alias("last"))
    twice = twice.where("first <> last").select(F.col("key").alias("of"), F.col("key2").alias("of2"))
    twice = written(twice, "suffix-twice")
    single = starts.where("decide").join(twice, (F.col("key") == F.col("of")) & (F.col("key2") == F.col("of2")), "left_semi")

    step = stepped.select("text", "low", "high", F.explode("done").alias("step"), "at")
    ranges = step.select(
        "text",
        F.expr(f"struct(greatest(low, at - step * {width} - {width - 1}) AS low, least(high, at - step * {width}) AS high)").alias("range"),
    )
    ranges = ranges.union(single.select("text", F.expr("struct(start AS low, start AS high)")))
    ranges = ranges.groupBy(F.col("text").alias("of")).agg(F.collect_set("range").alias("more"))
    both = per_text.join(ranges, F.col("text") == F.col("of"), "left")
    both = both.select("text", "n_bytes", F.expr("concat(ranges, coalesce(more, array()))").alias("ranges"))
    return both.where("size(ranges) > 0")


_SPANS = "array<struct<start: long, end: long>>"


def _spans(decided: DataFrame, length: int) -> DataFrame:
    """``text, n_bytes, spans, n_removed`` of the texts that lose bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [merged([(x["low"], x["high"]) for x in r], length) for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[{"start": a, "end": b} for a, b in own] for own in spans], kind),
                    pa.array([sum(b - a for a, b in own) for own in spans], pa.int64()),
                ],
                ["text", "n_bytes", "spans", "n_removed"],
            )

    return decided.mapInArrow(each, f"text binary, n_bytes long, spans {_SPANS}, n_removed long")


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes of ``data`` outside ``spans``."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]])


def _kept_digests(docs: DataFrame, partial: DataFrame) -> DataFrame:
    """``text, kept_sha256`` of texts of which some bytes are left."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [
                sha256(cut(data.as_py(), [(x["start"], x["end"]) for x in spans.as_py()])).hexdigest()
                for data, spans in zip(batch.column(1), batch.column(2), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], ["text", "kept_sha256"])

    both = _texts(docs, partial).withColumnRenamed("text", "held").join(partial, F.col("held") == F.col("text"))
    return both.select("text", "data", "spans").mapInArrow(each, "text binary, kept_sha256 string")


def repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES
) -> DataFrame:
    """``id_col, n_bytes, spans, n_removed, kept_sha256`` of every row of ``docs``.

    ``spans`` are the maximal runs of bytes of a text's UTF-8 form that lie in some string of ``length``
    bytes which also starts anywhere else, in this text or another; strings are judged on the texts as they
    are, and ``kept_sha256`` is the digest of the other bytes. Repeated rows are texts of their own, so all
    of their bytes go, unless they have fewer than ``length``. A null text is empty; a null id
    stays null; an empty table gives an empty result.

    Batches of the table enter a family of suffix arrays one after another. What begins alike is
    compared in three rounds: all strings of an anchor together, STEP next to each other, single ones; each
    round takes what the one before left open. Digests of 128 bits stand for the bytes. Equal
    strings are counted where they lie, so a passage in very many texts is a row for each task and not a
    group in one, and texts are shuffled only where some but not all of their strings come twice.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("content"))
    found = written(suffixes(plain, length), "suffixes")
    texts = docs.select(F.col(text_col).cast("string").alias("content"))
    spans = written(_spans(_decided(found, texts, length, batches), length), "suffix-spans")

    rows = found.select("id", "text", "n_bytes", "own_sha256")
    copies = rows.groupBy(F.col("text").alias("of")).agg(F.count("*").alias("n"), F.first("n_bytes").alias("size"))
    copies = copies.where(f"n > 1 AND size >= {length}").select("of", "size")
    copies = written(copies, "suffix-copies")
    single = spans.join(copies.select("of"), F.col("text") == F.col("of"), "left_anti")
    partial = written(single.where("n_removed < n_bytes").select("text", "spans"), "suffix-partial")
    kept = _kept_digests(texts, partial).select(F.col("text").alias("cut"), "kept_sha256")
    changed = single.join(kept, F.col("text") == F.col("cut"), "left").select(
        F.col("text").alias("of"), "spans", "n_removed", F.coalesce("kept_sha256", F.sha2(F.lit(""), 256)).alias("left")
    )
    whole = copies.select(
        "of", F.expr("array(struct(0L AS start, size AS end))"), "size", F.sha2(F.lit(""), 256).alias("left")
    )
    changed = written(changed.union(whole), "suffix-changed")
    return rows.join(changed, F.col("text") == F.col("of"), "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("spans", F.expr(f"CAST(array() AS {_SPANS})")).alias("spans"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("left", "own_sha256").alias("kept_sha256"),
    )
