"""Periodic runs of words, found by a dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.tables import field_of

#: a run has so many words at least, and so many periods
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: about so many bytes of results are handed on at once
BATCH_BYTES = 8 << 20

#: words of a document by its id and its own words
Prepare = Callable[[object, list[bytes]], list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    """The runs of bytes that are no ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each value among the distinct ones, and how often each rank occurs."""
    _, ranks, counts = np.unique(values, return_inverse=True, return_counts=True)
    return ranks.reshape(-1), counts


def _proposals(at: np.ndarray, names: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """``first, last, period``: places one after another whose factor of ``length`` words comes
    again first after ``period`` words.

    Only periods above half of ``length`` and up to it are proposed: a shorter one is proposed
    by shorter factors, and a run of a longer one has longer factors.
    """
    order = np.lexsort((at, names))
    place, name = at[order], names[order]
    gap = place[1:] - place[:-1]
    near = (name[1:] == name[:-1]) & (gap <= 2 * length) & (2 * gap > length) & (gap <= length)
    if not near.any():
        return
    place, gap = place[:-1][near], gap[near]
    order = np.lexsort((place, gap))
    place, gap = place[order], gap[order]
    ends = np.flatnonzero((place[1:] != place[:-1] + 1) | (gap[1:] != gap[:-1]))
    firsts = np.concatenate([[0], ends + 1])
    lasts = np.concatenate([ends, [len(place) - 1]])
    yield from zip(place[firsts].tolist(), place[lasts].tolist(), gap[firsts].tolist(), strict=True)


def _extended(words: np.ndarray, first: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``[first, end)`` that keeps ``period``, in steps that double."""
    step = 64
    while first > 0:
        low = max(0, first - step)
        differ = np.flatnonzero(words[low:first] != words[low + period : first + period])
        if len(differ):
            first = low + int(differ[-1]) + 1
            break
        first, step = low, 2 * step
    step = 64
    while end < len(words):
        high = min(len(words), end + step)
        differ = np.flatnonzero(words[end:high] != words[end - period : high - period])
        if len(differ):
            end += int(differ[0])
            break
        end, step = high, 2 * step
    return first, end


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every maximal run of a sequence of word numbers, in order.

    The names of factors of 1, 2, 4, ... words are made from those of half the length. A factor
    that occurs once names no period, nor does one that holds it, so names are kept for the others
    alone and most texts need a few lengths only. Within a run of period q, a factor of q words or
    more comes again first after q words, as q is the smallest period; so the factors of the least
    power of two that is not below q propose it at every place where the run has 4 q words.
    """
    found = set()
    at, names, length = np.arange(len(words)), words, 1
    while len(at) > 1:
        names, counts = _ranks(names)
        often = counts[names] > 1
        at, names = at[often], names[often]
        for first, last, period in _proposals(at, names, length):
            start, end = _extended(words, first, last + length + period, period)
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found.add((start, end - start, period))
        # a factor of twice the length, where both of its halves occur more than once
        after = np.searchsorted(at, at + length)
        after[after == len(at)] = 0
        whole = at[after] == at + length if len(at) else np.zeros(0, dtype=bool)
        names = names[whole] * (int(names.max(initial=0)) + 1) + names[after[whole]]
        at, length = at[whole], 2 * length
    return sorted(found, key=lambda run: (run[0], run[2]))


def _kept(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    edge = np.zeros(count + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:count] == 0


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare: Prepare | None = None
) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every row of ``docs``.

    Words are runs of bytes that are no ASCII white space, numbered from 0. ``runs`` holds
    ``start, length, period`` of each stretch of words with smallest period q and max(6, 4 q)
    words or more that no neighbouring word extends, by start and then period. ``collapsed`` is
    the words that no run holds after its first q words, joined by a blank. ``prepare`` may change
    the words of a document first.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows each
    return a row, a null id stays null, an empty table gives an empty result. Texts are
    worked on whole, one at a time, and nothing is shuffled.
    """
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType(
        [
            field_of(docs, id_col, id_col),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    kinds = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, runs, texts, size = [], [], [], [], 0

            def done() -> pa.RecordBatch:
                columns = [
                    pa.array(ids, batch.schema.field(0).type),
                    pa.array(sizes, pa.int64()),
                    pa.array(runs, kinds),
                    pa.array(texts, pa.string()),
                ]
                return pa.RecordBatch.from_arrays(columns, schema.names)

            for own, text in zip(batch.column(0), batch.column(1), strict=True):
                own = own.as_py()
                words = words_of(text.as_py())
                if prepare is not None and words:
                    words = prepare(own, words)
                numbers: dict[bytes, int] = {}
                coded = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
                # a sequence without a word that comes twice has no run
                found = runs_of(coded) if len(numbers) < len(words) else []
                left = words
                if found:
                    left = [words[i] for i in np.flatnonzero(_kept(len(words), found)).tolist()]
                ids.append(own)
                sizes.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                texts.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size > BATCH_BYTES:
                    yield done()
                    ids, sizes, runs, texts, size = [], [], [], [], 0
            if ids:
                yield done()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, schema)
