"""Licence notices in documents: MinHash over overlapping windows finds, exact containment decides."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


SHINGLE = 5
CONTAINED = 0.8
#: a window that contains a template shares a band with it with this probability at least
COLLISION = 0.9999
#: rows of a band; with one, every shared minimum is a candidate
ROWS = 1
#: a window is three blocks of half its class's size
BLOCKS = 3
SMALLEST_CLASS = 4
#: bytes of text and words that are worked on together
SLICE_BYTES = 4 << 20
SLICE_WORDS = 200_000
SEED = 20_240_501
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

# Short notices as projects write them, and the opening notices of public licences.
NOTICES = (
    ("mit-line", "MIT", "Released under the MIT License."),
    ("apache-line", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-line", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-line", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "mit-permission",
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions:",
    ),
    (
        "apache-notice",
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
        " in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl-notice",
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version.",
    ),
    (
        "bsd-conditions",
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met:",
    ),
)


def _lower_table() -> np.ndarray:
    """A byte in lower case if it belongs to a word (letter, digit or part of a longer character)."""
    table = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0x80 or c.isalnum():
            table[b] = b if b >= 0x80 else ord(c.lower())
    return table


_LOWER = _lower_table()
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; no word goes over a place of ``breaks``."""
    inside = _LOWER[data] > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same in either case of ASCII letters."""
    found = np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), SLICE_WORDS):
        a, b = starts[at : at + SLICE_WORDS], ends[at : at + SLICE_WORDS]
        sizes = b - a
        begins = np.cumsum(sizes) - sizes
        within = np.arange(sizes.sum()) - np.repeat(begins, sizes)
        value = _LOWER[data[np.repeat(a, sizes) + within]].astype(np.uint64) * _POWERS[within % len(_POWERS)]
        found[at : at + SLICE_WORDS] = np.add.reduceat(value, begins)
    return _mixed(found)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """A number for every run of SHINGLE words."""
    count = max(0, len(words) - SHINGLE + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(SHINGLE):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return _mixed(total)


def bands_for(size: int, window: int, contained: float = CONTAINED) -> int:
    """Bands that make a collision as likely as COLLISION.

    Of a template's ``size`` shingles a window of ``window`` holds ``contained`` or more; its
    other shingles only make the union larger, so the similarity is at least shared / union.
    """
    shared = max(1, math.ceil(contained * size - 1e-9))
    similarity = shared / (size + window - shared)
    one = similarity**ROWS
    return 1 if one >= 1 else max(1, math.ceil(math.log(1 - COLLISION) / math.log(1 - one)))


@dataclass(frozen=True)
class Template:
    name: str
    license: str
    shingles: frozenset
    hashes: np.ndarray
    block: int
    bands: int

    @classmethod
    def of(cls, name: str, license_: str, text: str, contained: float) -> Template:
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        starts, ends = word_spans(data, np.empty(0, dtype=np.int64))
        words = _words(data, starts, ends)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        hashes = np.unique(shingle_hashes(word_hashes(data, starts, ends)))
        shingles = frozenset(zip(*(words[k:] for k in range(SHINGLE)), strict=False))
        run = len(words) - SHINGLE + 1
        size = SMALLEST_CLASS
        while size < run:
            size *= 2
        block = size // 2
        return cls(name, license_, shingles, hashes, block, bands_for(len(shingles), BLOCKS * block, contained))


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [_LOWER[data[a:b]].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Scanner:
    """Finds templates in runs of texts."""

    def __init__(self, notices: Sequence[tuple[str, str, str]], contained: float):
        self.contained = contained
        self.templates = [Template.of(*notice, contained) for notice in notices]
        self.blocks = sorted({t.block for t in self.templates})
        functions = ROWS * max((t.bands for t in self.templates), default=0)
        draw = np.random.default_rng(SEED).integers(0, 1 << 63, size=(2, functions), dtype=np.uint64)
        self.factors, self.terms = draw[0] * np.uint64(2) + np.uint64(1), draw[1]
        # minima of all templates for all hash functions
        self.minima = np.array(
            [[(t.hashes * a + c).min() for a, c in zip(self.factors, self.terms, strict=True)] for t in self.templates],
            dtype=np.uint64,
        )

    def candidates(self, shingles: np.ndarray, real: np.ndarray) -> set[tuple[int, int]]:
        """(template, window) that agree in all rows of a band."""
        found: set[tuple[int, int]] = set()
        size = 2 * max(self.blocks, default=1)
        padded = np.zeros(-(-max(len(shingles), 1) // size) * size, dtype=np.uint64)
        padded[: len(shingles)] = shingles
        empty = np.ones(len(padded), dtype=bool)
        empty[: len(shingles)] = ~real
        agreed: list[np.ndarray | None] = [None] * len(self.templates)
        for j, (factor, term) in enumerate(zip(self.factors, self.terms, strict=True)):
            least = padded * factor + term
            least[empty] = _NONE
            width = 1
            for block in self.blocks:
                while width < block:
                    least = np.minimum(least[0::2], least[1::2])
                    width *= 2
                # the first and last window reach beyond the ends
                edge = np.full(BLOCKS - 1, _NONE)
                long = np.concatenate([edge, least, edge])
                count = len(least) + BLOCKS - 1
                window = long[:count]
                for k in range(1, BLOCKS):
                    window = np.minimum(window, long[k : k + count])
                for t, template in enumerate(self.templates):
                    if template.block == block and j < ROWS * template.bands:
                        same = window == self.minima[t, j]
                        agreed[t] = same if j % ROWS == 0 else agreed[t] & same
                        if j % ROWS == ROWS - 1:
                            found.update((t, int(w)) for w in np.flatnonzero(agreed[t]))
        return found

    def scan(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, int]]:
        """(document, template, containment, first word) for texts that lie end to end in ``data``."""
        starts, ends = word_spans(data, bounds)
        first_word = np.searchsorted(starts, bounds)
        shingles = shingle_hashes(word_hashes(data, starts, ends))
        # a shingle that goes on into the next document is none
        owner = np.searchsorted(first_word, np.arange(len(shingles)), "right") - 1
        real = np.arange(len(shingles)) + SHINGLE <= first_word[owner + 1]
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for t, w in sorted(self.candidates(shingles, real)):
            template = self.templates[t]
            low = max(0, (w - BLOCKS + 1) * template.block)
            high = min(len(shingles), (w + 1) * template.block)
            for doc in np.unique(owner[low:high]).tolist():
                a = max(low, int(first_word[doc]))
                b = min(high + SHINGLE - 1, int(first_word[doc + 1]))
                words = _words(data, starts[a:b], ends[a:b])
                runs = list(zip(*(words[k:] for k in range(SHINGLE)), strict=False))
                shared = template.shingles.intersection(runs)
                part = len(shared) / len(template.shingles)
                if part >= self.contained:
                    place = a - int(first_word[doc]) + next(i for i, r in enumerate(runs) if r in shared)
                    old = best.get((doc, t))
                    if old is None or part > old[0] or (part == old[0] and place < old[1]):
                        best[doc, t] = (part, place)
        return [(doc, t, part, place) for (doc, t), (part, place) in sorted(best.items())]


def license_scan(
    docs: DataFrame,
    notices: Sequence[tuple[str, str, str]] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
    contained: float = CONTAINED,
) -> DataFrame:
    """``id_col, template, license, containment, first_word``: a row for each template in each document.

    A template (name, licence, text) is found where a window of the text holds ``contained`` or
    more of its distinct five-word shingles; ``containment`` is the most a window holds and
    ``first_word`` where that begins. Words are runs of letters and digits, any case. Windows are
    at least as long as the template and overlap by two thirds, so that every place of it lies in
    one; the bands find such a window with a probability of COLLISION, and the words themselves
    decide. Whole texts; null, empty and shorter texts hold nothing; repeated rows each return
    their rows; no templates or an empty table give an empty result. The templates are a
    parameter that is sent to every task; nothing is shuffled.
    """
    scanner = Scanner(notices, contained)
    names = [id_col, "template", "license", "containment", "first_word"]
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("template", T.StringType()),
            T.StructField("license", T.StringType()),
            T.StructField("containment", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
        ]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not scanner.templates:
                continue
            texts = pa.array(batch.column(1)).cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            whole = texts.buffers()[2]
            data = np.frombuffer(whole, dtype=np.uint8) if whole is not None else np.empty(0, dtype=np.uint8)
            at = 0
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES)))
                end = min(end, len(texts))
                bounds = offsets[at : end + 1] - offsets[at]
                found = scanner.scan(data[offsets[at] : offsets[end]], bounds)
                if found:
                    rows = pa.array([at + doc for doc, *_ in found])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            pa.array([scanner.templates[t].name for _, t, _, _ in found]),
                            pa.array([scanner.templates[t].license for _, t, _, _ in found]),
                            pa.array([part for _, _, part, _ in found]),
                            pa.array([place for _, _, _, place in found], pa.int64()),
                        ],
                        names,
                    )
                at = end

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("whole text")).mapInArrow(each, schema)
