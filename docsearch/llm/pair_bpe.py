"""Byte-level BPE over an index of the places of every pair."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: characters of text whose new words are merged together
SLICE_CHARS = 4_000_000
#: words a Python worker remembers before it starts afresh
REMEMBERED = 400_000

# Unicode white space, and the words and runs that the byte-level scheme merges within.
SPACE = "\t-\r \x85\xa0  -     　"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: the same with letters, digits and signs in one: what lies between its ends depends on itself alone
_CHUNKS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_WORDS = regex.compile(WORDS)


def byte_names() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: itself if printable."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merges and tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        ids = whole["model"]["vocab"]
        names = byte_names()
        byte_of = {name: b for b, name in enumerate(names)}
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        tokens = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        tokens |= {i: content.encode() for content, i in self.special.items()}
        self.size = max(tokens) + 1
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.of_byte = np.array([ids[name] for name in names], dtype=np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in whole["model"]["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        made = {new: rank for rank, (_, _, new) in enumerate(self.merges)}
        if len(made) < len(self.merges) or any(
            made.get(a, -1) >= rank or made.get(b, -1) >= rank
            for rank, (a, b, _) in enumerate(self.merges)
        ):
            raise ValueError("the merges are not in the order in which their parts are made")
        pairs = np.array([a * self.size + b for a, b, _ in self.merges], dtype=np.int64)
        self.rank_order = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.rank_order]
        lengths = np.array([len(tokens.get(i, b"")) for i in range(self.size)], dtype=np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(self.size)), dtype=np.uint8)
        self.split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; -1 for one that never merges."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.rank_order[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_all(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """The tokens of each word, as bytes, by one index over the bytes of all of them.

    The index maps a pair's rank to the places where the pair stands. Ranks are applied from the
    lowest; a merge changes the pairs left and right of it, whose new places join the lists of
    their ranks. A place that has changed since it was listed no longer holds the pair.
    """
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = len(data)
    token = np.append(vocab.of_byte[data], -1)
    after, before = np.arange(1, end + 2), np.arange(-1, end)
    bounds = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([[0], bounds[:-1]]).astype(np.int64)
    after[bounds - 1] = end
    before[starts] = end
    places: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def listed(at: np.ndarray) -> None:
        at = at[after[at] != end]
        ranks = vocab.ranks(token[at], token[after[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        firsts = [0, *cuts.tolist()]
        for first, last in zip(firsts, [*firsts[1:], len(at)], strict=True):
            rank = int(ranks[first])
            if rank in places:
                places[rank].append(at[first:last])
            else:
                places[rank] = [at[first:last]]
                heapq.heappush(active, rank)

    listed(np.arange(end))
    while active:
        rank = heapq.heappop(active)
        left, right, new = vocab.merges[rank]
        lists = places.pop(rank)
        at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
        second = after[at]
        holds = (token[at] == left) & (token[second] == right)
        at, second = at[holds], second[holds]
        if left == right and (second[:-1] == at[1:]).any():
            free, taken = [], -1
            for i, (a, b) in enumerate(zip(at.tolist(), second.tolist(), strict=True)):
                if a != taken:
                    free.append(i)
                    taken = b
            at, second = at[free], second[free]
        if not len(at):
            continue
        third = after[second]
        token[at], token[second] = new, -2
        after[at] = third
        before[third] = at
        first = before[at]
        listed(np.concatenate([first[first != end], at]))
    kept = np.flatnonzero(token[:end] >= 0)
    whole, width = token[kept].astype(vocab.kind).tobytes(), vocab.kind.itemsize
    cuts = [*(np.searchsorted(kept, starts) * width).tolist(), len(whole)]
    return [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class Encoder:
    """Encodes texts slice by slice; remembers the tokens of words it has met."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: set[str]) -> None:
        known = self.known
        whole = [c for c in chunks if (c[1:] if c[0] == " " else c).isalpha()]
        parts = {c: _WORDS.findall(c) for c in chunks.difference(whole)}
        words = set(whole)
        for found in parts.values():
            words.update(found)
        fresh = [w for w in words if w not in known]
        if fresh:
            known.update(zip(fresh, merge_all([w.encode("utf-8") for w in fresh], self.vocab), strict=True))
        for chunk, found in parts.items():
            if len(found) != 1:
                known[chunk] = b"".join([known[w] for w in found])

    def _pieces(self, text: str) -> list:
        """A text as lists of chunks, with the ids of special tokens between."""
        split = self.vocab.split
        if split is None or not any(s in text for s in self.vocab.special):
            return [_CHUNKS.findall(text)]
        return [
            self.vocab.special[part] if i % 2 else _CHUNKS.findall(part)
            for i, part in enumerate(split.split(text))
        ]

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        pieces = [self._pieces(text) for text in texts]
        met: set[str] = set()
        for text in pieces:
            for piece in text:
                if not isinstance(piece, int):
                    met.update(piece)
        if len(self.known) > REMEMBERED:
            self.known = {}
        self._learn(met - self.known.keys())
        look, kind = self.known.__getitem__, self.vocab.kind
        return [
            np.frombuffer(
                b"".join(
                    [
                        np.array([p], dtype=kind).tobytes() if isinstance(p, int) else b"".join(map(look, p))
                        for p in text
                    ]
                ),
                dtype=kind,
            )
            for text in pieces
        ]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: Iterable[str], most: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Runs of whole texts of about ``most`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


Batches = Iterator[pa.RecordBatch]


def _encoded(batches: Batches, path: str, ids_col: str) -> Batches:
    """The last column, a text, as its ids; the others as they are."""
    encoder = _encoder(path)
    for batch in batches:
        others = batch.schema.names[:-1]
        texts = batch.column(len(others))
        done = 0
        for run in slices(t.as_py() or "" for t in texts):
            ids = encoder.encode(run)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            part = batch.slice(done, len(run))
            done += len(run)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(i) for i in range(len(others))),
                    pa.ListArray.from_arrays(ends, np.concatenate(ids).astype(np.int32)),
                ],
                [*others, ids_col],
            )


def _text_of(ids: np.ndarray, vocab: Vocabulary) -> str:
    lengths = vocab.lengths[ids]
    ends = np.cumsum(lengths)
    source = np.repeat(vocab.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ids) else 0)
    return vocab.bytes[source].tobytes().decode("utf-8", "replace")


def _decoded(batches: Batches, path: str, text_col: str, keep_ids: bool) -> Batches:
    """The last column, ids, as its text; the others as they are."""
    vocab = vocabulary(path)
    for batch in batches:
        last = batch.num_columns - 1
        texts = [
            _text_of(row.values.drop_null().to_numpy().astype(np.int64), vocab) if row.is_valid else None
            for row in batch.column(last)
        ]
        kept = batch.num_columns if keep_ids else last
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(kept)), pa.array(texts, pa.string())],
            [*batch.schema.names[:kept], text_col],
        )


IDS = T.ArrayType(T.IntegerType())


def _schema(table: DataFrame, others: list[str], **more: T.DataType) -> T.StructType:
    return T.StructType([table.schema[c] for c in others] + [T.StructField(k, v) for k, v in more.items()])


def bpe_encode(table: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``table`` with the token ids of ``text_col`` (``array<int>``) in place of the text.

    ``path`` names a byte-level BPE file of the tokenizers library that all executors can open;
    ids are that library's, special tokens written in a text included. Whole texts of any length;
    a null text is an empty one, and an empty one has no ids. Other columns are carried along (one
    named ``ids_col`` is replaced), repeated rows stay, and an empty table gives an empty result.
    """
    others = [c for c in table.columns if c not in (text_col, ids_col)]
    return table.select(*others, F.col(text_col).cast("string")).mapInArrow(
        lambda batches: _encoded(batches, path, ids_col), _schema(table, others, **{ids_col: IDS})
    )


def bpe_decode(table: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``table`` with the text of the token ids in place of the ids.

    Bytes that are no UTF-8 become U+FFFD, special tokens their own text. Null ids give null, a
    null inside the ids counts as no token, no ids an empty text; an id outside the vocabulary is
    an error. Other columns are carried along (one named ``text_col`` is replaced).
    """
    others = [c for c in table.columns if c not in (ids_col, text_col)]
    return table.select(*others, F.col(ids_col).cast("array<int>")).mapInArrow(
        lambda batches: _decoded(batches, path, text_col, False),
        _schema(table, others, **{text_col: T.StringType()}),
    )


def bpe_round_trip(
    table: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", back_col: str = "decoded"
) -> DataFrame:
    """``table`` with the ids of ``text_col`` and the text those ids decode to in place of the text.

    What :func:`bpe_encode` and then :func:`bpe_decode` give, in one pass of one Python worker.
    """
    others = [c for c in table.columns if c not in (text_col, ids_col, back_col)]
    return table.select(*others, F.col(text_col).cast("string")).mapInArrow(
        lambda batches: _decoded(_encoded(batches, path, ids_col), path, back_col, True),
        _schema(table, others, **{ids_col: IDS, back_col: T.StringType()}),
    )
