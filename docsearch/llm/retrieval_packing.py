"""Packing of documents into windows: lexical neighbours fill the window of a seed document."""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from docsearch.llm.pair_bpe import SPACE, byte_names, slices
from docsearch.llm.tables import field_of, written

WINDOW = 2048
#: stands after every document
END_ID = 1
#: a shard's index holds so many documents or so many tokens at most, beyond its last document
SHARD_DOCS = 1024
SHARD_TOKENS = 4_000_000
K1, B = 1.2, 0.75
#: tokens by which documents are brought near each other before they are cut into shards
ROUTES = 3
#: words and chunks an encoder remembers; half of them, those not met of late, are forgotten at a time
REMEMBERED = 1_000_000
SEQUENCE_SHIFT = 40

# What the word scheme takes as one word, after lower-casing.
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
_ASCII_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^{SPACE}a-z0-9]+")
_MARKS = re.compile(r"(?:[^\w ]|_)[.,] ")
_BREAKS = str.maketrans("\t\n\r", "   ")


class _Remembered(dict):
    """What ``make`` gives for a key, kept. Beyond half of REMEMBERED, what is kept becomes the older
    half, and of the older half before it only what is met again stays."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def forget(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts by a word-level BPE file (NFC, lower case, no token across white space).

    The library encodes each distinct word once; a text's ids are those of its words in order. Texts
    with a character that the library and Python's tables class or change differently, as tables of other
    Unicode versions do, are left to the library.
    """

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = dict(enumerate(byte_names()))
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.known = _Remembered(self._chunk)
        self.trusted: set[str] = set()
        self.strange: set[str] = set()

    def _bytes(self, ids: Iterator[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _word(self, word: str) -> bytes:
        plain = word.isascii() and word.isalpha()
        raw = word if plain else word.encode("utf-8").decode("latin-1").translate(self.names)
        return self._bytes([t.id for t in self.model.tokenize(raw)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._word(chunk)
        words = (_ASCII_WORDS if chunk.isascii() else _WORDS).findall(chunk)
        # a chunk that is one word, as a number's digit or a mark, is not looked up again as that word
        return self._word(words[0]) if len(words) == 1 else b"".join([self.known[w] for w in words])

    def _is_strange(self, text: str) -> bool:
        """Whether a text holds a character that the library treats in another way than this class."""
        for met in set(text).difference(self.trusted, self.strange):
            # between letters, alone, and after white space, a class of characters shows in the cuts
            probe = f"a{met}a {met} 1{met}1 !{met}!"
            ours = [w for c in self._chunks(probe) for w in _WORDS.findall(c)]
            theirs = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(probe))
            same = [w.encode("utf-8").decode("latin-1").translate(self.names) for w in ours] == [w for w, _ in theirs]
            (self.trusted if same else self.strange).add(met)
        return bool(self.strange) and not self.strange.isdisjoint(text)

    def _chunks(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = (text.translate(_BREAKS) if "\t" in text or "\r" in text else text.replace("\n", " ")).lower()
        # a mark between a letter or digit and a blank is a word of its own; without it, words are met again more often
        if not _MARKS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces: list[list | None] = []
        for text in texts:
            if not text.isascii() and self._is_strange(text):
                pieces.append(None)
            elif self.split is not None and any(s in text for s in self.special):
                parts = self.split.split(text)
                pieces.append([self.special[p] if i % 2 else self._chunks(p) for i, p in enumerate(parts)])
            else:
                pieces.append([self._chunks(text)])
        self.known.forget()
        look = self.known.__getitem__

        def whole(text: str, made: list | None) -> bytes:
            if made is None:
                return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
            return b"".join([self._bytes([p]) if isinstance(p, int) else b"".join(map(look, p)) for p in made])

        return [np.frombuffer(whole(t, p), dtype=self.kind) for t, p in zip(texts, pieces, strict=True)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _tokens(path: str, names: list[str]):
    """Rows of documents with their ids and routes, and last a row with the task's term counts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([END_ID], dtype=encoder.kind)
        seen = np.zeros(encoder.size, dtype=np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            done = 0
            for run in slices([t or "" for t in batch.column(1).to_pylist()]):
                ids = [np.concatenate([x, end]) for x in encoder.encode(run)]
                routes = np.zeros((len(ids), ROUTES), dtype=np.int32)
                for i, x in enumerate(ids):
                    terms = np.unique(x)
                    seen[terms] += 1
                    # later merges make rarer tokens, so the highest ids say most about a text
                    top = terms[: -ROUTES - 1 : -1]
                    routes[i, : len(top)] = top
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(run)),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        *(pa.array(routes[:, r]) for r in range(ROUTES)),
                        pa.nulls(len(ids), pa.list_(pa.int64())),
                    ],
                    names,
                )
                done += len(run)
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, kind),
                    pa.nulls(1, pa.binary()),
                    *(pa.nulls(1, pa.int32()) for _ in range(ROUTES)),
                    pa.array([seen], pa.list_(pa.int64())),
                ],
                names,
            )

    return each


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for row in batch.column(0):
            counts = row.values.to_numpy()
            total = counts if total is None else total + counts
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["counts"])


class ShardIndex:
    """An inverted BM25 index over the documents of a shard, with the corpus's frequencies."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        found = [np.unique(d, return_counts=True) for d in docs]
        counts = [len(terms) for terms, _ in found]
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        often = np.concatenate([c for _, c in found]).astype(np.float64)
        doc = np.repeat(np.arange(len(docs)), counts)
        length = np.repeat([len(d) for d in docs], counts) / mean_length
        weight = idf[terms] * often * (K1 + 1) / (often + K1 * (1 - B + B * length))
        order = np.argsort(terms, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        listed, self.starts, sizes = np.unique(terms[order], return_index=True, return_counts=True)
        self.ends = self.starts + sizes
        place = np.searchsorted(listed, terms)
        # only terms that lead to another document are worth asking with
        asked = np.where(sizes[place] > 1, weight, 0.0)
        bounds = np.cumsum([0, *counts])
        self.size = len(docs)
        self.queries = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            self.queries.append(place[a:b][asked[a:b] > 0])

    def scores(self, seed: int) -> np.ndarray:
        query = self.queries[seed]
        if not len(query):
            return np.zeros(self.size)
        spans = list(zip(self.starts[query].tolist(), self.ends[query].tolist(), strict=True))
        return np.bincount(
            np.concatenate([self.doc[a:b] for a, b in spans]),
            np.concatenate([self.weight[a:b] for a, b in spans]),
            minlength=self.size,
        )


class Packer:
    """Fills windows one after the other; a piece is (document, start, length)."""

    def __init__(self, window: int):
        self.window = window
        self.open: list[tuple[int, int, int]] = []
        self.fill = 0

    def add(self, doc: int, size: int) -> Iterator[list[tuple[int, int, int]]]:
        """The windows that ``doc`` fills; what is left of it opens the next."""
        at = 0
        while at < size:
            length = min(size - at, self.window - self.fill)
            self.open.append((doc, at, length))
            self.fill += length
            at += length
            if self.fill == self.window:
                yield self.open
                self.open, self.fill = [], 0

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """What is open at the end, cut into sequences whose lengths are powers of two."""
        pieces = self.open[::-1]
        while self.fill:
            room = 1 << (self.fill.bit_length() - 1)
            self.fill -= room
            sequence = []
            while room:
                doc, start, length = pieces.pop()
                taken = min(room, length)
                sequence.append((doc, start, taken))
                room -= taken
                if taken < length:
                    pieces.append((doc, start + taken, length - taken))
            yield sequence


def pack_shard(
    packer: Packer, docs: list[np.ndarray], first: int, idf: np.ndarray, mean_length: float
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of a shard's documents, numbered from ``first``; the last may stay open.

    The document a window opens with is its seed; unused documents follow by their BM25 score for
    it, and the next in order where none shares a term. One that does not fit is cut, and its
    rest opens, and is the seed of, the next window.
    """
    index = ShardIndex(docs, idf, mean_length)
    unused = np.ones(len(docs), dtype=bool)
    seed, scores, next_ = -1, None, 0
    for _ in range(len(docs)):
        if seed >= 0 and packer.fill:
            if scores is None:
                scores = np.where(unused, index.scores(seed), -1.0)
            doc = int(scores.argmax())
            if scores[doc] <= 0:
                doc = -1
        else:
            doc = -1
        if doc < 0:
            while not unused[next_]:
                next_ += 1
            doc = next_
        unused[doc] = False
        if scores is not None:
            scores[doc] = -1.0
        full = list(packer.add(first + doc, len(docs[doc])))
        yield from full
        if not packer.fill:
            seed, scores = -1, None
        elif full or seed < 0:
            seed, scores = doc, None


def _packed(window: int, idf: np.ndarray, mean_length: float, kind: np.dtype, names: list[str]):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window)
        sequence = TaskContext.get().partitionId() << SEQUENCE_SHIFT
        shard: list[np.ndarray] = []
        keys: list = []
        held: dict[int, tuple] = {}  # documents of earlier shards in the open window
        first = 0

        def rows(sequences) -> pa.RecordBatch | None:
            nonlocal sequence
            out: dict[str, list] = {name: [] for name in names}
            for pieces in sequences:
                offset = 0
                for doc, start, length in pieces:
                    key, ids = held[doc] if doc < first else (keys[doc - first], shard[doc - first])
                    values = (
                        key,
                        start,
                        length,
                        ids[start : start + length].astype("<u4").tobytes(),
                        len(ids),
                        sequence,
                        offset,
                    )
                    for name, value in zip(names, values, strict=True):
                        out[name].append(value)
                    offset += length
                sequence += 1
            if not out[names[0]]:
                return None
            types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(out[name], type_) for name, type_ in zip(names, types, strict=True)], names
            )

        def closed() -> pa.RecordBatch | None:
            nonlocal shard, keys, first, held
            made = rows(pack_shard(packer, shard, first, idf, mean_length))
            held = {
                doc: held[doc] if doc < first else (keys[doc - first], shard[doc - first])
                for doc, _, _ in packer.open
            }
            first += len(shard)
            shard, keys = [], []
            return made

        tokens = 0
        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, ids in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(key.as_py())
                shard.append(np.frombuffer(ids.as_py(), dtype=kind))
                tokens += len(shard[-1])
                if len(shard) == SHARD_DOCS or tokens >= SHARD_TOKENS:
                    if (made := closed()) is not None:
                        yield made
                    tokens = 0
        if shard and (made := closed()) is not None:
            yield made
        if packer.fill and (made := rows(packer.rest())) is not None:
            yield made

    return each


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    Columns: ``id_col, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``. A document is its ids by the word-level tokenizer file ``path``, which
    all executors can open, and then END_ID; it is cut where a window ends, and each of its ids lies in
    exactly one piece. A null or empty text is END_ID alone. Repeated rows are packed each, null ids
    are carried, and an empty table gives an empty result.

    Documents are sorted by their rarest tokens, so that related ones share a range partition
    and, within it, a shard of bounded size with its inverted index. Weights use document
    frequencies over all documents, a vector as long as the vocabulary. Windows are full except
    at the end of a partition, where lengths are powers of two, so no sequence needs padding.
    """
    encoder = word_encoder(path)
    names = ["id", "ids", *(f"r{i}" for i in range(ROUTES)), "counts"]
    schema = T.StructType(
        [
            field_of(docs, id_col, "id"),
            T.StructField("ids", T.BinaryType()),
            *(T.StructField(f"r{i}", T.IntegerType()) for i in range(ROUTES)),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    table = written(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
            _tokens(path, names), schema
        ),
        "tokens",
    )
    seen = np.zeros(encoder.size, dtype=np.int64)
    counted = (
        table.where("counts is not null")
        .select("counts")
        .mapInArrow(_summed, "counts array<long>")
        .select(F.posexplode("counts").alias("term", "n"))
        .where("n > 0")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    for term, n in counted.collect():  # one row a vocabulary entry at most
        seen[term] = n
    stored = table.where("ids is not null")
    totals = stored.agg(F.count("*").alias("docs"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    mean_length = max(1.0, (totals["bytes"] or 0) / encoder.kind.itemsize / max(1, totals["docs"]))
    # a term in more than half of all documents says nothing and weighs nothing
    idf = np.maximum(0.0, np.log((totals["docs"] - seen + 0.5) / (seen + 0.5)))
    order = [*(f"r{i}" for i in range(ROUTES)), "id"]
    out = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    packed = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            *(T.StructField(name, T.LongType()) for name in out[4:]),
        ]
    )
    return (
        stored.select("id", "ids", *order[:-1])
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "ids")
        .mapInArrow(_packed(window, idf, mean_length, encoder.kind, out), packed)
    )
