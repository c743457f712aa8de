"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docsearch.llm.tables import free_name

#: n-grams in a profile
PROFILE = 300
#: about so many labelled rows of a language are learned from, those of least hash
ROWS_PER_LANGUAGE = 2000
#: profiles are sent to every task, so their number is checked
MAX_LANGUAGES = 1000
UNKNOWN = "und"
HASH_STEPS = 1 << 20
_CODE_BITS = 21
_BLANK = 0x20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one to three characters of a whole text, and how often each occurs.

    Words are runs of letters in lower case with a blank at either side; an n-gram lies within a
    word. It is one number, 21 bits a character. A text without letters has none.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.concatenate([[_BLANK], np.where(_letters()[codes], codes, _BLANK), [_BLANK]])
    codes = codes[np.concatenate([[True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)])]
    one = codes[codes != _BLANK]
    if not len(one):
        return one, one
    two = codes[:-1] << _CODE_BITS | codes[1:]
    middle = codes[1:-1]
    three = (codes[:-2] << 2 * _CODE_BITS | middle << _CODE_BITS | codes[2:])[middle != _BLANK]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(found: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The ``most`` most frequent n-grams; equal counts in the order of the n-grams."""
    return found[np.lexsort((found, -counts))[:most]]


class Profiles:
    """The profiles of all languages side by side."""

    def __init__(self, by_language: dict[str, np.ndarray], size: int = PROFILE):
        self.languages = sorted(by_language)
        self.size = size
        self.grams = np.unique(np.concatenate([*by_language.values(), np.empty(0, dtype=np.int64)]))
        # an n-gram that a profile lacks is as far out of place as can be
        self.ranks = np.full((len(self.languages), len(self.grams) + 1), -1, dtype=np.int64)
        for row, language in enumerate(self.languages):
            profile = by_language[language]
            self.ranks[row, np.searchsorted(self.grams, profile)] = np.arange(len(profile))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language at the least out-of-place distance, and one less that distance as a share
        of the largest possible; equal distances go to the first language by name."""
        found, counts = grams(text) if text else (np.empty(0), None)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(found, counts, self.size)
        at = np.searchsorted(self.grams, own)
        at = np.where(self.grams[np.minimum(at, len(self.grams) - 1)] == own, at, len(self.grams))
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(apart.argmin())
        return self.languages[best], float(1 - apart[best] / (self.size * len(own)))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    rest = F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> DataFrame:
    """``language, gram, place``: the profile of every value of ``label_col``.

    Learned from rows that are not held out and have an id, a text and a label: all of a language
    with up to ``rows_per_language`` of them, else those whose hash falls in the share that makes
    about so many. N-grams are counted in each task and summed in Spark; ranks are found without
    bringing all n-grams of a language together. An empty table gives no profile.
    """
    labelled = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(label_col).cast("string").alias("language"),
        held_out(id_col).alias("held"),
    ).where("id is not null and text is not null and language is not null and not held")
    rates = labelled.groupBy(F.col("language").alias("rated")).agg(
        F.least(F.lit(1.0), rows_per_language / F.count("*")).alias("rate")
    )
    place = F.pmod(F.xxhash64("id"), F.lit(HASH_STEPS)) / HASH_STEPS
    sample = labelled.join(rates, F.col("language") == F.col("rated")).where(place < F.col("rate"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            parts: dict[str, list] = {}
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts.setdefault(language, []).append(grams(text))
            for language, some in parts.items():
                some.append(totals.get(language, (np.empty(0, np.int64), np.empty(0, np.int64))))
                found, place_ = np.unique(np.concatenate([g for g, _ in some]), return_inverse=True)
                counts = np.zeros(len(found), dtype=np.int64)
                np.add.at(counts, place_, np.concatenate([c for _, c in some]))
                totals[language] = (found, counts)
        for language, (found, counts) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language] * len(found), pa.string()),
                    pa.array(found, pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["language", "gram", "n"],
            )

    order = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    return (
        sample.select("language", "text")
        .mapInArrow(counted, "language string, gram long, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(order) - 1)
        .where(F.col("place") < PROFILE)
        .select("language", "gram", "place")
    )


def collected(profiles: DataFrame) -> Profiles:
    """Profiles as a small value for all tasks: PROFILE numbers for each of MAX_LANGUAGES at most."""
    rows = profiles.orderBy("language", "place").limit(MAX_LANGUAGES * PROFILE + 1).collect()
    if len(rows) > MAX_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    by_language: dict[str, list[int]] = {}
    for row in rows:
        by_language.setdefault(row["language"], []).append(row["gram"])
    return Profiles({k: np.array(v, dtype=np.int64) for k, v in by_language.items()})


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) from the whole text alone.

    A null text, one without a letter, and any text where no profile was learned is ``und`` with
    score 0. Columns of those names are replaced; all other columns and every row stay.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.nearest(t.as_py()) for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(kept))),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                [*kept, "lang_pred", "score"],
            )

    text = F.col(text_col).cast("string").alias(free_name(docs, "whole"))
    return docs.select(*kept, text).mapInArrow(each, schema)
