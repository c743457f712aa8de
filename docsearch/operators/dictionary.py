"""Tables of words and patterns against the terms of an index, by equality joins.

Asking which terms are near a word, or fit a pattern, by testing each term costs a pass over the
dictionary a question. A ``TermDictionary`` holds, beside an index, each term under keys that a question
can look up:

===============  =========================================================================
``pieces``       a term cut into ``distance`` + 1 pieces, each with its number and the term's length
``grams``        its runs of three characters, with a mark before and marks after the term
``gram_counts``  how many terms hold a run
===============  =========================================================================

At most ``distance`` edits leave one of the pieces as it is, at most so many characters from its place, so
no near term is missed, and a term has ``distance`` + 1 keys however long it is. All tables are partitioned by a hash of the key and sorted by it, so that a set of questions
small enough to be sent to all tasks also says which files are read. What the keys bring together is
then verified.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.operators.batch import tasks_for
from docsearch.operators.postings import DOC, packed, unpacked
from docsearch.operators.sizes import broadcast_if_small
from docsearch.operators.space import IndexSpace
from docsearch.sources.index_tables import BUCKETS, bucket_of
from docsearch.sources.shared import kept, put

#: characters of the runs
GRAM = 3
#: stand before and after a term, so that runs say where it begins and ends; no term holds them
START, END = "\u0002", "\u0003"
NO_TEXTS = "CAST(array() AS ARRAY<STRING>)"


def _piece(text: str, start: str, size: str) -> str:
    return f"substring({text}, {start} + 1, {size})"


def _piece_bounds(length: str, number: str, pieces: int) -> tuple[str, str]:
    """Where piece ``number`` of a term of ``length`` characters begins, and how long it is."""
    start, end = (f"int(({number}) * {length} div {pieces})" for number in (number, f"{number} + 1"))
    return start, f"{end} - {start}"


def _term_pieces(distance: int) -> Column:
    """A term in ``distance`` + 1 pieces, each with the length of the term and its number."""
    keys = []
    for i in range(distance + 1):
        start, size = _piece_bounds("char_length(term)", str(i), distance + 1)
        keys.append(f"concat_ws(':', char_length(term), {i}, {_piece('term', start, size)})")
    return F.expr(f"array({', '.join(keys)})")


def _with_pieces(words: DataFrame, distance: int, most: int) -> DataFrame:
    """``words`` once for each ``key`` under which a term within ``most`` edits may stand. Before a piece
    without edits there are as many edits as it is shifted by, at least, and after it as many as then are
    left of the difference in length."""
    shifts = [(more, by) for more in range(-most, most + 1) for by in range(-most, most + 1) if abs(by) + abs(by + more) <= most]
    shifted = words.withColumn("size", F.char_length("word"))
    # the term has ``more`` characters more, and its piece stands in the word ``by`` characters later
    tried = F.array(*(F.struct(F.lit(more).alias("more"), F.lit(by).alias("by")) for more, by in shifts))
    shifted = shifted.withColumn("tried", F.explode(tried)).withColumn("number", F.explode(F.array(*map(F.lit, range(distance + 1)))))
    shifted = shifted.withColumn("of", F.expr("size + tried.more")).where("of > 0")
    start, size = _piece_bounds("of", "number", distance + 1)
    shifted = shifted.withColumn("start", F.expr(f"{start} + tried.by")).withColumn("long", F.expr(size))
    shifted = shifted.where("start >= 0 and start + long <= size")
    key = F.expr(f"concat_ws(':', of, number, {_piece('word', 'start', 'long')})")
    return shifted.select(*words.columns, key.alias("key")).distinct()


def _runs(text: str, size: int) -> str:
    return (
        f"IF(char_length({text}) < {size}, {NO_TEXTS},"
        f" transform(sequence(1, char_length({text}) - {size - 1}), i -> substring({text}, i, {size})))"
    )


def _term_grams(term: str) -> Column:
    """All runs of GRAM characters of a marked term. After the term there are as many marks as let a run
    begin at each of its characters and at the first mark, so that shorter runs are beginnings of these."""
    marked = f"concat('{START}', {term}, '{END * GRAM}')"
    return F.expr(f"array_distinct({_runs(marked, GRAM)})")


def _pattern_grams() -> Column:
    """The longest runs that a term must hold to fit ``pattern``: one at least, the mark before the term."""
    pieces = f"filter(split(concat('{START}', pattern, '{END}'), '[*?]'), p -> p <> '')"
    return F.expr(
        f"array_distinct(flatten(transform({pieces}, p -> IF(char_length(p) <= {GRAM}, array(p), {_runs('p', GRAM)}))))"
    )


def _like() -> Column:
    r"""``pattern`` as LIKE has it: ``*`` is ``%``, ``?`` is ``_``, and all else stands for itself."""
    literal = F.regexp_replace("pattern", r"([\\%_])", r"\\$1")
    return F.translate(literal, "*?", "%_")


@dataclass(frozen=True)
class TermDictionary:
    """The terms of an index under their keys, in a directory written once."""

    spark: SparkSession
    path: str
    distance: int
    buckets: int

    @classmethod
    def write(cls, space: IndexSpace, path: str, distance: int = 2, buckets: int = BUCKETS) -> TermDictionary:
        """Keys of all terms that a document of ``space`` holds, for questions of up to ``distance`` edits."""
        found = cls(space.spark, path, distance, buckets)
        terms = space.term_stats(F.lit(True), ()).groupBy("field", "term").agg(F.sum("df").alias("df"))
        put(terms.where("df > 0"), f"{path}/terms")
        held = space.spark.read.parquet(f"{path}/terms").select("field", "term")
        found._write("pieces", held.withColumn("key", F.explode(_term_pieces(distance))))
        found._write("grams", held.withColumn("key", F.explode(_term_grams("term"))))
        counts = found._read("grams").groupBy("field", "key").agg(F.count(F.lit(1)).alias("terms"))
        found._write("gram_counts", counts)
        return found

    def _write(self, name: str, rows: DataFrame) -> None:
        rows = rows.withColumn("bucket", bucket_of(F.col("key"), self.buckets)).hint("rebalance", "bucket")
        rows = rows.sortWithinPartitions("bucket", "field", "key")
        put(rows, f"{self.path}/{name}", ["bucket"])

    def _read(self, name: str) -> DataFrame:
        kept = "terms long" if name == "gram_counts" else "term string"
        schema = f"field string, {kept}, key string, bucket int"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _look_up(self, name: str, field: str, keyed: DataFrame) -> DataFrame:
        """What stands under the ``key`` of each row of ``keyed``, once a row."""
        asked = keyed.withColumn("bucket", bucket_of(F.col("key"), self.buckets))
        return self._read(name).where(F.col("field") == field).drop("field").join(
            broadcast_if_small(asked), ["bucket", "key"]
        )

    def similar(self, words: DataFrame, field: str, distance: int | None = None) -> DataFrame:
        """``(word, term, edits)``: the terms of ``field`` within ``distance`` edits of each ``word``.

        Words are taken as they are, not analysed. A null word has no terms; repeated words are one.
        """
        most = self.distance if distance is None else distance
        if not 0 <= most <= self.distance:
            raise ValueError(f"the dictionary holds keys for up to {self.distance} edits, not {most}")
        asked = words.select("word").where("word is not null").distinct()
        met = self._look_up("pieces", field, _with_pieces(asked, self.distance, most)).select("word", "term")
        near = met.withColumn("edits", F.levenshtein("word", "term", most)).where(F.col("edits").between(0, most))
        # a pair meets under several keys
        return near.distinct()

    def fitting(self, patterns: DataFrame, field: str) -> DataFrame:
        """``(pattern, term)``: the terms of ``field`` that each ``pattern`` fits, with ``*`` for any run of
        characters and ``?`` for one.

        A pattern looks up the one of its runs that the fewest terms hold; a run shorter than those of the
        terms stands for all that begin with it. One without characters of its own looks up the mark that
        all terms hold. A null pattern fits nothing; repeated ones are one.
        """
        asked = patterns.select("pattern").where("pattern is not null").distinct()
        wanted = asked.withColumn("run", F.explode(_pattern_grams()))
        runs = broadcast_if_small(wanted.select("run").distinct())
        held = self._read("gram_counts").where(F.col("field") == field).select("key", "terms")
        counts = held.withColumn("run", F.explode(F.array(*(F.substring("key", 1, k) for k in range(1, GRAM + 1)))))
        counts = counts.distinct().join(runs, "run", "left_semi")
        # a run that no term holds stands first, and brings nothing
        of_runs = counts.groupBy("run").agg(F.sum("terms").alias("terms"))
        counted = wanted.join(broadcast_if_small(of_runs), "run", "left")
        rarest = F.min(F.struct(F.coalesce("terms", F.lit(0)).alias("terms"), "run"))
        chosen = counted.groupBy("pattern").agg(rarest.alias("rarest"))
        chosen = chosen.where("rarest.terms > 0").select("pattern", F.col("rarest.run").alias("run"), _like().alias("like"))
        keyed = chosen.join(broadcast_if_small(counts.select("run", "key")), "run").drop("run")
        found = self._look_up("grams", field, keyed).where("term like like").select("pattern", "term")
        # a term may hold several runs that begin alike
        return found.distinct()


def holding(space: IndexSpace, field: str, found: DataFrame, by: str) -> DataFrame:
    """``(by, index, type, id, n_terms)``: the documents that hold in ``field`` a ``term`` found for a word
    or pattern, and how many such terms they hold. Only the buckets of these terms are read."""
    # kept, as looking them up again for each use would cost more than to read them
    pairs = kept(found.select(by, "term").distinct(), "found-terms")
    numbers = pairs.select(by).distinct().withColumn("number", F.monotonically_increasing_id())
    numbers = broadcast_if_small(kept(numbers, "found-numbers"))
    # a term goes with what it was found for, so that postings, once made, are joined with nothing
    of_terms = pairs.join(numbers, by).groupBy("term").agg(F.collect_list("number").alias("of"))
    code = F.struct(F.monotonically_increasing_id().alias("no"), "of").alias("code")
    codes = broadcast_if_small(kept(of_terms.select("term", code), "found-codes"))
    counts = space.term_stats(F.col("field") == field, ()).join(pairs, "term")
    rows = space.vocabulary_rows(field, codes).withColumns({"tf": F.lit(None).cast("double"), "len": F.lit(None).cast("int")})
    # a document kept in several rows holds a term once; dealt out by document, rows are shuffled only here
    held = unpacked(packed(rows).repartition(tasks_for(counts), *DOC)).select(*DOC, "code").distinct()
    each = held.select(*DOC, F.explode("code.of").alias("number"))
    counted = each.groupBy("number", *DOC).agg(F.count(F.lit(1)).alias("n_terms"))
    return counted.join(numbers, "number").select(by, *DOC, "n_terms")
