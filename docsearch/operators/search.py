"""One question over a space: matching, scoring, paging, counting.

The clause tree becomes one filter over postings and one aggregate per document, with a
column per leaf; boolean logic and score are then plain expressions over that row. The only
shuffle is the aggregate on the document key, after map-side combining. Document frequencies
are a one-row scalar subquery, so no join is needed to attach them.

The score of a term is ``sqrt(tf) * idf^2 * boost / sqrt(len)`` with
``idf = 1 + ln(N / (df + 1))``; N and df count all selected documents. A clause group multiplies
the sum by the share of its scoring clauses that matched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.functions import highlights
from docsearch.functions.analyzers import ANALYZERS, analyzer
from docsearch.functions.converters import date_out
from docsearch.operators.postings import ALL_ANALYZER, DATE_KINDS, DOC, ROW, path_value
from docsearch.operators.space import Space, union
from docsearch.plans import clauses as q
from docsearch.plans.mapping import DocumentMapping
from docsearch.settings import DEFAULT_PAGE_SIZE

SCORE_DIGITS = 6
STATS = "__stats"


# -- leaves ------------------------------------------------------------------------------


@dataclass(frozen=True)
class TermLeaf:
    """A term of a field; with ``types``, only in documents of those."""

    field: str
    term: str
    types: tuple[str, ...] | None = None

    def condition(self) -> Column:
        return (F.col("field") == self.field) & (F.col("term") == self.term) & _of(self.types)


@dataclass(frozen=True)
class PatternLeaf:
    """Prefix, wildcard or fuzzy: terms that pass a test; scored as a constant."""

    clause: q.Prefix | q.Wildcard | q.Fuzzy

    def test(self, term: Column) -> Column:
        c = self.clause
        if isinstance(c, q.Prefix):
            return F.startswith(term, F.lit(c.value))
        if isinstance(c, q.Wildcard):
            return term.rlike(wildcard_pattern(c.pattern))
        return F.levenshtein(term, F.lit(c.value), c.distance).between(0, c.distance)

    def condition(self) -> Column:
        return (F.col("field") == self.clause.field) & self.test(F.col("term"))


@dataclass(frozen=True)
class PhraseLeaf:
    field: str
    terms: tuple[str, ...]
    slop: int
    types: tuple[str, ...] | None = None

    def condition(self) -> Column:
        wanted = F.col("term").isin(sorted(set(self.terms)))
        return (F.col("field") == self.field) & wanted & _of(self.types)


@dataclass(frozen=True)
class RangeLeaf:
    clause: q.Range


@dataclass(frozen=True)
class EveryLeaf:
    pass


Leaf = TermLeaf | PatternLeaf | PhraseLeaf | RangeLeaf | EveryLeaf

def _of(types: tuple[str, ...] | None) -> Column:
    return F.lit(True) if types is None else F.col("type").isin(list(types))


SPECIAL = set(r"\.[]{}()<>+-=!?^$|*#&~")


def wildcard_pattern(pattern: str) -> str:
    wild = {"*": "(?s:.*)", "?": "(?s:.)"}
    body = "".join(wild.get(c) or (f"\\{c}" if c in SPECIAL else c) for c in pattern)
    return f"^{body}$"


def literal_text(value, kind: str) -> Column:
    """The term an index holds for a value of a field of type ``kind``; null if it is no such value."""
    if kind == "string":
        return F.lit(value).cast("string")
    typed = F.lit(value).try_cast(kind)
    if kind in DATE_KINDS:
        return date_out(typed, kind == "timestamp")
    return typed.cast("string")


@dataclass(frozen=True)
class _Node:
    """A clause with its leaves resolved to column positions."""

    kind: str
    boost: float
    leaf: int | None = None
    children: tuple[_Node, ...] = ()
    must: tuple[_Node, ...] = ()
    should: tuple[_Node, ...] = ()
    must_not: tuple[_Node, ...] = ()


class _Resolver:
    """Words of a question become terms as the words of the field did, type by type.

    Everything a question's texts and values turn into is asked of Spark at once.
    """

    def __init__(self, space: Space, analyzer_name: str | None, clause):
        self.space, self.how = space, analyzer_name
        self.leaves: list[Leaf] = []
        self.known = space.known_fields()
        asked: dict[tuple, Column] = {}
        for leaf in _leaf_clauses(clause):
            asked |= self._asked(leaf)
        self.answers: dict[tuple, object] = {}
        if asked:
            row = space.spark.sql("SELECT 1").select(*[c.alias(f"a{i}") for i, c in enumerate(asked.values())])
            self.answers = dict(zip(asked, row.first(), strict=True))

    def _groups(self, field: str, what) -> dict:
        """The types that have the field, by ``what`` tells them apart; None where all agree."""
        found: dict = {}
        for type_name, known in self.known:
            if known.path == field:
                found.setdefault(what(known), []).append(type_name)
        return {k: None if len(found) == 1 else tuple(sorted(set(v))) for k, v in found.items()}

    def _analyzers(self, field: str) -> dict:
        if self.how is not None or field == q.ALL:
            return {self.how or ALL_ANALYZER: None}
        return self._groups(field, lambda f: f.analyzer) or {ALL_ANALYZER: None}

    def _kinds(self, field: str) -> dict:
        return self._groups(field, lambda f: f.kind) or {"string": None}

    def _asked(self, clause) -> dict[tuple, Column]:
        if isinstance(clause, q.Match | q.Phrase):
            return {
                ("terms", how, clause.text): analyzer(how)(F.lit(clause.text)) for how in self._analyzers(clause.field)
            }
        if isinstance(clause, q.Term):
            return {
                ("value", kind, str(clause.value)): F.coalesce(
                    literal_text(clause.value, kind), F.lit(clause.value).cast("string")
                )
                for kind in self._kinds(clause.field)
            }
        return {}

    def _either(self, boost: float, nodes: list[_Node]) -> _Node:
        return replace(nodes[0], boost=boost) if len(nodes) == 1 else _Node("either", boost, children=tuple(nodes))

    def leaf(self, leaf: Leaf) -> int:
        if leaf not in self.leaves:
            self.leaves.append(leaf)
        return self.leaves.index(leaf)

    def node(self, clause) -> _Node:
        match clause:
            case q.Match():
                if clause.operator not in ("any", "all"):
                    raise ValueError("operator is 'any' or 'all'")
                nodes = []
                for how, types in self._analyzers(clause.field).items():
                    terms = dict.fromkeys(self.answers["terms", how, clause.text] or ())
                    children = tuple(
                        _Node("term", 1.0, self.leaf(TermLeaf(clause.field, t, types))) for t in terms
                    )
                    nodes.append(_Node(clause.operator, 1.0, children=children))
                return self._either(clause.boost, nodes)
            case q.Term():
                nodes = [
                    _Node("term", 1.0, self.leaf(TermLeaf(clause.field, self.answers["value", kind, str(clause.value)], types)))
                    for kind, types in self._kinds(clause.field).items()
                ]
                return self._either(clause.boost, nodes)
            case q.Phrase():
                nodes = []
                for how, types in self._analyzers(clause.field).items():
                    terms = tuple(self.answers["terms", how, clause.text] or ())
                    for term in terms:  # their document frequencies weigh the phrase
                        self.leaf(TermLeaf(clause.field, term, types))
                    leaf = PhraseLeaf(clause.field, terms, clause.slop, types)
                    nodes.append(_Node("phrase", 1.0, self.leaf(leaf)))
                return self._either(clause.boost, nodes)
            case q.Prefix() | q.Wildcard() | q.Fuzzy():
                return _Node("constant", clause.boost, self.leaf(PatternLeaf(replace(clause, boost=1.0))))
            case q.Range():
                return _Node("constant", clause.boost, self.leaf(RangeLeaf(replace(clause, boost=1.0))))
            case q.MatchAll():
                return _Node("constant", clause.boost, self.leaf(EveryLeaf()))
            case q.Bool():
                must = tuple(map(self.node, clause.must))
                should = tuple(map(self.node, clause.should))
                if not must and not should:
                    must = (_Node("constant", 1.0, self.leaf(EveryLeaf())),)
                return _Node(
                    "bool", clause.boost, must=must, should=should,
                    must_not=tuple(map(self.node, clause.must_not)),
                )
        raise TypeError(f"not a clause: {clause!r}")


def _leaf_clauses(clause) -> list:
    if isinstance(clause, q.Bool):
        inner = (*clause.must, *clause.should, *clause.must_not)
        return [leaf for c in inner for leaf in _leaf_clauses(c)]
    return [clause]


# -- the per-document row ----------------------------------------------------------------


def _f(i: int) -> str:
    return f"f{i}"


def _field_of(leaf: Leaf) -> str | None:
    if isinstance(leaf, PatternLeaf):
        return leaf.clause.field
    return getattr(leaf, "field", None)


class Search:
    """A question bound to a space. Every result is a lazy DataFrame.

    ``hits`` has ``index, type, id, score``; ``total``, ``page``, ``scores``, ``explain`` and
    ``highlight`` derive from the same per-document row. Texts are analysed as the field they are
    matched against is, unless ``analyzer_name`` names another way.
    """

    def __init__(self, space: Space, clause, analyzer_name: str | None = None):
        if analyzer_name is not None and analyzer_name not in ANALYZERS:
            raise ValueError(f"unknown analyzer {analyzer_name!r}")
        resolver = _Resolver(space, analyzer_name, clause)
        self.space = space
        self.root = resolver.node(clause)
        self.leaves = resolver.leaves
        self.known = resolver.known
        self.fields = sorted({f for f in map(_field_of, self.leaves) if f is not None})
        self._rows: DataFrame | None = None

    # matching

    def rows(self) -> DataFrame:
        """One row per document that some leaf matches: ``f{i}`` how often leaf i matches,
        ``n{j}`` the norm of field j."""
        if self._rows is None:
            parts = [p for p in (self._term_rows(), *self._phrase_rows(), *self._key_rows()) if p is not None]
            if not parts:
                parts = [self.space.keys().limit(0)]
            sums = [F.sum(_f(i)).alias(_f(i)) for i in range(len(self.leaves))]
            norms = [F.max(f"n{j}").alias(f"n{j}") for j in range(len(self.fields))]
            filled = union([self._filled(p) for p in parts])
            columns = [*sums, *norms]
            # a question without words has no leaf, and no document
            self._rows = filled.groupBy(*DOC).agg(*columns) if columns else filled
        return self._rows

    def _filled(self, part: DataFrame) -> DataFrame:
        wanted = [_f(i) for i in range(len(self.leaves))] + [f"n{j}" for j in range(len(self.fields))]
        have = set(part.columns)
        return part.select(
            *DOC, *[(F.col(c) if c in have else F.lit(0.0)).cast("double").alias(c) for c in wanted]
        )

    def _rows_of(self, leaves, positions: bool) -> DataFrame | None:
        if not leaves:
            return None
        condition = reduce(Column.__or__, [leaf.condition() for leaf in leaves])
        exact: list[str] | None = []
        for leaf in leaves:
            if isinstance(leaf, TermLeaf):
                exact.append(leaf.term)
            elif isinstance(leaf, PhraseLeaf):
                exact += leaf.terms
            else:
                exact = None
                break
        if exact == []:
            return None
        fields = {_field_of(leaf) for leaf in leaves}
        exact = None if exact is None else sorted(set(exact))
        return self.space.term_rows(condition, fields, exact, positions)

    def _norms(self) -> list[Column]:
        norm = F.col("boost") / F.sqrt(F.col("len"))
        return [
            F.when(F.col("field") == field, norm).otherwise(0.0).alias(f"n{j}")
            for j, field in enumerate(self.fields)
        ]

    def _term_rows(self) -> DataFrame | None:
        chosen = {i: x for i, x in enumerate(self.leaves) if isinstance(x, TermLeaf | PatternLeaf)}
        rows = self._rows_of(list(chosen.values()), positions=False)
        if rows is None:
            return None
        counts = [
            F.when(x.condition(), F.col("tf")).otherwise(0.0).alias(_f(i))
            for i, x in chosen.items()
        ]
        return rows.select(*DOC, *counts, *self._norms())

    def _phrase_rows(self) -> list[DataFrame]:
        found = []
        for i, leaf in enumerate(self.leaves):
            if not isinstance(leaf, PhraseLeaf) or not leaf.terms:
                continue
            rows = self._rows_of([leaf], positions=True)
            places = [
                F.sort_array(
                    F.flatten(F.collect_list(F.when(F.col("term") == t, F.col("positions"))))
                ).alias(f"p{k}")
                for k, t in enumerate(leaf.terms)
            ]
            j = self.fields.index(leaf.field)
            norm = F.max(F.col("boost") / F.sqrt(F.col("len"))).alias(f"n{j}")
            together = rows.groupBy(*ROW).agg(*places, norm)
            every = reduce(Column.__and__, [F.size(f"p{k}") > 0 for k in range(len(leaf.terms))])
            freq = phrase_frequency([F.col(f"p{k}") for k in range(len(leaf.terms))], leaf.slop, leaf.terms)
            found.append(
                together.where(every)
                .select(*DOC, freq.cast("double").alias(_f(i)), f"n{j}")
                .where(F.col(_f(i)) > 0)
            )
        return found

    def _key_rows(self) -> list[DataFrame | None]:
        found = []
        for i, leaf in enumerate(self.leaves):
            keys = None
            if isinstance(leaf, RangeLeaf):
                keys = self.space.where(leaf.clause.field, lambda v, c=leaf.clause: in_range(v, c))
            elif isinstance(leaf, EveryLeaf):
                keys = self.space.keys()
            found.append(None if keys is None else keys.select(*DOC, F.lit(1.0).alias(_f(i))))
        return found

    # statistics

    def statistics(self) -> DataFrame:
        """One row: ``num_docs`` and ``df{i}`` of every leaf."""
        scored = [i for i, x in enumerate(self.leaves) if isinstance(x, TermLeaf)]
        condition = reduce(
            Column.__or__, [self.leaves[i].condition() for i in scored], F.lit(False)
        )
        known = self.space.term_stats(condition, sorted({self.leaves[i].term for i in scored}))
        if known is not None:
            counts = known.agg(
                *[
                    F.coalesce(F.sum(F.when(self.leaves[i].condition(), F.col("df"))), F.lit(0)).alias(f"df{i}")
                    for i in scored
                ]
                or [F.lit(0).alias("none")]
            )
        else:
            # reads the same columns as the search itself, so both share one exchange
            counts = self.rows().agg(
                F.count(F.lit(1)).alias("matched"),
                *[F.count_if(F.col(_f(i)) > 0).alias(f"df{i}") for i in scored],
                *[F.max(_f(i)).alias(f"top{i}") for i in range(len(self.leaves))],
                *[F.max(f"n{j}").alias(f"norm{j}") for j in range(len(self.fields))],
            )
        return counts.withColumn("num_docs", self.space.count().scalar())

    # boolean logic and score

    def _matched(self, node: _Node) -> Column:
        if node.kind in ("term", "constant", "phrase"):
            return F.col(_f(node.leaf)) > 0
        if node.kind in ("any", "all", "either"):
            join = Column.__and__ if node.kind == "all" else Column.__or__
            parts = [self._matched(c) for c in node.children]
            return reduce(join, parts) if parts else F.lit(False)
        needed = [self._matched(c) for c in node.must]
        if not node.must:
            needed.append(reduce(Column.__or__, [self._matched(c) for c in node.should]))
        needed += [~self._matched(c) for c in node.must_not]
        return reduce(Column.__and__, needed)

    def _score(self, node: _Node) -> Column:
        if node.kind == "constant":
            return F.lit(node.boost)
        if node.kind == "term":
            return self._term_score(self.leaves[node.leaf], node.leaf, self._idf(node.leaf)) * node.boost
        if node.kind == "phrase":
            leaf = self.leaves[node.leaf]
            idfs = [self._idf(self.leaves.index(TermLeaf(leaf.field, t, leaf.types))) for t in leaf.terms]
            if not idfs:
                return F.lit(0.0)
            return self._term_score(leaf, node.leaf, reduce(Column.__add__, idfs)) * node.boost
        scoring = node.children or (*node.must, *node.should)
        hits = [self._matched(c) for c in scoring]
        parts = [
            F.when(hit, self._score(c)).otherwise(0.0)
            for hit, c in zip(hits, scoring, strict=True)
        ]
        total = reduce(Column.__add__, parts, F.lit(0.0))
        # a document is of one type, so of the ways one text is asked for only one can match
        if len(scoring) > 1 and node.kind != "either":
            matched = reduce(Column.__add__, [hit.cast("int") for hit in hits])
            total = total * matched / len(scoring)
        return total * node.boost

    def _term_score(self, leaf, i: int, idf: Column) -> Column:
        norm = F.col(f"n{self.fields.index(leaf.field)}")
        return F.sqrt(F.col(_f(i))) * F.pow(idf, 2) * norm

    def _idf(self, i: int) -> Column:
        return idf(F.col(f"{STATS}.num_docs"), F.col(f"{STATS}.df{i}"))

    def _with_statistics(self) -> DataFrame:
        stats = self.statistics().select(F.struct("*")).scalar()
        return self.matching().withColumn(STATS, stats)

    # results

    def matching(self) -> DataFrame:
        """Rows of the documents the whole question matches, unscored."""
        return self.rows().where(self._matched(self.root))

    def _scored(self) -> DataFrame:
        score = F.round(self._score(self.root), SCORE_DIGITS)
        return self._with_statistics().select(*DOC, score.alias("score"))

    @property
    def hits(self) -> DataFrame:
        """``(index, type, id, score)`` of every hit, unordered."""
        return self._scored()

    def total(self) -> DataFrame:
        """One row ``(total)``: all hits, not only a page. No score is computed."""
        return self.matching().agg(F.count(F.lit(1)).alias("total"))

    def page(self, start: int = 0, size: int | None = None) -> DataFrame:
        """Hits in order: score descending, then type and id. Spark keeps only the top
        ``start + size`` rows of each task, so a page far down costs as much as a sort."""
        limit = DEFAULT_PAGE_SIZE if size is None else size
        ordered = self.hits.orderBy(F.desc("score"), "type", "id")
        return (ordered.offset(start) if start else ordered).limit(limit)

    def sorted_page(
        self,
        entity: str | DocumentMapping,
        column: str,
        descending: bool = False,
        start: int = 0,
        size: int | None = None,
    ) -> DataFrame:
        """A page of one entity's hits in the order of one of its columns, then of the id."""
        limit = DEFAULT_PAGE_SIZE if size is None else size
        mapping = self.space.registry.require(entity)
        rows = self.space.entity(mapping).select(*DOC, F.col(f"row.{column}").alias(column))
        key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
        ordered = self.matching().select(*DOC).join(rows, list(DOC)).orderBy(key, "id")
        return (ordered.offset(start) if start else ordered).limit(limit)

    def matched_terms(self) -> DataFrame:
        """``(index, type, id, n_terms)``: how many distinct terms of a document the prefix,
        wildcard and fuzzy clauses found."""
        leaves = [x for x in self.leaves if isinstance(x, PatternLeaf)]
        rows = self._rows_of(leaves, positions=False)
        return rows.groupBy(*DOC).agg(F.count_distinct("field", "term").alias("n_terms"))

    def phrase_counts(self) -> DataFrame:
        """``(index, type, id, freq)``: how often the phrase clauses occur."""
        places = [F.col(_f(i)) for i, x in enumerate(self.leaves) if isinstance(x, PhraseLeaf)]
        freq = reduce(Column.__add__, places).cast("long")
        return self.matching().select(*DOC, freq.alias("freq"))

    def highlighted(
        self,
        documents: DataFrame,
        fields: dict[str, tuple[int, int]],
        pre: str = highlights.PRE_TAG,
        post: str = highlights.POST_TAG,
    ) -> DataFrame:
        """``documents`` (typed, already cut to the hits wanted) with one array of fragments per
        field. ``fields`` maps a path to ``(fragment size, number of fragments)``; a path into a
        collection highlights each item on its own. A text is cut into words as its field's
        analyzer cuts it; an exact field is one word."""
        schema = documents.schema["source"].dataType
        marked = []
        for path, (size, count) in fields.items():
            value, kind = path_value("source", schema, path)
            marked.append(self._marked(value, kind, path, size, count, pre, post).alias(path))
        return documents.select(*DOC, *marked)

    def _marked(self, value, kind, path, size, count, pre, post) -> Column:
        how = next((f.analyzer for _, f in self.known if f.path == path), ALL_ANALYZER)
        hit = self.word_test(how, path)

        def mark(text: Column) -> Column:
            return highlights.fragments(text.cast("string"), hit, size, count, pre, post, how)

        return F.flatten(F.transform(value, mark)) if isinstance(kind, T.ArrayType) else mark(value)

    def scores(self, hits: DataFrame | None = None) -> DataFrame:
        """``(index_type, id, score)``."""
        chosen = self.hits if hits is None else hits
        return chosen.select(
            F.concat_ws(".", "index", "type").alias("index_type"), "id", "score"
        )

    def explain(self) -> DataFrame:
        """``(index, type, id, field, term, tf, df, idf, norm, weight)`` per hit and term."""
        parts = []
        for i, leaf in enumerate(self.leaves):
            if not isinstance(leaf, TermLeaf):
                continue
            norm = F.col(f"n{self.fields.index(leaf.field)}")
            weight = self._term_score(leaf, i, self._idf(i))
            parts.append(
                F.struct(
                    F.lit(leaf.field).alias("field"),
                    F.lit(leaf.term).alias("term"),
                    F.col(_f(i)).alias("tf"),
                    F.col(f"{STATS}.df{i}").alias("df"),
                    F.round(self._idf(i), SCORE_DIGITS).alias("idf"),
                    F.round(norm, SCORE_DIGITS).alias("norm"),
                    F.round(weight, SCORE_DIGITS).alias("weight"),
                )
            )
        rows = self._with_statistics().select(*DOC, F.explode(F.array(*parts)).alias("x"))
        return rows.select(*DOC, "x.*").where(F.col("tf") > 0)

    def word_test(self, how: str = ALL_ANALYZER, path: str | None = None):
        """Whether a word of a text is one the question asks for; prohibited clauses do not count.
        Whole values of an exact field count only if asked for in that field."""
        wanted, tests = set(), []
        for i in _positive(self.root):
            leaf = self.leaves[i]
            if how == "keyword" and _field_of(leaf) != path:
                continue
            if isinstance(leaf, TermLeaf):
                wanted.add(leaf.term)
            elif isinstance(leaf, PhraseLeaf):
                wanted.update(leaf.terms)
            elif isinstance(leaf, PatternLeaf):
                tests.append(leaf.test)
        as_term = highlights.normal(how)
        return lambda word: reduce(
            Column.__or__,
            [t(as_term(word)) for t in tests],
            as_term(word).isin(sorted(wanted)) if wanted else F.lit(False),
        )


def _positive(node: _Node) -> list[int]:
    own = [] if node.leaf is None else [node.leaf]
    for child in (*node.children, *node.must, *node.should):
        own += _positive(child)
    return own


def idf(num_docs: Column, df: Column) -> Column:
    return 1 + F.log(num_docs.cast("double") / (df + 1))


def in_range(value: Column, clause: q.Range) -> Column:
    tests = []
    for bound, low, included in (
        (clause.low, True, clause.include_low),
        (clause.high, False, clause.include_high),
    ):
        if bound is None:
            continue
        typed = F.lit(bound)
        if low:
            tests.append(value >= typed if included else value > typed)
        else:
            tests.append(value <= typed if included else value < typed)
    return reduce(Column.__and__, tests) if tests else value.isNotNull()


def _shift(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda position: position - by) if by else positions


def _first_between(positions: Column, low: Column, high: Column) -> Column:
    return F.array_min(F.filter(positions, lambda x: (x >= low) & (x <= high)))


def phrase_frequency(places: list[Column], slop: int, terms: Sequence[str] = ()) -> Column:
    """How many occurrences of the first term take part in a match. ``places`` holds the
    positions of each term; a match brings every term, shifted by its place in the phrase,
    within ``slop`` of the others. A term that ``terms`` names twice needs two positions."""
    shifted = [_shift(place, k) for k, place in enumerate(places)]
    if slop == 0:
        return F.size(reduce(F.array_intersect, shifted))
    names = terms or tuple(range(len(places)))

    def near(start: Column) -> Column:
        def window(low: Column) -> Column:
            return reduce(Column.__and__, [placed(name, low) for name in dict.fromkeys(names)], F.lit(True))

        def placed(name, low: Column) -> Column:
            """Whether all occurrences of one term in the phrase find positions of their own: each
            takes the first that is free and in its window, in order; ``start`` holds the first."""
            offsets = [k for k, other in enumerate(names) if other == name and k]
            if not offsets:
                return F.lit(True)
            if len(offsets) == 1 and names[0] != name:
                return F.exists(shifted[offsets[0]], lambda x: (x >= low) & (x <= low + slop))
            positions = places[offsets[0]]
            if names[0] == name:
                positions = F.filter(positions, lambda x: x != start)
            taken = F.lit(-1)
            for k in offsets:
                free = _first_between(positions, F.greatest(low + k, taken + 1), low + k + slop)
                # past every window once an occurrence finds none
                taken = F.coalesce(free, F.lit(2**30))
            return taken < 2**30

        return F.exists(F.sequence(start - slop, start), window)

    return F.size(F.filter(shifted[0], near))


# -- entry points ------------------------------------------------------------------------


def search(space: Space, clause, **options) -> Search:
    """Ask one question. A plain text is matched against ``_all``."""
    return Search(space, q.Match(clause) if isinstance(clause, str) else clause, **options)


def count_hits(space: Space, clause) -> DataFrame:
    """One row ``(n)``. Neither scores nor sources are read."""
    return search(space, clause).total().withColumnRenamed("total", "n")


def entity_search(space: Space, entity: str | DocumentMapping, clause) -> Search:
    """Search one entity: its index and type replace whatever the space had selected."""
    return search(space.only(space.registry.require(entity)), clause)
