"""Questions: matching, scoring, ordering, counting, highlighting."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.entities import (
    DOC_TOKENS,
    DOCUMENT,
    PAGE,
    PART,
    TURN,
    cross_registry,
    cross_tables,
    document_space,
    mapping,
    tables,
    term_weights,
    tok,
)
from catalog.registry import query
from catalog.token_queries import conversations
from docsearch import (
    Bool,
    Fuzzy,
    Match,
    MatchAll,
    Phrase,
    Prefix,
    Range,
    Registry,
    Term,
    Wildcard,
    plus_minus,
)
from docsearch.operators.batch import batch_search
from docsearch.operators.bounded import bounded_batch_search
from docsearch.operators.documents import build_documents
from docsearch.operators.maintain import bulk_index
from docsearch.operators.search import count_hits, entity_search, search
from docsearch.operators.space import IndexSpace, TableSpace
from docsearch.sources.shared import fresh_path
from docsearch.sources.tables import read_table

WORDS = "thing esat"
THREE = "thing esat th"


def scored(hits):
    return hits.select(F.col("id").alias("doc_id"), "score")


def ids(hits):
    return hits.select(F.col("id").alias("doc_id"))


def text_sql(terms: list[str], having: str = "true", share: int | None = None) -> str:
    k = share or len(terms)
    return f"""WITH {term_weights(terms)}
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(sum(weight) * count(*) / {k}, 6) AS score
       FROM s GROUP BY doc_id HAVING {having}"""


# -- predicates --------------------------------------------------------------------------


@query(
    "match_any",
    f"""WITH {term_weights(["thing", "esat"])}
       SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              round(sum(sqrt(tf) * idf * idf / sqrt(len + 1)) * count(*) / 2, 6) AS score
       FROM w GROUP BY doc_id""",
)
def match_any(spark, folder):
    return scored(search(document_space(spark, folder), WORDS).hits)


@query("match_all_terms", text_sql(["thing", "esat"], "count(*) = 2"))
def match_all_terms(spark, folder):
    return scored(search(document_space(spark, folder), Match(WORDS, "text", "all")).hits)


@query("match_field", text_sql(["thing", "esat"]))
def match_field(spark, folder):
    return scored(search(document_space(spark, folder), Match(WORDS, "text")).hits)


@query(
    "term_exact",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              round(power(1 + ln((SELECT count(*) FROM documents)::DOUBLE
                    / ((SELECT count(*) FROM documents WHERE lang = 'en') + 1)), 2), 6) AS score
       FROM documents WHERE lang = 'en'""",
)
def term_exact(spark, folder):
    return scored(search(document_space(spark, folder), Term("lang", "en")).hits)


BOOL = Bool(
    must=[Match("thing", "text")], must_not=[Match("th", "text")], should=[Match("esat", "text")]
)
BOOL_SQL = f"""WITH {term_weights(["thing", "esat", "th"])},
       g AS (SELECT doc_id, bool_or(term = 'thing') AS must, bool_or(term = 'th') AS never,
                    sum(weight) FILTER (term <> 'th') AS weight, count(*) FILTER (term <> 'th') AS n
             FROM s GROUP BY doc_id)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(weight * n / 2, 6) AS score
       FROM g WHERE must AND NOT never"""


@query("bool_query", BOOL_SQL)
def bool_query(spark, folder):
    return scored(search(document_space(spark, folder), BOOL).hits)


@query("plus_minus", BOOL_SQL)
def plus_minus_query(spark, folder):
    clause = plus_minus(required=["thing"], prohibited=["th"], optional=["esat"], field="text")
    return scored(search(document_space(spark, folder), clause).hits)


@query(
    "bool_optional",
    f"""WITH {term_weights(["thing"])}
       SELECT 'given' AS parameter, CAST(doc_id AS VARCHAR) AS doc_id FROM s JOIN documents USING (doc_id)
       WHERE lang = 'en'
       UNION ALL SELECT 'left out', CAST(doc_id AS VARCHAR) FROM s""",
)
def bool_optional(spark, folder):
    space = document_space(spark, folder)

    def ask(lang):
        return Bool(must=[Match("thing", "text"), Term("lang", lang) if lang else None])

    given = search(space, ask("en")).matching()
    left_out = search(space, ask(None)).matching()
    return (
        ids(given)
        .withColumn("parameter", F.lit("given"))
        .unionByName(ids(left_out).withColumn("parameter", F.lit("left out")))
    )


@query(
    "bool_nested",
    f"""WITH {term_weights(["thing", "esat", "th"])},
       g AS (SELECT doc_id, bool_or(term = 'thing') AS a, bool_or(term = 'esat') AS b,
                    bool_or(term = 'th') AS c,
                    coalesce(sum(weight) FILTER (term = 'thing'), 0) AS wa,
                    coalesce(sum(weight) FILTER (term = 'esat'), 0) AS wb,
                    coalesce(sum(weight) FILTER (term = 'th'), 0) AS wc
             FROM s GROUP BY doc_id)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              round((wc + (wa + wb) * (a::INT + b::INT) / 2.0), 6) AS score
       FROM g WHERE c AND (a OR b)""",
)
def bool_nested(spark, folder):
    inner = Bool(should=[Match("thing", "text"), Match("esat", "text")])
    clause = Bool(must=[Match("th", "text"), inner])
    return scored(search(document_space(spark, folder), clause).hits)


def phrase_sql(slop: int) -> str:
    return f"""SELECT {slop} AS slop, CAST(a.doc_id AS VARCHAR) AS doc_id, count(DISTINCT a.pos) AS freq
       FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.pos - 1 BETWEEN a.pos - {slop} AND a.pos + {slop}
       WHERE a.term = 'of' AND b.term = 'the' GROUP BY a.doc_id"""


@query(
    "phrase",
    f"""WITH p AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) AS pos
                  FROM (SELECT doc_id, {tok("text")} AS x FROM documents))
       {phrase_sql(0)} UNION ALL {phrase_sql(2)}""",
)
def phrase(spark, folder):
    space = document_space(spark, folder)
    found = [
        search(space, Phrase("of the", "text", slop))
        .phrase_counts()
        .select(F.lit(slop).alias("slop"), F.col("id").alias("doc_id"), "freq")
        for slop in (0, 2)
    ]
    return found[0].unionByName(found[1])


@query(
    "phrase_score",
    f"""WITH {term_weights(["of", "the"])},
       p AS (SELECT doc_id, unnest(x) AS term, generate_subscripts(x, 1) AS pos
             FROM (SELECT doc_id, {tok("text")} AS x FROM documents)),
       f AS (SELECT a.doc_id, count(*) AS freq FROM p a JOIN p b
               ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
             WHERE a.term = 'of' AND b.term = 'the' GROUP BY a.doc_id),
       i AS (SELECT doc_id, sum(idf) AS idf, any_value(len) AS len FROM w GROUP BY doc_id)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(sqrt(freq) * idf * idf / sqrt(len), 6) AS score
       FROM f JOIN i USING (doc_id)""",
)
def phrase_score(spark, folder):
    return scored(search(document_space(spark, folder), Phrase("of the", "text")).hits)


def pattern_sql(test: str) -> str:
    return f"""WITH {DOC_TOKENS}
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, count(DISTINCT term) AS n_terms
       FROM t WHERE {test} GROUP BY doc_id"""


def pattern_hits(spark, folder, clause):
    found = search(document_space(spark, folder), clause).matched_terms()
    return found.select(F.col("id").alias("doc_id"), "n_terms")


@query("prefix", pattern_sql("starts_with(term, 'thi')"))
def prefix(spark, folder):
    return pattern_hits(spark, folder, Prefix("text", "thi"))


@query("wildcard", pattern_sql("regexp_full_match(term, 'th.ng.*')"))
def wildcard(spark, folder):
    return pattern_hits(spark, folder, Wildcard("text", "th?ng*"))


@query("fuzzy", pattern_sql("levenshtein(term, 'thing') <= 2"))
def fuzzy(spark, folder):
    return pattern_hits(spark, folder, Fuzzy("text", "thing", 2))


@query(
    "range",
    """SELECT 'shop_part' AS type, CAST(p_partkey AS VARCHAR) AS id FROM part
       WHERE p_retailprice >= 920 AND p_retailprice < 950.5
       UNION ALL SELECT 'shop_order', CAST(o_orderkey AS VARCHAR) FROM orders
       WHERE o_orderdate > TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1998-06-30'""",
)
def range_query(spark, folder):
    registry = Registry([mapping("shop.Part"), mapping("shop.Order")])
    space = TableSpace.over(registry, tables(spark, folder, "shop.Part", "shop.Order"))
    day = F.lit
    price = Range("p_retailprice", 920.0, 950.5, include_high=False)
    dates = Range(
        "o_orderdate",
        day("1997-03-01").cast("timestamp_ntz"),
        day("1998-06-30").cast("timestamp_ntz"),
        include_low=False,
    )
    found = [search(space, clause).matching().select("type", "id") for clause in (price, dates)]
    return found[0].unionByName(found[1])


@query(
    "boost",
    f"""WITH {term_weights(["thing"])},
       a AS (SELECT doc_id, weight * 3 AS weight FROM s
             UNION ALL
             SELECT doc_id, 2 * power(1 + ln((SELECT count(*) FROM documents)::DOUBLE
               / ((SELECT count(*) FROM documents WHERE source = 'src1') + 1)), 2)
             FROM documents WHERE source = 'src1')
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(sum(weight) * count(*) / 2, 6) AS score
       FROM a GROUP BY doc_id""",
)
def boost(spark, folder):
    """``text`` counts threefold by its mapping, the source twofold by the question."""
    boosted = mapping(
        "corpus.Document",
        only=["text", "source"],
        fields={"text": {"boost": 3.0}, "source": {"index": "not_analyzed"}},
    )
    clause = Bool(should=[Match("thing", "text"), Term("source", "src1", boost=2.0)])
    return scored(search(document_space(spark, folder, boosted), clause).hits)


# -- targets -----------------------------------------------------------------------------

CROSS_TOKENS = f"""
c AS (SELECT 'corpus' AS index, 'corpus_document' AS type, doc_id::VARCHAR AS id,
             list_append({tok("text")}, source) AS terms FROM documents
      UNION ALL SELECT 'web', 'web_page', page_id::VARCHAR, {tok("html")} FROM pages
      UNION ALL SELECT 'chat', 'chat_turn', conv_id || '_' || turn,
                       list_append({tok("text")}, role) FROM conversations
      UNION ALL SELECT 'shop', 'shop_part', p_partkey::VARCHAR,
                       list_concat({tok("p_name")}, {tok("p_brand")}) FROM part)"""


def cross_sql(where: str = "true") -> str:
    return f"""WITH {CROSS_TOKENS},
       k AS (SELECT * FROM c WHERE {where}),
       t AS (SELECT index, type, id, len(terms) AS len, unnest(terms) AS term FROM k),
       m AS (SELECT index, type, id, term, any_value(len) AS len, count(*) AS tf FROM t
             WHERE term IN ('thing', 'esat') GROUP BY index, type, id, term),
       d AS (SELECT term, count(*) AS df FROM m GROUP BY term)
       SELECT index, type, id, round(sum(sqrt(tf) * power(1 + ln((SELECT count(*) FROM k)::DOUBLE
              / (df + 1)), 2) / sqrt(len)) * count(*) / 2, 6) AS score
       FROM m JOIN d USING (term) GROUP BY index, type, id"""


def cross_space(spark, folder, **selection) -> TableSpace:
    return TableSpace.over(cross_registry(), cross_tables(spark, folder), **selection)


@query("cross_type", cross_sql())
def cross_type(spark, folder):
    return search(cross_space(spark, folder), WORDS).hits


@query(
    "match_everything",
    f"WITH {CROSS_TOKENS} SELECT index, type, id, 1.0::DOUBLE AS score FROM c",
)
def match_everything(spark, folder):
    return search(cross_space(spark, folder), MatchAll()).hits


@query("select_indices", cross_sql("index IN ('corpus', 'chat')"))
def select_indices(spark, folder):
    return search(cross_space(spark, folder, indices=["CORPUS", TURN]), WORDS).hits


@query("select_types", cross_sql("type IN ('web_page', 'shop_part')"))
def select_types(spark, folder):
    return search(cross_space(spark, folder, types=["web_page", PART]), WORDS).hits


@query("domain_search", cross_sql("type = 'web_page'"))
def domain_search(spark, folder):
    everything = cross_space(spark, folder, indices="corpus")
    return entity_search(everything, PAGE, WORDS).hits


def written_index(spark, folder) -> str:
    path = fresh_path(spark, "search-index")
    bulk_index(cross_registry(), cross_tables(spark, folder), path)
    return path


@query("indexed_search", cross_sql("index IN ('corpus', 'chat')"))
def indexed_search(spark, folder):
    """The question of ``select_indices``, asked of index tables on storage."""
    path = written_index(spark, folder)
    space = IndexSpace.over(spark, path, cross_registry(), indices=["corpus", TURN])
    return search(space, WORDS).hits


@query("indexed_prefix", pattern_sql("starts_with(term, 'thi')"))
def indexed_prefix(spark, folder):
    """The question of ``prefix``, its terms looked up in the dictionary of a written index."""
    path = fresh_path(spark, "prefix-index")
    registry = Registry([DOCUMENT])
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path, [DOCUMENT])
    space = IndexSpace.over(spark, path, registry, types=DOCUMENT)
    found = search(space, Prefix("text", "thi")).matched_terms()
    return found.select(F.col("id").alias("doc_id"), "n_terms")


# -- questions analysed like the fields -----------------------------------------------------


PAIRS = mapping(
    "corpus.Document",
    only=["text", "lang", "source"],
    fields={
        "text": {"analyzer": "whitespace"},
        "lang": {"index": "not_analyzed"},
        "source": {"analyzer": "stop"},
    },
)


def both_spaces(spark, folder, *mapped, name):
    """The same entities as tables and as a written index."""
    registry = Registry(list(mapped))
    loaded = tables(spark, folder, *[m.full_name for m in mapped])
    path = fresh_path(spark, name)
    bulk_index(registry, loaded, path, list(mapped))
    over_tables = TableSpace.over(registry, loaded)
    return {"tables": over_tables, "index": IndexSpace.over(spark, path, registry)}


def each_space(spaces, ask):
    found = [ask(space).withColumn("over", F.lit(name)) for name, space in spaces.items()]
    return found[0].unionByName(found[1])


def over_both(sql: str) -> str:
    return f"""WITH x AS ({sql}) SELECT *, 'tables' AS over FROM x UNION ALL SELECT *, 'index' FROM x"""


@query(
    "match_analyzer",
    over_both(
        r"""SELECT 'text' AS field, CAST(doc_id AS VARCHAR) AS id FROM documents
           WHERE list_contains(regexp_extract_all(text, '\S+'), 'The')
           UNION ALL SELECT 'lang', CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'en'
           UNION ALL SELECT 'source', CAST(doc_id AS VARCHAR) FROM documents
           WHERE regexp_full_match(source, 'src[0-9]*')"""
    ),
)
def match_analyzer(spark, folder):
    """A capital letter counts in a field cut at blanks, an exact field takes the whole text, and
    one without stop words and digits finds every source."""
    spaces = both_spaces(spark, folder, PAIRS, name="analyzer-index")

    def ask(space):
        asked = {"text": "The", "lang": "en", "source": "the SRC7"}
        found = [
            search(space, Match(text, field)).matching().select(F.lit(field).alias("field"), "id")
            for field, text in asked.items()
        ]
        return found[0].unionByName(found[1]).unionByName(found[2])

    return each_space(spaces, ask)


@query(
    "all_exact_value",
    over_both(
        "SELECT CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_brand = 'Brand#12' "
        r"OR list_has_any(regexp_extract_all(lower(p_name), '[\p{L}\p{N}]+'), ['brand', '12'])"
        r" OR list_has_any(regexp_extract_all(lower(p_brand), '[\p{L}\p{N}]+'), ['brand', '12'])"
    ),
)
def all_exact_value(spark, folder):
    """Free text finds the words of an exact field."""
    spaces = both_spaces(spark, folder, PART, name="brand-index")
    return each_space(spaces, lambda space: search(space, "Brand#12").matching().select("id"))


TYPED_PART = mapping("shop.Part", only=["p_size", "p_retailprice"])
TYPED_ORDER = mapping("shop.Order", only=["o_orderdate", "o_totalprice"])


@query(
    "term_typed",
    over_both(
        """SELECT 'size' AS asked, CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size = 7
           UNION ALL SELECT 'price', CAST(p_partkey AS VARCHAR) FROM part
             WHERE p_retailprice = (SELECT floor(min(p_retailprice)) FROM part)
           UNION ALL SELECT 'date', CAST(o_orderkey AS VARCHAR) FROM orders
             WHERE o_orderdate = TIMESTAMP '1998-01-02'"""
    ),
)
def term_typed(spark, folder):
    """An integer asked of an integer and of a double, and a date in plain writing."""
    spaces = both_spaces(spark, folder, TYPED_PART, TYPED_ORDER, name="typed-index")
    price = int(read_table(spark, folder, "part").agg(F.floor(F.min("p_retailprice"))).first()[0])
    asked = {
        "size": Term("p_size", "7"),
        "price": Term("p_retailprice", price),
        "date": Term("o_orderdate", "1998-01-02"),
    }

    def ask(space):
        found = [
            search(space, clause).matching().select(F.lit(name).alias("asked"), "id")
            for name, clause in asked.items()
        ]
        return found[0].unionByName(found[1]).unionByName(found[2])

    return each_space(spaces, ask)


@query(
    "highlight_exact",
    over_both(
        """SELECT CAST(p_partkey AS VARCHAR) AS id, '<em>' || p_brand || '</em>' AS fragment
           FROM part WHERE p_brand = 'Brand#12'"""
    ),
)
def highlight_exact(spark, folder):
    spaces = both_spaces(spark, folder, PART, name="mark-index")

    def ask(space):
        found = search(space, Term("p_brand", "Brand#12"))
        hits = space.typed(PART).join(found.matching().select("type", "id"), ["type", "id"])
        marked = found.highlighted(hits, {"p_brand": (10, 2)})
        return marked.select("id", F.explode("p_brand").alias("fragment"))

    return each_space(spaces, ask)


@query(
    "indexed_range",
    """SELECT 'shop_part' AS type, CAST(p_partkey AS VARCHAR) AS id FROM part
       WHERE p_retailprice >= 920 AND p_retailprice < 950
       UNION ALL SELECT 'shop_order', CAST(o_orderkey AS VARCHAR) FROM orders
       WHERE o_orderdate > TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1998-06-30'""",
)
def indexed_range(spark, folder):
    """Integer bounds on a double and dates, asked of a written index; a field that is stored
    but not searchable gives nothing."""
    hidden = mapping("shop.Supplier", fields={"s_acctbal": {"index": "no"}})
    space = both_spaces(spark, folder, TYPED_PART, TYPED_ORDER, hidden, name="range-index")["index"]
    dates = [F.lit(d).cast("timestamp_ntz") for d in ("1997-03-01", "1998-06-30")]
    clauses = (
        Range("p_retailprice", 920, 950, include_high=False),
        Range("o_orderdate", *dates, include_low=False),
        Range("s_acctbal", -1_000_000),
    )
    found = [search(space, clause).matching().select("type", "id") for clause in clauses]
    return found[0].unionByName(found[1]).unionByName(found[2])


SORTABLE = mapping("corpus.Document", only=["text", "n_chars"])


@query(
    "indexed_sort",
    f"""WITH {DOC_TOKENS},
       h AS (SELECT DISTINCT doc_id FROM t WHERE term IN ('thing', 'esat')),
       r AS (SELECT doc_id::VARCHAR AS doc_id, n_chars,
                    row_number() OVER (ORDER BY n_chars DESC, doc_id::VARCHAR) AS rk
             FROM h JOIN documents USING (doc_id)) SELECT rk, doc_id, n_chars FROM r WHERE rk <= 60""",
)
def indexed_sort(spark, folder):
    space = both_spaces(spark, folder, SORTABLE, name="sort-index")["index"]
    page = search(space, Match(WORDS, "text")).sorted_page(SORTABLE, "n_chars", descending=True)
    placed = ranked(page, F.desc("n_chars"), F.asc("id"))
    return placed.select("rk", F.col("id").alias("doc_id"), "n_chars")


@query("indexed_domain_search", cross_sql("type = 'web_page'"))
def indexed_domain_search(spark, folder):
    everything = IndexSpace.over(spark, written_index(spark, folder), cross_registry(), indices="corpus")
    return entity_search(everything, PAGE, WORDS).hits


# -- many questions ----------------------------------------------------------------------

BATCH_SQL = f"""WITH {DOC_TOKENS},
       b AS (SELECT item_id, list_distinct({tok("text")}) AS terms FROM benchmark),
       q AS (SELECT item_id, len(terms) AS k, unnest(terms) AS term FROM b),
       m AS (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY doc_id, term),
       d AS (SELECT term, count(*) AS df FROM m GROUP BY term),
       s AS (SELECT item_id, m.doc_id::VARCHAR AS doc_id,
                    round(sum(sqrt(tf) * power(1 + ln((SELECT count(*) FROM documents)::DOUBLE
                          / (df + 1)), 2) / sqrt(len)) * count(*) / any_value(k), 6) AS score
             FROM q JOIN m USING (term) JOIN d USING (term) JOIN l USING (doc_id)
             GROUP BY item_id, m.doc_id)
       SELECT * FROM (SELECT item_id, doc_id, score,
                row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM s)
       WHERE rk <= 10"""


def benchmark_queries(spark, folder):
    return read_table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def batch_columns(found):
    return found.select(
        F.col("query_id").alias("item_id"),
        F.col("id").alias("doc_id"),
        "score",
        F.col("rank").cast("long").alias("rk"),
    )


@query("batch_search", BATCH_SQL)
def batch_search_query(spark, folder):
    space = document_space(spark, folder)
    return batch_columns(batch_search(space, benchmark_queries(spark, folder), "text", 10))


@query("indexed_batch", BATCH_SQL)
def indexed_batch(spark, folder):
    """The questions of ``batch_search``, asked of index tables on storage."""
    path = fresh_path(spark, "batch-index")
    registry = Registry([DOCUMENT])
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path, [DOCUMENT])
    space = IndexSpace.over(spark, path, registry)
    return batch_columns(batch_search(space, benchmark_queries(spark, folder), "text", 10))


@query("batch_search_bounded", BATCH_SQL)
def batch_search_bounded(spark, folder):
    """The same hits, without scoring documents that only share common words with a question."""
    path = fresh_path(spark, "bounded-index")
    registry = Registry([DOCUMENT])
    bulk_index(registry, tables(spark, folder, "corpus.Document"), path, [DOCUMENT])
    space = IndexSpace.over(spark, path, registry)
    return batch_columns(bounded_batch_search(space, benchmark_queries(spark, folder), "text", 10))


# -- score, order, page, count -----------------------------------------------------------


@query("score_tfidf", text_sql(["thing", "esat", "th"]))
def score_tfidf(spark, folder):
    return scored(search(document_space(spark, folder), Match(THREE, "text")).hits)


def score_page(spark, folder):
    return scored(search(document_space(spark, folder), Match(THREE, "text")).page())


@query(
    "explain",
    f"""WITH {term_weights(["thing", "esat", "th"])}
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, term, CAST(tf AS DOUBLE) AS tf, df,
              round(idf, 6) AS idf, round(1 / sqrt(len), 6) AS norm, round(weight, 6) AS weight
       FROM s""",
)
def explain(spark, folder):
    rows = search(document_space(spark, folder), Match(THREE, "text")).explain()
    return rows.select(F.col("id").alias("doc_id"), "term", "tf", "df", "idf", "norm", "weight")


def ranked(page, *order):
    """A page with its places. A page is a few rows, so one window over it is small."""
    return page.withColumn("rk", F.row_number().over(Window.orderBy(*order)).cast("long"))


SORTED_SQL = f"""WITH {DOC_TOKENS},
       h AS (SELECT DISTINCT doc_id FROM t WHERE term IN ('thing', 'esat')),
       r AS (SELECT doc_id::VARCHAR AS doc_id, n_chars,
                    row_number() OVER (ORDER BY n_chars DESC, doc_id::VARCHAR) AS rk
             FROM h JOIN documents USING (doc_id))"""


@query("sort_field", SORTED_SQL + "SELECT rk, doc_id, n_chars FROM r WHERE rk <= 60")
def sort_field(spark, folder):
    hits = search(document_space(spark, folder, SORTABLE), Match(WORDS, "text"))
    page = hits.sorted_page(SORTABLE, "n_chars", descending=True)
    placed = ranked(page, F.desc("n_chars"), F.asc("id"))
    return placed.select("rk", F.col("id").alias("doc_id"), "n_chars")


@query(
    "page", SORTED_SQL + "SELECT rk - 10 AS rk, doc_id, n_chars FROM r WHERE rk > 10 AND rk <= 30"
)
def page(spark, folder):
    hits = search(document_space(spark, folder, SORTABLE), Match(WORDS, "text"))
    chosen = hits.sorted_page(SORTABLE, "n_chars", descending=True, start=10, size=20)
    placed = ranked(chosen, F.desc("n_chars"), F.asc("id"))
    return placed.select("rk", F.col("id").alias("doc_id"), "n_chars")


@query(
    "page_by_score",
    f"""WITH {term_weights(["thing", "esat", "th"])},
       g AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(sum(weight) * count(*) / 3, 6) AS score
             FROM s GROUP BY doc_id)
       SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rk, doc_id, score FROM g
       QUALIFY rk <= 60""",
)
def page_by_score(spark, folder):
    hits = search(document_space(spark, folder), Match(THREE, "text"))
    return ranked(scored(hits.page()), F.desc("score"), F.asc("doc_id"))


@query(
    "total",
    f"WITH {DOC_TOKENS} SELECT count(DISTINCT doc_id) AS total FROM t WHERE term IN ('thing', 'esat')",
)
def total(spark, folder):
    return search(document_space(spark, folder), Match(WORDS, "text")).total()


@query(
    "count_hits",
    f"WITH {DOC_TOKENS} SELECT count(DISTINCT doc_id) AS n FROM t WHERE term IN ('thing', 'esat')",
)
def count_hits_query(spark, folder):
    return count_hits(document_space(spark, folder), WORDS)


@query(
    "scores",
    "SELECT index || '.' || type AS index_type, id, score FROM (" + cross_sql() + ")",
)
def scores(spark, folder):
    return search(cross_space(spark, folder), WORDS).scores()


# -- highlighting ------------------------------------------------------------------------

PIECES = r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'"


def marked_sql(text: str, pre: str = "<em>", post: str = "</em>") -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({text}, {PIECES}),
      lambda x: CASE WHEN lower(x) IN ('thing', 'esat') THEN '{pre}' || x || '{post}' ELSE x END), '')"""


def holds_sql(text: str) -> str:
    return f"list_has_any({tok(text)}, ['thing', 'esat'])"


def hit_documents(spark, folder):
    """The hits' typed documents, and the search that found them."""
    space = document_space(spark, folder)
    found = search(space, Match(WORDS, "text"))
    documents = space.typed(DOCUMENT).join(found.matching().select("type", "id"), ["type", "id"])
    return found, documents


def fragment_rows(marked, column: str):
    return marked.select(
        F.col("id").alias("doc_id"), F.posexplode(f"`{column}`").alias("fragment_no", "fragment")
    )


def whole_text(spark, folder, **tags):
    found, documents = hit_documents(spark, folder)
    return fragment_rows(found.highlighted(documents, {"text": (0, 0)}, **tags), "text")


@query(
    "highlight",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 0 AS fragment_no, {marked_sql("text")} AS fragment
       FROM documents WHERE {holds_sql("text")}""",
)
def highlight(spark, folder):
    return whole_text(spark, folder)


@query(
    "highlight_tags",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 0 AS fragment_no,
              {marked_sql("text", "<strong>", "</strong>")} AS fragment
       FROM documents WHERE {holds_sql("text")}""",
)
def highlight_tags(spark, folder):
    return whole_text(spark, folder, pre="<strong>", post="</strong>")


@query(
    "fragments",
    rf"""WITH f AS (
         SELECT doc_id, list_filter(regexp_extract_all(text,
                  '(?s).{{1,100}}\z|.{{0,99}}[^\p{{L}}\p{{N}}]|.{{1,100}}'),
                  lambda p: {holds_sql("p")})[1:3] AS pieces
         FROM documents WHERE {holds_sql("text")}),
       u AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS fragment_no FROM f)
       SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(fragment_no AS INTEGER) AS fragment_no,
              {marked_sql("piece")} AS fragment FROM u""",
)
def fragments(spark, folder):
    found, documents = hit_documents(spark, folder)
    return fragment_rows(found.highlighted(documents, {"text": (100, 3)}), "text")


@query(
    "highlight_nested",
    f"""SELECT CAST(conv_id AS VARCHAR) AS doc_id, {marked_sql("text")} AS fragment
       FROM conversations WHERE {holds_sql("text")}""",
)
def highlight_nested(spark, folder):
    registry, loaded = conversations(spark, folder)
    space = TableSpace.over(registry, loaded)
    found = search(space, Match(WORDS, "turns.text"))
    documents = build_documents(registry, loaded, "chat.Conversation")
    hits = documents.join(found.matching().select("type", "id"), ["type", "id"])
    marked = found.highlighted(hits, {"turns.text": (0, 0)})
    return fragment_rows(marked, "turns.text").select("doc_id", "fragment")


