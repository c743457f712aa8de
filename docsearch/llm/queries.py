"""One query for each operator, over its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.llm.bit_sliced import top_k
from docsearch.llm.hilbert import hilbert_shards
from docsearch.llm.license_scan import license_scan
from docsearch.llm.line_join import line_classes
from docsearch.llm.link_graph import DAMPING, MOST_STEPS, RATIO, Rule, page_verdicts
from docsearch.llm.merkle_manifest import FAN, merkle_manifest
from docsearch.llm.metric_join import near_vectors
from docsearch.llm.pair_bpe import bpe_round_trip
from docsearch.llm.periodic_runs import periodic_runs
from docsearch.llm.pivot_simhash import simhash_components
from docsearch.llm.rank_profiles import collected, held_out, identify, learn
from docsearch.llm.registry import query
from docsearch.llm.retrieval_packing import pack
from docsearch.llm.suffix_levels import repeated_bytes

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_retrieval_packing")
def op1_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents"), WORD_BPE)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op2_hilbert_shards")
def op2_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    placed = hilbert_shards(
        sized,
        ("lang", "source", "size", "doc_id"),
        "doc_id",
        {"size": F.col("size"), "text_crc32": F.col("text_crc32")},
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@query(
    "op3_bit_sliced_top_k",
    """
    WITH v AS (
      SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
      WHERE q.vec_id % 20 = 0
    )
    SELECT * FROM (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
             vec_id, score
      FROM s) WHERE rank <= 20
    """,
)
def op3_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query("op7_pivot_simhash")
def op7_pivot_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"))


@query(
    "op8_metric_join",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93
    ), reach AS (
      SELECT vec_id AS a, vec_id AS b FROM embeddings
      UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, least.component_id,
           e.vec_id = least.component_id AS kept
    FROM embeddings e JOIN least USING (vec_id)
    """,
)
def op8_metric_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


@query("op9_rank_profiles")
def op9_rank_profiles(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = identify(docs.select("doc_id", "text"), collected(learn(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op10_pair_bpe")
def op10_pair_bpe(spark: SparkSession, folder: str) -> DataFrame:
    both = bpe_round_trip(table(spark, folder, "documents").select("doc_id", "text"), BYTE_BPE)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_line_join")
def op4_line_join(spark: SparkSession, folder: str) -> DataFrame:
    return line_classes(table(spark, folder, "documents"), least=1)


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def _verdict_sql() -> str:
    """The same judgement in SQL, with every step of the spreading written out."""
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    host = f"coalesce(translate(regexp_extract({{}}, '(?s)^.*?://([^/?#]*)', 1), {lower}), '')"
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
    steps = "ranks0 AS (SELECT host, t, d, t * (1 - {0}) AS trust, d * (1 - {0}) AS distrust FROM seeds)".format(
        DAMPING
    )
    for i in range(1, MOST_STEPS + 1):
        steps += f""", ranks{i} AS (
      SELECT host, t, d,
        t * (1 - {DAMPING}) + {DAMPING} * coalesce((SELECT sum(r.trust * e.ahead) FROM edges e
          JOIN ranks{i - 1} r ON r.host = e.source WHERE e.target = s.host), 0) AS trust,
        d * (1 - {DAMPING}) + {DAMPING} * coalesce((SELECT sum(r.distrust * e.back) FROM edges e
          JOIN ranks{i - 1} r ON r.host = e.target WHERE e.source = s.host), 0) AS distrust
      FROM seeds s)"""
    return rf"""
    WITH rules(of, start, said) AS (VALUES {rules}), p AS (
      SELECT page_id, {host.format("url")} AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, html
      FROM pages
    ), ruled AS (
      SELECT page_id, host, path, best.rule, best.said FROM p LEFT JOIN LATERAL (
        SELECT of || start AS rule, said FROM rules
        WHERE (host = of OR ends_with(host, '.' || of)) AND starts_with(path, start)
        ORDER BY length(of || start) DESC, length(of) DESC LIMIT 1) best ON true
    ), found AS (
      SELECT host AS source, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?([^"''\s>]+)', 1)) AS link FROM p
    ), pairs AS (
      SELECT source, {host.format("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END")} AS target
      FROM found WHERE contains(link, '//')
    ), links AS (
      SELECT source, target, count(*) AS links FROM pairs
      WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL
    ), edges AS (
      SELECT source, target, links / sum(links) OVER (PARTITION BY source) AS ahead,
        links / sum(links) OVER (PARTITION BY target) AS back FROM links
    ), named AS (
      SELECT host FROM p WHERE host <> '' UNION SELECT source FROM links UNION SELECT target FROM links
    ), seeds AS (
      SELECT n.host,
        coalesce(count(*) FILTER (r.said = 'allow') / nullif((SELECT count(*) FROM ruled WHERE said = 'allow'), 0), 0) AS t,
        coalesce(count(*) FILTER (r.said = 'block') / nullif((SELECT count(*) FROM ruled WHERE said = 'block'), 0), 0) AS d
      FROM named n LEFT JOIN ruled r ON r.host = n.host GROUP BY n.host
    ), {steps}
    SELECT r.page_id, r.host, r.path, r.rule,
      coalesce(r.said, CASE WHEN k.distrust > {RATIO} * k.trust THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled r LEFT JOIN ranks{MOST_STEPS} k ON k.host = r.host
    """


@query("op6_link_graph", _verdict_sql())
def op6_link_graph(spark: SparkSession, folder: str) -> DataFrame:
    return page_verdicts(table(spark, folder, "pages"), URL_RULES)


def planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, of which one in ten repeats a stretch from some word to the end."""
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@query("op13_basic_factor_runs")
def op13_basic_factor_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), prepare=planted_run)
    # exact ratios: of two runs the one with the greater length * other period comes first
    best = F.expr(
        "aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),"
        " (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
#: levels that the SQL writes out: leaves of a language up to FAN ** 8, and languages up to FAN ** 3
SQL_LEVELS, SQL_TOP_LEVELS = 8, 3


def _manifest_sql() -> str:
    """The same trees in SQL, level by level; a level of one node hands it on."""

    def leaf(text: str) -> str:
        values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(concat({}))".format(
            ", ".join(f"coalesce(concat(strlen({v}), ':', {v}), '-')" for v in values)
        )

    crc = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT))), lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)),
      lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))"""
    beside = "coalesce(string_agg(d, '') OVER (PARTITION BY tree, place // {fan} ORDER BY place ROWS BETWEEN {rows}), '')"
    before = beside.format(fan=FAN, rows="UNBOUNDED PRECEDING AND 1 PRECEDING")
    after = beside.format(fan=FAN, rows="1 FOLLOWING AND UNBOUNDED FOLLOWING")

    def levels(name: str, count: int) -> str:
        steps = ""
        for i in range(count):
            steps += f""", {name}s{i} AS (
      SELECT tree, place, {before} AS l, {after} AS r, count(*) OVER (PARTITION BY tree) > 1 AS more, d FROM {name}{i}
    ), {name}{i + 1} AS (
      SELECT tree, place // {FAN} AS place, CASE WHEN bool_or(more) THEN sha256(string_agg(d, '' ORDER BY place)) ELSE min(d) END AS d
      FROM {name}s{i} GROUP BY ALL)"""
        return steps

    def fold(name: str, i: int, source: str, tree: str, at: str) -> str:
        return f"""SELECT f.* REPLACE (
        CASE WHEN s.more THEN proof || s.l || s.r ELSE proof END AS proof,
        CASE WHEN s.more THEN sha256(s.l || folded || s.r) ELSE folded END AS folded)
      FROM {source} f JOIN {name}s{i} s ON s.tree = {tree} AND s.place = {at} // {FAN**i}"""

    folds, last = "", "fold"
    for name, count, tree, at in (("n", SQL_LEVELS, "f.tree", "f.place"), ("t", SQL_TOP_LEVELS, "''", "f.top")):
        for i in range(count):
            folds += f", fold_{name}{i} AS ({fold(name, i, last, tree, at)})"
            last = f"fold_{name}{i}"
    return f"""
    WITH leaves AS (
      SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf,
        CASE WHEN {crc} IS NOT NULL AND xor({crc}, 4294967295) % 3 = 0
          THEN {leaf(f"translate(text, {ASCII})")} ELSE {leaf("text")} END AS presented
      FROM documents
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
    ), n0 AS (SELECT tree, place, leaf AS d FROM numbered){levels("n", SQL_LEVELS)}
    , tops AS (SELECT tree AS named, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top FROM n{SQL_LEVELS})
    , t0 AS (SELECT '' AS tree, top AS place, subroot AS d FROM tops){levels("t", SQL_TOP_LEVELS)}
    , fold AS (
      SELECT doc_id, tree, place, leaf, subroot, top, (SELECT min(d) FROM t{SQL_TOP_LEVELS}) AS root,
        '' AS proof, presented AS folded
      FROM numbered JOIN tops ON named = tree){folds}
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM {last}
    """


@query("op11_merkle_manifest", _manifest_sql())
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.expr(f"translate(text, {ASCII})")
    changed = {"text": F.when(F.coalesce(chosen, F.lit(False)), lowered).otherwise(F.col("text"))}
    return merkle_manifest(table(spark, folder, "documents"), presented=changed)


@query("op12_suffix_levels")
def op12_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
