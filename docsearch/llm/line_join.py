"""Near-duplicate lines within an edit distance or alike in their words, by DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch.llm.components import components
from docsearch.llm.near_copies import ALIKE, SHINGLE, alike_pairs, cell_links, small
from docsearch.llm.tables import free_name, step, written

#: lines at this edit distance or less are near copies
DISTANCE = 2
#: shorter lines take part only where a caller asks for them
MIN_CHARS = 32
#: lines of so many characters up to MIN_CHARS are near copies at this distance, about as strict as DISTANCE in MIN_CHARS
SHORT_CHARS, SHORT_DISTANCE = 16, 1
#: so many hashes of candidate lines, or of keys they share, are broadcast; beyond it both sides are shuffled
BROADCAST_LINES = 1_000_000

#: runs that more lines hold than this are common: lines take rarer ones as keys where they can. Under so
#: many, comparing a line with a cell costs less than reading it again
COMMON = 1024
#: longs of the bits that tell unlike sets of word runs apart
SKETCH_LONGS = 4
#: characters of scripts written without spaces; each is a word
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

# The characters that the pattern \s stands for, as SQL writes them.
BLANKS = r" \t\n\u000B\u000C\r"
ODD_BLANKS = (r"\t", r"\n", r"\u000B", r"\u000C", r"\r")
# ASCII letters whose counts tell unlike lines apart; any of them give the same result.
LETTERS = "etaonishrldugfwb"
NIBBLE = 4


def within(left: str, right: str, distance: int) -> Column:
    """Whether two text columns are within an edit distance: a banded bit-parallel automaton.

    Bit o of ``rd`` says that, after j characters of ``right``, the first j + o - distance of
    ``left`` can be matched with d edits. One step takes the matches of the band's 2 * distance + 1
    characters and moves all bits at once.
    """
    band = 2 * distance + 1
    match = " | ".join(
        f"IF(get(p.x, j + {o - distance - 1}) = get(p.y, j - 1), {1 << o}, 0)" for o in range(band)
    )
    # the characters of both texts are split once, inside an array of one element
    masks = (
        f"transform(array(struct(split({left}, '') AS x, split({right}, '') AS y)),"
        f" p -> transform(sequence(1, size(p.y)), j -> {match}))[0]"
    )
    start, steps, fewer = [], [], ""
    for d in range(distance + 1):
        start.append(f"'r{d}', {sum(1 << (distance + i) for i in range(d + 1))}")
        step = f"(s.r{d} & m)"
        if d:
            moves = f"{step} | s.r{d - 1} | shiftright(s.r{d - 1}, 1) | shiftleft({fewer}, 1)"
            step = f"(({moves}) & {(1 << band) - 1})"
        steps.append(f"'r{d}', {step}")
        fewer = step
    states = (
        f"aggregate({masks}, named_struct({', '.join(start)}),"
        f" (s, m) -> named_struct({', '.join(steps)}), s -> s.r{distance})"
    )
    longer = f"char_length({left}) - char_length({right})"
    return F.expr(
        f"abs({longer}) <= {distance} AND (char_length({right}) = 0"
        f" OR (shiftright({states}, {longer} + {distance}) & 1) = 1)"
    )


def _letter_counts(line: str) -> str:
    """How often each of LETTERS occurs, modulo 16, in one number."""
    return " | ".join(
        f"shiftleft(CAST(octet_length({line}) - octet_length(replace({line}, '{c}', '')) AS BIGINT) & 15, {NIBBLE * i})"
        for i, c in enumerate(LETTERS)
    )


def _alike(a: str, b: str, distance: int) -> str:
    """An edit changes two letters' counts by one at most, so near copies differ little in them."""
    apart = []
    for i in range(len(LETTERS)):
        one, two = (f"(shiftright({x}, {NIBBLE * i}) & 15)" for x in (a, b))
        gap = f"(({one} - {two} + 16) & 15)"
        apart.append(f"least({gap}, 16 - {gap})")
    return f"{' + '.join(apart)} <= {2 * distance}"


def _segment(length: str, i: int, parts: int) -> tuple[str, str]:
    """Start, from 0, and size of segment ``i`` of a line cut into ``parts`` nearly equal ones."""
    base, longer = f"({length} DIV {parts})", f"({length} % {parts})"
    return (
        f"({i} * {base} + greatest(0, {i} - ({parts} - {longer})))",
        f"({base} + IF({i} >= {parts} - {longer}, 1, 0))",
    )


def _key(line: str, length: str, i: int, start: str, size: str) -> str:
    return f"xxhash64({length} * 64 + {i}, substring({line}, {start} + 1, {size}))"


def _own_keys(line: str, chars: str, distance: int) -> list[str]:
    """The keys under which a line is indexed: its length, a segment's number and text."""
    found = []
    for i in range(distance + 1):
        start, size = _segment(chars, i, distance + 1)
        found.append(_key(line, chars, i, start, size))
    return found


def _other_keys(line: str, chars: str, distance: int) -> list[str]:
    """The further keys under which a line looks for lines no longer than itself.

    One of distance + 1 segments of a near copy stands unchanged in the line, no further from its
    own place than the edits left of it and right of it allow.
    """
    found = []
    for shorter in range(distance + 1):
        length = f"({chars} - {shorter})"
        for i in range(distance + 1):
            start, size = _segment(length, i, distance + 1)
            rest = distance - i
            for shift in range(max(-i, shorter - rest), min(i, shorter + rest) + 1):
                if shorter or shift:
                    place = f"({start} + {shift})"
                    key = _key(line, length, i, place, size)
                    found.append(f"IF({place} >= 0 AND {place} + {size} <= {chars}, {key}, NULL)")
    return found


def _long_enough(line: Column, least: int) -> Column:
    """Whether a line has ``least`` characters and is not blank, or has MIN_CHARS of any kind."""
    size = F.char_length(line)
    return (size >= max(least, MIN_CHARS)) | ((size >= least) & line.rlike(r"\S"))


def _lines(docs: DataFrame, id_col: str, text_col: str, least: int = MIN_CHARS) -> DataFrame:
    """``id, line_no, line`` of the lines that take part, and two hashes that name the line."""
    text = F.split(F.col(text_col).cast("string"), "\n", -1)
    return (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.posexplode(text).alias("line_no", "line"))
        .withColumn("line_chars", F.char_length("line"))
        .where(_long_enough(F.col("line"), least))
        .withColumn("h", F.xxhash64("line"))
        .withColumn("h2", F.xxhash64(F.lit(1), "line"))
    )


def _keyed(lines: DataFrame, distance: int) -> DataFrame:
    """``h, keys``: distinct lines with their own keys first and then the others."""
    keys = _own_keys("line", "line_chars", distance) + _other_keys("line", "line_chars", distance)
    # columns of their own, not an array, let the aggregate hash and not sort
    distinct = lines.select("h", *(F.expr(key).alias(f"k{i}") for i, key in enumerate(keys))).distinct()
    return distinct.select("h", F.array(*(f"k{i}" for i in range(len(keys)))).alias("keys"))


def _meetings(keyed: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """``a, a_key`` and ``b, place, b_key``: lines under those keys alone that bring two lines together.

    Nearly all keys belong to one line. A semi-join finds the others without making a pair.
    """
    own = F.slice("keys", 1, distance + 1)
    indexed = keyed.select(F.col("h").alias("a"), F.explode(own).alias("a_key"))
    probes = keyed.select(F.col("h").alias("b"), F.posexplode("keys").alias("place", "b_key"))
    probes = probes.where("b_key is not null")
    met = written(probes.join(indexed, F.expr("a_key = b_key AND a <> b"), "left_semi"), "line-probes")
    shared = written(met.select(F.col("b_key").alias("key")).distinct(), "line-shared")
    if shared.count() <= BROADCAST_LINES:
        shared = F.broadcast(shared)
    return written(indexed.join(shared, F.col("a_key") == F.col("key"), "left_semi"), "line-indexed"), met


def _two_hash_name() -> Column:
    return F.concat(F.hex("h"), F.lit(":"), F.hex("h2"))


def _word_runs(line: str) -> str:
    """The distinct hashes of a line's runs of SHINGLE words, sorted; empty for fewer words."""
    spaced = (
        f"IF(octet_length({line}) > char_length({line}) AND {line} RLIKE r'{UNSPACED}',"
        f" regexp_replace({line}, r'({UNSPACED})', ' $1 '), {line})"
    )
    text = f"trim(BOTH '{BLANKS}' FROM lower({spaced}))"
    # one blank between words, as nearly everywhere, needs no pattern
    odd = " OR ".join(f"contains(t, '{blank}')" for blank in ("  ", *ODD_BLANKS))
    words = rf"IF({odd}, split(t, r'\s+'), split(t, ' '))"
    run = ", ".join(f"w[i + {k}]" for k in range(SHINGLE))
    # text and words are made once, inside an array of one element; words are hashed once
    hashed = f"transform(array({text}), t -> transform({words}, word -> xxhash64(word)))[0]"
    runs = f"IF(size(w) < {SHINGLE}, array(), transform(sequence(0, size(w) - {SHINGLE}), i -> xxhash64({run})))"
    return f"transform(array({hashed}), w -> sort_array(array_distinct({runs})))[0]"


def _parities(runs: str) -> str:
    """For each of SKETCH_LONGS * 64 classes of hashes, whether a set holds an odd number of them.

    Two sets' parities differ in no more bits than there are hashes in one of the sets alone.
    """
    start = ", ".join(f"'s{k}', 0L" for k in range(SKETCH_LONGS))
    step = ", ".join(
        f"'s{k}', IF(shiftright(x, 6) & {SKETCH_LONGS - 1} = {k}, s.s{k} ^ shiftleft(1L, CAST(x & 63 AS INT)), s.s{k})"
        for k in range(SKETCH_LONGS)
    )
    return f"aggregate({runs}, named_struct({start}), (s, x) -> named_struct({step}))"


def _runs_alike(a: str, b: str) -> str:
    """What sets as alike as ALIKE fulfil: sizes are near, and few hashes are in one of them alone."""
    apart = " + ".join(f"bit_count({a}_sketch.s{k} ^ {b}_sketch.s{k})" for k in range(SKETCH_LONGS))
    return (
        f"least({a}_n, {b}_n) >= {ALIKE} * greatest({a}_n, {b}_n) - 1e-6"
        f" AND {apart} <= ({a}_n + {b}_n) * {(1 - ALIKE) / (1 + ALIKE)} + 1e-6"
    )


def _keys_kept(n: str) -> str:
    """How many of ``n`` runs are keys: sets as alike as ALIKE share one of so many first ones in any common order."""
    return f"CAST({n} - ceil({ALIKE} * {n} - 1e-6) + 1 AS INT)"


def _run_sets(lines: DataFrame, names: DataFrame) -> DataFrame:
    """``h, runs`` of the distinct lines whose hash is a ``want`` of ``names``."""
    held = lines.join(small(names), F.col("h") == F.col("want"))
    return held.groupBy("h").agg(F.first("line").alias("line")).select("h", F.expr(_word_runs("line")).alias("runs"))


def _shared(keys: DataFrame) -> DataFrame:
    """``met``: the keys of ``h, key`` that more than one line has."""
    ends = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return written(ends.where("low <> high").select(F.col("key").alias("met")), "line-shared")


def _run_keys(lines: DataFrame) -> DataFrame:
    """``h, key``: the rarest runs of every line, as many as it takes, without keys that are one line's alone.

    Runs are in order of their hash, but for those that more than COMMON lines hold which meet under
    common keys: they come last, by the number of these lines. So lines that share a passage and little
    else meet under few of its runs, and only they are read again to find the order.
    """
    runs = lines.select("h", F.expr(_word_runs("line")).alias("runs"))
    kept = F.expr(f"slice(runs, 1, {_keys_kept('size(runs)')})")
    keyed = written(runs.select("h", kept.alias("keys")), "line-keys")
    keys = keyed.select("h", F.explode("keys").alias("key"))
    shared = _shared(keys)
    met = written(keys.join(small(shared), F.col("key") == F.col("met"), "left_semi").distinct(), "line-met")

    common = written(met.groupBy(F.col("key").alias("met")).count().where(F.col("count") > COMMON), "line-common")
    busy = met.join(small(common), F.col("key") == F.col("met"), "left_semi").select(F.col("h").alias("want"))
    sets = _run_sets(lines, written(busy.distinct(), "line-wanted"))
    held = sets.select(F.explode("runs").alias("run")).groupBy("run").agg(F.count("*").alias("held"))
    ranks = written(held.where(F.col("held") > COMMON), "line-ranks")

    moved = keys.join(small(ranks), F.col("key") == F.col("run"), "left_semi").select(F.col("h").alias("want"))
    moved = written(moved.distinct(), "line-moved")
    places = _run_sets(lines, moved).select("h", F.size("runs").alias("n"), F.explode("runs").alias("key"))
    places = places.join(small(ranks), F.col("key") == F.col("run"), "left")
    order = Window.partitionBy("h").orderBy(F.coalesce("held", F.lit(0)), "key")
    places = places.withColumn("place", F.row_number().over(order)).where(f"place <= {_keys_kept('n')}")
    places = written(places.select("h", "key"), "line-places")

    # lines that have not moved may have a key alone until a moved line takes it
    new = places.select("key").distinct().join(shared, F.col("key") == F.col("met"), "left_anti")
    new = written(new.select(F.col("key").alias("met")), "line-new")
    stay = met.union(keys.join(small(new), F.col("key") == F.col("met"), "left_semi").distinct())
    stay = stay.join(small(moved), F.col("h") == F.col("want"), "left_anti")
    return written(stay.union(places), "line-met")


def word_links(lines: DataFrame, hashes: DataFrame) -> DataFrame:
    """``a, b``: links between two-hash names of distinct lines alike in ALIKE of their word runs.

    Of ``n`` runs in order, all but ALIKE * n and one more are a line's keys: lines so alike share one
    of them at least, so none is missed. Sets and sketches are made only for lines that share a key.
    Components are those of all links. ``hashes`` has both hashes, ``h`` and ``h2``, of the lines.
    """
    keys = step(lambda: _run_keys(lines), "line-met")
    keys = written(keys.join(small(_shared(keys)), F.col("key") == F.col("met"), "left_semi"), "line-met")
    wanted = written(keys.select(F.col("h").alias("want")).distinct(), "line-wanted")
    sets = written(_run_sets(lines, wanted).select(F.col("h").alias("name"), F.col("runs").alias("shingles")), "line-sets")
    bands = keys.groupBy("h").agg(F.collect_list("key").alias("bands"))
    distinct = sets.join(bands, F.col("name") == F.col("h")).select(
        "name",
        F.expr("CAST(size(shingles) AS LONG) AS n"),
        F.expr(_parities("shingles")).alias("sketch"),
        "bands",
    )

    def ends(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("want")).union(pairs.select("b"))
        return small(written(both.distinct(), "line-wanted"))

    def verified(pairs: DataFrame) -> DataFrame:
        return alike_pairs(pairs, sets.join(ends(pairs), F.col("name") == F.col("want"), "left_semi")).distinct()

    found = written(cell_links(written(distinct, "line-runs"), _runs_alike, verified), "line-links")
    names = hashes.join(ends(found), F.col("h") == F.col("want"), "left_semi")
    names = written(names.select("h", _two_hash_name().alias("name")).distinct(), "line-names")

    def side(which: str) -> DataFrame:
        return names.select(*(F.col(c).alias(f"{which}_{c}") for c in ("h", "name")))

    both = found.join(side("left"), F.col("a") == F.col("left_h")).join(side("right"), F.col("b") == F.col("right_h"))
    return both.select(F.col("left_name").alias("a"), F.col("right_name").alias("b"))


def edit_links(lines: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: the two-hash names of distinct lines within ``distance`` edits."""
    indexed, probes = _meetings(written(_keyed(lines, distance), "line-keys"), distance)
    wanted = written(
        indexed.select(F.col("a").alias("want")).union(probes.select("b")).distinct(), "line-wanted"
    )
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    texts = written(
        lines.join(wanted, F.col("h") == F.col("want"))
        .groupBy("h", "h2")
        .agg(F.first("line").alias("line"))
        .select("h", _two_hash_name().alias("name"), "line", F.expr(_letter_counts("line")).alias("letters")),
        "line-texts",
    )
    letters = texts.select(F.col("h").alias("of"), "letters").distinct()
    left = indexed.join(letters, F.col("a") == F.col("of")).select("a", "a_key", F.col("letters").alias("a_letters"))
    right = probes.join(letters, F.col("b") == F.col("of")).select("b", "place", "b_key", F.col("letters").alias("b_letters"))
    # under keys that both are indexed by, a pair would meet both ways
    once = f"(a < b OR place > {distance})"
    met = left.join(
        right, F.expr(f"a_key = b_key AND a <> b AND {once} AND {_alike('a_letters', 'b_letters', distance)}")
    )
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def side(which: str) -> DataFrame:
        return texts.select(*(F.col(c).alias(f"{which}_{c}") for c in ("h", "name", "line")))

    both = pairs.join(side("left"), F.col("a") == F.col("left_h")).join(side("right"), F.col("b") == F.col("right_h"))
    return both.where(within("left_line", "right_line", distance)).select(
        F.col("left_name").alias("a"), F.col("right_name").alias("b")
    )


def line_links(
    docs: DataFrame,
    hashes: DataFrame,
    id_col: str,
    text_col: str,
    distance: int = DISTANCE,
    least: int = MIN_CHARS,
) -> DataFrame:
    """``a, b``: the two-hash names of distinct lines that are near copies by edits or by words.

    ``hashes`` has the hashes ``h`` and ``h2`` of all lines.
    """
    lines = _lines(docs, id_col, text_col, max(least, MIN_CHARS))
    links = step(lambda: edit_links(lines, distance), "line-links")
    links = links.union(step(lambda: word_links(lines, hashes), "line-links"))
    if least >= MIN_CHARS:
        return links
    # a short line and one of MIN_CHARS characters may be one edit apart
    short = _lines(docs, id_col, text_col, max(least, SHORT_CHARS)).where(F.col("line_chars") <= MIN_CHARS)

    def short_links() -> DataFrame:
        distinct = written(short.select("h", "h2", "line", "line_chars").distinct(), "line-short")
        return edit_links(distinct, min(distance, SHORT_DISTANCE))

    return links.union(step(short_links, "line-links"))


def line_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    least: int = MIN_CHARS,
) -> DataFrame:
    """``id_col, line_no, class_id, class_line_no, kept`` of every line that takes part.

    Lines end at a line feed. Equal lines, lines within ``distance`` edits (insert, delete or replace
    a character), and lines whose runs of SHINGLE words have a Jaccard similarity of ALIKE or more,
    are in a class, and so is what can be reached over such links; a class
    is named by its first line, the smallest id and then line number, which alone is ``kept``.
    Lines under ``least`` characters, blank ones under MIN_CHARS and lines of documents without an id or
    text are left out. Lines of SHORT_CHARS to MIN_CHARS characters link at SHORT_DISTANCE edits, shorter
    ones if they are equal.
    Repeated rows are one document. An empty table gives an empty result.

    Only distinct lines meet, and only hashes are shuffled: a text is read again for those lines
    that share a segment with another, and compared if it has about the same letters.
    """
    lines = written(_lines(docs, id_col, text_col, least).select("id", "line_no", "h", "h2"), "lines")

    def joined() -> DataFrame:
        return components(line_links(docs, lines, id_col, text_col, distance, least), "a", "b")

    links = step(joined, "line-components")
    first = lines.groupBy("h", "h2").agg(F.min(F.struct("id", "line_no")).alias("first"))
    named = first.withColumn("name", _two_hash_name())
    linked = named.join(links, F.col("name") == F.col("node"))
    roots = linked.groupBy(F.col("component").alias("root")).agg(F.min("first").alias("least"))
    moved = linked.join(roots, F.col("component") == F.col("root")).select(
        F.col("name").alias("moved"), "least"
    )
    classes = named.join(moved, F.col("name") == F.col("moved"), "left").select(
        F.col("h").alias("class_h"), F.col("h2").alias("class_h2"), F.coalesce("least", "first").alias("first")
    )
    same = (F.col("h") == F.col("class_h")) & (F.col("h2") == F.col("class_h2"))
    return lines.join(classes, same).select(
        F.col("id").alias(id_col),
        "line_no",
        F.col("first.id").alias("class_id"),
        F.col("first.line_no").alias("class_line_no"),
        ((F.col("id") == F.col("first.id")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept"),
    )


def without_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    least: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` whose texts hold each class of near-duplicate lines once, at its first place.

    A document that loses lines and has none of ``least`` characters left, or only blank ones under
    MIN_CHARS, goes; one that loses none, or has no id or text, stays as it is.
    """
    owner, gone = free_name(docs, "owner"), free_name(docs, "gone")
    repeated = (
        line_classes(docs, id_col, text_col, distance, least)
        .where("not kept")
        .groupBy(F.col(id_col).alias(owner))
        .agg(F.collect_set("line_no").alias(gone))
    )
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    rest = F.filter(lines, lambda _, i: ~F.array_contains(gone, i))
    joined = docs.join(repeated, F.col(id_col) == F.col(owner), "left")
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(rest, "\n"))
    passage = F.exists(rest, lambda line: _long_enough(line, least))
    return joined.where(F.col(gone).isNull() | passage).select(
        *(text.alias(c) if c == text_col else F.col(c) for c in docs.columns)
    )
