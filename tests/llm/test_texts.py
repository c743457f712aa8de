"""SimHash, line join, licence scan, language profiles, BPE and packing."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from odd import LONG, ODD_ROWS, SCHEMA, edits, no_docs, odd_docs, rows, smallest
from tokenizers import Tokenizer

from docsearch.llm import license_scan as licenses
from docsearch.llm import line_join, pivot_simhash
from docsearch.llm.pair_bpe import bpe_decode, bpe_encode
from docsearch.llm.queries import BYTE_BPE, WORD_BPE
from docsearch.llm.rank_profiles import Profiles, collected, held_out, identify, learn
from docsearch.llm import retrieval_packing as packing
from docsearch.llm.retrieval_packing import pack

WORDS = "the of and cat dog river stone house green blue walk run talk tree sky".split()


def _varied(count, seed, words=30):
    """Texts of which some differ in a word or two."""
    rng = random.Random(seed)
    texts = []
    for i in range(count):
        if texts and rng.random() < 0.5:
            own = rng.choice(texts).split()
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
        else:
            own = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(words)]
        texts.append(" ".join(own))
    return texts


def _print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _simhash_wanted(docs, radius=2):
    prints = {i: _print(t) for i, t in docs}
    top = smallest(prints, lambda x, y: (prints[x] ^ prints[y]).bit_count() <= radius)
    return sorted((i, f"{prints[i]:016x}", top[i]) for i, _ in docs)


def test_simhash_equals_brute_force(spark):
    docs = list(enumerate(_varied(300, 1)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = _simhash_wanted(docs)
    assert len({w[2] for w in want}) < 290
    assert rows(pivot_simhash.simhash_components(table), "*") == sorted(want, key=repr)
    wider = _simhash_wanted(docs, 4)
    assert wider != want
    assert rows(pivot_simhash.simhash_components(table, radius=4), "*") == sorted(wider, key=repr)
    with pytest.raises(ValueError):
        pivot_simhash.simhash_components(table, radius=5)


def test_simhash_cells_of_close_fingerprints():
    rng = np.random.default_rng(2)
    prints = np.unique(np.array([0x0F0F << 20 ^ int(x) for x in rng.integers(0, 1 << 12, 400)], dtype=np.uint64))
    left, right = pivot_simhash.cell_links(np.zeros(len(prints), dtype=np.int64), prints)
    near = {(int(a), int(b)) for a, b in zip(left, right, strict=True)}
    every = lambda x, y: (int(prints[x]) ^ int(prints[y])).bit_count() <= 2
    assert all(every(a, b) for a, b in near) and len(near) < len(prints) * 3
    nodes = range(len(prints))
    assert smallest(nodes, lambda x, y: (x, y) in near) == smallest(nodes, every)


def test_simhash_of_odd_rows(spark):
    found = rows(pivot_simhash.simhash_components(odd_docs(spark)), "*")
    prints = [(i, _print(t)) for i, t, *_ in ODD_ROWS]
    assert sorted((f[0], f[1]) for f in found if f[0]) == sorted((i, f"{p:016x}") for i, p in prints if i)
    by_id = dict((f[0], f[2]) for f in found)
    assert (by_id[2], by_id[3], by_id[7], by_id[5], by_id[None]) == (2, 2, 2, 1, None)
    assert pivot_simhash.simhash_components(no_docs(spark)).count() == 0


def _edited(rng, line, count):
    for _ in range(count):
        at, how = rng.randrange(len(line) + 1), rng.randrange(3)
        line = line[:at] + (rng.choice("xyé") if how != 1 else "") + line[at + (how != 0) :]
    return line


def test_edit_automaton_equals_the_table(spark):
    rng = random.Random(4)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("", "abc"), ("🙂é", "é🙂")]
    for _ in range(300):
        line = "".join(rng.choice("abé") for _ in range(rng.randrange(20)))
        pairs.append((line, _edited(rng, line, rng.randrange(5))))
    table = spark.createDataFrame(pairs, "l string, r string")
    for most in (1, 2, 3):
        for r in table.withColumn("near", line_join.within("l", "r", most)).collect():
            assert r["near"] == (edits(r["l"], r["r"]) <= most), (r, most)


def _line_wanted(docs):
    lines = {(i, n): line for i, t in docs for n, line in enumerate(t.split("\n")) if len(line) >= 32}
    top = smallest(lines, lambda x, y: edits(lines[x], lines[y]) <= 2)
    return sorted((*k, *top[k], k == top[k]) for k in lines)


def test_line_classes_equal_brute_force(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(31, 45))) for _ in range(20)]
    docs = [(i, "\n".join(_edited(rng, rng.choice(lines), rng.randrange(4)) for _ in range(4))) for i in range(45)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = _line_wanted(docs)
    assert len({w[2:4] for w in want}) < len(want) / 2
    assert sorted(tuple(r) for r in line_join.line_classes(table).collect()) == want


def test_lines_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = rows(line_join.line_classes(docs), "*")
    assert set(found) == {(1, 0, 1, 0, True), (4, 0, 4, 0, True), (5, 0, 1, 0, False)}
    rest = line_join.without_repeated_lines(docs)
    assert rest.columns == docs.columns
    assert rows(rest, "doc_id", "text") == sorted([(i, t) for i, t, *_ in ODD_ROWS if i != 5], key=repr)
    assert line_join.line_classes(no_docs(spark)).count() == 0
    assert line_join.without_repeated_lines(no_docs(spark)).count() == 0


def test_repeated_line_is_cut_out_of_a_text(spark):
    line, other = "this line stands in more than one of the documents", "while this one of the same length is its own"
    texts = [f"one\n{line}", f"two\n{line}!\nthree\n{line}\n{other}", f"four\n{line}"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # what the last one is left with is no passage
    assert rows(line_join.without_repeated_lines(table), "*") == [(0, f"one\n{line}"), (1, f"two\nthree\n{other}")]


def _licences_wanted(docs):
    scanner = licenses.Scanner(licenses.NOTICES, licenses.CONTAINED)
    want = {}
    for i, text in docs:
        words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
        runs = list(zip(*(words[k:] for k in range(5)), strict=False))
        for t in scanner.templates:
            at = [n for n, r in enumerate(runs) if r in t.shingles]
            # what the shortest stretch that every window grid covers holds
            parts = [len({runs[n] for n in at if s <= n < s + 2 * t.block}) / len(t.shingles) for s in at]
            if parts and max(parts) >= licenses.CONTAINED:
                want[i, t.name] = max(parts)
    return want


def test_licences_equal_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for i in range(150):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(400))]
        notice = rng.choice(licenses.NOTICES)[2].split()
        for _ in range(rng.randrange(4)):
            notice[rng.randrange(len(notice))] = "other"
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + notice + words[at:]) if i % 3 else " ".join(words)))
    found = licenses.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {(r["doc_id"], r["template"]): r["containment"] for r in found}
    want = _licences_wanted(docs)
    assert set(got) == set(want) and len(got) == len(found) > 40
    assert all(got[k] >= want[k] - 1e-9 for k in want)


def test_licences_of_odd_rows(spark):
    docs = odd_docs(spark).unionByName(
        spark.createDataFrame([(20, "released UNDER the mit license")], "doc_id long, text string"), True
    )
    found = licenses.license_scan(docs)
    assert rows(found, "*") == [(20, "mit-line", "MIT", 1.0, 0)]
    assert licenses.license_scan(docs, notices=()).count() == 0
    assert licenses.license_scan(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        licenses.license_scan(docs, notices=(("x", "X", "too short"),))


def test_bands_make_collisions_likely():
    for size in (1, 4, 17, 63):
        window = 3 * max(2, size)
        shared = max(1, int(np.ceil(0.8 * size - 1e-9)))
        similarity = shared / (size + window - shared)
        assert 1 - (1 - similarity) ** licenses.bands_for(size, window) >= 0.9999


def test_languages_of_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), collected(learn(docs))).withColumn("held", held_out())
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in found.collect() if r["held"]]
    assert len(held) > 30
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_learning_reads_no_held_out_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    changed = docs.selectExpr("doc_id", f"IF({'crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2'}, 'zzzz', text) AS text", "lang")
    assert rows(learn(docs), "*") == rows(learn(changed), "*")


def test_out_of_place_distance_by_hand():
    profiles = Profiles({"x": np.array([5, 7, 9]), "y": np.array([ord("a")])}, size=3)
    # "a" has the n-grams a, " a", "a ", " a ": the first three by number are ranked 0, 1, 2
    assert profiles.nearest("a") == ("y", pytest.approx(1 - (0 + 3 + 3) / 9))
    assert profiles.nearest("12") == profiles.nearest(None) == ("und", 0.0)


def test_languages_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = identify(docs, collected(learn(docs)))
    assert found.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    unknown = {r["doc_id"] for r in found.collect() if r["lang_pred"] == "und"}
    assert unknown == {2, 3, 7, 8} and found.count() == len(ODD_ROWS)
    none = collected(learn(no_docs(spark)))
    assert identify(no_docs(spark), none).count() == 0
    assert {r["lang_pred"] for r in identify(docs, none).collect()} == {"und"}


def test_bpe_equals_the_library(spark, folder):
    library = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(9)
    texts = [t for _, t, *_ in ODD_ROWS] + ["".join(rng.choice(" \n\tab'sréΣ1²<|>.,🙂") for _ in range(80)) for _ in range(300)]
    texts += ["a  b   c\n\n d<|endoftext|>e", "aaaaaaa aaaa", LONG + "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(
        spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id + 10000", "text")
    )
    encoded = bpe_encode(docs, BYTE_BPE)
    decoded = {r["doc_id"]: r["text"] for r in bpe_decode(encoded, BYTE_BPE).collect()}
    for r in encoded.join(docs, "doc_id").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert decoded[r["doc_id"]] == library.decode(ids, skip_special_tokens=False) == (r["text"] or "")


def test_bpe_decodes_what_is_no_text(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    ids = [[250], [133, 98], [], None, [50256, None, 64]]
    table = spark.createDataFrame(list(enumerate(ids)), "n long, ids array<int>")
    found = [r["text"] for r in bpe_decode(table, BYTE_BPE).orderBy("n").collect()]
    assert found[:3] == [library.decode(x, skip_special_tokens=False) for x in ids[:3]]
    assert found[3:] == [None, library.decode([50256, 64], skip_special_tokens=False)]


def test_bpe_of_odd_rows(spark):
    found = bpe_encode(odd_docs(spark), BYTE_BPE)
    assert found.count() == len(ODD_ROWS) and bpe_encode(no_docs(spark), BYTE_BPE).count() == 0
    assert bpe_decode(found, BYTE_BPE).count() == len(ODD_ROWS)


def _check_pieces(pieces, texts):
    """Every id of every document lies in one piece, and sequences are gapless and full."""
    library = Tokenizer.from_file(WORD_BPE)
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        parts[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] * 4 == len(r["ids"])
    for i, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        got = sorted(parts[i])
        assert [s for s, _, _ in got] == [sum(len(x) for _, x, _ in got[:n]) for n in range(len(got))]
        assert [x for _, part, _ in got for x in part] == ids and {n for _, _, n in got} == {len(ids)}
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 2048
    return sequences


def test_packing_is_whole_and_full(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = pack(docs, WORD_BPE).collect()
    sequences = _check_pieces(pieces, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert sum(n for p in sequences.values() for _, n in p) == sum(r["length"] for r in pieces)


def test_packing_of_odd_rows(spark):
    docs = odd_docs(spark).dropDuplicates(["doc_id"])
    pieces = pack(docs, WORD_BPE).collect()
    _check_pieces(pieces, {i: t for i, t, *_ in ODD_ROWS})
    repeated = pack(odd_docs(spark), WORD_BPE).collect()
    assert sum(r["length"] for r in repeated if r["doc_id"] == 5) == 2 * sum(r["length"] for r in pieces if r["doc_id"] == 5)
    assert pack(no_docs(spark), WORD_BPE).count() == 0


def test_word_encoder_equals_the_library_on_every_character():
    """Also on those that tables of other Unicode versions class differently."""
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    points = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    texts = [f"Word{c}x {c}{c} A1{c}b" for c in points]
    rng = random.Random(4)
    texts += ["".join(rng.choice([rng.choice(points), *"aA 1\n\t'sé."]) for _ in range(60)) for _ in range(500)]
    encoder = packing.WordEncoder(WORD_BPE)
    found = [ids.tolist() for ids in encoder.encode(texts)]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_word_encoder_remembers_words_without_their_marks():
    texts = ["stone, river. café. tree_, b", "a.. b., c ,. d", ". , x", "end.", "Σ. Σ, a\t, b.\nc", "1, 2. ½, 三. z"]
    encoder = packing.WordEncoder(WORD_BPE)
    for text in texts:
        found = encoder.encode([text])[0].tolist()
        assert found == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder = packing.WordEncoder(WORD_BPE)
    encoder.encode(["stone, café. stone."])
    assert {"stone", "café", ",", "."} <= set(encoder.known)
    assert "café." not in encoder.known


def test_word_encoder_that_forgets(monkeypatch):
    texts = [" ".join(f"w{i * j % 97},x{j}" for j in range(40)) for i in range(60)]
    whole = packing.WordEncoder(WORD_BPE).encode(texts)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = packing.WordEncoder(WORD_BPE)
    for text, want in zip(texts, whole, strict=True):
        assert encoder.encode([text])[0].tolist() == want.tolist()
    assert len(encoder.known) < 200


def _bm25(docs, idf, mean_length, seed):
    """The score of every document for all of a seed's terms, term by term."""
    scores = []
    for doc in docs:
        total = 0.0
        for term in sorted(set(docs[seed].tolist())):
            often = doc.tolist().count(term)
            saturation = often + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean_length)
            total += idf[term] * often * (packing.K1 + 1) / saturation
        scores.append(total)
    return scores


def test_windows_are_filled_with_the_best_unused_neighbours():
    """Documents of 60 to 120 distinct terms each, so that a seed asks with all of them."""
    rng = np.random.default_rng(12)
    odds = 1 / np.arange(1, 401)
    docs = [rng.choice(400, rng.integers(60, 200), p=odds / odds.sum()).astype("<u2") for _ in range(80)]
    held = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=400)
    idf = np.maximum(0.0, np.log((len(docs) - held + 0.5) / (held + 0.5)))
    mean = float(np.mean([len(d) for d in docs]))
    index = packing.ShardIndex(docs, idf, mean)
    for seed in range(len(docs)):
        others = np.arange(len(docs)) != seed
        assert np.allclose(index.scores(seed)[others], np.array(_bm25(docs, idf, mean, seed))[others])

    window = 700
    packer = packing.Packer(window)
    windows = [*packing.pack_shard(packer, docs, 0, idf, mean), *packer.rest()]
    pieces = [piece for sequence in windows for piece in sequence]
    order = [doc for doc, start, _ in pieces if start == 0]
    assert sorted(order) == list(range(len(docs)))
    unused, fill, scores = set(order), 0, None
    for seed in order:
        if scores is not None:
            best = max(scores[d] for d in unused)
            assert seed == min(unused) if best <= 0 else np.isclose(scores[seed], best)
        unused.remove(seed)
        opens = fill == 0 or fill + len(docs[seed]) > window
        fill = (fill + len(docs[seed])) % window
        if fill == 0:
            scores = None
        elif opens:
            scores = _bm25(docs, idf, mean, seed)


def test_packing_brings_neighbours_together(spark):
    rng = random.Random(12)
    topics = [[f"{a}{b}" for b in "bcdfghjklm"] for a in ("qua", "zor", "vix", "wuj")]
    docs = []
    for i in range(200):
        docs.append((i, " ".join(rng.choice(topics[i % 4]) for _ in range(150))))
    pieces = pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), WORD_BPE).collect()
    windows = defaultdict(set)
    for r in pieces:
        windows[r["sequence_id"]].add(r["doc_id"] % 4)
    full = [w for w in windows.values()]
    assert sum(len(w) for w in full) / len(full) < 2


def test_digest_of_ids_is_of_decimal_text(spark, folder):
    from docsearch.llm.queries import op10_pair_bpe

    library = Tokenizer.from_file(BYTE_BPE)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op10_pair_bpe(spark, folder).limit(40).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_schema_matches():
    assert len(ODD_ROWS[0]) == len(SCHEMA.split(","))
