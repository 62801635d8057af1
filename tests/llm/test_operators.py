"""Each operator against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and other columns."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

from emberlog.llm import bpe, components, decontaminate, html_extract, license_scan, quality, quote_links, similar, simhash, token_files, url_filter, warc
from emberlog.llm import queries as llm_queries
from emberlog.llm.chunks import ChunkEncoder
from emberlog.llm.common import shared_dir

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", " ", "one", "Two words", "The MIT License, and the Apache License. CC BY 4.0!", "mit license mit license", "Ça été — naïve Straße\n\nline\nline\n", "a b c a b c a b c d", "x\t\ty  z \n", "<|endoftext|> it's 3.14, ok.\nNew \x1c odd",
    "SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)\ncode", "aaaa" * 3000, "word, " * 500, "😀 emoji é́", "one",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, "en", 7, "x") for i, t in enumerate(TEXTS)] + [(3, "one", "en", 7, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int, fingerprint string")


def empty(df):
    return df.where("false")


def test_license_scan(docs):
    got = {(r.doc_id, r.n_words): r for r in license_scan.license_scan(docs).collect()}
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in docs.collect():
        w = words.findall((r.text or "").translate(LOWER))
        places = [k for p in license_scan.BASE for q in [p.split()] for k in range(len(w)) if w[k : k + len(q)] == q]
        g = got[(r.doc_id, len(w))]
        assert (g.n_base, g.first_word, g.last_word) == (len(places), min(places, default=None), max(places, default=None))
    assert got[(5, 11)].base_labels == "apache,cc-by,mit" and got[(0, 0)].labels == ""
    assert license_scan.license_scan(empty(docs)).count() == 0


def test_license_expressions():
    assert license_scan.postfix("a OR b AND c WITH d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert license_scan.evaluate("GPL-3.0-only OR MIT") == (["gpl", "mit"], 1)
    assert license_scan.evaluate("(GPL-3.0-only AND MIT)") == (["gpl", "mit"], 3)
    for bad in ("", "AND MIT", "(MIT", "MIT)", "MIT OR", "()"):
        with pytest.raises(license_scan.Expression):
            license_scan.postfix(bad)


def test_long_license_expressions_are_read_whole():
    line = "SPDX-License-Identifier: (" + " OR ".join(["MIT"] * 500) + ") AND GPL-3.0-only"
    got = license_scan.scan(line)
    assert got[5] == "gpl,mit" and got[8] is False and len(got[7]) == 1


def test_many_tags_on_a_line():
    """Each tag has its own expression, and a text of tags alone takes time by its length."""
    import time

    kinds = ["MIT", "GPL-2.0-only OR Apache-2.0", "ISC AND BSD-3-Clause"]
    got = license_scan.scan("code " + " ".join(f"SPDX-License-Identifier: {kinds[k % 3]}" for k in range(300)))
    assert got[5] == "apache,bsd,gpl,isc,mit" and len(got[7]) == 300 and got[7][:2] == ["MIT", "GPL-2.0-only Apache-2.0 or"]
    assert license_scan.scan("SPDX-License-Identifier: SPDX-License-Identifier: MIT\nSPDX-License-Identifier")[5] == "mit"
    began = time.time()
    assert len(license_scan.scan("SPDX-License-Identifier: MIT " * 40_000)[7]) == 40_000
    assert time.time() - began < 20


def test_reserved_rights_beside_a_licence():
    assert license_scan.scan("Copyright, all rights reserved.")[5] == "proprietary"
    assert license_scan.scan("All rights reserved. Redistribution and use in source and binary forms")[5] == "bsd"


def test_quality_statistics():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b ", "#c\n", "é ", "  ", "\n", "a b c "]) for _ in range(rng.randrange(60)))
        w = WORDS.findall(text)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        assert quality.statistics(text)[0] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_trees_are_monotonic_and_right():
    rng = np.random.default_rng(0)
    x = rng.random((1500, len(quality.FEATURES)))
    y = ((x[:, 2] < 0.5) | (rng.random(1500) < 0.05)).astype(float)
    trees = quality.fit_trees(x[:1000], y[:1000], [s for _, s in quality.FEATURES])
    assert ((trees.score(x[1000:]) >= 0.5) == (y[1000:] > 0)).mean() > 0.93
    for k, (_, sign) in enumerate(quality.FEATURES):
        if sign:
            line = np.repeat(x[:20], 50, 0)
            line[:, k] = np.tile(np.linspace(-1, 2, 50), 20)
            assert (np.diff(trees.margin(line).reshape(20, 50), axis=1) * sign >= -1e-12).all()
    assert (quality.fit_trees(x[:10], np.ones(10), [0] * 12).score(x[:5]) > 0.5).all()


def test_quality_on_tables(spark, docs):
    labels = spark.createDataFrame([(1, 0, 0), (8, 1, 0), (8, 1, 0), (None, 1, 0), (13, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.fit_quality(docs, labels)
    got = quality.score_documents(docs, trees).collect()
    assert len(got) == docs.count() and all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert quality.score_documents(empty(docs), quality.fit_quality(docs, empty(labels))).count() == 0
    kept = quality.keep_good(docs, quality.fit_quality(docs, empty(labels)))
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality.score_documents(docs, quality.fit_quality(docs, empty(labels))).collect())


def test_bpe_equals_the_library(docs):
    import tiktoken

    path = public_tokenizers.path(bpe.VOCABULARY)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(2)
    more = ["".join(rng.choice(["the ", "a", "xyz", ", ", ". ", "\n", "é", "  ", "12", "'s", "_", "!?", "​", "ﬁ"]) for _ in range(rng.randrange(80))) for _ in range(300)]
    codec = bpe.codec(path, public_tokenizers.PATTERN)
    texts = [t or "" for t in TEXTS] + more
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t), repr(t)
        assert codec.decode(ids) == t.encode()
    got = bpe.encode_documents(docs).collect()
    want = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == want
    assert bpe.encode_documents(empty(docs)).count() == 0


def test_merges_are_leftmost_and_least():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aaa": 258, b"ba": 259, b"abab": 260, b"aaaa": 261}
    merger = bpe.Merger(ranks)

    def plain(piece: bytes) -> list[int]:
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = min(((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
            if not found:
                return [ranks[p] for p in parts]
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]

    rng = random.Random(3)
    pieces = ["".join(rng.choice("aab") for _ in range(rng.choice([1, 3, 9, 40, 300]))).encode() for _ in range(400)] + [b"c"]
    for piece, ids in zip(pieces, merger(pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(piece)


def test_chunk_table_may_overflow():
    calls = []
    encoder = ChunkEncoder(lambda xs: calls.append(len(xs)) or [x.encode() for x in xs], most=5)
    texts = ["a b, c. d", "e f  g\n", "a b c d e f g h", ""]
    assert [x.decode() for x in encoder.encode(texts)] == texts
    assert [x.decode() for x in encoder.encode(texts[::-1])] == texts[::-1]


def test_chunk_table_is_bounded_and_can_be_emptied():
    encoder = ChunkEncoder(lambda xs: [x.encode() for x in xs], most=5)
    for texts in (["a b c d e f g h", ", i", "j\nk, l. m"], ["k  l", "a b", "n"]):
        assert [x.decode() for x in encoder.encode(texts)] == texts
        assert len(encoder.words) <= 5 and len(encoder.chunks) <= 5
    encoder.forget()
    assert not encoder.words and not encoder.chunks


def test_encoding_leaves_no_table_in_workers(docs, monkeypatch):
    """Workers live on in a pipeline, so what a task has learnt goes with it."""
    import pyarrow as pa

    class Taken:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(bpe.common, "keyed", lambda *a: Taken())
    run = bpe.encode_documents(docs)
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": ["one two three", "four  five\t"]})
    assert sum(x.num_rows for x in run(iter([rows]))) == 2
    chunks = bpe.codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN).chunks
    assert not chunks.words and not chunks.chunks


def test_words_of_letters_equal_the_library():
    import tokenizers

    path = public_tokenizers.path(token_files.VOCABULARY)
    lib = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(6)
    some = ["the", "Reonen", " a", " b", ", ", ". ", "\n", "é", "  ", "12", "'s", "$$$", "\t", "\u3000", "\x1e", "<|endoftext|>"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(12))) for _ in range(3000)] + ["a" * 5000, " " + "Ab" * 400, "'re", "s"]
    encoder = token_files.encoder(path)
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.whole(texts) == want and encoder.encode(texts) == want


def test_token_files(spark, docs):
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    manifest = token_files.write_token_files(docs, shared_dir(spark, "t"), file_tokens=1000)
    got = sorted(((r.doc_id is not None, r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, manifest).collect()), key=lambda r: r[2])
    assert [r[1] for r in got] == sorted((r[1] for r in got), key=lambda k: (k is not None, k or 0))
    start = 0
    for _, _, s, n, _ in got:
        assert s == start
        start += n
    want = Counter()
    for r in docs.collect():
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((k, n, c) for _, k, _, n, c in got) == want
    assert token_files.write_token_files(empty(docs), shared_dir(spark, "t")).count() == 0


def test_codes_are_directly_addressable():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 300, 3000), rng.integers(0, 2**32, 500, dtype=np.uint64), [0, 255, 256, 2**32 - 1]]).astype(np.uint32)
    ends = np.array([0, 10, 2000, len(ids)])
    f = token_files.TokenFile(token_files.pack([5, None, 7, 8], ends, ids))
    assert [f.token(i) for i in range(0, len(ids), 37)] == ids[::37].tolist()
    assert (f.read(13, 3100) == ids[13:3100]).all() and len(f.document(0)) == 0 and (f.document(3) == ids[2000:]).all()
    assert f.keys == [5, None, 7, 8]


def brute_components(prints: dict) -> dict:
    keys = sorted(prints, key=lambda k: (k is None, k or 0))
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)), key=lambda k: (k is None, k or 0))
                root[y] = x
    return {k: find(k) for k in keys}


def test_golay_code():
    words = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    index = simhash.nearest(words)
    low, high, errors = simhash._golay()
    code = words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]
    assert (np.bitwise_count(code ^ words) <= 3).all() and (low[code & 0xFFF] == high[code >> 12]).all() and (index == code >> 11).all()
    other = words.copy()
    for k in np.random.default_rng(1).integers(0, 23, (2, 2000)):
        other ^= 1 << k
    for a, b in zip(words[:300], other[:300], strict=True):
        assert set(simhash.fuzzy_keys(np.array([a]))[1].tolist()) & set(simhash.fuzzy_keys(np.array([b]))[1].tolist())


def test_fingerprint():
    for t in TEXTS[:10] + ["A b c d e f"]:
        w = WORDS.findall((t or "").translate(LOWER))
        shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(t or "") == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("pairwise", [0, 12])
def test_links_join_all_near_fingerprints(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(4)
    prints = {}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4)))
            prints[len(prints)] = centre
    signed = sorted({p - (1 << 64 if p >> 63 else 0) for p in prints.values()})
    found = components.connected_components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")))
    got = {r.node: r.component for r in found.collect()}
    want = brute_components(prints)
    parts = {}
    for k, p in prints.items():
        s = p - (1 << 64 if p >> 63 else 0)
        parts.setdefault(want[k], set()).add(got.get(s, s))
    assert all(len(v) == 1 for v in parts.values()) and len(parts) == len({next(iter(v)) for v in parts.values()})


def test_near_duplicates(docs):
    got = simhash.near_duplicates(docs).collect()
    prints = {r.doc_id: r.fp % (1 << 64) for r in got}
    want = brute_components(prints)
    assert len(got) == docs.count() and all(r.component_id == want[r.doc_id] for r in got if want[r.doc_id] is not None)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(want.values()))
    assert simhash.near_duplicates(empty(docs)).count() == 0 and simhash.keep_first(empty(docs)).count() == 0


def test_similar_texts_against_brute_force(spark, monkeypatch):
    """Chains and clouds of near copies, texts around a shared passage, and the cases of TEXTS."""
    monkeypatch.setattr(similar, "PAIRS_A_ROW", 3)
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    texts = list(TEXTS)
    base, passage, chain = text(150), text(80), text(120)
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(150)] = rng.choice(words)
        texts += [" ".join(copy), " ".join(text(30) + passage + text(30))]
    for k in range(12):
        chain = chain[6:] + text(6)
        texts.append("  ".join(chain).title() if k % 2 else " ".join(chain))
    rng.shuffle(texts)
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, item string, c string")
    sets = [similar.shingle_set(t or "") for t in texts]
    prints = [simhash.fingerprint(t or "") for t in texts]
    plain = [set(zip(*(w[k:] for k in range(5)), strict=False)) or {tuple(w)} - {()} for w in (WORDS.findall((t or "").translate(LOWER)) for t in texts)]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(plain[a] & plain[b])
            if (prints[a] ^ prints[b]).bit_count() <= 2 or both and both >= 0.8 * (len(plain[a]) + len(plain[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


@pytest.mark.parametrize("small", [0, 100_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL_GRAPH", small)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (100, 100), (200, 7)] + [(300, k) for k in range(301, 330)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect()}
    assert {got[k] for k in [*range(41), 200]} == {0} and got[101] == 100 and {got[k] for k in range(300, 330)} == {300} and len(got) == 74


ITEM = "Anna bought 3 apples for 5 dollars at the old market near the river, and then Anna walked home with her brother."


def test_decontamination(spark):
    other = ITEM.replace("Anna", "Maria").replace("3", "17").replace("5 dollars", "9 euros")
    mixed = ITEM.replace("then Anna", "then Otto")
    benchmark = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8 9"), (9, ITEM)], "item_id long, text string")
    rows = [(1, "Before. " + ITEM + " After."), (2, "Some words. " + other), (3, None), (4, ""), (5, "a clean text about the old market near the river"), (6, "Here. " + mixed + " More."), (None, ITEM.lower()), (8, "1 2 3 4 5 6 7 8 9"), (1, "Before. " + ITEM + " After."), (10, " ".join(ITEM.split()[:8]))]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, item long, h int")
    for bound in (decontaminate.IN_SCAN, 3):
        got = {r.doc_id: (r.item, r.changed) for r in decontaminate.matches(df, benchmark, in_scan=bound).collect()}
        assert got[1] == (1, False) and got[2] == (1, True) and got[8] == (5, False) and not set(got) & {3, 4, 5, 10}
    kept = decontaminate.keep_clean(df, benchmark)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {3, 4, 5, 10} and not {1, 2, 8} & {r.doc_id for r in kept.collect()}
    assert decontaminate.contamination(df, benchmark.where("false")).count() == 0 and decontaminate.contamination(empty(df), benchmark).count() == 0


def test_copies_in_other_case_or_lines_are_found(spark):
    """Also copies whose names don't look like names, items heavy with numbers, and short items."""
    item = "One day Anna and Otto took the old road from Bremen to Hamburg, where Maria sold 3 maps of the whole coast to Karl and his friends."
    heavy = "Set 1 2 3 4 5 6 then add 7 8 9 10 11 12 once"
    benchmark = spark.createDataFrame([(1, item), (2, heavy), (3, "Blue whales sing"), (4, "Maps"), (5, "1 2 3 4 5 6 7"), (6, item.replace("Anna", "Ida").replace("Otto", "Jan").replace("Bremen", "Rome").replace("Maria", "Zoe"))], "item_id long, text string")
    texts = [item.lower(), item.upper(), item.title(), item.replace(" ", "\n"), item.replace(" ", "  "), "x " + heavy + " y", "Do BLUE whales\nsing?", "maps", "1 2 3 4 5 6 7", "blue whales can sing of maps", " ".join(item.lower().split()[:14])]
    texts.append(item.replace("Anna", "Ida").replace("Otto", "Jan").replace("Bremen", "Rome").replace("Maria", "Zoe").upper())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bound in (decontaminate.IN_SCAN, 3):
        got = {(r.doc_id, r.item, r.changed) for r in decontaminate.matches(df, benchmark, in_scan=bound).collect()}
        assert got == {*((k, 1, False) for k in range(5)), (5, 2, False), (6, 3, False), (7, 4, False), (8, 5, False), (11, 1, False)}


def test_items_of_other_scripts_and_of_numbers(spark):
    """Unspaced scripts, formulas and rows of numbers, with what must stay clean beside them."""
    items = ["东京是日本的首都吗", "2 + 2 = 4", "首都", "42", "3, 5, 7, 11", "何時に起きますか", "???", "7 * 8"]
    texts = ["他问:东京是日本的首都吗?", "We know that 2+2 = 4, surely.", "日本的首都", "there are 42 of them", "the primes 3, 5, 7, 11 and so on", "首都", "42", "What ???", "12 + 2 = 4 is wrong", "大阪是日本的城市", "明日は何時に起きますか。", "7*8", "3, 5, 7, 11, 13", "2 2 4", "7 * 8 = 56"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bound in (decontaminate.IN_SCAN, 3):
        got = {(r.doc_id, r.item) for r in decontaminate.matches(df, benchmark, in_scan=bound).collect()}
        assert got == {(0, 0), (1, 1), (4, 4), (5, 2), (6, 3), (10, 5), (11, 7)}


def test_names_at_beginnings_are_slots(spark):
    item = "Alice has 30 apples and gives 12 of them to the old man, so how many does Alice have left?"
    twice = "Nobody knew. " + item + " Alice went home after that and slept until noon on the next day."
    carol = item.replace("Alice", "Carol").replace("30", "50")
    texts = [carol, carol.replace("does Carol", "does Erin"), item, "They say Carol" + carol[5:], "x. " + carol, item.lower(), twice.replace("Alice", "Carol"), twice.replace("Alice went", "Bob went").replace("Alice has", "Carol has").replace("does Alice", "does Erin")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bound in (decontaminate.IN_SCAN, 3):
        for text, want in ((item, {(0, True), (2, False), (3, True), (4, True), (5, False), (6, True)}), (twice, {(6, True)})):
            benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
            assert {(r.doc_id, r.changed) for r in decontaminate.matches(df, benchmark, in_scan=bound).collect()} == want
    other = spark.createDataFrame([(1, "What is the capital of Spain")], "item_id long, text string")
    asked = spark.createDataFrame([(1, "Where is the capital of Spain"), (2, "What is the capital of Spain")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.matches(asked, other).collect()] == [2]


def test_slots_must_be_consistent(spark):
    item = "Anna has 3 pens. " * 4
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = spark.createDataFrame([(1, item.replace("3", "8")), (2, "Anna has 3 pens. Anna has 4 pens. Anna has 5 pens. Anna has 6 pens. ")], "doc_id long, text string")
    assert [(r.doc_id, r.changed) for r in decontaminate.matches(df, benchmark).collect()] == [(1, True)]


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello World\n\nHow are you?"), (1, 1, "a", "> hello   world\nFine."), (1, 2, "user", "> > hello world\n> Fine.\n\nGood\n>"), (1, 3, "a", "> Good\nbye"), (2, 0, "user", ">Good\nother"), (2, 1, "a", "no > quotes"),
        (None, 1, "a", "> Good"), (3, None, "x", None), (4, 0, "user", "> nothing like it\n>> deeper\n> again"),
    ]
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, depth int")).collect()}
    assert len(got) == len(rows)
    links = {k: (r.parent_conv, r.parent_turn, r.root_conv, r.root_turn, r.depth) for k, r in got.items() if r.parent_turn is not None}
    assert links == {(1, 1): (1, 0, 1, 0, 1), (1, 2): (1, 1, 1, 0, 2), (1, 3): (1, 2, 1, 0, 3), (2, 0): (1, 2, 1, 0, 3)}
    assert got[(1, 2)].text == "Good" and got[(1, 2)].max_level == 2 and got[(4, 0)].n_quotes == 3 and got[(4, 0)].text == "" and got[(3, None)].text == ""
    assert quote_links.link_quotes(empty(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).count() == 0


def test_quotes_of_parts(spark):
    """Paragraphs, lines and sentences of a longer message, also with others left out or lines broken anew."""
    long = "Alpha one two.\n\nBeta three four.\nBeta five six.\nBeta seven.\n\nGamma says this. Then it says more of it here. End.\n\nDelta nine."
    quotes = [
        "> Beta three four.\n> Beta five six.\n> Beta seven.\n>\n> Gamma says this. Then it says more of it here. End.", "> beta three four.\n> Beta five six.", "> Then it says\n> more of it here.", "> Alpha one two.\n>\n> Delta nine.",
        "> Beta three four.\n> Beta seven.", "> Gamma says that.", "> eta three four.",
    ]
    rows = [(1, 0, "user", long)] + [(1, k + 1, "a", q + "\nOwn words number " + "x" * k) for k, q in enumerate(quotes)] + [(2, 0, "a", "> says more of it here."), (2, 1, "a", "> says more")]
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k for k, r in got.items() if r.n_linked == 1 and (r.parent_conv, r.parent_turn, r.depth) == (1, 0, 1)} == {*((1, k) for k in range(1, 6)), (2, 0)}
    assert all(got[k].n_linked == 0 and got[k].parent_turn is None and got[k].n_quotes == 1 for k in ((1, 6), (1, 7), (2, 1)))


def test_url_rules_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://A.Example.com/en/7?x#y", None), (2, "http://example.com/en/6", ""), (3, "x", None), (4, None, None), (5, "https://free.info/a", link.format("http://bad.net/de/1")), (6, "http://bad.net/de/1", ""),
        (7, "http://free.info/b#top", '<META HTTP-EQUIV="refresh" content="0; URL=/a">'), (8, "http://one.info/", link.format("http://example.com/en/70&amp;q")), (9, "http://one.info", link.format("//bad.net/de/1")), (10, "http://xcom/en/", ""), (1, "http://a.example.com/en/7", None),
    ]
    got = {}
    for r in url_filter.judge_urls(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")).collect():
        got.setdefault(r.page_id, r)
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[2].verdict == "block" and got[2].rule == "com/en/" and (got[3].host, got[3].path, got[3].verdict) == ("", "", "allow") and got[4].verdict == "allow"
    assert [got[k].component for k in (5, 6, 7, 8, 9)] == ["bad.net/de/1"] * 5 or len({got[k].component for k in (5, 6, 7, 8, 9)}) == 1
    assert [got[k].verdict for k in (5, 6, 7, 8)] == ["allow", "block", "allow", "allow"] and got[10].rule is None
    # without the allowed alias the block reaches all of them
    few = spark.createDataFrame([r for r in rows if r[0] != 8], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(few).where("page_id IN (5, 7, 9)").collect()} == {5: "block", 7: "block", 9: "block"}
    assert url_filter.judge_urls(few.where("false")).count() == 0


def test_url_query_follows_its_contract(spark, tmp_path):
    urls = ["http://a.net/de/1", "http://net/de/", "http://example.net/de/7", "http://b.example.net/de/80", "http://b.example.net/en/8", "http://example.com/en/71", "http://example.com/en/6", "http://x.org/es/", "http://free.info/", "x", None]
    canonical = {8: '<link rel="canonical" href="http://a.net/de/1">', 10: ""}
    spark.createDataFrame([(k, u, canonical.get(k)) for k, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in llm_queries.op8_url_filter(spark, str(tmp_path)).collect()}
    assert got == {
        0: ("net/de/", "allow"), 1: ("net/de/", "allow"), 2: ("net/de/", "allow"), 3: ("example.net/de/8", "block"), 4: (None, "allow"), 5: ("example.com/en/7", "allow"),
        6: ("com/en/", "block"), 7: ("org/es/", "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"),
    }


def test_warc(spark):
    big, small = "<p>é" + "x" * 200, "tiny"
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, small), (4, "http://a/3", small), (5, "u v", None), (6, "x", ""), (None, "n", big), (1, "http://a/2", big), (7, "http://é/", "y" * 99)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    manifest = warc.write_archives(df, shared_dir(spark, "w"), archive_bytes=300)
    got = Counter(tuple(r) for r in warc.read_archives(spark, manifest).collect())
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 100 and i != 1
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None)] += 1
    assert got == want
    assert warc.write_archives(df.where("false"), shared_dir(spark, "w")).count() == 0


def test_normaliser():
    parts = [warc.record(k, "http://x", "response", b"a" * k * 1000, "d", k * 1000, None) for k in range(5)]
    whole = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = whole.compress(b"".join(parts)) + whole.flush()
    out = io.BytesIO()
    index = warc.normalise(io.BytesIO(data), out)
    assert [warc.read_member(out.getvalue()[o : o + n])[1] for o, n, _ in index] == [b"a" * k * 1000 for k in range(5)]
    assert warc.read_index(warc.index_bytes(index)) == index and b"".join(warc.records(warc.inflated(io.BytesIO(out.getvalue())))) == b"".join(parts)
    assert warc.normalise(io.BytesIO(b""), io.BytesIO()) == []
    with pytest.raises(ValueError):
        warc.normalise(io.BytesIO(zlib.compress(parts[1][:-10], wbits=31)), io.BytesIO())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="ad">Buy {0}</div><article><h1>Title {0} &amp;</h1><p><b>First{0}<br>line<p>Second &lt;x&gt; &copy &nbsp; end</p><div class="share">Share</div><ul><li>one<li>two</ul><section id="comments"><p>Comment {0}</p></section></article><aside>Side</aside><footer>&copy; F</footer></body></html>"""


def test_html(spark):
    rows = [(k, f"http://h/{k}", PAGE.format(k)) for k in range(6)] + [(10, None, None), (11, "http://one/", ""), (12, "http://plain/", "<div><p>a  b</p>c</div><div class='footer'>no</div>"), (13, "http://cut/", "<article><p>cut of"), (0, "http://h/0", PAGE.format(0))]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[3] == "Title 3 &\nFirst3 line\nSecond <x> © end\none\ntwo"
    assert texts[10] == texts[11] == "" and texts[12] == "a b\nc" and texts[13] == "cut of" and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_pages(df.where("false")).count() == 0


def test_html_slot_without_article(spark):
    page = "<html><body><div id='top'><a href='/'>Home</a></div><div id='main0'><div class='text'><p>{}</p></div></div><div id='end'>all rights</div></body></html>"
    df = spark.createDataFrame([(k, f"http://h/{k}", page.format(f"long text number {k} " * 20)) for k in range(4)], "page_id long, url string, html string")
    assert all(r.text == ("long text number %d " % r.page_id * 20).strip() for r in html_extract.extract_pages(df).collect())


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    good = [text(rng.randrange(60, 200)) for _ in range(40)]
    item = text(30)
    rows = [(k, t) for k, t in enumerate(good)] + [(100, good[3]), (101, good[3]), (102, "too short"), (103, "same words here " * 40), (104, good[5] + " " + item + " " + text(60)), (105, None)]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(30)] + [(103, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in rows if k < 40}


def test_very_long_texts(spark):
    """No expression may take stack or time that grows with more than the text's length."""
    n = 60_000
    texts = ["1,1." * n, ">" * 200 + " x\n" + "> q\n" * n, "a://" + "b" * n, "b" * n, "-.," * n, "word " * n, "Ab " * n, "<p " + 'a="' * n, "(" * n]
    df = spark.createDataFrame([(k, k, "user", t, "http://h/" + t[:9000], t) for k, t in enumerate(texts)], "doc_id long, turn long, role string, text string, url string, html string")
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contamination(df, benchmark).count() == 0
    assert quote_links.link_quotes(df.withColumnRenamed("doc_id", "conv_id")).count() == len(texts)
    longer = df.withColumn("url", F.col("text"))
    assert url_filter.judge_urls(longer, "doc_id").count() == len(texts)
    assert html_extract.extract_pages(df, "doc_id").count() == len(texts)
    assert license_scan.license_scan(df).count() == len(texts) and simhash.near_duplicates(df).count() == len(texts) and bpe.encode_documents(df).count() == len(texts)


def test_other_nouns_are_other_sentences(spark):
    items = ["Wer hat die Relativitätstheorie im Jahr 1905 veröffentlicht und wo?", "Der Hund frisst den Knochen im Garten von Herrn Maier", "What is photosynthesis exactly?", ITEM]
    texts = ["Wer hat die Katze im Haus 77 veröffentlicht und wo?", "Der Baum frisst den Vogel im Wasser von Frau Schmidt", "He asked: What is photosynthesis exactly? Nobody knew.", items[0], "x " + items[1].upper(), ITEM.replace("Anna", "Maria"), items[0].replace("1905", "1955")]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, __doc int, __mark int")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item, r.changed) for r in decontaminate.matches(df, benchmark).collect()}
    assert got == {(2, 2, False), (3, 0, False), (4, 1, False), (5, 3, True), (6, 0, True)}
    kept = decontaminate.keep_clean(df, benchmark)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {0, 1}


def test_license_identifiers_are_whole():
    assert license_scan.scan("SPDX-License-Identifier: mitigated")[5:9] == ("unknown", license_scan.scan("SPDX-License-Identifier: mitigated")[6], ["mitigated"], False)
    for name, label in (("MIT", "mit"), ("GPL-2.0-or-later", "gpl"), ("LGPL-2.1+", "lgpl"), ("BSD-3-Clause", "bsd"), ("CC-BY-SA-4.0", "cc-by"), ("0BSD", "bsd"), ("LicenseRef-own", "proprietary"), ("isclose", "unknown"), ("Apache-2.0", "apache")):
        assert license_scan.family(name)[0] == label
    got = license_scan.scan("Straße é SPDX-License-Identifier:MIT OR Apache-2.0\r\n# spdx-LICENSE-identifier : (GPL-3.0 AND ISC)\nSPDX-License-Identifier MIT")
    assert got[7] == ["MIT Apache-2.0 or", "GPL-3.0 ISC and"] and got[8] is False


def test_license_scan_is_linear():
    import time

    began = time.monotonic()
    got = license_scan.scan("cc by " * 800_000)
    assert got[:4] == (1_600_000, 800_000, 0, 1_599_998) and time.monotonic() - began < 30


@pytest.mark.parametrize("seed", range(3))
def test_license_places_against_brute_force(seed):
    rng = random.Random(seed)
    pieces = [w for p in license_scan.BASE for w in p.split()] + ["MIT", "License", "x", "Ä", "cc-by", "apache\nLicense", ",", "  "]
    for _ in range(200):
        text = rng.choice([" ", "\t", "-"]).join(rng.choice(pieces) for _ in range(rng.randrange(30)))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        at = sorted((k, label) for p, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        got = license_scan.scan(text)
        assert got[:5] == (len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))


def test_special_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_files.VOCABULARY)
    library = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "x  <|endoftext|>\n\n y", "<|endoftext|><|endoftext|>", "<|endoftext", "a<|endoftext|>b, c"]
    assert [np.frombuffer(x, "<u4").tolist() for x in token_files.encoder(path).encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def brute_templates(rows):
    """Slot and own words per host from whole lists of vectors instead of their hashes. rows: (page, host, html)."""
    hosts: dict = {}
    for page, host, text in rows:
        hosts.setdefault(host, []).append((page, text))
    out = {}
    for host, pages in hosts.items():
        vectors, held, total = {}, Counter(), 0
        for page, text in pages:
            opened, sizes, runs, known = html_extract.tokens(text)
            total += sizes[""]
            for key, n, size in [*(((p, None), n, sizes[p]) for p, n in opened.items()), *(((known[r][0], r), n, n * known[r][1]) for r, n in runs.items())]:
                vectors.setdefault(key, []).append((page, n))
                held[key] += size
        every = sorted((page, 1) for page, _ in pages)
        template = [(*key, sorted(v) == every, held[key]) for key, v in vectors.items() if len(v) >= html_extract.SUPPORT * len(pages)]
        out[host] = html_extract.article_of(template, total, len(pages))
    return out


def test_html_templates_against_brute_force(spark):
    """Pages without articles; repeated rows change nothing; the template's own words, other headers and deep nests."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for host in ("a", "b", "c"):
        for k in range(5):
            body = "".join(f"<p>{' '.join(word() for _ in range(20))}</p>" for _ in range(rng.randrange(1, 6)))
            rows.append((f"http://{host}/{k}", f"<div class='top'><b>{host} site</b></div><div class='wrap'><div class='story'>{body}</div><div class='legal'>All rights reserved by {host}</div></div><ul>{'<li>x</li>' * k}</ul>"))
    for k in range(4):
        rows.append((f"http://flat/{k}", f"<body>Own {word()} {word()} {word()} here<div>Read on at flat</div></body>"))
        rows.append((f"http://header/{k}", f"<header>Site header</header><p>short {k}</p>"))
        rows.append((f"http://deep/{k}", "<div>" * 40 + f"<div class='menu{'x' * 50}'>m</div><section>{' '.join(word() for _ in range(30))}</section>" + "</div>" * 40))
    for copies in (1, 2):
        df = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(rows)] * copies, "page_id long, url string, html string")
        got = html_extract.extract_pages(df).collect()
        want = brute_templates([(k, u.split("/")[2], h) for k, (u, h) in enumerate(rows)])
        assert len(got) == len(rows) * copies
        for r in got:
            host = r.url.split("/")[2]
            assert r.text == html_extract.main_text(rows[r.page_id][1], *want[host])
            if host in "abc":
                assert "rights" not in r.text and "site" not in r.text and r.text.count("\n") == rows[r.page_id][1].count("<p>") - 1
            if host == "flat":
                assert r.text.startswith("Own") and "Read" not in r.text
            if host == "header":
                assert r.text == f"short {r.url[-1]}"
            if host == "deep":
                assert len(r.text.split()) == 30


def test_html_walk_is_linear():
    import time

    began = time.monotonic()
    for text in ("<div>" * 60_000 + "x" + "</div>" * 60_000, "<i>" * 60_000 + "<p>" * 60_000 + "x", "<ul><li>" * 30_000 + "x"):
        assert html_extract.main_text(text, None) == "x"
    assert time.monotonic() - began < 60


def test_quote_marks(spark):
    """Other line separators, very many marks, carriage returns and marks with blanks."""
    rows = [(1, 0, "u", "Alpha beta gamma delta epsilon"), (1, 1, "u", "> Alpha beta\u2028gamma delta epsilon\nOwn"), (1, 2, "u", "> " * 200 + "deep\r\n>\t>one\rafter > this"), (1, 3, "u", "a > b\n  >> Own")]
    got = {r.turn: r for r in quote_links.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].text == "Own" and got[1].n_quotes == 1 and got[2].max_level == 200 and got[2].n_quotes == 2 and got[2].text == "after > this"
    assert got[3].text == "a > b" and got[3].max_level == 2 and got[3].n_linked == 1


def test_quotes_of_few_words_attributions_and_elisions(spark):
    rows = [
        (1, 0, "u", "thanks"), (2, 0, "u", "thanks"), (3, 0, "u", "> thanks\nHm"), (4, 0, "u", "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."),
        (4, 1, "a", "On Monday Bob wrote:\n> Alpha beta gamma [...] kappa lambda mu.\n\nYes"), (4, 2, "u", "Am 3. Mai schrieb Eva:\n> On Monday Bob wrote:\n>> Alpha beta gamma delta\n> Yes\nOn the way I wrote:\nnothing"),
        (4, 3, "a", "> Alpha beta [...] omega"), (5, 0, "u", "> Alpha beta gamma delta epsilon […] theta iota kappa lambda mu."),
    ]
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[(3, 0)].n_quotes == 1 and got[(3, 0)].n_linked == 0 and got[(4, 3)].n_linked == 0
    assert got[(4, 1)].text == "Yes" and (got[(4, 1)].parent_conv, got[(4, 1)].parent_turn) == (4, 0)
    assert got[(4, 2)].text == "On the way I wrote:\nnothing" and got[(4, 2)].n_quotes == got[(4, 2)].n_linked == 2 and got[(4, 2)].parent_turn == 1
    assert (got[(5, 0)].parent_conv, got[(5, 0)].parent_turn) == (4, 0)


@pytest.mark.parametrize("name", ["article", "main", "div"])
def test_html_template_within_articles(spark, name):
    """Words of the template go inside articles too; so do comments, footers and adverts, whatever stands beside these words, and no article on social science."""
    page = f"<html><body><div class='site-menu'>Menu</div><{name} id='a'><h1>Story {{0}}</h1><p>{{1}}</p><div class='social-science'>An essay {{0}}</div><div class='related-work'>Work {{0}}</div><p>Read more from our partners site</p>"
    page += f"<div class='post-comments'>Comment {{0}}</div><div class='article-footer'>Foot {{0}}</div><div class='content-ads'>Buy {{0}}</div><div class='related-story'>Other {{0}}</div></{name}></body></html>"
    words = lambda k: " ".join(f"w{k}x{n}" for n in range(60))
    df = spark.createDataFrame([(k, f"http://h/{k}", page.format(k, words(k))) for k in range(5)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}
    assert got == {k: f"Story {k}\n{words(k)}\nAn essay {k}\nWork {k}" for k in range(5)}


def test_html_marks():
    apart = "comments post-comments comment12 article-footer content-ads related-story share-buttons sidebar sidebar-wrap widget search-box".split()
    kept = "social-science related-work has-sidebar no-comments content-sidebar-wrap main-content entry story-body blog-widget advanced shared-values".split()
    assert all(map(html_extract.marks_apart, apart)) and not any(map(html_extract.marks_apart, kept))
