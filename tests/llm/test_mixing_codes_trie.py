"""Mixing, vector codes and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberlog.llm import common, mixing, prefix, prefix_trie, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left, rest = total - sum(most * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        share = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        over = {s for s in names if share[s] > most * sizes[s]}
        if not over:
            return share
        full |= over


def test_ranks_and_sums(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(10**9)}-{i}", rng.randrange(-5, 100)) for i in range(3000)]
    got = {r.k: (r.pos, r.sum_v) for r in prefix.ranked(spark.createDataFrame(rows, "k string, v long").repartition(7), ["k"], ("v",)).collect()}
    want, total = {}, 0
    for i, (k, v) in enumerate(sorted(rows)):
        total += v
        want[k] = (i, total)
    assert got == want
    assert prefix.ranked(spark.createDataFrame([], "k string, v long"), ["k"], ("v",)).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_fit_is_as_near_as_any_choice(seed):
    """With few documents every subset is tried: none that keeps the shares is nearer."""
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 40), rng.randrange(1, 6)))
    counts = [rng.randrange(1, 4) for _ in lengths]
    total = sum(a * b for a, b in zip(lengths, counts, strict=True))
    budget = rng.uniform(0, total)
    got = mixing.fit(np.array(lengths), np.array(counts), budget)
    assert all(0 <= g <= c for g, c in zip(got, counts, strict=True))
    shares = [math.floor(c * budget / total) for c in counts]
    best = min(abs(sum(a * b for a, b in zip(lengths, take, strict=True)) - budget) for take in itertools.product(*[range(s, c + 1) for s, c in zip(shares, counts, strict=True)]))
    assert abs(float((got * lengths).sum()) - budget) == pytest.approx(best)


def test_fit_of_large_and_lone_lengths():
    lengths, counts = np.array([10, 1_000_000]), np.array([100_000, 1])
    assert int((mixing.fit(lengths, counts, 1_000_003.0) * lengths).sum()) == 1_000_000
    assert mixing.fit(np.array([1_000_000]), np.array([1]), 600_000.0).tolist() == [1]
    assert mixing.fit(np.array([1_000_000]), np.array([1]), 400_000.0).tolist() == [0]
    assert mixing.fit(np.array([3]), np.array([4]), 12.0).tolist() == [4]
    rng = np.random.default_rng(1)
    lengths, counts = np.arange(1, 3000), rng.integers(1, 50, 2999)
    for share in (0.1, 0.5, 0.93):
        budget = share * float((lengths * counts).sum())
        assert abs(float((mixing.fit(lengths, counts, budget) * lengths).sum()) - budget) <= 0.5


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["a", "b", "b", "b", "b", "é", "Z", None]), "en", 1, "x") for i in range(600)]
    rows += [(None, "x y", "a", "en", 1, "x")] * 3 + [(7, None, None, "en", 1, "x"), (8, "", "", "en", 1, "x"), (9, "w " * 40000, "long", "en", 1, "x"), (9, "only one", "tiny", "en", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string, size int, taken string")
    got = mixing.mix(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = brute_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == Counter((r[0], size(r[1]), sizes[r[2]], round(want[r[2]], 6)) for r in rows)
    assert all(r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size for r in got)
    taken = Counter()
    for r in got:
        taken[round(r.target, 6)] += r.taken
    for s in ("a", "b", "é", "Z", None):
        assert abs(taken[round(want[s], 6)] - want[s]) <= 0.5
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(df.where("false")).count() == 0
    assert [r.taken for r in mixing.mix(df.where("size(split(text, ' ')) < 0 OR text = ''")).collect()] == [0] * sum(1 for r in rows if r[1] == "")


def test_mixing_of_one_length(spark):
    """Many documents of one source and length are ordered in parts."""
    rows = [(i, "a b c", "s") for i in range(9000)] + [(i, "a", "t") for i in range(20000, 30000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes = {"s": 27000, "t": 10000}
    want = brute_targets(sizes)
    assert abs(sum(r.taken for r in got if r.size == 3) - want["s"]) <= 1.5 and abs(sum(r.taken for r in got if r.size == 1) - want["t"]) <= 0.5


def brute_codes(rows):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    w = len(kept[0][1]) // 8
    part = lambda v, p: v[p * w : p * w + w]
    books = [[part(v, p) for _, v, _ in first] for p in range(8)]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def codes():
        return [[min((d2(part(v, p), e), k) for k, e in enumerate(books[p])) for p in range(8)] for _, v, _ in kept]

    for _ in range(6):
        found = codes()
        for p in range(8):
            for k in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), c in zip(kept, found, strict=True) if c[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), label) for (i, _, label), c in zip(kept, codes(), strict=True)]
    total = Counter()
    for _, _, e, label in out:
        total[label] += e
    return Counter((i, code, e, total[label], digest) for i, code, e, label in out)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


@pytest.mark.parametrize("n", [1, 5, 300])
def test_vector_codes(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i if i != 11 else None, rng.normal(0, 0.3, 16).astype(np.float32).tolist(), int(rng.integers(0, 4)) if i % 7 else None, "x", "y") for i in range(n)]
    rows += [(2, rows[0][1], 1, "x", "y"), (0, rows[0][1], 1, "x", "y"), (900, None, 1, "x", "y"), (901, [None] + [0.0] * 15, 1, "x", "y"), (902, [float("nan")] * 16, 1, "x", "y"), (903, [float("inf")] + [0.0] * 15, 2, "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df.repartition(3)).collect())
    assert got == brute_codes([r[:3] for r in rows])
    assert vector_codes.compress(df.where("false")).count() == 0
    assert vector_codes.compress(df.where("embedding IS NULL")).count() == 0


def test_vectors_of_other_lengths(spark):
    rows = [(1, [0.5] * 3, 1, "", ""), (2, [], 1, "", ""), (3, [0.25] * 9, None, "", ""), (4, [1e30] * 9, 2, "", "")]
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3, 4] and all(len(r.code) == 16 and r.error == 0 for r in got)


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 20])
def test_trees_find_the_least_index_of_the_nearest(spread):
    rng = np.random.default_rng(spread)
    book = rng.integers(-spread, spread + 1, (16, 8))
    x = np.concatenate([rng.integers(-spread, spread + 1, (500, 8)), book])
    d = ((x[:, None] - book) ** 2).sum(2)
    index, best = vector_codes.nearest(vector_codes.plant(book), x)
    assert (best == d.min(1)).all() and (index == d.argmin(1)).all()


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(c - c % 100, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = Counter()
    for node, m in members.items():
        inside = [x for x in members if x[: len(node)] == node]
        ended = sorted(c for c in m if len(made[c]) == len(node))
        out[
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), sum(not children[x] for x in inside),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in inside if x), hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest(),
        ] += 1
    return out


def tried(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, d int")
    found = prefix_trie.prefix_trie(*prefix_trie.rebuilt(common.checkpoint(prefix_trie.turns_of(df))))
    return found.drop("first", "last").collect(), found


@pytest.mark.parametrize("segment", [64, 2])
def test_prefix_trie(spark, segment, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rng = random.Random(segment)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 230), -3]:
        n = rng.randrange(1, 9)
        same = rng.random() < 0.5
        rows += [(c, t if t else None, rng.choice(["user", None]) if not same else "user", rng.choice(["a", "b", "é😀", None, ""]) if not same else "q") for t in range(n)]
    rows += [(300, t, "user", f"long {t % 3}") for t in range(300)] + [(301, t, "user", f"long {t % 3}") for t in range(299)] + [(None, 1, "user", "nobody")]
    got, found = tried(spark, rows)
    assert Counter(map(tuple, got)) == brute_trie(rows)
    places = found.select("depth", "first", "last").collect()
    assert sorted(r.first for r in places) == list(range(len(places))) and all(r.first <= r.last for r in places)
    assert tried(spark, [])[0] == []


def test_trie_of_copies_and_turnless_conversations(spark):
    rows = [(c, 1, "user", "same") for c in range(3000)] + [(5000, None, None, None)]
    got, _ = tried(spark, rows)
    assert Counter(map(tuple, got)) == brute_trie(rows)
