"""Links between texts with similar word shingles: min-hash bands give candidates, bits of min-hashes sift them, exact comparison decides."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.components import connected_components

#: Bands and min-hashes a band. Texts at a similarity of 0.8 share a band with a probability of 0.9996, closer ones with more.
BANDS, ROWS = 20, 5
#: Buckets with up to so many pairs of different classes a row are compared pair by pair where one comparison with their leader isn't enough; members of others get bands of more min-hashes.
PAIRS_A_ROW = 64
#: Min-hashes that a deeper level adds to a band, and the probability that a pair may miss all bands of a deeper level.
DEEPER, MISSED = 5, 0.002
#: Min-hashes of level 0 and of deeper levels whose last two bits stand in the marks that sift pairs.
MARKS = (256, 512)
#: Standard errors by which the marks' estimate may fall short of the similarity before a pair goes unverified (2 of 10,000 pairs just at it).
ERRORS = 3.5
#: Tables of up to so many keys (some 40 bytes each) are sent to all executors; larger ones are joined by a shuffle.
SMALL_TABLE = 200_000
#: Shingles whose min-hashes are computed at a time, so that very long texts take no more memory.
CHUNK = 2048
PRIME = np.uint64(0x9E3779B185EBCA87)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text: str, shingle: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles, A-Z lower-cased; fewer words: the whole sequence; none: no hashes."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = np.array([digest(w, 42) for w in text.encode("utf-8", "surrogatepass").translate(LOWER).split()], np.uint64)
    if not len(words):
        return words
    wide = min(shingle, len(words))
    found = np.full(len(words) - wide + 1, wide, np.uint64)
    for k in range(wide):
        found = (found ^ words[k : k + len(found)]) * PRIME
        found ^= found >> np.uint64(29)
    return np.unique(found)


@lru_cache(maxsize=16)
def _factors(level: int, n: int) -> np.ndarray:
    return np.random.default_rng([42, level]).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(hashes: np.ndarray, level: int, n: int) -> np.ndarray:
    """n min-hashes of a set that isn't empty; each level has its own."""
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, n, 512):  # bounds memory where a level has very many
        factors = _factors(level, n)[at : at + 512]
        for k in range(0, len(hashes), CHUNK):
            least[at : at + 512] = np.minimum(least[at : at + 512], (hashes[k : k + CHUNK, None] * factors).min(axis=0))
    return least


def sketch(hashes: np.ndarray) -> bytes | None:
    """The last 16 bits of each min-hash of level 0, band by band. An empty set has none."""
    return min_hashes(hashes, 0, BANDS * ROWS).astype("<u2").tobytes() if len(hashes) else None


def marks_of(least: np.ndarray) -> list[int]:
    """The last two bits of each min-hash, 32 to a long."""
    places = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce((least & np.uint64(3)).reshape(-1, 32) << places, axis=1).view(np.int64).tolist()


def sketch_bands(column: str = "sketch") -> Column:
    """The bands' keys of a sketch."""
    wide = 2 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda t: F.xxhash64(t, F.substring(F.col(column), t * wide + 1, F.lit(wide))))


def deep_bands(level: int, similarity: float) -> int:
    """Bands of a deeper level: so many that a pair just at the similarity misses all of them with a probability of MISSED."""
    return math.ceil(math.log(MISSED) / math.log1p(-(similarity ** (ROWS + DEEPER * level))))


def deep_keys(hashes: np.ndarray, level: int, bands: int) -> np.ndarray:
    """One 64-bit key a band of a deeper level, whose bands have DEEPER min-hashes more at each level."""
    keys = np.arange(bands, dtype=np.uint64)
    for column in min_hashes(hashes, level, bands * (ROWS + DEEPER * level)).reshape(bands, -1).T:
        keys = (keys ^ column) * PRIME
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def shares(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have at least that Jaccard similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both + 1e-9 >= similarity * (len(a) + len(b) - both)


def _joined(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """big.join(small); small (a checkpointed table of keys) is counted, and sent to all executors only if it's within SMALL_TABLE."""
    few = small.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    return big.join(F.broadcast(small) if few else small, on, how)


def _hashes(items: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(item, hashes): the shingle hashes of items (item, doc_id, mark) from texts (doc_id, mark, text)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, shingle).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["item", "hashes"])

    found = _joined(texts, items, ["doc_id", "mark"]).select("item", "text").mapInArrow(run, "item binary, hashes binary")
    return found.dropDuplicates(["item"])


def _likely(level: int, similarity: float) -> Column:
    """Whether the similarity that marks sx and sy estimate isn't clearly too small; as a join's condition, so that no other pair leaves the join."""
    n = MARKS[min(level, 1)]
    equal = similarity + (1 - similarity) / 4
    most = n * (1 - equal) + ERRORS * math.sqrt(n * equal * (1 - equal))

    def differing(x: Column, y: Column) -> Column:
        found = x.bitwiseXOR(y)
        return F.bit_count(found.bitwiseOR(F.shiftrightunsigned(found, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return F.aggregate(F.zip_with("sx", "sy", differing), F.lit(0), lambda found, k: found + k) <= F.lit(int(most))


def _marks(sets: DataFrame, level: int) -> DataFrame:
    """(item, marks) of sets at a level; none of the sets is empty."""
    n = MARKS[min(level, 1)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            marks = [marks_of(min_hashes(np.frombuffer(v, np.uint64), level, n)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.list_(pa.int64()))], ["item", "marks"])

    return sets.select("item", "hashes").mapInArrow(run, "item binary, marks array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) of classes whose items (x, y) have at least that similarity; pairs may be repeated."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x, y = ([np.frombuffer(v, np.uint64) for v in batch.column(k).to_pylist()] for k in (2, 3))
            near = pa.array([shares(a, b, similarity) for a, b in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(near)

    first, second = sets.select(F.col("item").alias("x"), F.col("hashes").alias("hx")), sets.select(F.col("item").alias("y"), F.col("hashes").alias("hy"))
    pairs = pairs.select("x", "y", "a", "b").dropDuplicates(["x", "y"])
    return common.checkpoint(pairs.join(first, "x").join(second, "y").select("a", "b", "hx", "hy").mapInArrow(run, "a long, b long").distinct())


def _near_in_size(x: str, y: str, similarity: float) -> Column:
    return F.least(x, y) + F.lit(1e-9) >= similarity * F.greatest(x, y)


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of buckets (k) with more than one class, with the bucket's size (n), its largest class (most) and the pairs of different classes a row."""
    classes = rows.groupBy("k", "c").agg(F.count("*").alias("m"))
    buckets = classes.groupBy("k").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("squares"), F.max(F.struct("m", "c")).alias("most"), F.count("*").alias("classes")).where("classes > 1")
    buckets = buckets.select("k", "n", F.col("most.c").alias("most"), ((F.col("n") * F.col("n") - F.col("squares")) / (2 * F.col("n"))).alias("pairs"))
    return _joined(rows, common.checkpoint(buckets), ["k"])


def _starred(shared: DataFrame, marks: DataFrame, sets: DataFrame, level: int, similarity: float) -> DataFrame:
    """Verified edges between members of buckets and their bucket's leader, the member with most company over all its buckets."""
    company = common.checkpoint(shared.groupBy("item").agg(F.sum("n").alias("company")))
    met = _joined(shared.select("item", "c", "size", "k"), company, ["item"])
    leaders = common.checkpoint(met.groupBy("k").agg(F.max(F.struct("company", "item", "c", "size")).alias("leader")).select("k", "leader.item", "leader.c", "leader.size"))
    leaders = leaders.select("k", F.col("item").alias("y"), F.col("c").alias("b"), F.col("size").alias("ny"))
    stars = _joined(shared.select(F.col("item").alias("x"), F.col("c").alias("a"), F.col("size").alias("nx"), "k"), leaders, ["k"])
    stars = stars.where("a <> b").where(_near_in_size("nx", "ny", similarity)).groupBy("x", "y").agg(F.min("a").alias("a"), F.min("b").alias("b"))
    for i in "xy":  # a pair of a member and a leader meets their marks once, whatever the number of buckets that they share
        stars = _joined(stars, marks.select(F.col("item").alias(i), F.col("marks").alias("s" + i)), [i])
    return _verified(stars.where(_likely(level, similarity)), sets, similarity)


def _crossed(rows: DataFrame, marks: DataFrame, sets: DataFrame, level: int, similarity: float) -> DataFrame:
    """Verified edges between the classes of each bucket; members of its largest class aren't compared with each other."""
    rows = _joined(rows.select("k", "most", "item", "c", "size"), marks, ["item"])
    one, two = (rows.select("k", "most", F.col("item").alias(i), F.col("c").alias(c), F.col("size").alias("n" + i), F.col("marks").alias("s" + i)) for i, c in (("x", "a"), ("y", "b")))
    pairs = one.where("a <> most").join(two.drop("most"), "k").where("a <> b AND (b = most OR x > y)").where(_near_in_size("nx", "ny", similarity)).where(_likely(level, similarity))
    return _verified(pairs, sets, similarity)


def merge_similar(items: DataFrame, texts: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """Edges (a, b) between classes that hold texts with at least that Jaccard similarity of word shingles.

    items has a row per different set of shingles: item (its digest), c (its class, long), size, sketch, and doc_id and
    mark, which tell a row of texts (doc_id, mark, text) with it. Members of a bucket with more than one class are
    compared with its leader, the member that has most company over all its buckets, which in a group of copies is their
    common original. Then buckets that still have more than one class are compared across classes pair by pair, if that
    takes at most PAIRS_A_ROW pairs a row. Members of others get bands anew, of more min-hashes and so many more bands
    that a pair just at the similarity still meets with a probability of 1 - MISSED; so on until none is left. Rows of a
    level are members times its bands, and hold neither texts nor marks. A pair goes by marks, bits of its min-hashes, which meet
    it within the join; whole sets are fetched only for pairs that these don't rule out. Shuffles of steps that are done
    are let go at each level.
    """
    rows = items.select("item", "c", "size", F.explode(sketch_bands()).alias("k"))
    spark = items.sparkSession
    shared = common.written(_mixed(rows), "shared")
    needed = common.checkpoint(_joined(items.select("item", "doc_id", "mark"), common.checkpoint(shared.select("item").distinct()), ["item"], "left_semi"))
    sets = common.written(_hashes(needed, texts, shingle), "sets")
    edges = None
    level = 0
    marks = common.checkpoint(_marks(sets, level))
    while True:
        edges = _starred(shared, marks, sets, level, similarity) if edges is None else edges.union(_starred(shared, marks, sets, level, similarity))
        left = shared.where("n > 2").select("item", "c", "size", "k")
        for labels in (_two_steps, connected_components):  # what small buckets link thins out the large ones
            common.release(spark)
            now = common.checkpoint(labels(edges).select(F.col("node").alias("c"), F.col("component").alias("now")))
            left = common.written(_mixed(_joined(left, now, ["c"], "left").withColumn("c", F.coalesce("now", "c")).drop("now")), "left")
            edges = edges.union(_crossed(left.where(F.col("pairs") <= PAIRS_A_ROW), marks, sets, level, similarity))
            left = left.where(F.col("pairs") > PAIRS_A_ROW).select("item", "c", "size", "k")
            if left.isEmpty():
                return edges
        deep = common.checkpoint(left.groupBy("item").agg(F.min(F.struct("c", "size")).alias("r")).select("item", "r.*"))
        level += 1
        shared = common.written(_mixed(_rebanded(deep, sets, level, similarity)), "shared")
        marks = common.checkpoint(_marks(_joined(sets, common.checkpoint(shared.select("item").distinct()), ["item"], "left_semi"), level))


def _two_steps(edges: DataFrame) -> DataFrame:
    """(node, component) of members' classes a by their leaders' classes b, followed for two steps. Nodes of one component are linked, though not all linked ones share one."""
    least = edges.groupBy("a").agg(F.min("b").alias("b")).where("b < a")
    ahead = least.select(F.col("a").alias("b"), F.col("b").alias("further"))
    return least.join(ahead, "b", "left").select(F.col("a").alias("node"), F.coalesce("further", "b").alias("component"))


def _rebanded(members: DataFrame, sets: DataFrame, level: int, similarity: float) -> DataFrame:
    """Members (item, c, size) with the keys (k) of a deeper level's bands."""
    bands = deep_bands(level, similarity)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys = [deep_keys(np.frombuffer(v, np.uint64), level, bands) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["item", "ks"])

    keys = sets.join(members.select("item"), "item", "left_semi").mapInArrow(run, "item binary, ks array<long>")
    return members.join(keys, "item").select("item", "c", "size", F.explode("ks").alias("k"))
