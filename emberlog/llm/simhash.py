"""SimHash near-duplicates: fuzzy keys by the binary Golay code over segments of the fingerprint."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.components import connected_components
from emberlog.llm.similar import merge_similar, shingle_set, sketch

#: Segments of a 64-bit fingerprint: first bit and width; the last is padded to the code's 23 bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the perfect (23, 12) Golay code.
GENERATOR = 0b110001110101
#: Buckets up to this size are compared pair by pair; the members of larger ones meet at shared midpoints instead.
PAIRWISE = 12
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash over XXH64 (seed 42) of word shingles, repeats included; fewer words: the whole sequence; none: zero."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[s:e], 42) for s, e in zip(starts[: n - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):
        ones += np.unpackbits(h[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word, and the error pattern of each syndrome."""

    def syndrome(word: int) -> int:
        for k in range(22, 10, -1):
            if word >> k & 1:
                word ^= GENERATOR << k - 11
        return word

    single = [syndrome(1 << k) for k in range(23)]
    spread = lambda bits: np.array([np.bitwise_xor.reduce([s for k, s in enumerate(bits) if v >> k & 1] or [0]) for v in range(1 << len(bits))], np.int32)
    errors = np.zeros(2048, np.int32)
    for i in range(23):
        errors[single[i]] = 1 << i
        for j in range(i):
            errors[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    return spread(single[:12]), spread(single[12:]), errors


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each 23-bit word; there's exactly one."""
    low, high, errors = _golay()
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and of its 23 neighbours: (row numbers, indices), each index once a row.

    Words at two or fewer differing bits share one: a word halfway between them is a neighbour of both.
    """
    flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.int64)
    found = np.sort(nearest(words[:, None] ^ flips), axis=1)
    first = np.concatenate([np.ones((len(words), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)
    rows, columns = np.nonzero(first)
    return rows, found[rows, columns]


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints: for each segment taken as free of errors, itself with the fuzzy keys of the next one.

    Two differing bits can't lie in all three segments, so fingerprints at two or fewer share a key.
    """
    bits = prints.view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for k, part in enumerate(parts):
        r, index = fuzzy_keys(parts[(k + 1) % 3])
        rows.append(r)
        keys.append(np.int64(k) << 40 | part[r] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit integer, a row per input row."""
    common.prepare(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return common.keyed(df, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp) that join all those at two or fewer differing bits.

    Those of a bucket with at most PAIRWISE members are compared, each link is verified. The members of a larger bucket
    meet at midpoints: each goes to itself and to its 64 neighbours, those that meet are within two bits of each other,
    and each links to the least of them. That finds the same components with rows in proportion to members.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            prints = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            rows, keys = bucket_keys(prints)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["k", "fp"])

    keys = distinct.select("fp").mapInArrow(run, "k long, fp long")
    sizes = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.checkpoint(keys.join(sizes, "k"))
    small = shared.where(F.col("n") <= PAIRWISE)
    a, b = small.select("k", F.col("fp").alias("a")), small.select("k", F.col("fp").alias("b"))
    pairs = a.join(b, "k").where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long") for k in range(64)])
    large = shared.where(F.col("n") > PAIRWISE).select("fp").distinct()
    met = large.select("fp", F.explode(flips).alias("flip")).select(F.col("fp"), F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
    least = met.groupBy("z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("z", "b")
    return pairs.union(met.join(least, "z").where("fp > b").select(F.col("fp").alias("a"), "b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Class of every document by links at two or fewer differing bits, a row per input row: doc_id, fp, component_id.

    component_id is the smallest doc_id that links reach, itself included. Equal fingerprints, those of empty and null
    texts (zero) too, are one node, so copies aren't paired. A null key stays null and takes the least key of its class,
    which is null if the class has no other; repeated rows give a row each; an empty table gives none; other columns are
    left out. Texts are read once and never shuffled; links and components are those of different fingerprints only.
    """
    prints = common.checkpoint(fingerprints(df, id_col, text_col, shingle))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = connected_components(links(nodes))
    classes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = common.checkpoint(classes.join(least, "component").select("fp", "component_id"))
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, similarity: float | None = 0.8, similar_shingle: int = 5) -> DataFrame:
    """One row of each class of near-duplicates, with all its columns: that with the least key, of equal keys that with the least hash of its text.

    Fingerprints link at two or fewer differing bits. Near copies mostly differ in more bits than the code can bridge, so
    texts whose sets of similar_shingle-word shingles have at least that Jaccard similarity are linked too (None: they
    aren't). Rows are told by key and text; rows equal in both are one. A class without any key keeps the row with the
    least hash; empty and null texts are one class.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.col(id_col).cast("long")
    # The row's own columns stand in one, so that no name of theirs meets one of ours. Rows without a key have marks of their own.
    plain = df.select(F.coalesce(key, F.lit(0).cast("long")).alias("doc_id"), F.xxhash64(text, key.isNull()).alias("mark"), key.isNull().alias("last"), text.alias("text"), F.struct("*").alias("row"))
    prints = common.checkpoint(marked_fingerprints(plain, shingle, similar_shingle if similarity else 0))
    nodes = prints.groupBy("fp").agg(F.min(F.struct("last", "doc_id", "mark")).alias("first"))
    found = connected_components(links(nodes))
    classes = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    if similarity:
        classes = common.checkpoint(classes)
        known = prints.where("size > 0").join(classes.select("fp", F.col("component").alias("c")), "fp")
        items = known.groupBy("item").agg(F.min("c").alias("c"), F.min(F.struct("doc_id", "mark", "size", "sketch")).alias("r"))
        items = common.checkpoint(items.select("item", "c", "r.*"))
        equal = known.select("item", F.col("c").alias("a")).distinct().join(items.select("item", F.col("c").alias("b")), "item").where("a <> b").select("a", "b")
        found = connected_components(equal.union(merge_similar(items, plain.select("doc_id", "mark", "text"), similarity, similar_shingle)))
        found = found.select(F.col("node").alias("component"), F.col("component").alias("wider"))
        classes = classes.join(found, "component", "left").withColumn("component", F.coalesce("wider", "component"))
    kept = common.checkpoint(classes.groupBy("component").agg(F.min("first").alias("k")).select("k.doc_id", "k.mark"))
    # A kept key and text may stand in several equal rows, of which one stays; that needs no further shuffle.
    return plain.select("doc_id", "mark", "row").join(kept, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"]).select("row.*")


def marked_fingerprints(df: DataFrame, shingle: int, similar_shingle: int) -> DataFrame:
    """(doc_id, mark, last, fp) of rows (doc_id, mark, last, text); with similar_shingle the digest (item), size and sketch of the set of its shingles too."""
    common.prepare(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            texts = batch.column(3).to_pylist()
            columns = [*batch.columns[:3], pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))]
            names = ["doc_id", "mark", "last", "fp"]
            if similar_shingle:
                digests, sizes, sketches = [], [], []
                for text in texts:
                    hashes = shingle_set(text, similar_shingle)
                    digests.append(xxhash.xxh128_digest(hashes.tobytes()))
                    sizes.append(len(hashes))
                    sketches.append(sketch(hashes))
                columns += [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]
                names += ["item", "size", "sketch"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, mark long, last boolean, fp long" + (", item binary, size long, sketch binary" if similar_shingle else "")
    return df.select("doc_id", "mark", "last", "text").mapInArrow(run, schema)
