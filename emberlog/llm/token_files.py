"""Token files with directly addressable codes: any token is read without decoding the ones before it.

An id is cut into chunks of eight bits. Level k holds, in order, chunk k of every id that has one; a bitmap beside it says
which ids go on at the next level, and a rank directory holds the ones before each block of 512 bits, so that an id's
place at the next level is one directory entry and a count within one block. Layout, all numbers little-endian:

    magic "EMBERDAC", uint64 documents, uint64 tokens, uint32 levels, then for each level uint64 chunks;
    int64 keys, uint8 whether each key is there, uint64 end of each document's tokens;
    for each level: uint8 chunks, bitmap (whole 64-byte blocks), uint64 directory (a number per block, and the total).
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.chunks import ChunkEncoder

VOCABULARY = "byte_bpe_50k.json"
END = 2
MAGIC = b"EMBERDAC"
#: Tokens from which a task begins another file.
FILE_TOKENS = 4_000_000
LETTERS = re.compile(" ?[A-Za-z]+").fullmatch


def pack(keys: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's bytes: keys of documents, where each one's tokens end, and all tokens."""
    levels, sizes = [], []
    rest = ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.append(bits, np.zeros(-len(bits) % 64, np.uint8))
        ones = np.bitwise_count(bits.reshape(-1, 64)).sum(1, dtype=np.uint64)
        directory = np.concatenate([[np.uint64(0)], np.cumsum(ones, dtype=np.uint64)])
        levels += [(rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), directory.astype("<u8").tobytes()]
        sizes.append(len(rest))
        if not more.any():
            break
        rest = rest[more] >> 8
    there = np.array([k is not None for k in keys], np.uint8)
    head = MAGIC + struct.pack("<QQI", len(keys), len(ids), len(sizes)) + struct.pack(f"<{len(sizes)}Q", *sizes)
    return b"".join([head, np.array([k or 0 for k in keys], "<i8").tobytes(), there.tobytes(), np.asarray(ends, "<u8").tobytes(), *levels])


class TokenFile:
    """Reads tokens and documents of a file's bytes in any order."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.documents, self.tokens, n = struct.unpack_from("<QQI", data, 8)
        sizes = struct.unpack_from(f"<{n}Q", data, 28)
        at = 28 + 8 * n

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        keys, there = take("<i8", self.documents), take("u1", self.documents)
        self.keys = [k if t else None for k, t in zip(keys.tolist(), there.tolist(), strict=True)]
        self.ends = take("<u8", self.documents).astype(np.int64)
        self.levels = []
        for size in sizes:
            blocks = -(-(-(-size // 8)) // 64)
            self.levels.append((take("u1", size), take("u1", 64 * blocks), take("<u8", blocks + 1)))

    def rank(self, level: int, i: int) -> int:
        """Ones before bit i."""
        _, bits, directory = self.levels[level]
        block, within = divmod(i, 512)
        found = int(directory[block])
        if within:
            part = bits[64 * block : 64 * block + (within + 7) // 8].copy()
            if within % 8:
                part[-1] &= (1 << within % 8) - 1
            found += int(np.bitwise_count(part).sum(dtype=np.int64))
        return found

    def token(self, i: int) -> int:
        """One id, by a chunk and a rank a level."""
        value = shift = level = 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i, level, shift = self.rank(level, i), level + 1, shift + 8

    def read(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi (not included) as little-endian unsigned 32-bit integers."""
        out = np.empty(hi - lo, "<u4")
        into = None  # which of the ids go on
        for level, (chunks, bits, _) in enumerate(self.levels):
            part = chunks[lo:hi].astype(np.uint32) << np.uint32(8 * level)
            if into is None:
                out[:] = part
            else:
                out[into] |= part
            if hi == lo or level + 1 == len(self.levels):
                break
            goes = np.unpackbits(bits[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 : (lo & 7) + hi - lo].astype(bool)
            into = np.flatnonzero(goes) if into is None else into[goes]
            lo, hi = self.rank(level, lo), self.rank(level, hi)
        return out

    def document(self, d: int) -> np.ndarray:
        return self.read(int(self.ends[d - 1]) if d else 0, int(self.ends[d]))


@lru_cache(maxsize=1)
def encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    t = Tokenizer.from_file(path)
    # Of ASCII letters with at most one space before them, a byte-level tokenizer makes one piece as it stands, so the library's model gets them without its cutting.
    cut = t.pre_tokenizer
    added = tuple(x.content for x in t.get_added_tokens_decoder().values())
    model = Tokenizer(t.model) if t.normalizer is None and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space and not any(map(LETTERS, added)) else None

    def ids_of(by: Tokenizer, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() if len(e) > 64 else b"".join(map(packed.__getitem__, e.ids)) for e in by.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(texts: list[str]) -> list[bytes]:
        if model is None:
            return ids_of(t, texts)
        one = [bool(LETTERS(x)) for x in texts]
        words, others = iter(ids_of(model, [x.replace(" ", "Ġ") for x in compress(texts, one)])), iter(ids_of(t, [x for x, letters in zip(texts, one, strict=True) if not letters]))
        return [next(words if letters else others) for letters in one]

    packed = [i.to_bytes(4, "little") for i in range(max(t.get_vocab().values()) + 1)]
    return ChunkEncoder(whole, special=added)


def write_token_files(df: DataFrame, into: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the ids of every whole text, each document with the end id appended, in ascending key order; returns the manifest.

    One shuffle: rows are dealt out by ranges of the key and sorted within; each task encodes its rows and writes files of
    about file_tokens ids to the shared folder `into`, under the same names if it's tried again. Manifest: part, seq, path,
    documents, tokens, start (ids of all files before). Null keys come first; null and empty texts are the end id alone;
    rows with equal keys stand together, ordered by a hash of the text; strings of special tokens in a text give these, as in the library; an empty table writes no file.
    """
    import public_tokenizers

    spark = df.sparkSession
    common.prepare(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[bytes] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, tokens
            uri = f"{into}/part-{part:06d}-{seq:06d}.dac"
            ends = np.cumsum([len(x) // 4 for x in held])
            common.publish(uri, pack(keys, ends, np.frombuffer(b"".join(held), "<u4")))
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": uri, "documents": len(keys), "tokens": int(ends[-1])}])
            keys.clear(), held.clear()
            seq, tokens = seq + 1, 0
            return row

        for batch in common.gathered(batches):
            for key, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist()), strict=True):
                keys.append(key)
                held.append(ids + last)
                tokens += len(ids) // 4 + 1
                if tokens >= file_tokens:
                    yield flush()
        if keys:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The text orders rows of equal keys, so that very many of them, null keys too, are dealt out as well.
    order = (F.col("doc_id").asc_nulls_first(), F.col("h"))
    rows = common.keyed(df, id_col, text_col).withColumn("h", F.xxhash64("text")).repartitionByRange(n, *order).sortWithinPartitions(*order)
    listed = common.checkpoint(rows.mapInArrow(run, "part long, seq long, path string, documents long, tokens long"))
    parts = listed.groupBy("part").agg(F.sum("tokens").alias("t")).select("part", (F.sum("t").over(W.orderBy("part")) - F.col("t")).alias("before"))  # a row per task
    inner = F.sum("tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("tokens")
    return listed.withColumn("inner", inner).join(parts, "part").select("part", "seq", "path", "documents", "tokens", (F.col("before") + F.col("inner")).alias("start"))


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = common.file_system(uri)
                with system.open_input_file(path) as f:
                    got = TokenFile(f.read())
                ids = [got.document(d) for d in range(got.documents)]
                sizes = pa.array([len(x) for x in ids], pa.int64())
                begins = pa.array(start + np.concatenate([[0], got.ends[:-1]]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(got.keys, pa.int64()), begins, sizes, pa.array([zlib.crc32(x) for x in ids], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, min(2000, manifest.count()))
    return manifest.select("path", "start").repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
