"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from emberlog.llm import common
from emberlog.llm.chunks import ChunkEncoder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


class RankQueue:
    """Buckets of positions by merge rank; two levels of bitmaps tell which buckets have any.

    Each 64-bit word has a bit per rank, the summary a bit per word: the least rank is found by find-first-set on the
    summary and then on its word. Entries aren't removed when a merge makes them stale: the caller compares an entry's
    rank with the position's present one and skips it. Within a bucket the leftmost position comes first.
    """

    __slots__ = ("buckets", "summary", "words")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.summary = 0

    def add(self, rank: int, bucket: list[int]) -> None:
        """A new bucket with ascending positions."""
        self.buckets[rank] = bucket
        word = rank >> 6
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 63)
        self.summary |= 1 << word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.add(rank, [position])
        else:
            heapq.heappush(bucket, position)

    def least(self) -> int:
        """The least rank that has a bucket; -1 if there's none."""
        if not self.summary:
            return -1
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> None:
        """Takes an empty bucket out."""
        del self.buckets[rank]
        word = rank >> 6
        bits = self.words[word] = self.words[word] ^ 1 << (rank & 63)
        if not bits:
            self.summary ^= 1 << word


class Merger:
    """Ids of pre-tokens: of all adjacent pairs that have a rank, the least and leftmost merges first, until none has.

    Pre-tokens don't touch each other, so one queue holds the pairs of many at once, and a bucket's leftmost pairs of
    different pre-tokens merge in one step of numpy. A long pre-token goes through the queue alone, pair by pair.
    """

    #: Bytes of pre-tokens that go through one queue; bytes from which a pre-token is long; positions from which numpy pays.
    TOGETHER, LONG, MANY = 1 << 20, 256, 24

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.double = np.full(65536, -1, np.int32)
        pairs = {}
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.found = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where they have none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.found[at], np.int32(-1))

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        some, held = [], 0
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) >= self.LONG:
                self._merge(pieces, [k], out)
            elif piece:
                if held + len(piece) > self.TOGETHER:
                    self._merge(pieces, some, out)
                    some, held = [], 0
                some.append(k)
                held += len(piece)
        if some:
            self._merge(pieces, some, out)
        return out

    def _merge(self, pieces: list[bytes], some: list[int], out: list[bytes]) -> None:
        data = b"".join([pieces[k] for k in some])
        n, get = len(data), self.ranks.get
        many = self.MANY if len(some) > 1 else n + 1
        a = np.frombuffer(data, np.uint8)
        sizes = [len(pieces[k]) for k in some]
        starts = np.zeros(len(some) + 1, np.int64)
        np.cumsum(sizes, out=starts[1:])
        owner = np.repeat(np.arange(len(some), dtype=np.int32), sizes)
        edge = bytearray(n + 1)  # 1 where a pre-token starts
        edges = np.frombuffer(edge, np.uint8)
        edges[starts] = 1
        first = np.append(self.double[a[:-1].astype(np.int32) << 8 | a[1:]], np.int32(-1))
        first[starts[1:] - 1] = -1
        # Of the part that starts here: its end, the start of the part before, the rank with the next part or -1, and its id, -1 if none starts here.
        end, before, pair, token = array("i", range(1, n + 1)), array("i", range(-1, n - 1)), array("i", first.tobytes()), array("i", self.single[a].tobytes())
        ends, befores, ranks_at, tokens = (np.frombuffer(x, np.int32) for x in (end, before, pair, token))
        queue = RankQueue()
        push, pop, buckets = queue.push, heapq.heappop, queue.buckets

        def enter(ranks: np.ndarray, positions: np.ndarray) -> None:
            """Puts positions with ranks into the queue."""
            positions = positions[ranks >= 0]
            ranks = ranks[ranks >= 0]
            if not len(ranks):
                return
            order = np.lexsort((positions, ranks))
            ranks, positions = ranks[order], positions[order].tolist()
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(positions)]
            for rank, lo, hi in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
                bucket = buckets.get(rank)
                if bucket is None:
                    queue.add(rank, positions[lo:hi])
                elif hi - lo < 4:
                    for i in positions[lo:hi]:
                        heapq.heappush(bucket, i)
                else:
                    bucket += positions[lo:hi]
                    heapq.heapify(bucket)

        enter(first, np.arange(n, dtype=np.int32))
        while (rank := queue.least()) >= 0:
            bucket = buckets[rank]
            if len(bucket) >= many:
                queue.drop(rank)
                at = np.array(bucket, np.int32)
                at = at[ranks_at[at] == rank]
                at.sort()
                at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
                if not len(at):
                    continue
                leftmost = np.append(True, owner[at[1:]] != owner[at[:-1]])
                if not leftmost.all():
                    queue.add(rank, at[~leftmost].tolist())
                at = at[leftmost]
                gone = ends[at]
                stop = ends[gone]
                ends[at] = stop
                tokens[at] = rank
                tokens[gone] = ranks_at[gone] = ranks_at[at] = -1
                inner = edges[stop] == 0
                right, own = stop[inner], at[inner]
                befores[right] = own
                new = self.rank_of(tokens[own], tokens[right])
                ranks_at[own] = new
                tail = at[edges[at] == 0]
                left = befores[tail]
                newer = self.rank_of(tokens[left], tokens[tail])
                ranks_at[left] = newer
                enter(np.concatenate([new, newer]), np.concatenate([own, left]))
                continue
            lower = False
            while bucket and not lower:
                i = pop(bucket)
                if pair[i] != rank:
                    continue
                gone = end[i]
                stop = end[i] = end[gone]
                token[i] = rank
                token[gone] = pair[gone] = -1
                if edge[stop]:
                    pair[i] = -1
                else:
                    before[stop] = i
                    r = get(data[i : end[stop]])
                    if r is None:
                        pair[i] = -1
                    else:
                        pair[i] = r
                        push(r, i)
                        lower = r < rank
                if not edge[i]:
                    left = before[i]
                    r = get(data[left:stop])
                    if r is None:
                        pair[left] = -1
                    else:
                        pair[left] = r
                        push(r, left)
                        lower = lower or r < rank
            if not bucket:
                queue.drop(rank)
        there = tokens >= 0
        cuts = (np.concatenate([[0], np.cumsum(there)])[starts] * 4).tolist()
        packed = tokens[there].astype("<u4").tobytes()
        for k, lo, hi in zip(some, cuts, cuts[1:], strict=False):
            out[k] = packed[lo:hi]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encodes and decodes by a rank file. ids are bytes: little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.merger = Merger(self.ranks)
        self.chunks = ChunkEncoder(self._whole)

    def _whole(self, texts: list[str]) -> list[bytes]:
        cut = [self.find(x) for x in texts]
        pieces = list({p for x in cut for p in x})
        ids = dict(zip(pieces, self.merger([p.encode() for p in pieces]), strict=True))
        return [b"".join([ids[p] for p in x]) for x in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Ids of every whole text, and their decoding, by the ranks of a vocabulary file.

    One row per input row: doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (of the decoded bytes), with with_ids also ids binary. A null or empty text has no ids and the hash of
    nothing; a null key stays null; repeated rows give a row each; an empty table gives none; other columns are left out.
    No shuffle: each task encodes its own rows; its table of chunks is bounded, and goes with the task.
    """
    import public_tokenizers

    path, pattern = path or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    common.prepare(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        try:
            for batch in common.gathered(batches):
                ids = c.encode(batch.column(1).to_pylist())
                columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        finally:  # a worker lives on, in a pipeline with other steps' tasks
            c.chunks.forget()
            common.give_back()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return common.keyed(df, id_col, text_col).mapInArrow(run, schema)
