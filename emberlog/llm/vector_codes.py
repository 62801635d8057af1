"""Vector codes: parts of vectors take the nearest entry of their position's codebook, found by branch and bound in vantage-point trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import common

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components are held to so much either way (4096 before scaling), so that squared distances are exact integers.
LIMIT = 1 << 24
#: Entries that a node without children holds at most.
LEAF = 3


@dataclass
class Node:
    """A vantage point (or a leaf's entries) and what lies within and beyond its median distance, each with the least and greatest distance to it."""

    points: np.ndarray
    indexes: list[int]
    children: list[tuple[int, int, "Node"]]


def low(squares: np.ndarray) -> np.ndarray:
    """An integer that isn't over the root."""
    return np.maximum(np.floor(np.sqrt(squares.astype(float))).astype(np.int64) - 1, 0)


def high(squares: np.ndarray) -> np.ndarray:
    """An integer that isn't under the root."""
    return np.ceil(np.sqrt(squares.astype(float))).astype(np.int64) + 1


def distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    off = x - point
    return np.einsum("ij,ij->i", off, off)


def plant(book: np.ndarray, indexes: list[int] | None = None) -> Node:
    """The tree of a codebook (entries by components). The vantage point is the entry farthest from the others' mean."""
    indexes = list(range(len(book))) if indexes is None else indexes
    if len(indexes) <= LEAF:
        return Node(book[indexes], indexes, [])
    some = book[indexes]
    at = int(np.argmax(distances(some, some.sum(0) // len(some))))
    rest = [i for i in indexes if i != indexes[at]]
    far = distances(book[rest], some[at])
    order = np.argsort(far, kind="stable")
    halves = [order[: len(order) // 2], order[len(order) // 2 :]]
    children = [(int(low(far[h]).min()), int(high(far[h]).max()), plant(book, sorted(rest[i] for i in h))) for h in halves if len(h)]
    return Node(some[at : at + 1], [indexes[at]], children)


def search(node: Node, x: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Improves best (squared distances) and index of the rows by the node's entries.

    A child is visited unless it surely lies farther than the best: radii and distances are rounded so that the bound is
    never too great, and an equal bound is visited, as a tie may go to a lower index. Squared distances, which decide, are
    integers. The nearer child comes first.
    """
    for point, i in zip(node.points, node.indexes, strict=True):
        found = distances(x[rows], point)
        better = (found < best[rows]) | ((found == best[rows]) & (i < index[rows]))
        best[rows[better]], index[rows[better]] = found[better], i
    if not node.children:
        return
    least, most = low(found), high(found)
    bounds = np.stack([np.maximum(least - far, near - most) for near, far, _ in node.children])
    first = bounds.argmin(0)
    for k in range(len(node.children)):
        mine = np.flatnonzero(first == k)
        for c in [k, *(j for j in range(len(node.children)) if j != k)]:
            visit = mine[bounds[c, mine] <= high(best[rows[mine]])]
            if len(visit):
                search(node.children[c][2], x, rows[visit], best, index)


def nearest(tree: Node, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row; ties go to the lower index."""
    best, index = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)
    search(tree, x, np.arange(len(x)), best, index)
    return index, best


def parts_of(column, wide: int, parts: int) -> np.ndarray:
    """(rows, parts, components) of an Arrow list column; vectors shorter than wide are filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(size), wide), np.int64)
    out[np.arange(wide) < size[:, None]] = flat
    return out.reshape(len(size), parts, wide // parts)


def scaled(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): floor(4096 * x) of vectors that aren't null and whose components are finite numbers."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("v")).where("v IS NOT NULL").where(~bad)
    held = lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    return rows.withColumn("v", F.transform("v", held))


def sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, n, total): members of each entry and their components' sums, added up within each partition first."""
    parts, wide = len(books), books.shape[2] * len(books)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        trees = [plant(b) for b in books]
        counts, totals = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in common.gathered(batches):
            x = parts_of(batch.column(0), wide, parts)
            for p, tree in enumerate(trees):
                index, _ = nearest(tree, x[:, p])
                counts[p] += np.bincount(index, minlength=books.shape[1])
                np.add.at(totals[p], index, x[:, p])
        p, e = np.nonzero(counts)
        width = books.shape[2]
        columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)), np.repeat(counts[p, e], width), totals[p, e].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "n", "total"])

    found = rows.select("v").mapInArrow(run, "part long, entry long, place long, n long, total long")
    return found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def train(rows: DataFrame, wide: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, components) after so many rounds over all rows; the driver holds these and their sums only."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), wide), np.int64)
    for k, r in enumerate(first):
        start[k, : len(r["v"])] = r["v"]
    books = start.reshape(len(first), parts, wide // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in sums(rows, books).collect():
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """rows (vec_id, label, v) with code (a byte a part, as hex digits) and error."""
    parts, wide = len(books), books.shape[2] * len(books)
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        trees = [plant(b) for b in books]
        for batch in common.gathered(batches):
            x = parts_of(batch.column(2), wide, parts)
            found = [nearest(tree, x[:, p]) for p, tree in enumerate(trees)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = np.sum([d for _, d in found], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """A row per kept vector: vec_id, code, error, label, label_error (errors summed over equal labels, nulls together), codebooks_sha256.

    Vectors that are null or hold a null or a component that isn't finite are left out. Components become floor(4096 * x),
    held to LIMIT. Codebooks start with the entries smallest ids (a null id comes last, equal ids go by their vectors; fewer
    rows make fewer entries). Vectors shorter than the longest, empty ones too, and those whose length the parts don't
    divide are filled up with zeros. Repeated rows count each. An empty table gives no rows; other columns are left out.
    """
    if entries > 256:
        raise ValueError("an entry's index has to fit in a byte")
    common.prepare(df.sparkSession)
    rows = common.checkpoint(scaled(df, id_col, vector_col, label_col))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    books = train(rows, -(-max(longest, 1) // parts) * parts, parts, entries, rounds)
    found = common.checkpoint(encoded(rows, books))
    found = found.withColumns({"k": F.coalesce(F.col("label").cast("string"), F.lit("")), "none": F.col("label").isNull()})
    by_label = common.checkpoint(found.groupBy("k", "none").agg(F.sum("error").alias("label_error")))
    return common.joined(found, by_label, ["k", "none"]).select("vec_id", "code", "error", "label", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
