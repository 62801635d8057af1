"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import checkpoint

#: Up to so many edges (some 20 MB with long names) a round runs in one task, without an exchange; more are dealt out by node.
SMALL_GRAPH = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's larger neighbours to its least neighbour or itself."""
    both = edges.select(F.inline(F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("v")), F.struct(F.col("b").alias("n"), F.col("a").alias("v")))))
    least = both.groupBy("n").agg(F.min("v").alias("m"))
    larger = edges.select(F.col("b").alias("n"), F.col("a").alias("v"))  # edges keep a > b
    return larger.join(least, "n").select(F.col("v").alias("a"), F.least("n", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of them."""
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    met = edges.select(F.col("a").alias("n"), F.col("b").alias("v")).join(least, "n")
    return met.select(F.explode(F.array("v", "n")).alias("a"), F.col("m").alias("b"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    Loops, repeated edges, either direction and nulls (ignored) are fine; without edges there are no rows. Node values
    may be of any ordered type. Steps group by node with partial minima and join on the node, so that a node with very
    many edges is split by adaptive execution; the driver only sees counts. Each round is checkpointed to the shared folder.
    A graph of at most SMALL_GRAPH edges, which no round adds to, takes the same steps in one task.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a > b").distinct()
    now = checkpoint(now)
    mark = None
    while True:
        row = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if row[0] == 0 or (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
        if row[0] <= SMALL_GRAPH:
            now = now.coalesce(1)
        now = checkpoint(_small_star(_large_star(now).where("a > b").distinct()).where("a > b").distinct())
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
