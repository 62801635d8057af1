"""Isolation forest: trees on bounded samples, built in parallel, scored as flat arrays."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.operators.risk import exact_percentiles, percentiles_by

EULER = 0.5772156649015329
SAMPLE, TREES, SEED = 256, 200, 42
TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grow(x: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int, float, int, int, int, int]]:
    """(node, feature, threshold, left, right, size, depth), the root first, level by level; a leaf has feature -1.

    All nodes of a level are split at once: rows stand node by node, so each node's ranges are one reduction.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    out: list = []
    rows, starts, first = np.arange(len(x)), np.zeros(1, np.int64), 0
    for depth in range(limit + 1):
        sizes = np.diff(np.append(starts, len(rows)))
        lo, hi = np.minimum.reduceat(x[rows], starts), np.maximum.reduceat(x[rows], starts)
        free = hi > lo
        n = free.sum(1)
        split = (n > 0) & (depth < limit)
        feature = (free.cumsum(1) > (rng.random(len(n)) * n).astype(np.int64)[:, None]).argmax(1)
        at = np.arange(len(n))
        low, high = lo[at, feature], hi[at, feature]
        threshold = np.minimum(low + rng.random(len(n)) * (high - low), np.nextafter(high, low))
        left = first + len(n) + 2 * (np.cumsum(split) - 1)
        for k in range(len(n)):
            me = first + k
            out.append((me, int(feature[k]), float(threshold[k]), int(left[k]), int(left[k]) + 1, int(sizes[k]), depth) if split[k] else (me, -1, 0.0, me, me, int(sizes[k]), depth))
        if not split.any():
            break
        node = np.repeat(at, sizes)
        rows, node = rows[split[node]], node[split[node]]
        side = 2 * (np.cumsum(split) - 1)[node] + (x[rows, feature[node]] > threshold[node])
        order = np.argsort(side, kind="stable")
        rows = rows[order]
        first += len(n)
        starts = np.searchsorted(side[order], np.arange(2 * int(split.sum())))
    return out


def fit(rows: DataFrame, column: str = "z", id_columns: tuple[str, ...] = ("runnable", "t"), trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Trees (TREE_SCHEMA), each on at most `sample` rows of its own, so on at most trees * sample rows: those with the least hashes of their ids.

    The sample is drawn in one pass, dealt to the trees, and each tree is grown in a task. The same seed gives the same
    trees whatever the partitions. With fewer rows than that, trees share rows.
    """
    mark = F.xxhash64(*id_columns, F.lit(seed))
    n = rows.count()
    size = max(1, min(sample, n))
    # Top rows of each partition first, then of these; no full sort.
    drawn = rows.select(F.col(column).alias("x"), mark.alias("h")).orderBy("h", "x").limit(trees * size)
    numbered = drawn.withColumn("i", F.row_number().over(W.orderBy("h", "x")) - 1)  # bounded by trees * size
    if n >= trees * size:
        dealt = numbered.withColumn("tree", (F.col("i") % trees).cast("int"))
    else:
        each = numbered.select("x", "h", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        dealt = each.withColumn("i", F.row_number().over(W.partitionBy("tree").orderBy(F.xxhash64("h", "tree"), "x"))).where(F.col("i") <= size)

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(sorted(map(tuple, pdf["x"].tolist())), float)
        found = grow(x, np.random.default_rng([seed, int(key[0])]))
        return pd.DataFrame([(int(key[0]), *r) for r in found], columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])

    return dealt.groupBy("tree").applyInPandas(build, TREE_SCHEMA)


@dataclass
class Forest:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    depth: int
    sample: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between -1 (most isolated) and 0."""
        if not len(x):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(goes, self.left[at], self.right[at])
        scale = mean_path(self.sample)
        return -np.power(2.0, -self.path[at].mean(1) / scale) if scale else np.full(len(x), -0.5)


def forest(trees: DataFrame) -> Forest:
    """The trees in flat arrays; they are at most some hundred thousand nodes, bounded by trees and sample."""
    return flat(trees.orderBy("tree", "node").toPandas())


def flat(pdf: pd.DataFrame) -> Forest:
    """Flat arrays of trees in order of tree and node."""
    pdf = pdf.reset_index(drop=True)
    starts = pdf.groupby("tree", sort=True).size().cumsum().shift(fill_value=0)
    offset = pdf["tree"].map(starts).to_numpy(np.int64)
    path = pdf["depth"].to_numpy(float) + np.array([mean_path(s) for s in pdf["size"]])
    sample = int(pdf.loc[pdf["node"] == 0, "size"].max())
    return Forest(pdf["feature"].to_numpy(np.int64), pdf["threshold"].to_numpy(float), offset + pdf["left"].to_numpy(np.int64), offset + pdf["right"].to_numpy(np.int64), path, starts.to_numpy(np.int64), int(pdf["depth"].max()), sample)


def score(rows: DataFrame, model: Forest, column: str = "z") -> DataFrame:
    """Adds score."""

    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        parts = [model.score(np.stack(x.iloc[k : k + 2048].to_numpy())) for k in range(0, len(x), 2048)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return rows.withColumn("score", of(F.col(column)))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt out by keys to as many tasks as the session has shuffle partitions, however small they are."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: How many more rows than a sample each tree draws at first, so that few trees get less than a sample.
SPARE = 1.25


def drawn(rows: DataFrame, by: str, id_columns: tuple[str, ...], trees: int, sample: int, seed: int) -> DataFrame:
    """rows with tree and h, a row for each tree that draws it: about `sample` times SPARE a tree.

    A key with n rows has room for m = n / (sample * SPARE) trees that share no row. So many are dealt out at once by a hash
    of the ids, in as many rounds, each with its own hash, as the trees take; a row is tested once a round and only copied
    for a tree that draws it. A key with less than twice that many rows gives all its rows to every tree. So a key makes about
    trees * sample rows, however many it has.
    """
    n = rows.groupBy(by).agg(F.count("*").alias("__n"))
    wide = sample * SPARE
    met = rows.join(n, by)
    room = F.floor(F.col("__n") / wide)
    u = lambda g: F.pmod(F.xxhash64(*id_columns, F.lit(seed), g), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rounds = F.sequence(F.lit(0).cast("long"), F.ceil(trees / F.greatest(room, F.lit(1))) - 1)
    dealt = F.filter(F.transform(rounds, lambda g: g * room + F.when(F.floor(u(g) * F.col("__n") / wide) < room, F.floor(u(g) * F.col("__n") / wide)).otherwise(F.lit(trees))), lambda t: t < trees)
    every = F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))
    out = met.withColumn("tree", F.explode(F.when(room < 2, every).otherwise(dealt))).withColumn("tree", F.col("tree").cast("int"))
    return out.withColumn("h", F.xxhash64(*id_columns, F.lit(seed), F.lit("order"), "tree")).drop("__n")


def fit_by(rows: DataFrame, by: str = "runnable", column: str = "z", id_columns: tuple[str, ...] = ("runnable", "t"), trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Trees of each key (by, TREE_SCHEMA), each on at most `sample` of its key's rows, those with the least hashes of what it draws."""
    # Growing takes time by the tree, not by the byte, so small tables aren't put together into few tasks.
    some = drawn(rows.select(by, *[c for c in id_columns if c != by], F.col(column).alias("x")), by, id_columns, trees, sample, seed)
    some = spread(some, by, "tree")
    dealt = some.withColumn("i", F.row_number().over(W.partitionBy(by, "tree").orderBy("h", "x"))).where(F.col("i") <= sample).select(by, "tree", "x")

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(sorted(map(tuple, pdf["x"].tolist())), float)
        found = grow(x, np.random.default_rng([seed, int(key[1])]))
        return pd.DataFrame([(key[0], int(key[1]), *r) for r in found], columns=[by, "tree", "node", "feature", "threshold", "left", "right", "size", "depth"])

    return dealt.groupBy(by, "tree").applyInPandas(build, f"{by} string, {TREE_SCHEMA}")


def score_by(rows: DataFrame, trees: DataFrame, by: str = "runnable", column: str = "z", at_once: int = 20_000) -> DataFrame:
    """(by, id columns, score) of rows by their key's own trees; large keys are dealt out in parts of about at_once rows.

    rows: by, the columns to keep and `column`. Rows of a key without trees have no score and are left out.
    """
    keep = [c for c in rows.columns if c != column]
    parts = rows.groupBy(by).agg(F.ceil(F.count("*") / F.lit(at_once)).cast("int").alias("__parts"))
    dealt = rows.join(parts, by).withColumn("__part", F.pmod(F.xxhash64(*keep), F.col("__parts")).cast("int")).drop("__parts")
    models = trees.join(parts, by).select(*trees.columns, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))

    def of(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in (*keep, "score")})
        model = flat(right.sort_values(["tree", "node"], kind="stable"))
        x = np.array(left[column].tolist(), float)
        found = np.concatenate([model.score(x[k : k + 2048]) for k in range(0, len(x), 2048)])
        return left[keep].assign(score=found)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != column)
    return spread(dealt, by, "__part").groupBy(by, "__part").cogroup(spread(models, by, "__part").groupBy(by, "__part")).applyInPandas(of, f"{kinds}, score double")


def labels(rows: DataFrame, contamination: float = 0.03, by: list[str] | None = None) -> DataFrame:
    """Adds offset (the contamination's percentile of score), decision (score less offset) and label (-1 below it, else 1)."""
    if by:
        out = rows.join(percentiles_by(rows, F.col("score"), (contamination,), by).withColumnRenamed("p0", "offset"), by)
    else:
        out = rows.withColumn("offset", F.lit(exact_percentiles(rows, F.col("score"), (contamination,))[0]).cast("double"))
    return out.withColumns({"decision": F.col("score") - F.col("offset"), "label": F.when(F.col("score") < F.col("offset"), -1).otherwise(1)})


def save(path: str, trees: DataFrame, scaler: DataFrame, params: dict) -> None:
    """A model as three tables below a folder."""
    trees.write.mode("overwrite").parquet(f"{path}/trees")
    scaler.coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    trees.sparkSession.createDataFrame([(k, str(v)) for k, v in params.items()], "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/params")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    params = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/params").collect()}
    return spark.read.parquet(f"{path}/trees"), spark.read.parquet(f"{path}/scaler"), params
