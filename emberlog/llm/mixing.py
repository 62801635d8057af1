"""Mixing sources to target weights: whole passes over a source, then documents whose lengths fit the remaining budget."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.prefix import ranked

#: Weights of sources in order, repeating, and how often a document may be taken.
WEIGHTS, MOST = (5, 2, 1), 3
#: Words of a budget that dynamic programming fits; the rest goes by each length's share.
FITTED = 1 << 14
#: Documents of one source and length that are ordered together.
TOGETHER = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes (source, none, source_size) with weight and target.

    Sources by code point, that without a name last, share all words by weight. A target stops at `most` times its
    source's size; what is over is shared anew by weight until none is above. Only sums over sources come to the driver.
    """
    placed = ranked(sizes, ["none", "source"], position="place")
    known = common.checkpoint(placed.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")).drop("place"))
    total = known.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * F.lit(most).cast("long")
    left, weight = total, None
    while True:
        # Sources whose share is above their limit keep it; the others' share only grows.
        full = F.lit(False) if weight is None else limit * F.lit(weight).cast("double") < F.lit(float(left)) * F.col("weight")
        row = known.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        now, now_weight = total - (row[0] or 0), row[1] or 0
        if (now, now_weight) == (left, weight) or not now_weight:
            break
        left, weight = now, now_weight
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1))
    return known.withColumn("target", F.least(share, limit.cast("double")))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: float, fitted: int = FITTED) -> np.ndarray:
    """How many documents of each length (ascending, over 0) to take, so that their words come nearest to the budget.

    Each length first gives its share, rounded down. What is then missing is taken from long to short, one document a
    length, then as many as fit, until at most `fitted` words are left. Those a bounded knapsack fits: of the sums that the
    documents left over can make up to twice the rest, the one nearest to it, of equally near ones the smaller.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total or not total:
        return counts.copy()
    take = np.minimum(np.floor(counts * (budget / total)).astype(np.int64), counts)
    rest = budget - int((lengths * take).sum())
    for one in (True, False):
        for k in range(len(lengths) - 1, -1, -1):
            if rest <= fitted:
                break
            n = min(int(counts[k] - take[k]), int(rest // lengths[k]), 1 if one else total)
            if n > 0:
                take[k] += n
                rest -= n * int(lengths[k])
    free = np.flatnonzero((counts > take) & (lengths < 2 * rest))
    if rest > fitted:  # only documents longer than what is left
        if len(free):
            take[free[0]] += 1
        return take
    take[free] += knapsack(lengths[free], (counts - take)[free], rest)
    return take


def knapsack(lengths: np.ndarray, counts: np.ndarray, rest: float) -> np.ndarray:
    """How many of each length to take so that the sum is nearest to rest; counts are split into powers of two, each an item to take or leave."""
    most = int(2 * rest)
    used = np.zeros(len(lengths), np.int64)
    if rest <= 0 or not len(lengths):
        return used
    reached = np.zeros(most + 1, bool)
    reached[0] = True
    by = np.full(most + 1, -1, np.int64)  # the item that first makes each sum; the sum before it is made by earlier items
    items: list[tuple[int, int]] = []
    for k, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        left, n = min(count, most // length), 1
        while left > 0:
            n = min(n, left)
            wide = n * length
            new = reached[: most + 1 - wide] & ~reached[wide:]
            by[wide:][new] = len(items)
            reached[wide:] |= new
            items.append((k, n))
            left, n = left - n, 2 * n
        if rest == int(rest) and reached[int(rest)]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        k, n = items[by[at]]
        used[k] += n
        at -= n * int(lengths[k])
    return used


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 42) -> DataFrame:
    """A row per input row: doc_id, size, source_size, target (of its source), taken (words the mix takes, repeats counted), passes.

    A document is taken whole, up to `most` times. Each source is taken as often as its target holds it whole; documents for
    the rest are counted by exact length and fitted to it, and of each length those with the least seeded hashes of key and
    text are taken once more. A source is a group of at most sqrt(2 * words) different lengths there, never of documents.
    Documents of a length are ordered in parts of some TOGETHER by their hash, of which only the one that holds the limit is
    sorted. Null texts have no words; a null source is one of its own, after all others; a null key counts like any
    other. Rows equal in key and text are told apart by nothing, so which of them is taken says nothing either. An empty
    table gives none; other columns are left out. Reruns give the same rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = F.col(source_col).cast("string")
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(source, F.lit("")).alias("source"), source.isNull().alias("none"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text).alias("h"),
    )
    docs = common.checkpoint(docs)
    key = ["source", "none"]
    lengths = common.checkpoint(docs.groupBy(*key, "size").agg(F.count("*").alias("n")))
    shares = targets(lengths.groupBy(*key).agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    shares = common.checkpoint(shares.withColumn("passes", whole).withColumn("rest", F.when(F.col("passes") < most, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0)))
    schema = "source string, none boolean, size long, n long, more long, source_size long, target double, passes long"

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        some = pdf["size"].to_numpy() > 0
        more = np.zeros(len(pdf), np.int64)
        more[some] = fit(pdf["size"].to_numpy()[some], pdf["n"].to_numpy()[some], float(pdf["rest"].iloc[0]))
        return pdf.assign(more=more)[["source", "none", "size", "n", "more", "source_size", "target", "passes"]]

    plan = common.checkpoint(lengths.join(shares, key).groupBy(*key).applyInPandas(fitted, schema))
    met = common.joined(docs, plan, [*key, "size"])
    part = F.pmod("h", F.ceil(F.col("n") / TOGETHER))
    split = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    met = met.withColumn("part", F.when(split, part))
    parts = met.where("part IS NOT NULL").groupBy(*key, "size", "part").agg(F.count("*").alias("held"), F.max("more").alias("more"))
    up_to = W.partitionBy(*key, "size").orderBy("part")  # parts of one length, each of some TOGETHER documents
    parts = parts.withColumn("before", F.sum("held").over(up_to) - F.col("held"))
    limits = common.checkpoint(parts.select(*key, "size", "part", F.least(F.greatest(F.col("more") - F.col("before"), F.lit(0)), "held").alias("want"), "held"))
    judged = common.joined(met, limits, [*key, "size", "part"], "left")
    sort = (F.col("want") > 0) & (F.col("want") < F.col("held"))
    plain = judged.where(F.coalesce(~sort, F.lit(True))).withColumn("extra", F.when(F.col("part").isNull(), F.col("more") > 0).otherwise(F.col("want") > 0))
    order = W.partitionBy(*key, "size", "part").orderBy("h", "doc_id")
    sorted_ = judged.where(sort).withColumn("extra", F.row_number().over(order) <= F.col("want"))
    out = plain.unionByName(sorted_).withColumn("passes", F.col("passes") + F.col("extra").cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"), "passes")
