"""Risk scores: scaling, rescaling, levels, explanations, ranks, and a linear reconstruction model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Features of the model in order; the state's risk comes last.
FEATURES = (
    "error_count_5m", "error_count_1h", "fatal_count_1h", "warn_count_1h", "distinct_errors_5m", "error_rate_delta", "has_stack_trace_5m", "state_transitions_1h", "restarts_24h",
    "pool_exhaustion_count_5m", "bus_error_count_5m",
)
PER_RUNNABLE_FEATURES = (*FEATURES, "zkc_error_count_5m")
#: Risk of states, for the general model and for the models by runnable; others are 1.
STATE_RISK = {"STARTED": 0, "STOPPED": 1, "STOPPING": 2, "STARTING": 3, "DOWN": 4, "FAILED": 5, "UNKNOWN": 1, "DEACTIVATED": 0, "RECONFIGURING": 2, "UPDATING": 2}
STATE_RISK_PER_RUNNABLE = {"STARTED": 0, "UNKNOWN": 1, "STARTING": 3, "STOPPING": 4, "STOPPED": 5, "FAILED": 8, "DEACTIVATED": 2, "INOPERATIVE": 10}
RED, YELLOW = 70, 30
EXPLAINED, TOP = 0.5, 5


def state_risk(state: Column, table: Mapping[str, int] = STATE_RISK) -> Column:
    return F.coalesce(F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])[state], F.lit(1))


def matrix(vectors: DataFrame, features: tuple[str, ...] = FEATURES, states: Mapping[str, int] = STATE_RISK, missing_to_zero: bool = True) -> DataFrame:
    """vectors with x, an array of doubles: the features and the state's risk. -1 stands for missing and becomes 0, also where a value is -1 by itself."""
    value = lambda c: F.when(F.col(c) == -1, F.lit(0.0)).otherwise(F.col(c).cast("double")) if missing_to_zero else F.col(c).cast("double")
    return vectors.withColumn("x", F.array(*[value(c) for c in features], state_risk(F.col("current_state"), states).cast("double")))


def scaler(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(i, name, mean, std) of each feature of x: the population's; a constant feature has std 1."""
    aggs = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(len(names)) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    one = rows.agg(*aggs)
    parts = [F.struct(F.lit(i).alias("i"), F.lit(n).alias("name"), F.col(f"m{i}").alias("mean"), F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")).alias("std")) for i, n in enumerate(names)]
    return one.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def zscores(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """rows with z, by a fitted scaler: one row of parameters that goes along as a broadcast of fixed size."""
    params = fitted.agg(F.array_sort(F.collect_list(F.struct("i", "mean", "std"))).alias("__p"))
    out = rows.crossJoin(F.broadcast(params))  # one row on that side
    return out.withColumn("z", F.zip_with("x", "__p", lambda x, p: (x - p["mean"]) / p["std"])).drop("__p")


def scaler_by(rows: DataFrame, names: tuple[str, ...], by: str = "runnable") -> DataFrame:
    """(by, mean, std), arrays over the features of x, of each key: the population's; a constant feature has std 1."""
    std = lambda i: F.stddev_pop(F.col("x")[i])
    means, stds = ([f(i) for i in range(len(names))] for f in (lambda i: F.avg(F.col("x")[i]), std))
    return rows.groupBy(by).agg(F.array(*means).alias("mean"), F.transform(F.array(*stds), lambda s: F.when(s == 0, 1.0).otherwise(s)).alias("std"))


def zscores_by(rows: DataFrame, fitted: DataFrame, by: str = "runnable") -> DataFrame:
    """rows with z, by the scaler of each key."""
    met = rows.join(fitted, by)
    return met.withColumn("z", F.transform("x", lambda x, i: (x - F.col("mean")[i]) / F.col("std")[i])).drop("mean", "std")


def exact_percentiles(rows: DataFrame, value: Column, shares: tuple[float, ...], buckets: int = 4096) -> list[float | None]:
    """Percentiles with linear interpolation, over all rows and exact, without gathering them.

    Buckets of equal width are counted; only the few that hold a wanted rank are looked into, value by value, so the last
    step sees about one of `buckets` parts of the values. Null and not-a-number are left out; without values: None.
    """
    v = rows.select(value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)").persist()
    n, lo, hi = v.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n or lo == hi:
        v.unpersist()
        return [lo] * len(shares)
    place = F.least(F.floor((F.col("v") - lo) / ((hi - lo) / buckets)), F.lit(buckets - 1)).cast("int").alias("b")
    counts = sorted((r["b"], r["count"]) for r in v.groupBy(place).count().collect())  # at most `buckets` rows
    starts, total = {}, 0
    for b, c in counts:
        starts[b] = total
        total += c
    ranks = sorted({r for p in shares for h in [p * (n - 1)] for r in (int(h), min(int(h) + 1, n - 1))})
    inside = {r: max((b for b in starts if starts[b] <= r), key=lambda b: starts[b]) for r in ranks}
    some = v.select("v", place).where(F.col("b").isin(sorted(set(inside.values())))).groupBy("b", "v").count()
    before = F.sum("count").over(W.partitionBy("b").orderBy("v")) - F.col("count")
    met = some.select("b", "v", "count", before.alias("before"))
    hit = F.lit(False)
    for r, b in inside.items():
        hit = hit | ((F.col("b") == b) & (F.col("before") + starts[b] <= r) & (F.lit(r) < F.col("before") + starts[b] + F.col("count")))
    found = met.where(hit).collect()
    v.unpersist()
    at = {r: next(x["v"] for x in found if x["b"] == b and x["before"] + starts[b] <= r < x["before"] + starts[b] + x["count"]) for r, b in inside.items()}
    return [at[int(h)] + (at[min(int(h) + 1, n - 1)] - at[int(h)]) * (h - int(h)) for h in (p * (n - 1) for p in shares)]


def percentiles_by(rows: DataFrame, value: Column, shares: tuple[float, ...], by: list[str], buckets: int = 4096) -> DataFrame:
    """(by..., p0, p1, ...): percentiles of each key with linear interpolation, exact, without holding a key's values.

    As exact_percentiles, with each key's own buckets. Null and not-a-number are left out; a key without values has no row.
    """
    key = F.struct(*by).alias("k")
    v = rows.select(key, value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    ends = v.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / buckets
    bucket = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / F.when(width == 0, 1.0).otherwise(width)), F.lit(buckets - 1))).cast("int")
    # Equal values are counted before they are shuffled by key.
    placed = v.groupBy("k", "v").agg(F.count("*").alias("c")).join(ends, "k").withColumn("b", bucket)
    counted = placed.groupBy("k", "b", "n").agg(F.sum("c").alias("c"))
    counted = counted.withColumn("start", F.sum("c").over(W.partitionBy("k").orderBy("b")) - F.col("c"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"), F.least(F.floor(p * (F.col("n") - 1)) + int(up), F.col("n") - 1).alias("r")) for i, p in enumerate(shares) for up in (False, True)])
    wanted = counted.select("k", "b", "start", "c", F.explode(ranks).alias("w")).where("w.r >= start AND w.r < start + c").select("k", "b", "start", "w.*")
    some = placed.select("k", "b", "v", "c", "n").join(wanted.select("k", "b").distinct(), ["k", "b"], "left_semi")
    some = some.withColumn("before", F.sum("c").over(W.partitionBy("k", "b").orderBy("v")) - F.col("c"))
    hit = some.join(wanted, ["k", "b"]).where("r >= start + before AND r < start + before + c")
    at = lambda i, up: F.max(F.when((F.col("i") == i) & (F.col("up") == up), F.col("v")))
    part = lambda p: p * (F.col("n") - 1) - F.floor(p * (F.col("n") - 1))
    out = hit.groupBy("k", "n").agg(*[at(i, up).alias(f"v{i}_{int(up)}") for i in range(len(shares)) for up in (False, True)])
    return out.select("k.*", *[(F.col(f"v{i}_0") + (F.col(f"v{i}_1") - F.col(f"v{i}_0")) * part(p)).alias(f"p{i}") for i, p in enumerate(shares)])


def normalised(rows: DataFrame, score: str = "score", by: list[str] | None = None) -> DataFrame:
    """Adds risk_score, 0 to 100, between the 1st and 99th percentile of -score in the batch (or key); 0 for all if these are equal."""
    neg = -F.col(score)
    if by:
        bounds = percentiles_by(rows, neg, (0.01, 0.99), by).withColumnsRenamed({"p0": "__lo", "p1": "__hi"})
        joined = rows.join(bounds, by)
    else:
        lo, hi = exact_percentiles(rows, neg, (0.01, 0.99))
        joined = rows.withColumns({"__lo": F.lit(lo).cast("double"), "__hi": F.lit(hi).cast("double")})
    spread = F.col("__hi") - F.col("__lo")
    value = F.when(spread < 1e-10, 0.0).otherwise(F.least(F.greatest((neg - F.col("__lo")) / F.when(spread < 1e-10, 1.0).otherwise(spread) * 100, F.lit(0.0)), F.lit(100.0)))
    return joined.withColumn("risk_score", value).withColumn("risk_level", level(F.col("risk_score"))).drop("__lo", "__hi")


def level(score: Column) -> Column:
    return F.when(score >= RED, "RED").when(score >= YELLOW, "YELLOW").otherwise("GREEN")


def top_features(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Adds top_features: of the five largest |z| those over 0.5, largest first, of those equal to nine digits the later feature first."""
    label = F.array(*[F.lit(n) for n in names])
    each = F.transform("z", lambda z, i: F.struct(F.round(F.abs(z), 9).alias("d"), i.alias("i")))
    ordered = F.slice(F.reverse(F.array_sort(each)), 1, TOP)
    out = F.transform(F.filter(ordered, lambda e: e["d"] > EXPLAINED), lambda e: F.struct(F.element_at(label, e["i"] + 1).alias("feature"), F.element_at("x", e["i"] + 1).alias("value"), F.element_at("z", e["i"] + 1).alias("deviation_std")))
    return rows.withColumn("top_features", out)


def risk_stats(scored: DataFrame) -> DataFrame:
    share = lambda name: F.count_if(F.col("risk_level") == name)
    return scored.agg(F.count("*").alias("n"), F.avg("risk_score").alias("mean_score"), F.max("risk_score").alias("max_score"), share("RED").alias("red"), share("YELLOW").alias("yellow"), share("GREEN").alias("green"), (share("RED") * 100.0 / F.count("*")).alias("red_pct"))


def percent_ranks(rows: DataFrame, score: str, by: list[str], name: str = "score", buckets: int = 4096) -> DataFrame:
    """rows with 100 less the mean percentage of values below and at or below, over the values of the key; null for a null score.

    Equal values are counted first. Each key's values are dealt out by buckets of equal width: a value's rank is the number
    of values in the buckets before it and its place among its bucket's, so no key is sorted whole.
    """
    v = rows.where(F.col(score).isNotNull()).groupBy(F.struct(*by).alias("__k"), F.col(score).cast("double").alias("__v")).agg(F.count("*").alias("c"))
    ends = v.groupBy("__k").agg(F.sum("c").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / buckets
    bucket = F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("lo")) / F.when(width > 0, width).otherwise(1.0)), F.lit(buckets - 1))).otherwise(0).cast("int")
    placed = v.join(ends, "__k").withColumn("b", bucket)
    starts = placed.groupBy("__k", "b").agg(F.sum("c").alias("m")).withColumn("start", F.sum("m").over(W.partitionBy("__k").orderBy("b")) - F.col("m")).drop("m")
    upto = F.sum("c").over(W.partitionBy("__k", "b").orderBy("__v"))
    ranks = placed.withColumn("upto", upto).join(starts, ["__k", "b"]).withColumn("upto", F.col("upto") + F.col("start"))
    value = F.lit(100.0) - (2 * F.col("upto") - F.col("c") + 1) * 50.0 / F.col("n")
    ranks = ranks.select("__k", "__v", value.alias("__rank"))
    keyed = rows.withColumns({"__k": F.struct(*by), "__v": F.col(score).cast("double")})
    return keyed.join(ranks, keyed["__k"].eqNullSafe(ranks["__k"]) & (keyed["__v"] == ranks["__v"]), "left").drop(ranks["__k"]).drop(ranks["__v"]).withColumn(name, F.col("__rank")).drop("__k", "__v", "__rank")


def min_max(rows: DataFrame, value: str, by: list[str], name: str = "score") -> DataFrame:
    """rows with 0 to 100 between least and greatest of the key; 0 for all if these are equal."""
    ends = rows.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    wide = F.col("__hi") - F.col("__lo")
    share = F.when(wide < 1e-10, 0.0).otherwise((F.col(value) - F.col("__lo")) / F.when(wide < 1e-10, 1.0).otherwise(wide) * 100)
    return rows.join(ends, by).withColumn(name, share).drop("__lo", "__hi")


def reconstruction(rows: DataFrame, k: int = 6, by: str = "runnable", names: int = len(PER_RUNNABLE_FEATURES) + 1) -> DataFrame:
    """Adds error: mean squared distance of z from its projection on the k main directions of its key.

    A linear stand-in for an autoencoder with k units in the middle. Directions come from each key's moments, which are
    sums over its rows; only these, names squared per key, meet in one place.
    """
    import numpy as np
    import pandas as pd

    sums = [F.sum(F.col("z")[i]).alias(f"s{i}") for i in range(names)] + [F.sum(F.col("z")[i] * F.col("z")[j]).alias(f"p{i}_{j}") for i in range(names) for j in range(i, names)]
    moments = rows.groupBy(by).agg(F.count("*").alias("n"), *sums)

    def directions(batches):
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                mean = np.array([r[f"s{i}"] for i in range(names)]) / r["n"]
                second = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(names)] for i in range(names)]) / r["n"]
                vectors = np.linalg.eigh(second - np.outer(mean, mean))[1][:, ::-1][:, :k]
                out.append((r[by], mean.tolist(), (vectors @ vectors.T).ravel().tolist()))
            yield pd.DataFrame(out, columns=[by, "__mean", "__projection"])

    fitted = moments.mapInPandas(directions, f"{by} string, __mean array<double>, __projection array<double>")
    joined = rows.join(fitted, by)
    c = F.zip_with("z", "__mean", lambda a, m: a - m)
    joined = joined.withColumn("__c", c)
    back = lambda i: F.aggregate(F.zip_with("__c", F.slice("__projection", i * names + 1, names), lambda a, p: a * p), F.lit(0.0), lambda s, v: s + v)
    error = F.aggregate(F.transform("__c", lambda v, i: F.pow(v - back(i), F.lit(2.0))), F.lit(0.0), lambda s, v: s + v) / names
    return joined.withColumn("error", error).drop("__mean", "__projection", "__c")


def over_percentile(rows: DataFrame, value: str = "error", q: float = 0.97, by: str = "runnable") -> DataFrame:
    """Adds threshold, label (-1 over the key's percentile, else 1) and score (0 to 100 between least and greatest)."""
    cut = percentiles_by(rows, F.col(value), (q,), [by]).withColumnRenamed("p0", "threshold")
    out = min_max(rows, value, [by]).join(cut, by)
    return out.withColumn("label", F.when(F.col(value) > F.col("threshold"), -1).otherwise(1))
