"""Reports over feature vectors and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of(vectors: DataFrame, features: tuple[str, ...], test: str = "> 0", key: str = "runnable") -> DataFrame:
    """(key, feature, pct): percentage of each key's vectors in which the feature passes a test: > 0, <> 0 or <> -1."""
    aggs = [(F.avg(F.expr(f"CAST({f} {test} AS DOUBLE)")) * 100).alias(f) for f in features]
    wide = vectors.groupBy(key).agg(*aggs)
    return wide.unpivot([key], list(features), "feature", "pct")


def correlated_pairs(vectors: DataFrame, features: tuple[str, ...], least: float = 0.9) -> DataFrame:
    """(a, b, r) of feature pairs whose correlation is beyond the least, by one aggregation for all pairs."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    one = vectors.agg(*[F.corr(a, b).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{k}").alias("r")) for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(rows).alias("p")).select("p.*").where(~F.isnan("r") & (F.abs("r") > least))


def by_hour(vectors: DataFrame, value: str, t: str = "t") -> DataFrame:
    """(hour, total) for all 24 hours of the day, UTC."""
    hours = vectors.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    sums = vectors.groupBy(F.hour(F.timestamp_seconds(t)).alias("hour")).agg(F.sum(value).alias("total"))
    return hours.join(sums, "hour", "left").select("hour", F.coalesce("total", F.lit(0)).alias("total"))


def by_weekday(vectors: DataFrame, value: str, t: str = "t") -> DataFrame:
    """(weekday, total); Monday is 0."""
    return vectors.groupBy(F.weekday(F.timestamp_seconds(t)).alias("weekday")).agg(F.sum(value).alias("total"))


def bad_days(vectors: DataFrame, runnable: str, value: str = "error_count_5m", least: int = 5, t: str = "t") -> DataFrame:
    """(day, own, others) of the days on which one runnable has more than so many errors; others as a list by falling sum."""
    rows = vectors.withColumn("day", F.to_date(F.timestamp_seconds(t)))
    sums = rows.groupBy("day", "runnable").agg(F.sum(value).alias("n"))
    days = sums.where((F.col("runnable") == runnable) & (F.col("n") > least)).select("day", F.col("n").alias("own"))
    rest = sums.where((F.col("runnable") != runnable) & (F.col("n") > 0)).join(days.select("day"), "day", "left_semi")
    # At most a row per runnable and day.
    listed = rest.groupBy("day").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "runnable"))).alias("l"))
    text = F.array_join(F.transform("l", lambda x: F.concat(x["runnable"], F.lit("="), (-x["m"]).cast("string"))), ", ")
    return days.join(listed, "day", "left").select(F.col("day").cast("string").alias("day"), "own", F.coalesce(text, F.lit("")).alias("others"))


def crash_validation(scored: DataFrame, crashes: DataFrame, score: str = "score", label: str = "label", t: str = "t") -> DataFrame:
    """Per crash and phase (pre, peak): vectors, anomalies and their percentage, greatest and mean score, first alert, minutes from it to the peak's end.

    crashes: name, pre_start, pre_end, peak_start, peak_end as epochs; a list of bounded length that is sent to all tasks.
    """
    phases = crashes.select("name", F.col("peak_start").alias("peak"), F.explode(F.array(F.struct(F.lit("pre").alias("phase"), F.col("pre_start").alias("lo"), F.col("pre_end").alias("hi")), F.struct(F.lit("peak").alias("phase"), F.col("peak_start").alias("lo"), F.col("peak_end").alias("hi")))).alias("p")).select("name", "peak", "p.*")
    met = scored.join(F.broadcast(phases), F.col(t).between(F.col("lo"), F.col("hi")))
    first = F.min(F.when(F.col(label) == -1, F.col(t)))
    out = met.groupBy("name", "phase").agg(F.count("*").alias("n"), F.count_if(F.col(label) == -1).alias("anomalies"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score"), first.alias("first_alert"), F.max("peak").alias("peak"))
    return out.select("name", "phase", "n", "anomalies", (F.col("anomalies") * 100.0 / F.col("n")).alias("anomaly_pct"), "max_score", "mean_score", "first_alert", ((F.col("peak") - F.col("first_alert")) / 60.0).alias("lead_minutes"))


def agreement(a: Column, b: Column) -> list[Column]:
    """both, either and Jaccard percentage of two flags."""
    both, either = F.count_if(a & b), F.count_if(a | b)
    return [both.alias("both"), either.alias("either"), F.when(either > 0, both * 100.0 / either).otherwise(0.0).alias("jaccard_pct")]


def recall_curve(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """(threshold, share of rows at or over it) for 0, 5, ... 95, by one aggregation."""
    cuts = list(range(0, 100, 5))
    one = scored.agg(*[F.avg((F.col(score) >= c).cast("double")).alias(f"c{c}") for c in cuts])
    rows = F.array(*[F.struct(F.lit(c).alias("threshold"), F.col(f"c{c}").alias("recall")) for c in cuts])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def shape(vectors: DataFrame, t: str = "t") -> DataFrame:
    return vectors.groupBy("runnable").agg(F.count("*").alias("vectors"), F.count_distinct("current_state").alias("states"), F.min(t).alias("first"), F.max(t).alias("last"))


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def largest_incidents(found: DataFrame, n: int = 10) -> DataFrame:
    """The n incidents with most detections; of equal ones the earliest, then by rules and root cause."""
    return found.orderBy(F.desc("detection_count"), "created", F.array_join("rules_involved", ","), "root_cause_runnable", "incident_id").limit(n)


def first_levels(scored: DataFrame, key: str = "runnable", t: str = "t") -> DataFrame:
    """(key, first_red, first_yellow, lead_minutes): the first vector of each level; null for a level that a key never has."""
    first = lambda name: F.min(F.when(F.col("risk_level") == name, F.col(t)))
    out = scored.groupBy(key).agg(first("RED").alias("first_red"), first("YELLOW").alias("first_yellow"))
    return out.withColumn("lead_minutes", (F.col("first_red") - F.col("first_yellow")) / 60.0)


def scores_around(scored: DataFrame, moments: DataFrame, seconds: int, key: str = "runnable", t: str = "t") -> DataFrame:
    """Scored rows at most so many seconds from a moment (key, at), with their offset to it; a join on key and time bucket."""
    bucket = lambda c: F.floor(c / seconds)
    near = moments.select(key, "at", F.explode(F.sequence(bucket(F.col("at")) - 1, bucket(F.col("at")) + 1)).alias("__b"))
    met = scored.withColumn("__b", bucket(F.col(t))).join(near, [key, "__b"])
    return met.withColumn("offset", F.col(t) - F.col("at")).where(F.abs("offset") <= seconds).drop("__b", "at")


def files_by_runnable(discovered: DataFrame) -> DataFrame:
    """(runnable, files, size_mb) of discovered log files."""
    return discovered.groupBy(F.coalesce("runnable_hint", F.lit("unknown")).alias("runnable")).agg(F.count("*").alias("files"), F.sum("size_mb").alias("size_mb"))


def index_by_runnable(records: DataFrame) -> DataFrame:
    """Per runnable: records, errors, state changes, restarts, distinct times, first and last time."""
    return records.groupBy("runnable").agg(
        F.count("*").alias("records"), F.count_if(F.col("level").isin("ERROR", "FATAL")).alias("errors"), F.count("state").alias("states"), F.count_if(F.col("state") == "STARTING").alias("restarts"),
        F.count_distinct("epoch").alias("distinct_epochs"), F.min("epoch").alias("first"), F.max("epoch").alias("last"),
    )


def index_stats(records: DataFrame, gauges: DataFrame, timers: DataFrame) -> DataFrame:
    """One row: runnables, records, metrics, their datapoints, distinct times of records, state changes, first and last time."""
    logs = records.agg(
        F.count_distinct("runnable").alias("runnables"), F.count("*").alias("records"), F.count_distinct("epoch").alias("distinct_epochs"), F.count("state").alias("state_changes"), F.min("epoch").alias("first"), F.max("epoch").alias("last"),
    )
    points = gauges.select("metric", "t").unionByName(timers.select("metric", "t")).agg(F.count_distinct("metric").alias("metrics"), F.count("*").alias("datapoints"))
    return logs.crossJoin(points)  # a row each
