"""Where results go: feature and score tables, and a hook for alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from emberlog.operators.features import INFRA, LOG_FEATURES

COLUMNS = ("runnable", "window_end", "window_end_epoch", *LOG_FEATURES, *INFRA)


def feature_table(vectors: DataFrame) -> DataFrame:
    """The 27 export columns in order; missing infrastructure features are -1, times ISO 8601."""
    out = vectors.withColumns({"window_end_epoch": F.col("t"), "window_end": F.concat(F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))})
    for c in INFRA:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(-1))
    return out.select(*COLUMNS)


def observed(table: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """table with measures that are taken while it's written: the observation's `get` has them afterwards, without another pass.

    Only what is written should be watched: a table that goes into a sort or a join may be read more than once.
    """
    seen = Observation(name)
    return table.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen


def write_features(vectors: DataFrame, path: str, kind: str = "parquet") -> dict:
    """Sorted by time and runnable: ranges of it as Parquet or CSV with header. One file per range; nothing is gathered in one task.

    Returns what the same pass counted: vectors, with_errors, with_infrastructure, first and last time.
    """
    table = feature_table(vectors).orderBy("window_end_epoch", "runnable")
    infra = F.greatest(*[F.col(c).cast("double") for c in INFRA]) > -1
    table, seen = observed(
        table, "features", vectors=F.count("*"), with_errors=F.count_if(F.col("error_count_1h") > 0), with_infrastructure=F.count_if(infra), first=F.min("window_end_epoch"), last=F.max("window_end_epoch"),
    )
    writer = table.write.mode("overwrite")
    writer.option("header", "true").csv(path) if kind == "csv" else writer.parquet(path)
    return seen.get


def write_records(records: DataFrame, path: str) -> dict:
    """Records by runnable as Parquet; returns what the same pass counted: records, errors, with_stack_trace, states, first and last time."""
    table, seen = observed(
        records, "records", records=F.count("*"), errors=F.count_if(F.col("level").isin("ERROR", "FATAL")), with_stack_trace=F.count_if("has_stack_trace"), states=F.count("state"), first=F.min("epoch"), last=F.max("epoch"),
    )
    table.write.mode("overwrite").partitionBy("runnable").parquet(path)
    return seen.get


def read_features(spark, path: str) -> DataFrame:
    """A feature table from CSV, with the timestamp parsed."""
    schema = ", ".join(f"{c} {'string' if c in ('runnable', 'window_end', 'current_state') else 'double' if any(x in c for x in ('delta', 'minutes', 'heap', 'cache', 'duration', 'rate_per')) else 'long'}" for c in COLUMNS)
    return spark.read.option("header", "true").schema(schema).csv(path).withColumns({"t": F.col("window_end_epoch"), "ts": F.timestamp_seconds("window_end_epoch")})


def write_scored(scored: DataFrame, path: str) -> None:
    scored.write.mode("overwrite").partitionBy("runnable").parquet(path)


def deliver(alerts: DataFrame, send: Callable[[str, dict], None]) -> None:
    """Hands each alert to send(channel, alert) in the tasks. Channels only label alerts; what sending means is up to the caller."""

    def run(rows) -> None:
        for r in rows:
            for channel in r["channels"]:
                send(channel, r.asDict())

    alerts.foreachPartition(run)
