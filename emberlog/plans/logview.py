"""Log records made of the events table by projection alone, in Spark and, the same, in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.text import json_field
from emberlog.functions.times import epoch
from emberlog.session import configure

NAMES = ("agent", "zoo_s", "elastic_s", "cdf_s", "cloudsearch_s", "ces_s", "umcadmin_s", "adsadmin_s", "abs_s", "arcm_s", "copernicus_s", "ecp_s", "dashboarding_s", "apg_s", "octopus_s", "loadbalancer_s")
STATES = ("STARTING", "DOWN", "STARTED", "STOPPING", "STOPPED")
PHRASES = (
    "No free database connection for pool ",
    "BUS-10507 cannot load object ",
    "[ZKC] No registered Instance ",
    "Login failed for user BulkExport ",
    "NullPointerException in JobMonitoringTag ",
    "Could not load properties for plugin ",
    "request timed out after ms ",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """runnable, level, message, stack_trace, has_stack_trace, state, epoch, seq."""
    e = read(spark, sf_dir, "events")
    k = json_field(F.col("props"), "k", "int")
    at = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    kind, n = F.col("event_type"), F.col("event_id")
    level = F.when(kind == "error", F.when(F.col("value") > 110, "FATAL").otherwise("ERROR")).when(kind == "signup", "WARN").otherwise("INFO")
    state = F.when(kind == "view", at(STATES, k % len(STATES)))
    message = (
        F.when(kind == "error", F.concat(at(PHRASES, n % len(PHRASES)), n.cast("string")))
        .when(kind == "signup", F.concat(F.lit("slow request "), n.cast("string")))
        .when(kind == "view", F.concat(F.lit("State change: UNKNOWN -> "), state))
        .otherwise(F.when(n % 50 == 0, F.lit("Getting RuntimeMXBean")).otherwise(F.concat(F.lit("done "), n.cast("string"))))
    )
    stack = F.when((kind == "error") & (k % 3 == 0), F.lit("java.lang.NullPointerException\n\tat JobMonitoringTag.run(Tag.java:1)"))
    return e.select(at(NAMES, F.col("user_id") % len(NAMES)).alias("runnable"), level.alias("level"), message.alias("message"), stack.alias("stack_trace"), stack.isNotNull().alias("has_stack_trace"), state.alias("state"), epoch(F.col("ts")).alias("epoch"), n.alias("seq"))


def quoted(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


SQL = f"""
raw AS (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events),
logs0 AS (
    SELECT {quoted(NAMES)}[user_id % {len(NAMES)} + 1] AS runnable,
           CASE WHEN event_type = 'error' THEN CASE WHEN value > 110 THEN 'FATAL' ELSE 'ERROR' END WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
           CASE WHEN event_type = 'view' THEN {quoted(STATES)}[k % {len(STATES)} + 1] END AS state,
           CASE WHEN event_type = 'error' AND k % 3 = 0 THEN 'java.lang.NullPointerException' || chr(10) || chr(9) || 'at JobMonitoringTag.run(Tag.java:1)' END AS stack_trace,
           event_type, event_id AS seq, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch
    FROM raw),
logs AS (
    SELECT runnable, level,
           CASE WHEN event_type = 'error' THEN {quoted(PHRASES)}[seq % {len(PHRASES)} + 1] || CAST(seq AS VARCHAR) WHEN event_type = 'signup' THEN 'slow request ' || CAST(seq AS VARCHAR)
                WHEN event_type = 'view' THEN 'State change: UNKNOWN -> ' || state WHEN seq % 50 = 0 THEN 'Getting RuntimeMXBean' ELSE 'done ' || CAST(seq AS VARCHAR) END AS message,
           stack_trace, stack_trace IS NOT NULL AS has_stack_trace, state, epoch, seq
    FROM logs0)
"""
