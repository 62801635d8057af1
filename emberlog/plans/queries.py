"""Queries of the log engine over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions.text import message_hash
from emberlog.operators import detect, features, throttle, windows
from emberlog.operators.detect import Catalogue, Escalation, Rule
from emberlog.plans.logview import SQL as LOGS
from emberlog.plans.logview import log_view

Query = Callable[[SparkSession, str], DataFrame]
STEP = 300

#: Rules with windows that suit the sparse test events.
RULES = Catalogue(
    (
        Rule("T1", "pool", "KEYWORD", "CRITICAL", "No free database connection", level_filter=("ERROR", "FATAL"), frequency_escalation=Escalation(2, 1440, "P1")),
        Rule("T2", "load", "REGEX", "HIGH", "bus-10507.*cannot load", level_filter=("ERROR",), frequency_escalation=Escalation(3, 2880, "CRITICAL")),
        Rule("T3", "null pointer", "REGEX", "HIGH", "NullPointerException.*JobMonitoringTag", level_filter=("ERROR",), match_stack_trace=True),
        Rule("T4", "instance", "KEYWORD", "LOW", "[ZKC] No registered Instance"),
        Rule("T5", "slow", "KEYWORD", "MEDIUM", "slow request", runnable_filter=("abs_s", "arcm_s", "zoo_s"), level_filter=("WARN",)),
        Rule("Q1", "down after start", "STATE_SEQUENCE", "HIGH", state_sequence=("STARTED", "DOWN"), window_minutes=1440, no_followup_state="STARTING"),
    )
)


def q_log_view(spark: SparkSession, d: str) -> DataFrame:
    return log_view(spark, d)


def q_time_grid(spark: SparkSession, d: str) -> DataFrame:
    return windows.time_grid(log_view(spark, d), step=STEP).groupBy("runnable").agg(F.count("*").alias("points"), F.min("t").alias("first"), F.max("t").alias("last"))


def q_feature_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: every runnable's log features on its grid."""
    return features.log_vectors(log_view(spark, d), STEP)


def q_window_counts(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d)
    w = windows.GridWindows(logs, windows.time_grid(logs), features.measures())
    return w.select(error_5m=w.count("error", 300), error_1h=w.count("error", 3600), restart_24h=w.count("restart", 86400)).where("error_5m > 0 OR error_1h > 0 OR restart_24h > 0")


def q_meaningful_baseline(spark: SparkSession, d: str) -> DataFrame:
    v = features.log_vectors(log_view(spark, d), STEP)
    return features.thinned(v).select("runnable", "t", "error_count_1h", "current_state", "baseline")


def q_state_asof(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d)
    states = logs.where("state IS NOT NULL").select("runnable", "epoch", "seq", F.col("state").alias("last_state"))
    errors = logs.where("level = 'ERROR'").select("runnable", "epoch", F.col("seq").alias("id"))
    return windows.as_of(errors, states, ["runnable"], "epoch", "last_state")


def q_gauge_tolerance(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d)
    gauge = logs.where("level = 'INFO'").groupBy(F.col("epoch").alias("t")).agg(F.min("seq").cast("double").alias("value"))
    probes = logs.where("level = 'ERROR'").select((F.floor(F.col("epoch") / 60) * 60).cast("long").alias("t")).distinct()
    return windows.within_tolerance(probes, gauge, [], "t", "value", 30)


def q_rule_match(spark: SparkSession, d: str) -> DataFrame:
    return detect.match_rules(log_view(spark, d), RULES).select("rule_id", "severity", "runnable", "epoch", "seq")


def q_rule_stats(spark: SparkSession, d: str) -> DataFrame:
    return detect.match_rules(log_view(spark, d), RULES).groupBy("rule_id", "severity").agg(F.count("*").alias("n"), F.count_distinct("runnable").alias("runnables"))


def q_freq_escalation(spark: SparkSession, d: str) -> DataFrame:
    return detect.escalate(detect.match_rules(log_view(spark, d), RULES), RULES).select("rule_id", "runnable", "epoch", "seq", "match_count", "escalated", "original_severity", "severity")


def q_state_sequence(spark: SparkSession, d: str) -> DataFrame:
    states = log_view(spark, d).where("state IS NOT NULL")
    return detect.state_sequences(states, RULES.rules[-1]).select("rule_id", "runnable", "epoch", "seq")


def q_no_followup(spark: SparkSession, d: str) -> DataFrame:
    return detect.no_followup(log_view(spark, d), RULES.rules[-1]).select("rule_id", "runnable", "epoch", "seq", "detected_epoch")


def q_throttle_cooldown(spark: SparkSession, d: str) -> DataFrame:
    hits = detect.match_rules(log_view(spark, d), RULES).select("rule_id", "runnable", "epoch", "seq")
    return throttle.throttle(hits, ["rule_id", "runnable"], 6 * 3600)


def q_message_groups(spark: SparkSession, d: str) -> DataFrame:
    errors = log_view(spark, d).where("level IN ('ERROR', 'FATAL')")
    return errors.groupBy(message_hash(F.col("message")).alias("message_hash")).agg(F.count("*").alias("n"), F.count_distinct("runnable").alias("runnables"))


QUERIES: dict[str, Query] = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

VECTORS = f"""
ends AS (SELECT runnable, min(epoch) AS lo, max(epoch) AS hi FROM logs GROUP BY runnable),
grid AS (SELECT runnable, unnest(generate_series((lo // 300) * 300 + 300, hi, 300)) AS t FROM ends WHERE lo < hi),
marked AS (SELECT *, CAST(level IN ('ERROR', 'FATAL') AS INT) AS err, CAST(coalesce(state = 'STARTING', false) AS INT) + CAST(contains(message, 'Getting RuntimeMXBean') AS INT) AS restart FROM logs),
hourly AS (
    SELECT g.runnable, g.t,
           count(*) FILTER (err = 1 AND epoch >= g.t - 300) AS error_count_5m,
           count(*) FILTER (err = 1) AS error_count_1h,
           count(*) FILTER (level = 'FATAL') AS fatal_count_1h,
           count(*) FILTER (level = 'WARN') AS warn_count_1h,
           count(DISTINCT CASE WHEN err = 1 AND epoch >= g.t - 300 THEN regexp_replace(message, '([^0-9])[0-9]+$', '\\1N') END) AS distinct_errors_5m,
           count(*) FILTER (err = 1 AND epoch BETWEEN g.t - 600 AND g.t - 301) AS previous,
           count(*) FILTER (has_stack_trace AND epoch >= g.t - 300) AS has_stack_trace_5m,
           count(*) FILTER (state IS NOT NULL) AS state_transitions_1h,
           count(*) FILTER (contains(message, 'No free database connection') AND epoch >= g.t - 300) AS pool_exhaustion_count_5m,
           count(*) FILTER (contains(message, 'BUS-') AND epoch >= g.t - 300) AS bus_error_count_5m,
           count(*) FILTER (contains(message, 'No registered Instance') AND epoch >= g.t - 300) AS zkc_error_count_5m
    FROM grid g LEFT JOIN marked m ON m.runnable = g.runnable AND m.epoch BETWEEN g.t - 3600 AND g.t GROUP BY g.runnable, g.t),
daily AS (SELECT g.runnable, g.t, CAST(coalesce(sum(restart), 0) AS BIGINT) AS restarts_24h FROM grid g LEFT JOIN marked m ON m.runnable = g.runnable AND restart > 0 AND m.epoch BETWEEN g.t - 86400 AND g.t GROUP BY g.runnable, g.t),
state_at AS (SELECT runnable, epoch, arg_max(state, seq) AS state FROM logs WHERE state IS NOT NULL GROUP BY runnable, epoch),
restart_at AS (SELECT DISTINCT runnable, epoch FROM marked WHERE restart > 0),
vectors AS (
    SELECT h.runnable, h.t, error_count_5m, error_count_1h, fatal_count_1h, warn_count_1h, distinct_errors_5m,
           CAST(error_count_5m - previous AS DOUBLE) / greatest(previous, 1) AS error_rate_delta, has_stack_trace_5m, coalesce(s.state, 'UNKNOWN') AS current_state, state_transitions_1h, restarts_24h,
           CASE WHEN r.epoch IS NULL THEN -1.0::DOUBLE ELSE (h.t - r.epoch) / 60.0::DOUBLE END AS minutes_since_last_restart, pool_exhaustion_count_5m, bus_error_count_5m, zkc_error_count_5m
    FROM hourly h JOIN daily USING (runnable, t)
    ASOF LEFT JOIN state_at s ON s.runnable = h.runnable AND s.epoch <= h.t
    ASOF LEFT JOIN restart_at r ON r.runnable = h.runnable AND r.epoch <= h.t)
"""

MATCHES = """
rules(rule_id, severity, ord) AS (VALUES ('T1', 'CRITICAL', 2), ('T4', 'LOW', 3), ('T5', 'MEDIUM', 4), ('T2', 'HIGH', 5), ('T3', 'HIGH', 6)),
matches AS (
    SELECT rule_id, severity, logs.* FROM logs, rules WHERE
        (rule_id = 'T1' AND level IN ('ERROR', 'FATAL') AND contains(message, 'No free database connection'))
        OR (rule_id = 'T2' AND level = 'ERROR' AND regexp_matches(message, '(?is)bus-10507.*cannot load'))
        OR (rule_id = 'T3' AND level = 'ERROR' AND (regexp_matches(message, '(?is)NullPointerException.*JobMonitoringTag') OR coalesce(regexp_matches(stack_trace, '(?is)NullPointerException.*JobMonitoringTag'), false)))
        OR (rule_id = 'T4' AND contains(message, '[ZKC] No registered Instance'))
        OR (rule_id = 'T5' AND runnable IN ('abs_s', 'arcm_s', 'zoo_s') AND level = 'WARN' AND contains(message, 'slow request')))
"""
THROTTLE = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {time}, {seq}) AS i FROM {rows}),
walk AS (
    SELECT {keys}, {seq}, {time}, i, {time} AS last, true AS kept FROM numbered WHERE i = 1
    UNION ALL SELECT {nkeys}, n.{seq}, n.{time}, n.i, CASE WHEN n.{time} - w.last >= {gap} THEN n.{time} ELSE w.last END, n.{time} - w.last >= {gap} FROM walk w JOIN numbered n ON {on} AND n.i = w.i + 1)
"""


def throttle_sql(rows: str, keys: tuple[str, ...], time: str, seq: str, gap: int) -> str:
    return THROTTLE.format(rows=rows, keys=", ".join(keys), nkeys=", ".join(f"n.{k}" for k in keys), on=" AND ".join(f"n.{k} = w.{k}" for k in keys), time=time, seq=seq, gap=gap)


MEANINGFUL = "error_count_5m > 0 OR error_count_1h > 0 OR fatal_count_1h > 0 OR state_transitions_1h > 0 OR restarts_24h > 0 OR pool_exhaustion_count_5m > 0 OR current_state NOT IN ('STARTED', 'UNKNOWN')"

FLUSHED = """downs AS (SELECT * FROM logs WHERE state = 'DOWN' QUALIFY row_number() OVER (PARTITION BY runnable ORDER BY epoch DESC, seq DESC) = 1),
flushed AS (SELECT d.runnable, d.epoch, d.seq, e.detected_epoch FROM downs d, (SELECT max(epoch) AS detected_epoch FROM logs) e WHERE e.detected_epoch - d.epoch >= 86400
    AND NOT EXISTS (SELECT 1 FROM logs f WHERE f.runnable = d.runnable AND f.state = 'STARTING' AND f.epoch > d.epoch))"""

ORACLE: dict[str, str] = {
    "q_log_view": f"WITH {LOGS} SELECT * FROM logs",
    "q_time_grid": f"WITH {LOGS}, {VECTORS} SELECT runnable, count(*) AS points, min(t) AS first, max(t) AS last FROM grid GROUP BY runnable",
    "q_feature_vectors": f"WITH {LOGS}, {VECTORS} SELECT * FROM vectors",
    "q_window_counts": f"""WITH {LOGS}, {VECTORS} SELECT runnable, t, error_count_5m AS error_5m, error_count_1h AS error_1h, restarts_24h AS restart_24h FROM vectors
        WHERE error_count_5m > 0 OR error_count_1h > 0 OR restarts_24h > 0""",
    "q_meaningful_baseline": f"""WITH RECURSIVE {LOGS}, {VECTORS}, quiet AS (SELECT runnable, t FROM vectors WHERE NOT ({MEANINGFUL})), {throttle_sql("quiet", ("runnable",), "t", "t", 3600).replace("runnable, t, t, i", "runnable, t, i").replace("n.runnable, n.t, n.t,", "n.runnable, n.t,")}
        SELECT v.runnable, v.t, error_count_1h, current_state, coalesce(kept, false) AS baseline FROM vectors v LEFT JOIN walk w ON w.runnable = v.runnable AND w.t = v.t AND kept WHERE ({MEANINGFUL}) OR kept""",
    "q_state_asof": f"""WITH {LOGS}, state_at AS (SELECT runnable, epoch, arg_max(state, seq) AS last_state FROM logs WHERE state IS NOT NULL GROUP BY runnable, epoch)
        SELECT l.runnable, l.epoch, l.seq AS id, s.last_state FROM logs l ASOF LEFT JOIN state_at s ON s.runnable = l.runnable AND s.epoch <= l.epoch WHERE level = 'ERROR'""",
    "q_gauge_tolerance": f"""WITH {LOGS}, gauge AS (SELECT epoch AS t, CAST(min(seq) AS DOUBLE) AS value FROM logs WHERE level = 'INFO' GROUP BY epoch),
        probes AS (SELECT DISTINCT (epoch // 60) * 60 AS t FROM logs WHERE level = 'ERROR')
        SELECT p.t, arg_min(g.value, CASE WHEN g.t = p.t THEN -1 ELSE g.t END) AS value FROM probes p LEFT JOIN gauge g ON g.t BETWEEN p.t - 30 AND p.t + 30 GROUP BY p.t""",
    "q_rule_match": f"WITH {LOGS}, {MATCHES} SELECT rule_id, severity, runnable, epoch, seq FROM matches",
    "q_rule_stats": f"WITH {LOGS}, {MATCHES} SELECT rule_id, severity, count(*) AS n, count(DISTINCT runnable) AS runnables FROM matches GROUP BY rule_id, severity",
    "q_freq_escalation": f"""WITH {LOGS}, {MATCHES}, counted AS (
        SELECT a.rule_id, a.runnable, a.epoch, a.seq, a.severity, CASE WHEN any_value(a.rule_id) IN ('T1', 'T2') THEN count(b.seq) ELSE 1 END AS match_count
        FROM matches a LEFT JOIN matches b ON a.rule_id = b.rule_id AND a.runnable = b.runnable AND b.epoch >= a.epoch - CASE a.rule_id WHEN 'T1' THEN 86400 ELSE 172800 END AND (b.epoch < a.epoch OR (b.epoch = a.epoch AND b.seq <= a.seq)) GROUP BY a.rule_id, a.runnable, a.epoch, a.seq, a.severity),
        judged AS (SELECT *, (rule_id = 'T1' AND match_count >= 2) OR (rule_id = 'T2' AND match_count >= 3) AS escalated FROM counted)
        SELECT rule_id, runnable, epoch, seq, match_count, escalated, CASE WHEN escalated THEN severity ELSE '' END AS original_severity, CASE WHEN escalated THEN CASE rule_id WHEN 'T1' THEN 'P1' ELSE 'CRITICAL' END ELSE severity END AS severity FROM judged""",
    "q_state_sequence": f"""WITH {LOGS}, st AS (SELECT runnable, epoch, seq, state FROM logs WHERE state IS NOT NULL)
        SELECT 'Q1' AS rule_id, a.runnable, a.epoch, a.seq FROM st a JOIN st b ON a.runnable = b.runnable AND b.epoch >= a.epoch - 86400 AND (b.epoch, b.seq) <= (a.epoch, a.seq)
        GROUP BY a.runnable, a.epoch, a.seq HAVING string_agg('<' || b.state || '>', '' ORDER BY b.epoch, b.seq) LIKE '%<STARTED>%<DOWN>%'""",
    "q_no_followup": f"""WITH {LOGS}, {FLUSHED} SELECT 'Q1' AS rule_id, runnable, epoch, seq, detected_epoch FROM flushed""",
    "q_throttle_cooldown": f"""WITH RECURSIVE {LOGS}, {MATCHES}, hits AS (SELECT rule_id, runnable, epoch, seq FROM matches), {throttle_sql("hits", ("rule_id", "runnable"), "epoch", "seq", 21600)} SELECT rule_id, runnable, epoch, seq, kept FROM walk""",
    "q_message_groups": f"""WITH {LOGS}, n AS (SELECT substr(sha256(CASE WHEN length(regexp_extract(message, '[0-9]+$')) >= 8 THEN regexp_replace(message, '[0-9]+$', '<HEX>') ELSE regexp_replace(message, ' [0-9]+$', ' <N>') END), 1, 16) AS h, runnable FROM
        (SELECT runnable, replace(message, 'BUS-10507', 'BUS-<N>') AS message FROM logs WHERE level IN ('ERROR', 'FATAL'))) SELECT h AS message_hash, count(*) AS n, count(DISTINCT runnable) AS runnables FROM n GROUP BY h""",
}
