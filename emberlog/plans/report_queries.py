"""Queries over the built-in catalogue, parsed lines, incidents' order, and scores per runnable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators import autoencoder, catalogue, correlate, detect, iforest, parse, report, risk
from emberlog.plans.logview import SQL as LOGS
from emberlog.plans.logview import log_view, quoted
from emberlog.plans.more_queries import HOURLY, LINES, PREFIX, STAND_IN, _event_lines, _lines, _stand_in, _vectors
from emberlog.plans.queries import MATCHES, RULES, VECTORS, Query
from emberlog.session import cut
from emberlog.sources.logs import runnable_hint

#: A message for each rule of the catalogue, and some that miss one by a little.
SAMPLES = (
    "No free database connection left", "Cannot open database X and login failed", "cannot open database; LOGIN FAILED", "Cannot calculate migration", "is INOPERATIVE now", "BeanCreationNotAllowedException: no",
    "NullPointerException at JobMonitoringTag", "bus-10507: cannot load object 7", "BUS-10201 cannot save objects", "Login failed for user BulkExport", "login failed for user bulkexport", "Banca UBAE", "MBean Catalina httpExecutor",
    "MissingServletRequestParameterException: dbName", "Could not load properties for plugin p", "BUS-10802 cannot initialize view", "BUS-10010 internal exception", "NO_PUBLISHED_DB_ACCESSIBLE", "[ZKC] No registered Instance",
    "Invalid apptype-specific info for app type APG", "Netty dependencies have versions that do not match", "Invalid RPC token (Invalid XSRF token)", "inoperative", "all is well",
)


def _sampled(spark: SparkSession, d: str) -> DataFrame:
    texts = F.array(*[F.lit(x) for x in SAMPLES])
    return log_view(spark, d).withColumn("message", F.element_at(texts, (F.col("seq") % len(SAMPLES) + 1).cast("int")))


def q_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Every keyword and expression rule of the built-in catalogue."""
    return detect.match_rules(_sampled(spark, d), catalogue.DEFAULT).select("rule_id", "severity", "runnable", "epoch", "seq")


def q_noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).groupBy(parse.is_noise(F.col("line")).alias("noise"), parse.is_continuation(F.col("line")).alias("continuation")).agg(F.count("*").alias("n"))


def q_runnable_family(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d)
    path = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("/var/runnable_"), "runnable", F.lit("/base/logs/zkc.log"))).when(F.col("seq") % 3 == 1, F.lit("/var/agent/agent.log")).otherwise(F.lit("/var/x/other.log"))
    instance = F.when(F.col("seq") % 2 == 0, F.lit("arcm0000000001")).otherwise(F.lit("nosuch01"))
    thread = F.when(F.col("seq") % 5 == 0, F.lit("pool ecp_s 3"))
    rows = logs.select(parse.runnable_of(path, instance, thread).alias("found"), parse.log_family(F.element_at(F.split(path, "/"), -1)).alias("family"))
    return rows.groupBy("found", "family").agg(F.count("*").alias("n"))


def q_parse_stats(spark: SparkSession, d: str) -> DataFrame:
    """Lines and records by format and level, and how many begin a record."""
    got = parse.parse_lines(_event_lines(spark, d))
    return got.groupBy("format_type", "level").agg(F.count("*").alias("n"), F.count("ts").alias("with_time"), F.count("duration_ms").alias("with_duration"))


def q_top_incidents(spark: SparkSession, d: str) -> DataFrame:
    """The ten incidents with most detections, of equal ones the earliest."""
    low = detect.match_rules(log_view(spark, d), RULES).where("severity IN ('MEDIUM', 'LOW')")
    low = low.withColumn("detection_id", detect.detection_id(F.col("rule_id"), F.col("runnable"), F.col("epoch"), F.col("seq")))
    got = report.largest_incidents(correlate.incidents(correlate.assign(low, HOURLY)), 10)
    return got.select(F.array_join("rules_involved", ",").alias("rules"), "root_cause_runnable", "created", "updated", "detection_count")


def q_detections_by_time(spark: SparkSession, d: str) -> DataFrame:
    """The hundred last detections in order of time."""
    hits = detect.match_rules(log_view(spark, d), RULES).select("rule_id", "rule_order", "runnable", "epoch", "seq")
    return hits.orderBy(F.desc("epoch"), F.desc("seq"), F.desc("rule_order")).limit(100).select("rule_id", "runnable", "epoch", "seq")


def q_minutes_since_restart(spark: SparkSession, d: str) -> DataFrame:
    return _vectors(spark, d).select("runnable", "t", F.round("minutes_since_last_restart", 6).alias("minutes"))


def q_eda_counts(spark: SparkSession, d: str) -> DataFrame:
    """Vectors by runnable and state."""
    return report.value_counts(_vectors(spark, d), ["runnable", "current_state"])


def q_distinct_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Seconds at which there is an error or a state, as one set."""
    logs = log_view(spark, d)
    return logs.where("level = 'ERROR'").select("epoch").union(logs.where("state IS NOT NULL").select("epoch")).distinct()


def q_first_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Per runnable the first red and the first yellow vector and the minutes between them."""
    return report.first_levels(risk.normalised(_stand_in(spark, d))).withColumn("lead_minutes", F.round("lead_minutes", 6))


def q_scores_around(spark: SparkSession, d: str) -> DataFrame:
    """Scores within half an hour of each runnable's last restart."""
    at = log_view(spark, d).where("state = 'STARTING'").groupBy("runnable").agg(F.max("epoch").alias("at"))
    return report.scores_around(_stand_in(spark, d), at, 1800).select("runnable", "t", "offset", (F.round("score", 6) + F.lit(0.0)).alias("score"))


def q_keyed_percentiles(spark: SparkSession, d: str) -> DataFrame:
    got = risk.percentiles_by(_stand_in(spark, d), F.col("score"), (0.01, 0.5, 0.97), ["runnable"])
    return got.select("runnable", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("p0", "p1", "p2")])


def _scaled_by_runnable(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with z, scaled by their own runnable's mean and deviation. Read several times; lost blocks are computed anew."""
    x = risk.matrix(_vectors(spark, d), risk.PER_RUNNABLE_FEATURES, risk.STATE_RISK_PER_RUNNABLE, False).select("runnable", "t", "x").persist()
    return risk.zscores_by(x, risk.scaler_by(x, (*risk.PER_RUNNABLE_FEATURES, "state_risk"))).select("runnable", "t", "z")


def q_scaled_by_runnable(spark: SparkSession, d: str) -> DataFrame:
    got = _scaled_by_runnable(spark, d)
    return got.select("runnable", "t", *[(F.round(F.col("z")[i], 6) + F.lit(0.0)).alias(n) for i, n in ((1, "z_error_1h"), (8, "z_restarts"), (12, "z_state"))])


def q_forest_by_runnable(spark: SparkSession, d: str) -> DataFrame:
    """A forest of 200 trees per runnable, its scores over all vectors, labels at 3 % and percent ranks."""
    z = _scaled_by_runnable(spark, d)
    labelled = cut(iforest.labels(cut(iforest.score_by(z, iforest.fit_by(z))), 0.03, ["runnable"]))  # each is read several times
    return risk.percent_ranks(labelled, "score", ["runnable"], "if_score").select("runnable", "t", "score", "label", "if_score")


def q_autoencoder(spark: SparkSession, d: str) -> DataFrame:
    """A net per runnable, its errors over all vectors, labels over the 97th percentile."""
    z = _scaled_by_runnable(spark, d)
    found = cut(autoencoder.errors_by(z, autoencoder.fit_by(z)))
    return risk.over_percentile(found).select("runnable", "t", "error", "label", "score")


def q_sequence_rules(spark: SparkSession, d: str) -> DataFrame:
    """The built-in catalogue's S01 to S03 over states whose times are a hundredth, so that windows of minutes hold some."""
    logs = log_view(spark, d).withColumn("epoch", F.floor(F.col("epoch") / 100).cast("long"))
    sequences = detect.Catalogue(tuple(r for r in catalogue.DEFAULT.rules if r.pattern_type == "STATE_SEQUENCE"))
    return detect.detect(logs, sequences).select("rule_id", "severity", "runnable", "epoch", "seq", "summary")


def q_parse_totals(spark: SparkSession, d: str) -> DataFrame:
    """The parse statistics of all lines, folded into records: noise, records by format and level, errors, stack traces."""
    lines = _event_lines(spark, d).select("source_file", F.col("source_file").alias("source_path"), F.col("seq").alias("line_number"), F.when(F.col("seq") % 9 == 0, F.concat("line", F.lit(" Accepted login for user Clous"))).otherwise(F.col("line")).alias("line"))
    got = parse.parse_stats(lines, parse.records(lines))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(c)
    return got.select("total_lines", "noise_lines", "records", "errors", "with_stack_trace", text("by_format_type"), text("by_level"))


def q_files_by_runnable(spark: SparkSession, d: str) -> DataFrame:
    """Files and their sizes by runnable, of events as if each user's were a file."""
    logs = log_view(spark, d)
    path = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("/var/runnable_"), "runnable", F.lit("/base/"), (F.col("seq") % 40).cast("string"), F.lit(".log"))).otherwise(F.concat(F.lit("/var/"), F.when(F.col("seq") % 3 == 1, F.lit("agent")).otherwise(F.lit("x")), F.lit("/a.log")))
    files = logs.groupBy(path.alias("path")).agg(F.sum(F.length("message")).cast("double").alias("size_mb")).withColumn("runnable_hint", runnable_hint(F.col("path")))
    return report.files_by_runnable(files)


def q_index_stats(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d)
    gauge = logs.where("level = 'INFO'").select(F.concat(F.lit("g"), (F.col("seq") % 5).cast("string")).alias("metric"), F.col("epoch").alias("t"))
    timer = logs.where("level = 'WARN'").select(F.lit("t0").alias("metric"), F.col("epoch").alias("t"))
    return report.index_stats(logs, gauge, timer)


def q_index_by_runnable(spark: SparkSession, d: str) -> DataFrame:
    return report.index_by_runnable(log_view(spark, d))


QUERIES: dict[str, Query] = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

E, EF = "level = 'ERROR'", "level IN ('ERROR', 'FATAL')"
#: Written from the rules' description, apart from the code above.
TESTS = {
    ("C01", "CRITICAL"): f"runnable = 'arcm_s' AND {EF} AND contains(message, 'No free database connection')",
    ("C02", "CRITICAL"): f"runnable IN ('abs_s', 'arcm_s') AND {EF} AND regexp_matches(message, '(?is)cannot open database.*login failed')",
    ("C03", "CRITICAL"): f"runnable = 'arcm_s' AND {EF} AND contains(message, 'Cannot calculate migration')",
    ("C04", "CRITICAL"): f"{EF} AND contains(message, 'INOPERATIVE')",
    ("C05", "CRITICAL"): "runnable = 'arcm_s' AND level = 'FATAL' AND contains(message, 'BeanCreationNotAllowedException')",
    ("H01", "HIGH"): f"runnable = 'arcm_s' AND {E} AND regexp_matches(message || chr(1) || coalesce(stack_trace, ''), '(?i)NullPointerException[^\\x01]*JobMonitoringTag|JobMonitoringTag[^\\x01]*NullPointerException')",
    ("H02", "HIGH"): f"runnable = 'arcm_s' AND {E} AND regexp_matches(message, '(?is)BUS-10507.*cannot load object')",
    ("H03", "HIGH"): f"runnable = 'arcm_s' AND {E} AND regexp_matches(message, '(?is)BUS-10201.*cannot save objects')",
    ("H04", "HIGH"): f"runnable IN ('arcm_s', 'abs_s') AND {E} AND contains(message, 'Login failed for user BulkExport')",
    ("M01", "MEDIUM"): "runnable = 'abs_s' AND level IN ('ERROR', 'WARN') AND contains(message, 'Banca UBAE')",
    ("M02", "MEDIUM"): f"{E} AND regexp_matches(message || chr(1) || coalesce(stack_trace, ''), '(?i)MBean[^\\x01]*Catalina[^\\x01]*(http|ajp)Executor')",
    ("M03", "MEDIUM"): "runnable = 'abs_s' AND level = 'WARN' AND regexp_matches(message, '(?is)MissingServletRequestParameterException.*(dbName|selectedItemId)')",
    ("M04", "MEDIUM"): f"runnable = 'abs_s' AND {E} AND contains(message, 'Could not load properties for plugin')",
    ("M05", "MEDIUM"): f"runnable = 'arcm_s' AND {E} AND regexp_matches(message, '(?is)BUS-10802.*cannot initialize view')",
    ("M06", "MEDIUM"): f"runnable = 'arcm_s' AND {E} AND regexp_matches(message, '(?is)BUS-10010.*internal exception')",
    ("M07", "MEDIUM"): f"runnable = 'abs_s' AND {E} AND contains(message, 'NO_PUBLISHED_DB_ACCESSIBLE')",
    ("L01", "LOW"): f"{E} AND contains(message, '[ZKC] No registered Instance')",
    ("L02", "LOW"): f"runnable = 'agent' AND {E} AND contains(message, 'Invalid apptype-specific info for app type APG')",
    ("L03", "LOW"): "runnable = 'abs_s' AND level = 'WARN' AND contains(message, 'Netty dependencies have versions that do not match')",
    ("L04", "LOW"): f"runnable = 'abs_s' AND {E} AND contains(message, 'Invalid RPC token (Invalid XSRF token)')",
}
LOW = f"""{LOGS}, {MATCHES}, low AS (SELECT *, coalesce(epoch - lag(epoch) OVER (PARTITION BY runnable, rule_id ORDER BY epoch, seq) > 216000, true) AS s FROM matches WHERE severity IN ('MEDIUM', 'LOW')),
g AS (SELECT *, sum(CAST(s AS INT)) OVER (PARTITION BY runnable, rule_id ORDER BY epoch, seq) AS i FROM low)"""
BOUNDS = "bounds AS (SELECT quantile_cont(-score, 0.01) AS lo, quantile_cont(-score, 0.99) AS hi FROM stand_in), risky AS (SELECT runnable, t, CASE WHEN hi - lo < 1e-10 THEN 0.0 ELSE least(greatest((-score - lo) / (hi - lo) * 100, 0.0), 100.0) END AS r FROM stand_in, bounds)"

STATE_BY_RUNNABLE = "CASE current_state " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in risk.STATE_RISK_PER_RUNNABLE.items()) + " ELSE 1 END"


def _z(c: str) -> str:
    return f"round(({c} - avg({c}) OVER w) / CASE WHEN stddev_pop({c}) OVER w = 0 THEN 1 ELSE stddev_pop({c}) OVER w END, 6) + 0.0"


#: Rule, window, severity, states, state that has to follow: as the catalogue describes them.
SEQUENCES = (("S01", 600, "CRITICAL", ("STARTING", "DOWN", "STARTING", "DOWN", "STARTING"), None), ("S02", 300, "HIGH", ("STARTED", "DOWN"), "STARTING"), ("S03", 180, "MEDIUM", ("STARTED", "STOPPING"), "STOPPED"))


def _sequence_sql(rule: str, wide: int, severity: str, states: tuple[str, ...], follow: str | None) -> str:
    text = f"""SELECT '{rule}' AS rule_id, '{severity}' AS severity, a.runnable, a.epoch, a.seq, '{" > ".join(states)}' AS summary FROM st a JOIN st b ON a.runnable = b.runnable AND b.epoch BETWEEN a.epoch - {wide} AND a.epoch AND (b.epoch, b.seq) <= (a.epoch, a.seq)
        GROUP BY a.runnable, a.epoch, a.seq HAVING string_agg('<' || b.state || '>', '' ORDER BY b.epoch, b.seq) LIKE '%{"%".join(f"<{s}>" for s in states)}%'"""
    if follow:
        text += f""" UNION ALL SELECT '{rule}', '{severity}', runnable, epoch, -1 - seq, '{states[-1]} without {follow}' FROM
            (SELECT * FROM st WHERE state = '{states[-1]}' QUALIFY row_number() OVER (PARTITION BY runnable ORDER BY epoch DESC, seq DESC) = 1) x, (SELECT max(epoch) AS stop FROM sampled) e
            WHERE stop - epoch >= {wide} AND NOT EXISTS (SELECT 1 FROM st f WHERE f.runnable = x.runnable AND f.state = '{follow}' AND f.epoch > x.epoch)"""
    return text


ORACLE: dict[str, str] = {
    "q_scaled_by_runnable": f"{PREFIX}, x AS (SELECT runnable, t, CAST(error_count_1h AS DOUBLE) AS e, CAST(restarts_24h AS DOUBLE) AS r, CAST({STATE_BY_RUNNABLE} AS DOUBLE) AS s FROM vectors) SELECT runnable, t, {_z('e')} AS z_error_1h, {_z('r')} AS z_restarts, {_z('s')} AS z_state FROM x WINDOW w AS (PARTITION BY runnable)",
    "q_sequence_rules": f"WITH {LOGS}, sampled AS (SELECT * REPLACE (epoch // 100 AS epoch) FROM logs), st AS (SELECT runnable, epoch, seq, state FROM sampled WHERE state IS NOT NULL) " + " UNION ALL ".join(_sequence_sql(*x) for x in SEQUENCES),
    "q_files_by_runnable": f"""WITH {LOGS}, f AS (SELECT CASE seq % 3 WHEN 0 THEN '/var/runnable_' || runnable || '/base/' || seq % 40 || '.log' WHEN 1 THEN '/var/agent/a.log' ELSE '/var/x/a.log' END AS path, CAST(sum(length(message)) AS DOUBLE) AS size_mb FROM logs GROUP BY 1)
        SELECT coalesce(nullif(regexp_extract(path, '/runnable_([a-z]+_s)/', 1), ''), CASE WHEN contains(path, 'agent') THEN 'agent' ELSE 'unknown' END) AS runnable, count(*) AS files, sum(size_mb) AS size_mb FROM f GROUP BY 1""",
    "q_index_stats": f"""WITH {LOGS}, p AS (SELECT 'g' || seq % 5 AS metric, epoch AS t FROM logs WHERE level = 'INFO' UNION ALL SELECT 't0', epoch FROM logs WHERE level = 'WARN')
        SELECT (SELECT count(DISTINCT runnable) FROM logs) AS runnables, (SELECT count(*) FROM logs) AS records, (SELECT count(DISTINCT metric) FROM p) AS metrics, (SELECT count(*) FROM p) AS datapoints, (SELECT count(DISTINCT epoch) FROM logs) AS distinct_epochs,
            (SELECT count(*) FROM logs WHERE state IS NOT NULL) AS state_changes, (SELECT min(epoch) FROM logs) AS first, (SELECT max(epoch) FROM logs) AS last""",
    "q_index_by_runnable": f"WITH {LOGS} SELECT runnable, count(*) AS records, count(*) FILTER (level IN ('ERROR', 'FATAL')) AS errors, count(state) AS states, count(*) FILTER (state = 'STARTING') AS restarts, count(DISTINCT epoch) AS distinct_epochs, min(epoch) AS first, max(epoch) AS last FROM logs GROUP BY runnable",
    "q_parse_totals": f"""WITH {LOGS}, k AS (SELECT seq, seq % 8 AS k, level, seq % 9 = 0 AS noise FROM logs), r AS (SELECT ['PIPE_8FIELD', 'SPRING', 'RUNNABLE_HIST', 'AGENT', 'REST_OPS', 'PLAIN_TS', 'WRAPPER'][k + 1] AS f,
            CASE WHEN k IN (0, 3, 6) THEN level WHEN k = 1 THEN 'ERROR' WHEN k = 2 THEN 'WARN' WHEN k = 4 THEN 'INFO' ELSE 'UNKNOWN' END AS level, seq, k FROM k WHERE NOT noise AND k < 7),
        owners AS (SELECT max(r.seq) AS seq FROM k JOIN r ON r.seq < k.seq WHERE k.k = 7 AND NOT k.noise GROUP BY k.seq)
        SELECT (SELECT count(*) FROM k) AS total_lines, (SELECT count(*) FROM k WHERE noise) AS noise_lines, (SELECT count(*) FROM r) AS records, (SELECT count(*) FROM r WHERE level IN ('ERROR', 'FATAL')) AS errors, (SELECT count(DISTINCT seq) FROM owners) AS with_stack_trace,
            (SELECT string_agg(f || '=' || n, ',' ORDER BY f) FROM (SELECT f, count(*) AS n FROM r GROUP BY f)) AS by_format_type, (SELECT string_agg(level || '=' || n, ',' ORDER BY level) FROM (SELECT level, count(*) AS n FROM r GROUP BY level)) AS by_level""",
    "q_catalogue": f"WITH {LOGS}, sampled AS (SELECT runnable, level, stack_trace, epoch, seq, {quoted(SAMPLES)}[seq % {len(SAMPLES)} + 1] AS message FROM logs) " + " UNION ALL ".join(f"SELECT '{i}' AS rule_id, '{s}' AS severity, runnable, epoch, seq FROM sampled WHERE {test}" for (i, s), test in TESTS.items()),
    "q_noise_filter": rf"""WITH {LINES} SELECT contains(line, 'Reusing existing ZKC instance') OR contains(line, 'Accepted login for user Clous') AS noise,
        regexp_matches(line, '^\s*$|^\s+(?:at\s|\.\.\.)|^\s*Caused by:\s|^[A-Za-z][\w.]*(?:Exception|Error|Throwable)[\s:]') AS continuation, count(*) AS n FROM lines GROUP BY 1, 2""",
    "q_runnable_family": f"""WITH {LOGS} SELECT CASE WHEN seq % 3 = 0 AND runnable LIKE '%\\_s' ESCAPE '\\' THEN runnable WHEN seq % 2 = 0 THEN 'arcm_s' WHEN seq % 5 = 0 THEN 'ecp_s' WHEN seq % 3 = 1 OR (seq % 3 = 0 AND contains(runnable, 'agent')) THEN 'agent' ELSE 'unknown' END AS found,
        CASE seq % 3 WHEN 0 THEN 'ARCM_ZKC' WHEN 1 THEN 'AGENT_LOG' ELSE 'UNKNOWN' END AS family, count(*) AS n FROM logs GROUP BY 1, 2""",
    "q_parse_stats": f"""WITH {LOGS}, k AS (SELECT seq % 8 AS k, level FROM logs), f AS (SELECT ['PIPE_8FIELD', 'SPRING', 'RUNNABLE_HIST', 'AGENT', 'REST_OPS', 'PLAIN_TS', 'WRAPPER', NULL][k + 1] AS format_type,
        CASE WHEN k IN (0, 3, 6) THEN level WHEN k = 1 THEN 'ERROR' WHEN k = 2 THEN 'WARN' WHEN k = 4 THEN 'INFO' WHEN k = 5 THEN 'UNKNOWN' END AS level, k FROM k)
        SELECT format_type, level, count(*) AS n, count(*) FILTER (k < 7) AS with_time, count(*) FILTER (k = 4) AS with_duration FROM f GROUP BY 1, 2""",
    "q_top_incidents": f"WITH {LOW} SELECT rule_id AS rules, runnable AS root_cause_runnable, min(epoch) AS created, max(epoch) AS updated, count(*) AS detection_count FROM g GROUP BY rule_id, runnable, i ORDER BY detection_count DESC, created, rules, root_cause_runnable LIMIT 10",
    "q_detections_by_time": f"WITH {LOGS}, {MATCHES} SELECT m.rule_id, runnable, epoch, seq FROM matches m JOIN rules r ON r.rule_id = m.rule_id ORDER BY epoch DESC, seq DESC, r.ord DESC LIMIT 100",
    "q_minutes_since_restart": f"""WITH {LOGS}, {VECTORS} SELECT g.runnable, g.t, round(coalesce((g.t - (SELECT max(epoch) FROM marked m WHERE m.restart > 0 AND m.runnable = g.runnable AND m.epoch <= g.t)) / 60.0::DOUBLE, -1.0), 6) AS minutes FROM grid g""",
    "q_eda_counts": f"{PREFIX} SELECT runnable, current_state, count(*) AS n FROM vectors GROUP BY 1, 2",
    "q_distinct_epochs": f"WITH {LOGS} SELECT DISTINCT epoch FROM logs WHERE level = 'ERROR' OR state IS NOT NULL",
    "q_first_alerts": f"""{PREFIX}, {STAND_IN}, {BOUNDS} SELECT runnable, min(t) FILTER (r >= 70) AS first_red, min(t) FILTER (r >= 30 AND r < 70) AS first_yellow,
        round((min(t) FILTER (r >= 70) - min(t) FILTER (r >= 30 AND r < 70)) / 60.0::DOUBLE, 6) AS lead_minutes FROM risky GROUP BY runnable""",
    "q_scores_around": f"""{PREFIX}, {STAND_IN}, a AS (SELECT runnable, max(epoch) AS moment FROM logs WHERE state = 'STARTING' GROUP BY 1) SELECT s.runnable, t, t - moment AS "offset", round(score, 6) + 0.0 AS score FROM stand_in s JOIN a ON a.runnable = s.runnable AND abs(t - moment) <= 1800""",
    "q_keyed_percentiles": f"{PREFIX}, {STAND_IN} SELECT runnable, round(quantile_cont(score, 0.01), 6) + 0.0 AS p0, round(quantile_cont(score, 0.5), 6) + 0.0 AS p1, round(quantile_cont(score, 0.97), 6) + 0.0 AS p2 FROM stand_in GROUP BY runnable",
}
