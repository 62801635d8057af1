"""Further queries: lines, incidents, alerts, scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.times import local_to_utc
from emberlog.operators import correlate, detect, features, iforest, narrate, parse, report, risk
from emberlog.plans.logview import SQL as LOGS
from emberlog.plans.logview import log_view, quoted, read
from emberlog.plans.queries import FLUSHED, MATCHES, RULES, VECTORS, Query, throttle_sql

HOURLY = 3600


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as a log: a record begins with each line that starts with a capital letter."""
    docs = read(spark, d, "documents").select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.md5("text")).alias("file"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return docs.select("doc_id", "file", (F.col("n") + 1).cast("long").alias("line_number"), "line")


def q_unstructured_class(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d)
    kind = F.when(parse.is_noise(F.col("line")), "NOISE").when(parse.is_continuation(F.col("line")), "CONTINUATION").otherwise(parse.unstructured_kind(F.col("line")))
    return lines.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def _event_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines in every format, made of events."""
    logs = log_view(spark, d)
    ts = F.date_format(F.timestamp_seconds("epoch"), "yyyy-MM-dd'T'HH:mm:ss',007'")
    sp = F.date_format(F.timestamp_seconds("epoch"), "yyyy-MM-dd HH:mm:ss',007'")
    dot = F.date_format(F.timestamp_seconds("epoch"), "yyyy-MM-dd HH:mm:ss'.007'")
    k, n = F.col("seq") % 8, F.col("seq").cast("string")
    pipe = F.concat(ts, F.lit("|"), "level", F.lit("|arcm000|default||r|t-1|Pool - "), "message")
    agent = F.concat(sp, F.lit("|"), "level", F.lit("|main| Core - "), "message")
    line = (
        F.when(k == 0, pipe)
        .when(k == 1, F.concat(ts, F.lit(" - ERROR [http:App@7] - "), "message"))
        .when(k == 2, F.concat(sp, F.lit("|abs_s - State change: STARTED -> DOWN "), n))
        .when(k == 3, agent)
        .when(k == 4, F.concat(dot, F.lit(" -- "), dot, F.lit(" (12ms) - v1 - 10.0.0.1 - ops - start "), n))
        .when(k == 5, F.concat(F.date_format(F.timestamp_seconds("epoch"), "yyyy-MM-dd'T'HH:mm:ss'.96Z '"), "message"))
        .when(k == 6, F.concat(F.lit("INFO   | jvm 1    | 2024/01/02 03:04:05 | "), agent))
        .otherwise(F.concat(F.lit("    at a.b.C(D.java:"), n, F.lit(")")))
    )
    return logs.select(F.col("seq"), F.lit("a.log").alias("source_file"), line.alias("line"))


def q_format_ladder(spark: SparkSession, d: str) -> DataFrame:
    got = parse.parse_lines(_event_lines(spark, d))
    return got.select("seq", "format_type", "level", "thread", "logger", "message", "content_runnable", F.unix_millis("ts").alias("ms"))


def q_multiline_islands(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d)
    start = F.col("line").rlike("^[A-Z]")
    shaped = lines.select("doc_id", F.col("file").alias("source_file"), "line_number", "line", F.when(start, "PLAIN_TS").alias("format_type"), F.when(start, F.col("line")).alias("message"), F.lit(False).alias("bad_time"))
    got = parse.fold_lines(shaped)
    return got.select("doc_id", "line_number", F.length("message").cast("long").alias("message_chars"), "has_stack_trace")


def q_dst_utc(spark: SparkSession, d: str) -> DataFrame:
    logs = log_view(spark, d).select("seq", F.timestamp_seconds(F.col("epoch") + F.col("seq") * 86400).alias("local"))
    return logs.select("seq", F.unix_seconds(local_to_utc(F.col("local"))).alias("utc"))


def _detections(spark: SparkSession, d: str) -> DataFrame:
    return detect.detect(log_view(spark, d), RULES)


def q_detections(spark: SparkSession, d: str) -> DataFrame:
    return _detections(spark, d).select("rule_id", "severity", "runnable", "epoch", "seq", "match_count", "escalated")


def q_incidents_low(spark: SparkSession, d: str) -> DataFrame:
    """Detections below HIGH only meet in their own runnable and rule, so incidents are sessions by gap."""
    low = detect.match_rules(log_view(spark, d), RULES).where("severity IN ('MEDIUM', 'LOW')")
    low = low.withColumn("detection_id", detect.detection_id(F.col("rule_id"), F.col("runnable"), F.col("epoch"), F.col("seq")))
    got = correlate.incidents(correlate.assign(low, HOURLY))
    return got.select(F.array_join("rules_involved", ",").alias("rules"), F.array_join("affected_runnables", ",").alias("runnables"), "created", "updated", "detection_count")


def q_incidents(spark: SparkSession, d: str) -> DataFrame:
    got = correlate.incidents(correlate.assign(_detections(spark, d), 720))
    return got.select("incident_id", "severity", "created", "updated", "detection_count", F.array_join("affected_runnables", ",").alias("runnables"), "root_cause_runnable", "root_cause_rule", "root_cause_estimate")


def q_incident_stats(spark: SparkSession, d: str) -> DataFrame:
    return correlate.incident_stats(correlate.incidents(correlate.assign(_detections(spark, d), 720)))


def q_incident_members(spark: SparkSession, d: str) -> DataFrame:
    """Every detection with its incident, as a timeline."""
    return correlate.timeline(correlate.assign(_detections(spark, d).drop("summary"), 720))


def q_open_incidents(spark: SparkSession, d: str) -> DataFrame:
    """Incidents that are open after everyone that has an INFO record of its root cause's runnable an hour after it was closed."""
    found = correlate.incidents(correlate.assign(_detections(spark, d), 720))
    quiet = log_view(spark, d).where("level = 'INFO'").select(F.col("runnable").alias("root_cause_runnable"), F.col("epoch").alias("at"))
    hour = F.floor(F.col("updated") / HOURLY)
    changes = found.withColumn("b", F.explode(F.array(hour, hour + 1))).join(quiet.withColumn("b", F.floor(F.col("at") / HOURLY)), ["root_cause_runnable", "b"]).where((F.col("at") > F.col("updated")) & (F.col("at") <= F.col("updated") + HOURLY))
    closed = changes.select("incident_id", F.col("at").alias("epoch"), F.lit("CLOSED").alias("status"))
    return correlate.open_incidents(correlate.with_status(found, closed)).select("incident_id", "severity", "updated", "root_cause_runnable")


def q_alerts(spark: SparkSession, d: str) -> DataFrame:
    got = narrate.alerts(_detections(spark, d), 360)
    return got.select("rule_id", "runnable", "epoch", "seq", "severity", "title", F.array_join("channels", ",").alias("channels"), "confidence")


def q_alert_stats(spark: SparkSession, d: str) -> DataFrame:
    return narrate.alert_stats(_detections(spark, d), 360)


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return features.log_vectors(log_view(spark, d))


def q_zscore(spark: SparkSession, d: str) -> DataFrame:
    x = risk.matrix(_vectors(spark, d))
    z = risk.zscores(x, risk.scaler(x, (*risk.FEATURES, "state_risk")))
    return z.select("runnable", "t", F.round(F.col("z")[1], 6).alias("z_error_1h"), F.round(F.col("z")[11], 6).alias("z_state"))


def _stand_in(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with a plain score instead of the forest's."""
    return _vectors(spark, d).withColumn("score", -(F.col("error_count_1h") + F.col("distinct_errors_5m") * 2 + F.col("t") % 1000 / 1000.0))


def q_risk_normalise(spark: SparkSession, d: str) -> DataFrame:
    return risk.normalised(_stand_in(spark, d)).select("runnable", "t", F.round("risk_score", 6).alias("risk_score"), "risk_level")


def q_risk_stats(spark: SparkSession, d: str) -> DataFrame:
    got = risk.risk_stats(risk.normalised(_stand_in(spark, d)))
    return got.select("n", F.round("mean_score", 4).alias("mean_score"), F.round("max_score", 4).alias("max_score"), "red", "yellow", "green")


def q_top_features(spark: SparkSession, d: str) -> DataFrame:
    names = (*risk.FEATURES, "state_risk")
    x = risk.matrix(_vectors(spark, d))
    got = risk.top_features(risk.zscores(x, risk.scaler(x, names)), names)
    return got.select("runnable", "t", F.array_join(F.transform("top_features", lambda f: f["feature"]), ",").alias("top"))


def q_iforest_score(spark: SparkSession, d: str) -> DataFrame:
    names = (*risk.FEATURES, "state_risk")
    # Read by the scaler, the sample and the scores; lost blocks are computed anew.
    x = risk.matrix(_vectors(spark, d)).select("runnable", "t", "x").persist()
    z = risk.zscores(x, risk.scaler(x, names))
    scored = iforest.labels(iforest.score(z, iforest.forest(iforest.fit(z))).select("runnable", "t", "score").persist(), 0.02)
    return risk.normalised(scored).select("runnable", "t", "score", "label", "risk_score", "risk_level")


def q_pct_rank(spark: SparkSession, d: str) -> DataFrame:
    return risk.percent_ranks(_stand_in(spark, d).select("runnable", "t", "score"), "score", ["runnable"]).select("runnable", "t", F.round("score", 6).alias("score"))


def q_recon_threshold(spark: SparkSession, d: str) -> DataFrame:
    got = risk.over_percentile(_stand_in(spark, d).withColumn("error", -F.col("score")))
    return got.select("runnable", "t", "label", F.round("score", 6).alias("score"))


def q_reconstruction(spark: SparkSession, d: str) -> DataFrame:
    names = (*risk.PER_RUNNABLE_FEATURES, "state_risk")
    x = risk.matrix(_vectors(spark, d), risk.PER_RUNNABLE_FEATURES, risk.STATE_RISK_PER_RUNNABLE, False)
    z = risk.zscores(x, risk.scaler(x, names))
    return risk.over_percentile(risk.reconstruction(z)).select("runnable", "t", "error", "label", "score")


REPORTED = ("error_count_5m", "error_count_1h", "fatal_count_1h", "warn_count_1h", "state_transitions_1h", "restarts_24h")


def q_nonzero_pct(spark: SparkSession, d: str) -> DataFrame:
    return report.share_of(_vectors(spark, d), REPORTED).withColumn("pct", F.round("pct", 6))


def q_corr_pairs(spark: SparkSession, d: str) -> DataFrame:
    return report.correlated_pairs(_vectors(spark, d), REPORTED, 0.05).withColumn("r", F.round("r", 6))


def q_hourly(spark: SparkSession, d: str) -> DataFrame:
    return report.by_hour(_vectors(spark, d), "error_count_5m")


def q_dow(spark: SparkSession, d: str) -> DataFrame:
    return report.by_weekday(_vectors(spark, d), "error_count_5m")


def q_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return report.bad_days(_vectors(spark, d), "arcm_s", least=0)


def q_vector_shape(spark: SparkSession, d: str) -> DataFrame:
    return report.shape(_vectors(spark, d))


DAY0 = 1704067200  # 2024-01-01
CRASHES = [(f"c{k}", DAY0 + k * 86400 * 5, DAY0 + k * 86400 * 5 + 43200, DAY0 + k * 86400 * 5 + 43200, DAY0 + k * 86400 * 5 + 86400) for k in range(1, 6)]


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return risk.normalised(_stand_in(spark, d)).withColumn("label", F.when(F.col("risk_score") >= 70, -1).otherwise(1))


def q_crash_validation(spark: SparkSession, d: str) -> DataFrame:
    crashes = spark.createDataFrame(CRASHES, "name string, pre_start long, pre_end long, peak_start long, peak_end long")
    got = report.crash_validation(_labelled(spark, d), crashes, "risk_score")
    rounded = {c: F.round(c, 6) for c in ("anomaly_pct", "max_score", "mean_score", "lead_minutes")}
    return got.withColumns(rounded)


def q_model_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).groupBy("runnable").agg(*report.agreement(F.col("label") == -1, F.col("fatal_count_1h") > 0)).withColumn("jaccard_pct", F.round("jaccard_pct", 6))


def q_recall_curve(spark: SparkSession, d: str) -> DataFrame:
    return report.recall_curve(_labelled(spark, d)).withColumn("recall", F.round("recall", 6))


QUERIES: dict[str, Query] = {k: v for k, v in list(globals().items()) if k.startswith("q_")}

LINES = r"lines AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), md5(text)) AS file, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS n FROM documents)"
PREFIX = f"WITH {LOGS}, {VECTORS}"
STAND_IN = "stand_in AS (SELECT *, -(error_count_1h + distinct_errors_5m * 2 + (t % 1000) / 1000.0::DOUBLE) AS score FROM vectors)"
NORMAL = """bounds AS (SELECT quantile_cont(-score, 0.01) AS lo, quantile_cont(-score, 0.99) AS hi FROM stand_in),
normal AS (SELECT stand_in.*, CASE WHEN hi - lo < 1e-10 THEN 0.0 ELSE least(greatest((-score - lo) / (hi - lo) * 100, 0.0), 100.0) END AS risk_score FROM stand_in, bounds),
labelled AS (SELECT *, CASE WHEN risk_score >= 70 THEN 'RED' WHEN risk_score >= 30 THEN 'YELLOW' ELSE 'GREEN' END AS risk_level, CASE WHEN risk_score >= 70 THEN -1 ELSE 1 END AS label FROM normal)"""
STATE = "CASE current_state WHEN 'STARTED' THEN 0 WHEN 'STOPPED' THEN 1 WHEN 'STOPPING' THEN 2 WHEN 'STARTING' THEN 3 WHEN 'DOWN' THEN 4 ELSE 1 END"

ORACLE: dict[str, str] = {
    "q_unstructured_class": rf"""WITH {LINES}, s AS (SELECT line, regexp_replace(line, '^\s+|\s+$', '', 'g') AS x FROM lines)
        SELECT CASE WHEN regexp_matches(line, 'Reusing existing ZKC instance|Accepted login for user Clous') THEN 'NOISE'
            WHEN regexp_matches(line, '^\s*$|^\s+(?:at\s|\.\.\.)|^\s*Caused by:\s|^[A-Za-z][\w.]*(?:Exception|Error|Throwable)[\s:]') THEN 'CONTINUATION'
            WHEN starts_with(x, 'BUS-') THEN 'BUS' WHEN regexp_matches(x, '^(DEBUG|EHLO|250|220|STARTTLS|RCPT|AUTH|MAIL FROM|354|DATA)') THEN 'SMTP'
            WHEN regexp_matches(x, '^(Date:|From:|Reply-To:|To:|Message-ID:|Subject:|MIME-|Content-|---)') THEN 'EMAIL'
            WHEN regexp_matches(x, '^[\s_/\\|()U"''>*=]+$|^[A-Z]{{4}} version|^Spring boot') THEN 'BANNER' ELSE 'OTHER' END AS kind, count(*) AS n FROM s GROUP BY 1""",
    "q_format_ladder": f"""WITH {LOGS}, b AS (SELECT *, seq % 8 AS k, CAST(seq AS VARCHAR) AS n, epoch * 1000 + 7 - 3600000 AS local_ms FROM logs)
        SELECT seq, CASE k WHEN 0 THEN 'PIPE_8FIELD' WHEN 1 THEN 'SPRING' WHEN 2 THEN 'RUNNABLE_HIST' WHEN 3 THEN 'AGENT' WHEN 4 THEN 'REST_OPS' WHEN 5 THEN 'PLAIN_TS' WHEN 6 THEN 'WRAPPER' END AS format_type,
            CASE WHEN k IN (0, 3, 6) THEN level WHEN k = 1 THEN 'ERROR' WHEN k = 2 THEN 'WARN' WHEN k = 4 THEN 'INFO' WHEN k = 5 THEN 'UNKNOWN' END AS level,
            CASE WHEN k = 0 THEN 't-1' WHEN k = 1 THEN 'http' WHEN k IN (3, 6) THEN 'main' WHEN k = 4 THEN '10.0.0.1@ops' END AS thread,
            CASE WHEN k = 0 THEN 'Pool' WHEN k = 1 THEN 'App' WHEN k IN (3, 6) THEN 'Core' WHEN k = 4 THEN 'REST_OPS' END AS logger,
            CASE WHEN k IN (0, 1, 3, 5, 6) THEN message WHEN k = 2 THEN 'State change: STARTED -> DOWN ' || n WHEN k = 4 THEN '[12ms] start ' || n END AS message,
            CASE WHEN k = 2 THEN 'abs_s' END AS content_runnable, CASE WHEN k = 5 THEN epoch * 1000 + 960 WHEN k < 7 THEN local_ms END AS ms FROM b""",
    "q_multiline_islands": rf"""WITH {LINES}, k AS (SELECT *, regexp_matches(line, '^[A-Z]') AS start, regexp_replace(line, '^\s+|\s+$', '', 'g') AS x,
            regexp_matches(line, '^\s*$|^\s+(?:at\s|\.\.\.)|^\s*Caused by:\s|^[A-Za-z][\w.]*(?:Exception|Error|Throwable)[\s:]') AS stack FROM lines),
        c AS (SELECT *, NOT start AND NOT stack AND (starts_with(x, 'BUS-') OR NOT (regexp_matches(x, '^(DEBUG|EHLO|250|220|STARTTLS|RCPT|AUTH|MAIL FROM|354|DATA)') OR regexp_matches(x, '^(Date:|From:|Reply-To:|To:|Message-ID:|Subject:|MIME-|Content-|---)')
            OR regexp_matches(x, '^[\s_/\\|()U"''>*=]+$|^[A-Z]{{4}} version|^Spring boot'))) AS more, sum(CAST(start AS INT)) OVER (PARTITION BY file ORDER BY n) AS rid FROM k)
        SELECT doc_id, min(n) FILTER (start) AS line_number, CAST(sum(CASE WHEN start THEN length(line) WHEN more THEN 1 + length(x) ELSE 0 END) AS BIGINT) AS message_chars,
            coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT start AND stack), '') <> '' AS has_stack_trace FROM c WHERE rid > 0 GROUP BY doc_id, file, rid""",
    "q_dst_utc": f"""WITH {LOGS}, l AS (SELECT seq, make_timestamp((epoch + seq * 86400) * 1000000) AS x, epoch + seq * 86400 AS e FROM logs),
        s AS (SELECT *, CAST(last_day(x) AS DATE) - CAST(dayofweek(last_day(x)) AS INTEGER) AS sunday FROM l)
        SELECT seq, e - CASE WHEN month(x) BETWEEN 4 AND 9 OR (month(x) = 3 AND CAST(x AS DATE) >= sunday) OR (month(x) = 10 AND CAST(x AS DATE) < sunday) THEN 7200 ELSE 3600 END AS utc FROM s""",
    "q_incidents_low": f"""WITH {LOGS}, {MATCHES}, low AS (SELECT *, coalesce(epoch - lag(epoch) OVER (PARTITION BY runnable, rule_id ORDER BY epoch, seq) > 216000, true) AS s FROM matches WHERE severity IN ('MEDIUM', 'LOW')),
        g AS (SELECT *, sum(CAST(s AS INT)) OVER (PARTITION BY runnable, rule_id ORDER BY epoch, seq) AS i FROM low)
        SELECT rule_id AS rules, runnable AS runnables, min(epoch) AS created, max(epoch) AS updated, count(*) AS detection_count FROM g GROUP BY rule_id, runnable, i""",
    "q_zscore": f"""{PREFIX}, x AS (SELECT runnable, t, CAST(error_count_1h AS DOUBLE) AS e, CAST({STATE} AS DOUBLE) AS s FROM vectors)
        SELECT runnable, t, round((e - avg(e) OVER ()) / CASE WHEN stddev_pop(e) OVER () = 0 THEN 1 ELSE stddev_pop(e) OVER () END, 6) AS z_error_1h, round((s - avg(s) OVER ()) / CASE WHEN stddev_pop(s) OVER () = 0 THEN 1 ELSE stddev_pop(s) OVER () END, 6) AS z_state FROM x""",
    "q_risk_normalise": f"{PREFIX}, {STAND_IN}, {NORMAL} SELECT runnable, t, round(risk_score, 6) AS risk_score, risk_level FROM labelled",
    "q_risk_stats": f"""{PREFIX}, {STAND_IN}, {NORMAL} SELECT count(*) AS n, round(avg(risk_score), 4) AS mean_score, round(max(risk_score), 4) AS max_score, count(*) FILTER (risk_level = 'RED') AS red,
        count(*) FILTER (risk_level = 'YELLOW') AS yellow, count(*) FILTER (risk_level = 'GREEN') AS green FROM labelled""",
    "q_pct_rank": f"""{PREFIX}, {STAND_IN} SELECT runnable, t, round(100.0 - ((rank() OVER (PARTITION BY runnable ORDER BY score) - 1) + count(*) OVER (PARTITION BY runnable ORDER BY score) + 1) * 50.0::DOUBLE / count(*) OVER (PARTITION BY runnable), 6) AS score FROM stand_in""",
    "q_recon_threshold": f"""{PREFIX}, {STAND_IN}, c AS (SELECT runnable, quantile_cont(-score, 0.97) AS cut, min(-score) AS lo, max(-score) AS hi FROM stand_in GROUP BY runnable)
        SELECT runnable, t, CASE WHEN -score > cut THEN -1 ELSE 1 END AS label, round(CASE WHEN hi - lo < 1e-10 THEN 0.0 ELSE (-score - lo) / (hi - lo) * 100 END, 6) AS score FROM stand_in JOIN c USING (runnable)""",
    "q_nonzero_pct": f"{PREFIX} " + " UNION ALL ".join(f"SELECT runnable, '{f}' AS feature, round(avg(CAST({f} > 0 AS DOUBLE)) * 100, 6) AS pct FROM vectors GROUP BY runnable" for f in REPORTED),
    "q_corr_pairs": f"{PREFIX}, c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM vectors" for i, a in enumerate(REPORTED) for b in REPORTED[i + 1 :]) + ") SELECT a, b, round(r, 6) AS r FROM c WHERE NOT isnan(r) AND abs(r) > 0.05",
    "q_hourly": f"{PREFIX}, h AS (SELECT CAST((t // 3600) % 24 AS INT) AS hour, CAST(sum(error_count_5m) AS BIGINT) AS total FROM vectors GROUP BY 1) SELECT CAST(g AS INT) AS hour, coalesce(total, 0) AS total FROM generate_series(0, 23) AS s(g) LEFT JOIN h ON hour = g",
    "q_dow": f"{PREFIX} SELECT CAST((t // 86400 + 3) % 7 AS INT) AS weekday, CAST(sum(error_count_5m) AS BIGINT) AS total FROM vectors GROUP BY 1",
    "q_cooccurrence": f"""{PREFIX}, s AS (SELECT strftime(make_timestamp(t * 1000000), '%Y-%m-%d') AS day, runnable, CAST(sum(error_count_5m) AS BIGINT) AS n FROM vectors GROUP BY 1, 2), d AS (SELECT day, n AS own FROM s WHERE runnable = 'arcm_s' AND n > 0)
        SELECT day, any_value(own) AS own, coalesce(string_agg(s.runnable || '=' || s.n, ', ' ORDER BY s.n DESC, s.runnable), '') AS others FROM d LEFT JOIN s ON s.day = d.day AND s.runnable <> 'arcm_s' AND s.n > 0 GROUP BY d.day""".replace("SELECT day, any_value", "SELECT d.day, any_value"),
    "q_vector_shape": f"{PREFIX} SELECT runnable, count(*) AS vectors, count(DISTINCT current_state) AS states, min(t) AS first, max(t) AS last FROM vectors GROUP BY runnable",
    "q_crash_validation": f"""{PREFIX}, {STAND_IN}, {NORMAL}, crashes AS (SELECT 'c' || k AS name, {DAY0} + k * 432000 AS p0 FROM generate_series(1, 5) AS g(k)),
        phases AS (SELECT name, 'pre' AS phase, p0 AS lo, p0 + 43200 AS hi, p0 + 43200 AS peak FROM crashes UNION ALL SELECT name, 'peak', p0 + 43200, p0 + 86400, p0 + 43200 FROM crashes)
        SELECT name, phase, count(*) AS n, count(*) FILTER (label = -1) AS anomalies, round(count(*) FILTER (label = -1) * 100.0::DOUBLE / count(*), 6) AS anomaly_pct, round(max(risk_score), 6) AS max_score, round(avg(risk_score), 6) AS mean_score,
            min(t) FILTER (label = -1) AS first_alert, round((max(peak) - min(t) FILTER (label = -1)) / 60.0::DOUBLE, 6) AS lead_minutes FROM labelled JOIN phases ON t BETWEEN lo AND hi GROUP BY name, phase""",
    "q_model_jaccard": f"""{PREFIX}, {STAND_IN}, {NORMAL} SELECT runnable, count(*) FILTER (label = -1 AND fatal_count_1h > 0) AS "both", count(*) FILTER (label = -1 OR fatal_count_1h > 0) AS either,
        round(CASE WHEN count(*) FILTER (label = -1 OR fatal_count_1h > 0) > 0 THEN count(*) FILTER (label = -1 AND fatal_count_1h > 0) * 100.0::DOUBLE / count(*) FILTER (label = -1 OR fatal_count_1h > 0) ELSE 0.0 END, 6) AS jaccard_pct FROM labelled GROUP BY runnable""",
    "q_recall_curve": f"{PREFIX}, {STAND_IN}, {NORMAL} SELECT CAST(c * 5 AS INT) AS threshold, round(avg(CAST(risk_score >= c * 5 AS DOUBLE)), 6) AS recall FROM labelled, generate_series(0, 19) AS g(c) GROUP BY c",
}

DETECTIONS = f"""{LOGS}, {MATCHES}, {FLUSHED}, st AS (SELECT runnable, epoch, seq, state FROM logs WHERE state IS NOT NULL),
counted AS (
    SELECT a.rule_id, a.severity, a.runnable, a.epoch, a.seq, CASE WHEN any_value(a.rule_id) IN ('T1', 'T2') THEN count(b.seq) ELSE 1 END AS match_count
    FROM matches a LEFT JOIN matches b ON a.rule_id = b.rule_id AND a.runnable = b.runnable AND b.epoch >= a.epoch - CASE a.rule_id WHEN 'T1' THEN 86400 ELSE 172800 END AND (b.epoch, b.seq) <= (a.epoch, a.seq)
    GROUP BY a.rule_id, a.severity, a.runnable, a.epoch, a.seq),
judged AS (SELECT *, (rule_id = 'T1' AND match_count >= 2) OR (rule_id = 'T2' AND match_count >= 3) AS escalated FROM counted),
detections AS (
    SELECT rule_id, CASE WHEN escalated THEN CASE rule_id WHEN 'T1' THEN 'P1' ELSE 'CRITICAL' END ELSE severity END AS severity, runnable, epoch, seq, match_count, escalated FROM judged
    UNION ALL SELECT 'Q1', 'HIGH', a.runnable, a.epoch, a.seq, 1, false FROM st a JOIN st b ON a.runnable = b.runnable AND b.epoch >= a.epoch - 86400 AND (b.epoch, b.seq) <= (a.epoch, a.seq)
    GROUP BY a.runnable, a.epoch, a.seq HAVING string_agg('<' || b.state || '>', '' ORDER BY b.epoch, b.seq) LIKE '%<STARTED>%<DOWN>%'
    UNION ALL SELECT 'Q1', 'HIGH', runnable, epoch, -1 - seq, 1, false FROM flushed)"""
COOLED = f"WITH RECURSIVE {DETECTIONS}, {throttle_sql('detections', ('rule_id', 'runnable'), 'epoch', 'seq', 21600)}"
NAMED = "CASE w.rule_id " + " ".join(f"WHEN '{r.rule_id}' THEN '{r.name}'" for r in RULES.rules) + " END"

#: The fold of incidents, one detection a step; a component of the dependency graph never meets another, so one list holds all.
NEAR = {n: sorted({*correlate.PARENTS.get(n, ()), *(c for c, ps in correlate.PARENTS.items() if n in ps)}) for n in correlate.LAYERS}
FOLD = f"""{DETECTIONS}, near(runnable, layer, parents, near) AS (VALUES {", ".join(f"('{n}', {k}, {quoted(correlate.PARENTS.get(n, ()))}::VARCHAR[], {quoted(tuple(NEAR[n]))}::VARCHAR[])" for n, k in correlate.LAYERS.items())}),
ranks(severity, rank) AS (VALUES ('P1', 5), ('CRITICAL', 4), ('HIGH', 3), ('MEDIUM', 2), ('LOW', 1)),
ordered AS (SELECT row_number() OVER (ORDER BY epoch, seq, coalesce(o.ord, 1)) AS i, substr(sha256(d.rule_id || '|' || d.runnable || '|' || epoch || '|' || seq), 1, 12) AS id, epoch, seq, coalesce(o.ord, 1) AS ord, d.rule_id, d.severity, rank, d.runnable, layer, near
    FROM detections d LEFT JOIN rules o ON o.rule_id = d.rule_id JOIN ranks r ON r.severity = d.severity JOIN near n ON n.runnable = d.runnable),
fold AS (
    SELECT CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(id VARCHAR, updated BIGINT, runnables VARCHAR[], rules VARCHAR[], rank INTEGER)[]) AS open, CAST(NULL AS VARCHAR) AS incident_id
    UNION ALL
    SELECT i, CASE WHEN pick IS NULL THEN list_append(live, {{'id': id, 'updated': epoch, 'runnables': [runnable], 'rules': [rule_id], 'rank': rank}})
        ELSE list_transform(live, lambda x: CASE WHEN x.id = pick THEN {{'id': x.id, 'updated': epoch, 'runnables': list_distinct(list_append(x.runnables, runnable)), 'rules': list_distinct(list_append(x.rules, rule_id)), 'rank': greatest(x.rank, rank)}} ELSE x END) END, coalesce(pick, id)
    FROM (SELECT *, coalesce(list_filter(live, lambda x: list_contains(x.runnables, runnable) AND (list_contains(x.rules, rule_id) OR rank >= 3))[-1].id,
            CASE WHEN rank >= 3 THEN list_filter(live, lambda x: x.rank >= 3 AND list_has_any(x.runnables, near))[-1].id END) AS pick
        FROM (SELECT o.*, list_filter(f.open, lambda x: o.epoch - x.updated <= 43200) AS live FROM fold f JOIN ordered o ON o.i = f.i + 1))),
placed AS (SELECT o.*, incident_id FROM ordered o JOIN fold USING (i))"""
INCIDENTS = f"""{FOLD}, firsts AS (SELECT incident_id, runnable, min(i) AS i FROM placed GROUP BY 1, 2), listed AS (SELECT incident_id, list(runnable ORDER BY i) AS names FROM firsts GROUP BY 1),
roots AS (SELECT incident_id, arg_min(runnable, (layer, i)) AS root, arg_min(rule_id, (layer, i)) AS root_rule, min(layer) AS root_layer, arg_min(severity, (-rank, i)) AS severity, min(epoch) AS created, max(epoch) AS updated, count(*) AS detection_count FROM placed GROUP BY 1),
cascades AS (SELECT l.incident_id, names, coalesce((SELECT list(f.runnable ORDER BY f.i) FROM firsts f JOIN near n ON n.runnable = f.runnable WHERE f.incident_id = l.incident_id AND list_contains(n.parents, r.root)), []) AS cascade FROM listed l JOIN roots r USING (incident_id)),
incidents AS (SELECT incident_id, severity, created, updated, detection_count, array_to_string(names, ',') AS runnables, root AS root_cause_runnable, root_rule AS root_cause_rule,
    CASE WHEN len(names) = 1 THEN 'Isolated problem (isolato) on ' || root || '.' WHEN len(cascade) > 0 THEN 'Probable root cause: ' || root || ' (layer ' || root_layer || '). Cascade (cascata) to ' || array_to_string(cascade, ', ') || '.'
        ELSE 'Affected: ' || array_to_string(names, ', ') || '. Lowest layer: ' || root || ' (layer ' || root_layer || '). Check whether they belong together.' END AS root_cause_estimate FROM roots JOIN cascades USING (incident_id))"""

ORACLE |= {
    "q_incidents": f"WITH RECURSIVE {INCIDENTS} SELECT * FROM incidents",
    "q_incident_stats": f"WITH RECURSIVE {INCIDENTS} SELECT severity, CASE WHEN detection_count = 1 THEN '1' WHEN detection_count <= 5 THEN '2-5' WHEN detection_count <= 20 THEN '6-20' ELSE '20+' END AS size, count(*) AS n FROM incidents GROUP BY 1, 2",
    "q_incident_members": f"WITH RECURSIVE {FOLD} SELECT incident_id, epoch, seq, CAST(ord - 1 AS INT) AS rule_order, runnable, rule_id || ': ' AS event FROM placed",
    "q_open_incidents": f"""WITH RECURSIVE {INCIDENTS} SELECT incident_id, severity, updated, root_cause_runnable FROM incidents i
        WHERE NOT EXISTS (SELECT 1 FROM logs l WHERE l.level = 'INFO' AND l.runnable = i.root_cause_runnable AND l.epoch > i.updated AND l.epoch <= i.updated + 3600)""",
    "q_detections": f"WITH {DETECTIONS} SELECT * FROM detections",
    "q_alerts": f"""{COOLED} SELECT w.rule_id, w.runnable, w.epoch, w.seq, d.severity, 'Alert ' || d.severity || ': ' || {NAMED} || ' on ' || w.runnable AS title,
        CASE WHEN d.severity IN ('P1', 'CRITICAL') THEN 'email,sms,teams' WHEN d.severity = 'HIGH' THEN 'email,teams' WHEN d.severity = 'MEDIUM' THEN 'email' ELSE 'log' END AS channels, 0.9::DOUBLE AS confidence
        FROM walk w JOIN detections d ON d.rule_id = w.rule_id AND d.runnable = w.runnable AND d.seq = w.seq WHERE kept""",
    "q_alert_stats": f"""{COOLED} SELECT d.severity, count(*) AS detections, count(*) FILTER (kept) AS alerts, count(*) FILTER (NOT kept) AS suppressed
        FROM walk w JOIN detections d ON d.rule_id = w.rule_id AND d.runnable = w.runnable AND d.seq = w.seq GROUP BY d.severity""",
    "q_top_features": f"""{PREFIX}, x AS (SELECT *, {STATE} AS state_risk FROM vectors),
        long AS ({" UNION ALL ".join(f"SELECT runnable, t, {i} AS i, '{c}' AS name, CASE WHEN {c} = -1 THEN 0.0 ELSE CAST({c} AS DOUBLE) END AS v FROM x" for i, c in enumerate((*risk.FEATURES, "state_risk")))}),
        z AS (SELECT *, (v - avg(v) OVER w) / CASE WHEN stddev_pop(v) OVER w = 0 THEN 1 ELSE stddev_pop(v) OVER w END AS z FROM long WINDOW w AS (PARTITION BY i)),
        r AS (SELECT *, row_number() OVER (PARTITION BY runnable, t ORDER BY round(abs(z), 9) DESC, i DESC) AS n FROM z)
        SELECT runnable, t, coalesce(string_agg(name, ',' ORDER BY n) FILTER (n <= 5 AND round(abs(z), 9) > 0.5), '') AS top FROM r GROUP BY runnable, t""",
}
