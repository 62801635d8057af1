"""Alerts: one row of text, channels and confidence for each detection that its cooldown lets through."""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators.throttle import throttle

COOLDOWN_MINUTES = 15
CONFIDENCE = 0.9
#: Seconds that an external service has for an alert.
SECONDS = 15
#: Channels by severity; others are only logged.
CHANNELS = {"P1": ("email", "sms", "teams"), "CRITICAL": ("email", "sms", "teams"), "HIGH": ("email", "teams"), "MEDIUM": ("email",)}
#: Title and narrative by rule; {placeholders} are columns. Rules without an entry take the default.
TEMPLATES = {
    "C01": ("Connection pool exhausted: {runnable}", "No free connection is left in the pool of {runnable}: {match_count} reports since {time}. Look for slow or blocked queries."),
    "C02": ("Database login failed: {runnable}", "{runnable} can't open its database. It may be offline or out of reach, or the credentials are wrong."),
    "C03": ("Schema migration failed: {runnable}", "The schema doesn't fit the version that {runnable} expects, so it restarts in a loop. Repair the schema; another restart won't help."),
    "C04": ("Service inoperative: {runnable}", "{runnable} ended up inoperative at {time}. The boot log tells which error kept it from starting."),
    "C05": ("Crash during shutdown: {runnable}", "{runnable} tried to make new objects while it shut down at {time}. If that repeats, find out what shuts it down."),
    "H01": ("Null pointers in job monitoring: {runnable}", "{match_count} null pointers in the job monitoring of {runnable}. They tend to come before a crash."),
    "H02": ("Objects can't be loaded: {runnable}", "{match_count} objects couldn't be loaded by {runnable}. Many of them mean that data or schema are inconsistent."),
    "H03": ("Objects can't be saved: {runnable}", "{match_count} objects couldn't be saved by {runnable}. Look for locks, a full pool or violated constraints."),
    "H04": ("Export user's login failed: {runnable}", "The export user can't log in to {runnable}. Check its credentials."),
    "S01": ("Restart loop: {runnable}", "{runnable} started and went down again and again within the {window}. Find the fatal error in its boot log first."),
    "S02": ("Crash without recovery: {runnable}", "{runnable} went down and wasn't started again within the {window}."),
    "S03": ("Slow shutdown: {runnable}", "{runnable} has been stopping for longer than the {window} allows."),
}
DEFAULT = ("Alert {severity}: {rule_name} on {runnable}", "Found on {runnable}: {summary}. Severity {severity}, rule {rule_id} ({rule_name}). {suggested_action}")


def fill(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def channels(severity: Column) -> Column:
    by = F.create_map(*[x for k, v in CHANNELS.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    return F.coalesce(by[severity], F.array(F.lit("log")))


def narrate(detections: DataFrame, templates: dict[str, tuple[str, str]] = TEMPLATES, default: tuple[str, str] = DEFAULT) -> DataFrame:
    """Alerts from detections, by templates in one projection; no row is looked up elsewhere."""
    pick = lambda k: F.coalesce(F.create_map(*[x for r, t in templates.items() for x in (F.lit(r), F.lit(t[k]))])[F.col("rule_id")], F.lit(default[k]))
    col = lambda n, other="": F.col(n) if n in detections.columns else F.lit(other)
    values = {
        "runnable": F.col("runnable"), "time": F.date_format(F.timestamp_seconds("epoch"), "HH:mm, dd/MM/yyyy"), "match_count": col("match_count", 1), "severity": F.col("severity"), "rule_id": F.col("rule_id"),
        "rule_name": col("rule_name"), "summary": col("summary"), "suggested_action": col("suggested_action"), "window": F.lit("time window"),
    }
    return detections.withColumns({"title": fill(pick(0), values), "narrative": F.trim(fill(pick(1), values)), "channels": channels(F.col("severity")), "confidence": F.lit(CONFIDENCE)})


def alerts(detections: DataFrame, cooldown_minutes: int = COOLDOWN_MINUTES, force: str | None = None, **kw) -> DataFrame:
    """narrate() for detections that their (rule, runnable)'s cooldown lets through."""
    # Detections of one record have one seq; with the rule in the key it's unique.
    kept = throttle(detections, ["rule_id", "runnable"], cooldown_minutes * 60, "epoch", "seq", force).where("kept").drop("kept")
    return narrate(kept, **kw)


def alert_stats(detections: DataFrame, cooldown_minutes: int = COOLDOWN_MINUTES) -> DataFrame:
    flagged = throttle(detections, ["rule_id", "runnable"], cooldown_minutes * 60)
    return flagged.groupBy("severity").agg(F.count("*").alias("detections"), F.count_if("kept").alias("alerts"), F.count_if(~F.col("kept")).alias("suppressed"))


def narrate_external(detections: DataFrame, call: Callable[[str], str | None], schema: str = "title string, narrative string, suggested_action string, confidence double", seconds: float = SECONDS) -> DataFrame:
    """Alerts whose text an external service writes: call(prompt) gives JSON or None; without a valid reply within so many seconds the template's text stays. Off unless called."""
    base = narrate(detections)
    prompt = F.concat_ws("\n", "rule_id", "severity", "runnable", "title", "narrative")

    def run(batches):
        for pdf in batches:
            yield pdf.assign(reply=[_safe(call, p, seconds) for p in pdf["prompt"]])

    asked = base.withColumn("prompt", prompt)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in asked.schema] + [T.StructField("reply", T.StringType(), True)])
    replied = asked.mapInPandas(run, nullable)
    r = replied.withColumn("__r", F.from_json("reply", schema))
    has = F.col("__r.title").isNotNull() & F.col("__r.narrative").isNotNull()
    return r.withColumns({"title": F.when(has, F.col("__r.title")).otherwise(F.col("title")), "narrative": F.when(has, F.col("__r.narrative")).otherwise(F.col("narrative")), "confidence": F.when(has, F.coalesce("__r.confidence", F.lit(0.7))).otherwise(F.col("confidence"))}).drop("__r", "prompt", "reply")


def _safe(call: Callable[[str], str | None], prompt: str, seconds: float) -> str | None:
    """What call gives, None if it fails or takes longer; a call that hangs is left to itself."""
    box: queue.SimpleQueue = queue.SimpleQueue()

    def ask() -> None:
        try:
            box.put(call(prompt))
        except Exception:  # a service that fails must not stop alerts
            box.put(None)

    threading.Thread(target=ask, daemon=True).start()
    try:
        return box.get(timeout=seconds)
    except queue.Empty:
        return None
