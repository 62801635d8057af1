"""Rule detection: a declarative catalogue is compiled to Columns; frequency and state sequences are windows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.operators.windows import in_order, trailing_counts


@dataclass(frozen=True)
class Escalation:
    threshold: int
    window_minutes: int
    escalate_to: str


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    pattern_type: str
    severity: str
    pattern: str = ""
    description: str = ""
    enabled: bool = True
    runnable_filter: tuple[str, ...] = ()
    level_filter: tuple[str, ...] = ()
    match_stack_trace: bool = False
    state_sequence: tuple[str, ...] = ()
    window_minutes: int = 10
    no_followup_state: str | None = None
    frequency_escalation: Escalation | None = None
    tags: tuple[str, ...] = ()
    suggested_action: str = ""


#: Order in which one record's detections come: sequences, keywords, expressions, each in the catalogue's order.
TYPES = ("STATE_SEQUENCE", "KEYWORD", "REGEX")


@dataclass(frozen=True)
class Catalogue:
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def of(self, *kinds: str) -> list[tuple[int, Rule]]:
        ordered = sorted(enumerate(r for r in self.rules if r.enabled), key=lambda x: (TYPES.index(x[1].pattern_type), x[0]))
        return [(k, r) for k, (_, r) in enumerate(ordered) if r.pattern_type in kinds]


def applies(rule: Rule) -> Column:
    """Runnable and level filters; empty ones take all."""
    out = F.lit(True)
    if rule.runnable_filter:
        out = out & F.col("runnable").isin(*rule.runnable_filter)
    if rule.level_filter:
        out = out & F.col("level").isin(*rule.level_filter)
    return out


def condition(rule: Rule) -> Column:
    """Whether a record matches: the cheap filters first, then message, then stack trace if the rule wants it."""
    if rule.pattern_type == "KEYWORD":
        test = lambda c: F.contains(F.coalesce(c, F.lit("")), F.lit(rule.pattern))
    elif rule.pattern:
        test = lambda c: F.coalesce(c, F.lit("")).rlike("(?isU)" + rule.pattern)
    else:
        return F.lit(False)
    hit = test(F.col("message"))
    if rule.match_stack_trace:
        hit = hit | test(F.col("stack_trace"))
    return applies(rule) & hit


def detection_id(*parts: Column) -> Column:
    """The same id in each run: a hash of what was detected where."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 12)


def match_rules(records: DataFrame, catalogue: Catalogue) -> DataFrame:
    """A row for each record and rule that match. Rules are evaluated in one projection of the scan; there's no join."""
    rules = catalogue.of("KEYWORD", "REGEX")
    if not rules:
        return records.withColumns({"rule_id": F.lit(None).cast("string"), "rule_order": F.lit(0), "severity": F.lit(None).cast("string"), "rule_name": F.lit(None).cast("string"), "suggested_action": F.lit(None).cast("string")}).where("false")
    hits = F.array_compact(F.array(*[F.when(condition(r), F.lit(k)) for k, r in rules]))
    names = F.create_map(*[x for k, r in rules for x in (F.lit(k), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("name"), F.lit(r.severity).alias("severity"), F.lit(r.suggested_action).alias("action")))])
    out = records.select("*", F.explode(hits).alias("rule_order")).withColumn("__r", names[F.col("rule_order")])
    return out.select(*records.columns, "rule_order", F.col("__r.rule_id").alias("rule_id"), F.col("__r.name").alias("rule_name"), F.col("__r.severity").alias("severity"), F.col("__r.action").alias("suggested_action"))


def escalate(matches: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Adds match_count, escalated, original_severity and the raised severity, by the trailing count of each (rule, runnable).

    Rules that share a window length are counted together; others keep a count of one.
    """
    groups: dict[int, list[Rule]] = {}
    for _, r in catalogue.of("KEYWORD", "REGEX"):
        if r.frequency_escalation:
            groups.setdefault(r.frequency_escalation.window_minutes, []).append(r)
    limit, to = F.lit(None).cast("long"), F.lit(None).cast("string")
    counted_ids = [r.rule_id for rules in groups.values() for r in rules]
    out = matches.where(~F.col("rule_id").isin(counted_ids) if counted_ids else F.lit(True)).withColumn("match_count", F.lit(1).cast("long"))
    for minutes, rules in groups.items():
        mine = matches.where(F.col("rule_id").isin([r.rule_id for r in rules]))
        out = out.unionByName(trailing_counts(mine, ["rule_id", "runnable"], "epoch", "seq", minutes * 60, "match_count"))
        for r in rules:
            limit = F.when(F.col("rule_id") == r.rule_id, F.lit(r.frequency_escalation.threshold).cast("long")).otherwise(limit)
            to = F.when(F.col("rule_id") == r.rule_id, F.lit(r.frequency_escalation.escalate_to)).otherwise(to)
    out = out.withColumns({"__limit": limit, "__to": to})
    up = F.coalesce(F.col("match_count") >= F.col("__limit"), F.lit(False))
    return out.withColumns({"escalated": up, "original_severity": F.when(up, F.col("severity")).otherwise(F.lit("")), "severity": F.when(up, F.col("__to")).otherwise(F.col("severity"))}).drop("__limit", "__to")


def state_sequences(states: DataFrame, rule: Rule) -> DataFrame:
    """State changes (runnable, epoch, seq, state) at which the rule's states stand in order within the window up to them; a rule without states has none."""
    some = states.where(F.col("runnable").isin(*rule.runnable_filter)) if rule.runnable_filter else states
    found = in_order(some, ["runnable"], "epoch", "seq", [F.col("state") == s for s in rule.state_sequence], rule.window_minutes * 60)
    return found.withColumns({"rule_id": F.lit(rule.rule_id), "severity": F.lit(rule.severity)})


def no_followup(records: DataFrame, rule: Rule, mode: str = "intended") -> DataFrame:
    """Per runnable the last change to the rule's last state that no later change to no_followup_state follows, at the end of the stream.

    The end is the time of the last of all records (runnable, epoch, seq, state or null), whatever its runnable.
    intended: the window has passed by then; strict: it ends exactly there. Rules with fewer than two states give none.
    """
    target = rule.state_sequence[-1] if rule.state_sequence else None
    ends = records.groupBy("runnable").agg(
        F.max(F.when(F.col("state") == target, F.struct("epoch", "seq"))).alias("target"),
        F.max(F.when(F.col("state") == rule.no_followup_state, F.col("epoch"))).alias("follow"),
        F.max("epoch").alias("last"),
    )
    ends = ends.withColumn("end", F.max("last").over(W.partitionBy()))  # a row per runnable
    if rule.runnable_filter:
        ends = ends.where(F.col("runnable").isin(*rule.runnable_filter))
    age = F.col("end") - F.col("target.epoch")
    late = age == rule.window_minutes * 60 if mode == "strict" else age >= rule.window_minutes * 60
    open_end = F.col("follow").isNull() | (F.col("follow") <= F.col("target.epoch"))
    found = ends.where(F.col("target").isNotNull() & open_end & late & F.lit(len(rule.state_sequence) > 1))
    return found.select("runnable", F.col("target.epoch").alias("epoch"), F.col("target.seq").alias("seq"), F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.severity).alias("severity"), F.col("end").alias("detected_epoch"))


def detect(records: DataFrame, catalogue: Catalogue) -> DataFrame:
    """All detections of records (runnable, level, message, stack_trace, state, epoch, seq): detection_id, epoch, seq, rule_order, rule_id, severity, runnable, summary, match_count, escalated, original_severity, suggested_action.

    A state that nothing followed by the end of the stream is detected at its own time, with -1 - seq of its record, so
    that it's told from a sequence that ends there.
    """
    common = ["epoch", "seq", "runnable", "rule_order", "rule_id", "rule_name", "severity", "summary", "match_count", "escalated", "original_severity", "suggested_action"]
    hit = escalate(match_rules(records, catalogue), catalogue)
    summary = F.concat(F.substring("message", 1, 80), F.when(F.col("escalated"), F.concat(F.lit(" [x"), F.col("match_count").cast("string"), F.lit("]"))).otherwise(F.lit("")))
    out = hit.withColumn("summary", summary).select(*common)
    states = records.where("state IS NOT NULL").select("runnable", "epoch", "seq", "state")
    for k, r in catalogue.of("STATE_SEQUENCE"):
        told = {"rule_order": F.lit(k), "rule_name": F.lit(r.name), "match_count": F.lit(1).cast("long"), "escalated": F.lit(False), "original_severity": F.lit(""), "suggested_action": F.lit(r.suggested_action)}
        out = out.unionByName(state_sequences(states, r).withColumns(told | {"summary": F.lit(" > ".join(r.state_sequence))}).select(*common))
        if r.no_followup_state:
            found = no_followup(records.select("runnable", "epoch", "seq", "state"), r).withColumns(told | {"summary": F.lit(f"{r.state_sequence[-1]} without {r.no_followup_state}"), "seq": -1 - F.col("seq")})
            out = out.unionByName(found.select(*common))
    return out.withColumn("detection_id", detection_id(F.col("rule_id"), F.col("runnable"), F.col("epoch"), F.col("seq")))
