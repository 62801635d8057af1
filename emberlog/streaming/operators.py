"""Streaming forms: matches, windows, throttle, frequency and incidents over a stream of records.

Records need runnable, level, message, ts (timestamp), epoch and seq. Rows later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from emberlog.operators import correlate, detect
from emberlog.operators.detect import Catalogue
from emberlog.operators.features import measures

WATERMARK = "10 minutes"


def matches(stream: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Rule matches; without state, so the batch operator does."""
    return detect.match_rules(stream, catalogue)


def window_counts(stream: DataFrame, length: str = "1 hour", step: str = "5 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Counts of each runnable in sliding windows, half open on the right; the batch operator's windows are closed."""
    flags = {n: c.cast("long") for n, c in measures().items()}
    rows = stream.withWatermark("ts", watermark).withColumns({f"m_{n}": c for n, c in flags.items()})
    return rows.groupBy("runnable", F.window("ts", length, step)).agg(*[F.sum(f"m_{n}").alias(n) for n in flags]).select("runnable", F.col("window.end").alias("window_end"), *flags)


def throttle(stream: DataFrame, gap: int, watermark: str = WATERMARK, force: str | None = None) -> DataFrame:
    """Detections (rule_id, runnable, epoch, seq, ts) that the cooldown of their rule and runnable lets through, and those with a true column `force`, which move the clock too."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["epoch", "seq"])
        kept = []
        for e, s, forced in zip(rows["epoch"], rows["seq"], rows["forced"], strict=True):
            if forced or last is None or e - last >= gap:
                last = int(e)
                kept.append((key[0], key[1], int(e), int(s)))
        state.update((last,))
        state.setTimeoutTimestamp(max((last + gap) * 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(kept, columns=["rule_id", "runnable", "epoch", "seq"])

    forced = F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False)
    rows = stream.withWatermark("ts", watermark).select("rule_id", "runnable", "epoch", "seq", "ts", forced.alias("forced"))
    return rows.groupBy("rule_id", "runnable").applyInPandasWithState(step, "rule_id string, runnable string, epoch long, seq long", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def frequency(stream: DataFrame, threshold: int, window_seconds: int, watermark: str = WATERMARK) -> DataFrame:
    """Detections with match_count and escalated: how many of their rule and runnable came in the window up to them. State is the window's times."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = list(state.get[0]) if state.exists else []
        out = []
        for e, s in pd.concat(list(batches)).sort_values(["epoch", "seq"])[["epoch", "seq"]].itertuples(index=False):
            times = [t for t in times if t >= e - window_seconds] + [int(e)]
            out.append((key[0], key[1], int(e), int(s), len(times), len(times) >= threshold))
        state.update((times,))
        state.setTimeoutTimestamp(max((times[-1] + window_seconds) * 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(out, columns=["rule_id", "runnable", "epoch", "seq", "match_count", "escalated"])

    rows = stream.withWatermark("ts", watermark).select("rule_id", "runnable", "epoch", "seq", "ts")
    return rows.groupBy("rule_id", "runnable").applyInPandasWithState(step, "rule_id string, runnable string, epoch long, seq long, match_count long, escalated boolean", "times array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def incident_updates(stream: DataFrame, minutes: int = correlate.WINDOW_MINUTES, watermark: str = WATERMARK, parents: dict = correlate.PARENTS) -> DataFrame:
    """Detections (detection_id, epoch, seq, rule_id, severity, runnable, ts) with incident_id, component by component; open incidents are the state."""
    component, near = correlate.groups(parents), correlate.neighbours(parents)
    keys = F.create_map(*[x for k, v in component.items() for x in (F.lit(k), F.lit(v))])
    columns = ["detection_id", "incident_id", "epoch"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        packed = state.get if state.exists else ([], [], [], [], [])
        open_ = [{"id": i, "updated": u, "runnables": set(r.split(",")), "rules": set(q.split(",")), "severity": s} for i, u, r, q, s in zip(*packed, strict=True)]
        out = []
        for d, t, _, rule, severity, runnable in pd.concat(list(batches)).sort_values(["epoch", "seq"])[["detection_id", "epoch", "seq", "rule_id", "severity", "runnable"]].itertuples(index=False):
            open_, found = correlate.place(open_, d, int(t), rule, severity, runnable, minutes, near)
            out.append((d, found["id"], int(t)))
        state.update(([i["id"] for i in open_], [i["updated"] for i in open_], [",".join(sorted(i["runnables"])) for i in open_], [",".join(sorted(i["rules"])) for i in open_], [i["severity"] for i in open_]))
        state.setTimeoutTimestamp(max((max(i["updated"] for i in open_) + minutes * 60) * 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(out, columns=columns)

    rows = stream.withWatermark("ts", watermark).withColumn("component", F.coalesce(keys[F.col("runnable")], F.concat(F.lit("~"), F.col("runnable"))))
    schema = "ids array<string>, updated array<bigint>, runnables array<string>, rules array<string>, severities array<bigint>"
    return rows.select("component", "detection_id", "epoch", "seq", "rule_id", "severity", "runnable", "ts").groupBy("component").applyInPandasWithState(step, "detection_id string, incident_id string, epoch long", schema, "append", GroupStateTimeout.EventTimeTimeout)
