"""Streaming operators with state and event-time timers: records of several lines, state sequences, missing follow-ups, closed windows.

Rows later than the watermark are dropped by Spark. State stands in RocksDB, so it needn't fit in an executor's memory.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from emberlog.operators import parse
from emberlog.operators.detect import Catalogue, Rule
from emberlog.streaming.operators import WATERMARK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Columns of a record that pandas would turn into other types; they travel as microseconds.
TIMES = ("ts", "end_ts")


def _stateful(stream: DataFrame) -> None:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _milliseconds(times: pd.Series) -> int:
    return int(times.max().timestamp() * 1000)


class OpenRecord(StatefulProcessor):
    """Per file the one record that may still grow: its own columns, its stack trace and the lines added to its message."""

    def __init__(self, columns: list[str], idle_ms: int):
        self.columns, self.idle_ms = columns, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", "head string, stack string, more string")

    def close(self) -> None:
        pass

    def _frame(self, done: list[tuple]) -> pd.DataFrame:
        rows = [[*json.loads(head), None if stack is None else stack, more] for head, stack, more in done]
        return pd.DataFrame(rows, columns=[*self.columns, "__stack", "__more"], dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        lines = pd.concat(list(rows)).sort_values("line_number", kind="stable")
        open_ = list(self.record.get()) if self.record.exists() else None
        stack, more, done = [], [], []

        def grown() -> tuple:
            head, before, after = open_
            return head, "\n".join(([before] if before is not None else []) + stack) if stack or before is not None else None, "\n".join(([after] if after is not None else []) + more) if more or after is not None else None

        for kind, text, head in zip(lines["kind"], lines["text"], lines["head"], strict=True):
            if kind == "record":
                if open_ is not None:
                    done.append(grown())
                open_, stack, more = [head, None, None], [], []
            elif open_ is not None and kind == "stack":
                stack.append(text)
            elif open_ is not None and kind == "more":
                more.append(text)
        if open_ is not None:
            self.record.update(grown())
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(max(_milliseconds(lines["arrived"]), timerValues.getCurrentWatermarkInMs()) + self.idle_ms)
        if done:
            yield self._frame(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.record.exists():
            last = tuple(self.record.get())
            self.record.clear()
            yield self._frame([last])


def records(lines: DataFrame, idle_seconds: int = 600, watermark: str = WATERMARK, tz_mode: str = "approx", product: str | None = None) -> DataFrame:
    """Records of a stream of lines (source_file, source_path, line_number, line, arrived; runnable_hint if there is one), as parse.records gives them.

    A file's lines come in order, in however many micro-batches. A record is given out when the file's next one begins,
    or by a timer when the watermark of `arrived` is idle_seconds past the file's last line; lines that continue a
    record after that are dropped, like those before a file's first record.
    """
    _stateful(lines)
    hint = F.col("runnable_hint") if "runnable_hint" in lines.columns else F.lit(None).cast("string")
    kept = lines.select("source_file", "source_path", hint.alias("runnable_hint"), "line_number", "line", "arrived").withWatermark("arrived", watermark)
    parsed = parse.parse_lines(kept.where(~parse.is_noise(F.coalesce(F.col("line"), F.lit("")))), "line", tz_mode)
    kinds = dict(parsed.dtypes)
    fixed = [c for c in parsed.columns if c not in ("line", "arrived", "source_file", "bad_time")]
    # The record's own columns travel as one text, so that state and pandas keep their types as they are.
    values = [F.unix_micros(c).cast("string") if c in TIMES else F.col(c).cast("string") for c in fixed]
    kind, text = parse.line_kind(parsed, "line", product)
    shaped = parsed.select("source_file", "line_number", "arrived", kind.alias("kind"), text.alias("text"), F.to_json(F.array(*values), {"ignoreNullFields": "false"}).alias("head"))
    schema = ", ".join(["source_file string", *[f"`{c}` string" for c in [*fixed, "__stack", "__more"]]])

    class Grouped(OpenRecord):
        def handleInputRows(self, key, rows, timerValues):
            for frame in super().handleInputRows(key, rows, timerValues):
                frame.insert(0, "source_file", key[0])
                yield frame

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            for frame in super().handleExpiredTimer(key, timerValues, expiredTimerInfo):
                frame.insert(0, "source_file", key[0])
                yield frame

    out = shaped.groupBy("source_file").transformWithStateInPandas(Grouped(fixed, idle_seconds * 1000), schema, "append", "EventTime")
    out = out.withColumns({c: F.timestamp_micros(F.col(c).cast("long")) if c in TIMES else F.col(c).cast(kinds[c]) for c in fixed})
    return parse.placed(parse.finished(out))


class Sequences(StatefulProcessor):
    """Per runnable: changes that the watermark hasn't passed yet, the latest start of each beginning of each rule's sequence, and states that wait for a follow-up."""

    def __init__(self, rules: list[tuple[int, Rule]]):
        self.rules = rules

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "epoch long, seq long, state string")
        self.known = handle.getValueState("known", "starts string, targets string")

    def close(self) -> None:
        pass

    def _advance(self, runnable: str, watermark: int) -> list[tuple]:
        rows = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        starts, targets = map(json.loads, self.known.get()) if self.known.exists() else ({}, {})
        due, later, out = [r for r in rows if r[0] * 1000 <= watermark], [r for r in rows if r[0] * 1000 > watermark], []
        moments = [(e, s, state) for e, s, state in due] + [(watermark / 1000, None, None)]
        for epoch, seq, state in moments:
            for k, rule in self.rules:
                if rule.runnable_filter and runnable not in rule.runnable_filter:
                    continue
                name, wide, order = str(k), rule.window_minutes * 60, rule.state_sequence
                target = targets.get(name)
                # What had to follow by now: the stream's time has passed the window of a state that still waits.
                if target is not None and not target[2] and epoch - target[0] >= wide:
                    out.append((runnable, k, int(target[0]), -1 - target[1], int(target[0]) + wide))
                    target[2] = True
                if state is None or not order:
                    continue
                best = starts.setdefault(name, [None] * len(order))
                for m in range(len(order) - 1, -1, -1):
                    begun = epoch if m == 0 else best[m - 1]
                    if state == order[m] and begun is not None:
                        best[m] = begun
                if best[-1] is not None and best[-1] >= epoch - wide:
                    out.append((runnable, k, epoch, seq, epoch))
                if rule.no_followup_state and len(order) > 1:
                    if target is not None and state == rule.no_followup_state and epoch > target[0]:
                        targets.pop(name)
                    if state == order[-1]:
                        targets[name] = [epoch, seq, False]
        self.waiting.put([tuple(r) for r in later]) if later else self.waiting.clear()
        self.known.update((json.dumps(starts), json.dumps(targets)))
        wide = {str(k): r.window_minutes * 60 for k, r in self.rules}
        needed = [r[0] * 1000 for r in later[:1]] + [(t[0] + wide[n]) * 1000 for n, t in targets.items() if not t[2]]
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if needed:
            self.handle.registerTimer(max(int(min(needed)), watermark + 1))
        return out

    def _frame(self, found: list[tuple]) -> Iterator[pd.DataFrame]:
        if found:
            yield pd.DataFrame(found, columns=["runnable", "rule_order", "epoch", "seq", "detected_epoch"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self.waiting.appendList([(int(e), int(s), x) for e, s, x in zip(frame["epoch"], frame["seq"], frame["state"], strict=True)])
        yield from self._frame(self._advance(key[0], timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._frame(self._advance(key[0], timerValues.getCurrentWatermarkInMs()))


def sequences(stream: DataFrame, catalogue: Catalogue, watermark: str = WATERMARK) -> DataFrame:
    """Detections of the catalogue's sequence rules on a stream of records (runnable, state, epoch, seq, ts): rule_id, rule_order, severity, runnable, epoch, seq, detected_epoch.

    Rows may come in any order within the watermark; they are taken in order of time once it has passed them. A sequence is
    found at each change at which detect.state_sequences finds it. A last state that waits for a follow-up is told when the
    stream's time has passed its window, with -1 - seq: it is what detect.no_followup would have told had the
    stream ended then. The state is the latest start of each beginning of a sequence, however many changes there were.
    """
    _stateful(stream)
    rules = catalogue.of("STATE_SEQUENCE")
    rows = stream.where("state IS NOT NULL").withWatermark("ts", watermark).select("runnable", "epoch", "seq", "state", "ts")
    found = rows.groupBy("runnable").transformWithStateInPandas(Sequences(rules), "runnable string, rule_order int, epoch long, seq long, detected_epoch long", "append", "EventTime")
    told = F.create_map(*[x for k, r in rules for x in (F.lit(k), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity")))])
    return found.withColumn("__r", told[F.col("rule_order")]).select("__r.rule_id", "rule_order", "__r.severity", "runnable", "epoch", "seq", "detected_epoch")


class ClosedWindows(StatefulProcessor):
    """Per runnable the sums of each step's bucket, those at exactly its grid point, and the distinct values of both."""

    def __init__(self, names: list[str], length: int, step: int):
        self.names, self.length, self.step = names, length, step

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "buckets string, next long, lo long, hi long")

    def close(self) -> None:
        pass

    def _emit(self, runnable: str, buckets: dict, next_: int | None, lo: int, hi: int, watermark: int) -> pd.DataFrame | None:
        n, empty = len(self.names), {"b": None, "a": None, "v": [], "w": []}
        t = lo // self.step * self.step + self.step if next_ is None else next_
        out = []
        while t * 1000 <= watermark and t <= hi:
            inside = [buckets[x] for x in range(t - self.length + self.step, t + 1, self.step) if x in buckets]
            edge = buckets.get(t - self.length, empty)
            sums = [sum(x["b"][k] for x in inside) + (edge["a"][k] if edge["a"] else 0) for k in range(n)]
            out.append((runnable, t, *sums, len({v for x in inside for v in x["v"]} | set(edge["w"]))))
            t += self.step
            next_ = t
        kept = {x: v for x, v in buckets.items() if next_ is None or x >= next_ - self.length}
        self.known.update((json.dumps(kept), next_, lo, hi))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if t <= hi:
            self.handle.registerTimer(max(t * 1000, watermark + 1))
        return pd.DataFrame(out, columns=["runnable", "t", *self.names, "distinct_values"]) if out else None

    def _state(self) -> tuple:
        if not self.known.exists():
            return {}, None, None, None
        buckets, next_, lo, hi = self.known.get()
        return {int(k): v for k, v in json.loads(buckets).items()}, next_, lo, hi

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        buckets, next_, lo, hi = self._state()
        for frame in rows:
            e = frame["epoch"].astype("int64")
            lo, hi = min(int(e.min()), lo if lo is not None else int(e.min())), max(int(e.max()), hi if hi is not None else int(e.max()))
            up = -(-e // self.step) * self.step
            for t, mine in frame.groupby(up, sort=False):
                on = mine[mine["epoch"] % self.step == 0]
                was = buckets.setdefault(int(t), {"b": [0] * len(self.names), "a": [0] * len(self.names), "v": [], "w": []})
                was["b"] = [x + int(mine[f"m_{m}"].sum()) for x, m in zip(was["b"], self.names, strict=True)]
                was["a"] = [x + int(on[f"m_{m}"].sum()) for x, m in zip(was["a"], self.names, strict=True)]
                was["v"], was["w"] = sorted({*was["v"], *mine["value"].dropna()}), sorted({*was["w"], *on["value"].dropna()})
        found = self._emit(key[0], buckets, next_, lo, hi, timerValues.getCurrentWatermarkInMs())
        if found is not None:
            yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.known.exists():
            found = self._emit(key[0], *self._state(), timerValues.getCurrentWatermarkInMs())
            if found is not None:
                yield found


def closed_windows(stream: DataFrame, measures: Mapping[str, Column], value: Column | None = None, length: int = 3600, step: int = 300, watermark: str = WATERMARK) -> DataFrame:
    """(runnable, t, a count per measure, distinct_values): counts over closed windows [t - length, t] at every grid point, as the batch's GridWindows gives them.

    The stream has runnable, epoch, ts and what the measures need; value's distinct values (not null) are counted exactly.
    Rows may come in any order within the watermark. A grid point is given out once the watermark has passed it, up to
    the last row seen. State is a row of sums, and its distinct values, a step of the window.
    """
    if length % step:
        raise ValueError("the window's length has to be a multiple of the step")
    _stateful(stream)
    names = list(measures)
    text = F.lit(None).cast("string") if value is None else value.cast("string")
    rows = stream.withWatermark("ts", watermark).select("runnable", "epoch", "ts", text.alias("value"), *[F.coalesce(c.cast("long"), F.lit(0)).alias(f"m_{n}") for n, c in measures.items()])
    schema = "runnable string, t long, " + ", ".join(f"`{n}` long" for n in [*names, "distinct_values"])
    return rows.groupBy("runnable").transformWithStateInPandas(ClosedWindows(names, length, step), schema, "append", "EventTime")
