"""Streaming forms give what the batch operators give on the same rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from emberlog.operators import correlate, detect
from emberlog.operators import throttle as batch_throttle
from emberlog.operators.detect import Catalogue, Escalation, Rule
from emberlog.operators import parse
from emberlog.operators.catalogue import DEFAULT
from emberlog.streaming import operators as streaming
from emberlog.streaming import stateful

RULES = Catalogue((Rule("a", "a", "KEYWORD", "HIGH", "x", frequency_escalation=Escalation(3, 5, "P1")), Rule("b", "b", "REGEX", "LOW", "y+")))
SCHEMA = "runnable string, level string, message string, stack_trace string, has_stack_trace boolean, state string, epoch long, seq long, ts timestamp"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    rng = random.Random(1)
    times = sorted(rng.randrange(4000) for _ in range(120))
    rows = [(rng.choice(["zoo_s", "ces_s", "agent"]), "ERROR", rng.choice(["x", "yy", "xy"]), None, False, None, t, k) for k, t in enumerate(times)]
    df = spark.createDataFrame(rows, SCHEMA.rsplit(", ", 1)[0]).withColumn("ts", F.timestamp_seconds("epoch"))
    path = str(tmp_path_factory.mktemp("stream") / "rows")
    df.coalesce(1).write.parquet(path)
    return df, path


def drained(spark, stream, tmp_path):
    name = "t" + str(abs(hash(str(tmp_path))))
    query = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).collect()


def test_matches(spark, source, tmp_path):
    df, path = source
    got = drained(spark, streaming.matches(spark.readStream.schema(SCHEMA).parquet(path), RULES).select("rule_id", "seq"), tmp_path)
    assert sorted(map(tuple, got)) == sorted((r.rule_id, r.seq) for r in detect.match_rules(df, RULES).collect())


def test_throttle(spark, source, tmp_path):
    df, path = source
    got = drained(spark, streaming.throttle(streaming.matches(spark.readStream.schema(SCHEMA).parquet(path), RULES), 300), tmp_path)
    want = batch_throttle.throttle(detect.match_rules(df, RULES), ["rule_id", "runnable"], 300).where("kept").collect()
    assert sorted((r.rule_id, r.runnable, r.seq) for r in got) == sorted((r.rule_id, r.runnable, r.seq) for r in want)


def test_frequency(spark, source, tmp_path):
    df, path = source
    only = Catalogue(RULES.rules[:1])
    got = drained(spark, streaming.frequency(streaming.matches(spark.readStream.schema(SCHEMA).parquet(path), only), 3, 300), tmp_path)
    want = detect.escalate(detect.match_rules(df, only), only).collect()
    assert sorted((r.seq, r.match_count, r.escalated) for r in got) == sorted((r.seq, r.match_count, r.escalated) for r in want)


def test_incidents(spark, source, tmp_path):
    df, path = source
    # A record may match two rules; in a stream as in a batch its time and number place both.
    one = Catalogue(RULES.rules[:1])
    made = lambda d: detect.match_rules(d, one).withColumn("detection_id", detect.detection_id(F.col("rule_id"), F.col("seq")))
    got = drained(spark, streaming.incident_updates(made(spark.readStream.schema(SCHEMA).parquet(path))), tmp_path)
    want = correlate.assign(made(df)).collect()
    assert {r.detection_id: r.incident_id for r in got} == {r.detection_id: r.incident_id for r in want}


def test_windows(spark, source, tmp_path):
    df, path = source
    got = drained(spark, streaming.window_counts(spark.readStream.schema(SCHEMA).parquet(path)), tmp_path)
    times = [(r.runnable, r.epoch) for r in df.collect()]
    for r in got:
        end = int(r.window_end.timestamp())
        assert r.error == sum(n == r.runnable and end - 3600 <= t < end for n, t in times)


def in_parts(spark, rows, schema, path, cuts):
    """Rows as files that a stream reads one a micro-batch, in order."""
    import os
    import time

    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.parquet(f"{path}/p{k}")
        for name in os.listdir(f"{path}/p{k}"):
            if name.endswith(".parquet"):
                os.utime(f"{path}/p{k}/{name}", (time.time() - 1000 + k,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


LINE = "source_file string, source_path string, line_number long, line string, arrived timestamp"


@pytest.mark.parametrize("seed", range(2))
def test_records_of_several_lines(spark, tmp_path, seed):
    """However the lines are split into micro-batches, the records are the batch's; the last ones come by a timer."""
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    rows = []
    for k in range(150):
        name = rng.choice(["runnable_arcm_s/a.log", "agent/b.log"])
        n = sum(r[0] == name for r in rows) + 1
        line = rng.choice([f"2024-01-02T03:04:05,{k:03d}|ERROR|arcm0|d|||t|Pool - m {k}", "\tat a.b(C.java:1)", "", "BUS-1 more", "EHLO x", "words", "Reusing existing ZKC instance", "2024-13-02T03:04:05,006 - bad"])
        rows.append((name, "/x/" + name, n, line, datetime(2024, 1, 2) + timedelta(seconds=k)))
    df = spark.createDataFrame(rows, LINE)
    want = parse.records(df.drop("arrived"))
    # A line of another file, a day later, moves the watermark.
    rows.append(("z.log", "z.log", 1, "nothing", datetime(2024, 1, 3)))
    cuts = sorted(rng.sample(range(1, len(rows)), 4))
    stream = stateful.records(in_parts(spark, rows, LINE, str(tmp_path / "in"), cuts))
    columns = sorted(set(want.columns) - {"log_family"})
    assert set(stream.columns) >= set(columns)
    got = drained(spark, stream.select(*columns), tmp_path)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want.select(*columns).collect())))


STATE = "runnable string, level string, message string, stack_trace string, state string, epoch long, seq long, ts timestamp"


@pytest.mark.parametrize("seed", range(2))
def test_sequences_and_missing_followups(spark, tmp_path, seed):
    """S01-S03 on a stream in any order within the watermark: the batch's sequences, and what the batch would have told of missing follow-ups had it ended at any time."""
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    rules = Catalogue(tuple(r for r in DEFAULT.rules if r.rule_id.startswith("S0")))
    assert len(rules.rules) == 3
    rows, t = [], 0
    for k in range(120):
        t += rng.choice([0, 5, 30, 100, 100, 400])
        state = rng.choice(["STARTING", "DOWN", "STARTED", "STOPPING", "STOPPED", None])
        rows.append((rng.choice(["zoo_s", "ces_s"]), "INFO", "m", None, state, t, k, datetime(1970, 1, 1) + timedelta(seconds=t)))
    df = spark.createDataFrame(rows, STATE)
    ordered = [r for r in sorted(rows, key=lambda r: (r[5], r[6])) if r[4]]
    want = set()
    for k, rule in rules.of("STATE_SEQUENCE"):
        want |= {(rule.rule_id, r.runnable, r.epoch, r.seq) for r in detect.state_sequences(df.where("state IS NOT NULL"), rule).collect()}
        for name in ("zoo_s", "ces_s") if rule.no_followup_state else ():
            mine = [r for r in ordered if r[0] == name]
            for i, r in enumerate(mine):
                if r[4] == rule.state_sequence[-1]:
                    late = r[5] + rule.window_minutes * 60
                    rest = [x for x in mine[i + 1 :] if x[5] < late]
                    if not any(x[4] == rule.state_sequence[-1] or (x[4] == rule.no_followup_state and x[5] > r[5]) for x in rest):
                        want.add((rule.rule_id, name, r[5], -1 - r[6]))
    moved = [rows[i] for i in sorted(range(len(rows)), key=lambda i: rows[i][5] + rng.randrange(300))]
    moved.append(("agent", "INFO", "m", None, "STARTED", 10**6, 999, datetime(1970, 1, 1) + timedelta(seconds=10**6)))
    cuts = sorted(rng.sample(range(1, len(moved)), 5))
    got = drained(spark, stateful.sequences(in_parts(spark, moved, STATE, str(tmp_path / "in"), cuts), rules), tmp_path)
    assert sorted((r.rule_id, r.runnable, r.epoch, r.seq) for r in got) == sorted(want)
    # What the batch tells at the end of the stream is among it.
    ends = {(r.rule_id, r.runnable, r.epoch, r.seq) for r in detect.detect(spark.createDataFrame(moved, STATE), rules).collect() if r.runnable != "agent"}
    assert ends <= {(r.rule_id, r.runnable, r.epoch, r.seq) for r in got}


@pytest.mark.parametrize("seed, length", [(0, 3600), (1, 600)])
def test_closed_windows(spark, tmp_path, seed, length):
    """Counts and distinct values at every grid point are the batch's, whatever the micro-batches and the order within the watermark."""
    from datetime import datetime, timedelta

    from emberlog.operators import windows

    rng = random.Random(seed)
    rows = [(rng.choice(["zoo_s", "ces_s"]), rng.choice(["ERROR", "INFO"]), rng.choice("abcd"), None, None, t, k) for k, t in enumerate(sorted(rng.choice([rng.randrange(9000), rng.randrange(30) * 300]) for _ in range(200)))]
    rows = [(*r[:5], r[5] + 90_000, r[6], datetime(1970, 1, 1) + timedelta(seconds=r[5] + 90_000)) for r in rows]  # a stream drops what stands at 0
    df = spark.createDataFrame(rows, STATE)
    measures = {"error": F.col("level") == "ERROR", "every": F.lit(1)}
    grid = windows.time_grid(df)
    w = windows.GridWindows(df, grid, measures)
    counts = {(r.runnable, r.t): (r.error, r.every) for r in w.select(error=w.count("error", length), every=w.count("every", length)).collect()}
    distinct = {(r.runnable, r.t): r.n for r in windows.distinct_in_windows(df, F.col("message"), length).collect()}
    moved = [rows[i] for i in sorted(range(len(rows)), key=lambda i: rows[i][5] + rng.randrange(300))]
    moved.append(("agent", "INFO", "m", None, None, 10**6, 999, datetime(1970, 1, 1) + timedelta(seconds=10**6)))
    stream = in_parts(spark, moved, STATE, str(tmp_path / "in"), sorted(rng.sample(range(1, len(moved)), 5)))
    got = drained(spark, stateful.closed_windows(stream, measures, F.col("message"), length), tmp_path)
    assert len(got) == len(counts)
    assert {(r.runnable, r.t): (r.error, r.every) for r in got} == counts
    assert all(r.distinct_values == distinct.get((r.runnable, r.t), 0) for r in got)


def test_forced_throttle(spark, tmp_path):
    from datetime import datetime, timedelta

    rng = random.Random(4)
    rows = [("r", rng.choice("ab"), t, k, rng.random() < 0.1, datetime(1970, 1, 1) + timedelta(seconds=t)) for k, t in enumerate(sorted(rng.randrange(2000) for _ in range(150)))]
    schema = "rule_id string, runnable string, epoch long, seq long, urgent boolean, ts timestamp"
    got = drained(spark, streaming.throttle(in_parts(spark, rows, schema, str(tmp_path / "in"), [40, 90]), 100, force="urgent"), tmp_path)
    want = batch_throttle.throttle(spark.createDataFrame(rows, schema), ["rule_id", "runnable"], 100, force="urgent").where("kept").collect()
    assert sorted(r.seq for r in got) == sorted(r.seq for r in want)
