"""Operators of the log engine against folds and brute force in Python."""

from __future__ import annotations

import random
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog import sinks
from emberlog.operators import autoencoder, correlate, detect, features, iforest, narrate, report, risk, throttle, windows
from emberlog.operators.catalogue import DEFAULT
from emberlog.operators.detect import Catalogue, Escalation, Rule
from emberlog.plans import pipelines

RECORD = "runnable string, level string, message string, stack_trace string, has_stack_trace boolean, state string, epoch long, seq long"


def records(spark, rows):
    return spark.createDataFrame([(r.get("runnable", "arcm_s"), r.get("level", "INFO"), r.get("message", ""), r.get("stack"), bool(r.get("stack")), r.get("state"), r["epoch"], k) for k, r in enumerate(rows)], RECORD)


def random_records(n, seed, span=4000, step=50):
    rng = random.Random(seed)
    states = ["STARTING", "DOWN", "STARTED", "STOPPING"]
    return [
        {"runnable": rng.choice(["arcm_s", "zoo_s"]), "level": rng.choice(["ERROR", "FATAL", "WARN", "INFO"]), "message": rng.choice(["No free database connection 7", "BUS-1 x", "Getting RuntimeMXBean", "m 9", "m 8 a"]), "state": rng.choice([None, None, *states]), "stack": rng.choice([None, "at x"]), "epoch": rng.randrange(0, span, step)}
        for _ in range(n)
    ]


def test_closed_windows_against_brute_force(spark):
    rows = random_records(250, 1, 9000)
    got = {(r.runnable, r.t): r for r in features.log_vectors(records(spark, rows)).collect()}
    for name in ("arcm_s", "zoo_s"):
        mine = sorted([(r["epoch"], k, r) for k, r in enumerate(rows) if r["runnable"] == name], key=lambda x: x[:2])
        lo, hi = mine[0][0], mine[-1][0]
        grid = range(lo // 300 * 300 + 300, hi + 1, 300)
        assert {t for n, t in got if n == name} == set(grid)
        for t in grid:
            g, err = got[(name, t)], ("ERROR", "FATAL")
            within = lambda a, b: [r for e, _, r in mine if a <= e <= b]
            e5, prev = sum(r["level"] in err for r in within(t - 300, t)), sum(r["level"] in err for r in within(t - 600, t - 301))
            assert (g.error_count_5m, g.error_count_1h) == (e5, sum(r["level"] in err for r in within(t - 3600, t)))
            assert g.error_rate_delta == pytest.approx((e5 - prev) / max(prev, 1))
            kinds = {r["message"].replace("7", "").replace("9", "").replace("8", "") for r in within(t - 300, t) if r["level"] in err}
            assert g.distinct_errors_5m == len(kinds)
            assert g.state_transitions_1h == sum(r["state"] is not None for r in within(t - 3600, t))
            assert g.restarts_24h == sum((r["state"] == "STARTING") + ("Getting RuntimeMXBean" in r["message"]) for r in within(t - 86400, t))
            states = [r["state"] for e, _, r in mine if e <= t and r["state"]]
            assert g.current_state == (states[-1] if states else "UNKNOWN")
            starts = [e for e, _, r in mine if e <= t and (r["state"] == "STARTING" or "RuntimeMXBean" in r["message"])]
            assert g.minutes_since_last_restart == pytest.approx((t - max(starts)) / 60 if starts else -1)


def test_one_time_has_no_grid(spark):
    assert features.log_vectors(records(spark, [{"epoch": 100}, {"epoch": 100}])).count() == 0


def test_throttle(spark):
    times = [0, 5, 14, 15, 16, 29, 30, 31, 200, 210]
    df = spark.createDataFrame([("k", t, i, t == 16) for i, t in enumerate(times)], "k string, epoch long, seq long, force boolean")
    assert [r.epoch for r in throttle.throttle(df, ["k"], 15).where("kept").orderBy("epoch").collect()] == [0, 15, 30, 200]
    assert [r.epoch for r in throttle.throttle(df, ["k"], 15, force="force").where("kept").orderBy("epoch").collect()] == [0, 15, 16, 31, 200]
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(500), i) for i in range(300)]
    got = {(r.k, r.seq) for r in throttle.throttle(spark.createDataFrame(rows, "k string, epoch long, seq long"), ["k"], 20).where("kept").collect()}
    want, last = set(), {}
    for k, t, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if k not in last or t - last[k] >= 20:
            last[k] = t
            want.add((k, i))
    assert got == want


def test_rules(spark):
    rows = [{"epoch": k, "level": "ERROR", "message": "No free database connection"} for k in range(12)] + [{"epoch": 20, "level": "INFO", "message": "No free database connection"}, {"epoch": 21, "level": "ERROR", "message": "x", "stack": "NullPointerException\nat JobMonitoringTag"}, {"epoch": 22, "level": "ERROR", "message": "token (Invalid XSRF token)"}]
    got = detect.detect(records(spark, rows), DEFAULT).orderBy("seq").collect()
    assert [(r.rule_id, r.match_count, r.severity) for r in got] == [("C01", k + 1, "P1" if k >= 9 else "CRITICAL") for k in range(12)] + [("H01", 1, "HIGH")]
    assert got[9].escalated and got[9].original_severity == "CRITICAL"
    assert detect.match_rules(records(spark, rows), Catalogue()).count() == 0
    empty = Catalogue((Rule("a", "a", "KEYWORD", "LOW", ""), Rule("b", "b", "REGEX", "LOW", "")))
    assert detect.match_rules(records(spark, rows), empty).select("rule_id").distinct().collect()[0][0] == "a"


def test_counts_leave_later_peers_out(spark):
    rule = Catalogue((Rule("a", "a", "KEYWORD", "LOW", "x", frequency_escalation=Escalation(3, 1, "HIGH")),))
    rows = [{"epoch": e, "message": "x"} for e in (0, 0, 0, 60, 61)]
    assert [r.match_count for r in detect.escalate(detect.match_rules(records(spark, rows), rule), rule).orderBy("seq").collect()] == [1, 2, 3, 4, 2]


def test_state_sequences_and_followups(spark):
    rule = DEFAULT.rules[-2]
    rows = [{"epoch": e, "state": s, "message": "x"} for e, s in [(0, "STARTED"), (10, "UNKNOWN"), (20, "DOWN"), (400, "DOWN"), (401, "STARTED"), (401, "DOWN"), (900, "STOPPED")]]
    states = records(spark, rows).where("state IS NOT NULL")
    assert sorted(r.epoch for r in detect.state_sequences(states, rule).collect()) == [20, 401]
    assert [(r.epoch, r.detected_epoch) for r in detect.no_followup(states, rule).collect()] == [(401, 900)]
    assert detect.no_followup(states, rule, "strict").count() == 0


def fold(rows, minutes, near):
    """All detections in one list of incidents, newest first."""
    found = []
    for d, t, rule, severity, runnable in rows:
        s = correlate.SEVERITIES.get(severity, 0)
        live = [i for i in reversed(found) if abs(t - i["updated"]) <= minutes * 60]
        one = next((i for i in live if runnable in i["runnables"] and (rule in i["rules"] or s >= 3)), None)
        one = one or (next((i for i in live if near.get(runnable, set()) & i["runnables"] and s >= 3 and i["severity"] >= 3), None))
        if one is None:
            one = {"id": d, "updated": t, "runnables": set(), "rules": set(), "severity": s, "members": []}
            found.append(one)
        one["updated"], one["severity"] = max(one["updated"], t), max(one["severity"], s)
        one["runnables"].add(runnable), one["rules"].add(rule), one["members"].append(d)
    return {d: i["id"] for i in found for d in i["members"]}


SEVERE = ["P1", "CRITICAL", "HIGH", "MEDIUM", "LOW", "?"]
DETECTED = "detection_id string, epoch long, seq long, rule_order int, rule_id string, severity string, runnable string"


@pytest.mark.parametrize("seed, span, chunks", [(0, 6000, 1), (1, 6000, 7), (2, 1500, 9), (3, 60_000, 5), (4, 300, 12)])
def test_incidents_against_one_fold(spark, seed, span, chunks):
    rng = random.Random(seed)
    rows = sorted((rng.randrange(span), k) for k in range(150))
    kinds = [(rng.choice("ABC"), rng.choice(SEVERE), rng.choice([*correlate.LAYERS, "other"])) for _ in range(20 if seed % 2 else 150)]
    rows = [(f"d{k}", t, k, 0, *rng.choice(kinds)) for t, k in rows]
    df = spark.createDataFrame(rows, DETECTED)
    assigned = correlate.assign(df, chunks=chunks)
    got = {r.detection_id: r.incident_id for r in assigned.collect()}
    assert got == fold([(r[0], r[1], r[4], r[5], r[6]) for r in rows], 5, correlate.neighbours(correlate.PARENTS))
    found = correlate.incidents(assigned).collect()
    assert sum(r.detection_count for r in found) == len(rows)
    members = {}
    for r in rows:
        members.setdefault(got[r[0]], []).append(r)
    for r in found:
        mine = members[r.incident_id]
        assert correlate.LAYERS.get(r.root_cause_runnable, 99) == min(correlate.LAYERS.get(x, 99) for x in r.affected_runnables)
        assert (r.created, r.updated, r.detection_count) == (mine[0][1], mine[-1][1], len(mine))
        assert r.affected_runnables == list(dict.fromkeys(x[6] for x in mine)) and r.rules_involved == list(dict.fromkeys(x[4] for x in mine))
        assert r.severity == max(mine, key=lambda x: correlate.SEVERITIES.get(x[5], 0))[5]
        assert r.root_cause_rule == next(x[4] for x in mine if x[6] == r.root_cause_runnable)
    stats = correlate.run_stats(correlate.incidents(assigned)).collect()[0]
    assert tuple(stats) == (len(rows), len(members), len(rows) - len(members), sum(len({x[6] for x in m}) > 1 for m in members.values()))
    assert correlate.timeline(assigned).count() == len(rows)


def test_a_component_without_gaps(spark):
    """A long chain of detections in one component: as one fold says, over chunks, with incidents that last over many of them."""
    n = 60_000
    kind = F.pmod(F.xxhash64("id"), F.lit(11))
    df = spark.range(n).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("detection_id"), (F.col("id") * 20).alias("epoch"), F.col("id").alias("seq"), F.lit(0).alias("rule_order"),
        F.element_at(F.array(*map(F.lit, "ABC")), (kind % 3 + 1).cast("int")).alias("rule_id"), F.element_at(F.array(*map(F.lit, SEVERE)), (F.floor(F.col("id") / 500) % 6 + 1).cast("int")).alias("severity"),
        F.element_at(F.array(*map(F.lit, ["zoo_s", "ces_s", "abs_s", "ecp_s"])), (kind % 4 + 1).cast("int")).alias("runnable"),
    )
    rows = [tuple(r) for r in df.orderBy("seq").collect()]
    near, open_, want = correlate.neighbours(correlate.PARENTS), [], {}
    for r in rows:
        open_, found = correlate.place(open_, r[0], r[1], r[4], r[5], r[6], 5, near)
        want[r[0]] = found["id"]
    assert {r.detection_id: r.incident_id for r in correlate.assign(df, chunks=16).collect()} == want


def test_status_of_incidents(spark):
    found = correlate.incidents(spark.createDataFrame([("d1", "i1", 1, 1, 0, "R", "HIGH", "zoo_s"), ("d2", "i2", 2, 2, 0, "R", "LOW", "ces_s")], DETECTED.replace("epoch", "incident_id string, epoch")))
    assert correlate.open_incidents(found).count() == 2
    changes = spark.createDataFrame([("i1", 5, "CLOSED"), ("i1", 9, "OPEN"), ("i2", 3, "CLOSED")], "incident_id string, epoch long, status string")
    assert [r.incident_id for r in correlate.open_incidents(correlate.with_status(found, changes)).collect()] == ["i1"]


def test_root_causes(spark):
    def of(*names):
        rows = [(f"d{k}", "i", k, k, 0, "R", "HIGH", n) for k, n in enumerate(names)]
        df = spark.createDataFrame(rows, "detection_id string, incident_id string, epoch long, seq long, rule_order int, rule_id string, severity string, runnable string")
        return correlate.incidents(df).collect()[0]

    assert of("arcm_s", "umcadmin_s", "zoo_s").root_cause_runnable == "zoo_s"
    assert "isolato" in of("arcm_s").root_cause_estimate
    r = of("elastic_s", "ces_s")
    assert r.root_cause_runnable == "elastic_s" and "cascata" in r.root_cause_estimate and r.cascade == ["ces_s"]
    for a, ps in correlate.PARENTS.items():
        assert not any(a in correlate.PARENTS.get(p, ()) for p in ps)


def test_alerts(spark):
    rows = [("C01", "arcm_s", "P1", t, t, 7) for t in (0, 100, 900)] + [("L01", "zoo_s", "LOW", 5, 5, 1), ("X", "zoo_s", "MEDIUM", 6, 6, 1)]
    df = spark.createDataFrame(rows, "rule_id string, runnable string, severity string, epoch long, seq long, match_count long")
    got = narrate.alerts(df, 15).orderBy("epoch").collect()
    assert [(r.rule_id, r.epoch) for r in got] == [("C01", 0), ("L01", 5), ("X", 6), ("C01", 900)]
    assert got[0].channels == ["email", "sms", "teams"] and got[1].channels == ["log"] and got[2].channels == ["email"]
    assert "arcm_s: 7" in got[0].narrative and got[0].title.endswith("arcm_s") and "{" not in "".join(r.title + r.narrative for r in got)
    assert {r.severity: (r.alerts, r.suppressed) for r in narrate.alert_stats(df, 15).collect()}["P1"] == (2, 1)
    external = narrate.narrate_external(df, lambda p: '{"title": "T", "narrative": "N"}' if "C01" in p else None).collect()
    assert {(r.rule_id, r.title == "T", r.confidence) for r in external} == {("C01", True, 0.7), ("L01", False, 0.9), ("X", False, 0.9)}


def test_tolerance(spark):
    gauge = spark.createDataFrame([(100, 1.0), (70, 2.0), (130, 3.0), (131, 4.0), (1000, 5.0)], "t long, value double")
    probes = spark.createDataFrame([(100,), (101,), (161,), (200,)], "t long")
    assert {r.t: r.value for r in windows.within_tolerance(probes, gauge, [], "t", "value").collect()} == {100: 1.0, 101: 1.0, 161: 4.0, 200: None}


def test_infrastructure(spark):
    v = spark.createDataFrame([("a", 300)], "runnable string, t long")
    g = spark.createDataFrame([("jvm/heap_committed_1", 310, 2.0**21), ("jvm/heap_used_1", 300, 2.0**20), ("jvm/heap_used_pct", 300, 9.0)], "metric string, t long, value double")
    t = spark.createDataFrame([("login_duration", 290, 4, 0.5, 0.7, 0.1)], "metric string, t long, count long, mean double, p95 double, m5_rate double")
    r = features.with_infra(v, g, t).collect()[0]
    assert (r.heap_committed_mb, r.heap_used_pct, r.login_count_5m, r.login_mean_duration_ms, r.http_pool_leased) == (2.0, 50.0, 4, 500.0, -1)


def vectors(spark, n=600):
    rng = np.random.default_rng(0)
    rows = [("a" if k % 2 else "b", 300 * k, *[int(x) for x in rng.poisson(3, 12)], "STARTED", float(rng.normal())) for k in range(n)]
    rows[7] = ("a", 2100, *[90] * 12, "FAILED", 50.0)
    names = [c for c in (*risk.PER_RUNNABLE_FEATURES,) if c != "error_rate_delta"]
    return spark.createDataFrame(rows, "runnable string, t long, " + ", ".join(f"{c} long" for c in [*names, "x_extra"]) + ", current_state string, error_rate_delta double")


def test_forest(spark, tmp_path):
    v = vectors(spark)
    trees, fitted = pipelines.train(v, trees=60)
    got = pipelines.predict(v, trees, fitted).orderBy("score").collect()
    assert got[0].t == 2100 and got[0].risk_level == "RED" and len(got[0].top_features) == 5 and -1 <= got[0].score < 0
    assert sum(r.risk_level == "RED" for r in got) < len(got) / 10
    iforest.save(str(tmp_path / "m"), trees, fitted, {"version": "1"})
    t2, f2, params = iforest.load(spark, str(tmp_path / "m"))
    again = pipelines.predict(v, t2, f2).orderBy("score").collect()
    assert [r.score for r in again] == [r.score for r in got] and params == {"version": "1"}
    labelled = iforest.labels(pipelines.predict(v, trees, fitted), 0.03).where("label = -1").count()
    assert 0 < labelled <= 19


def test_reconstruction_finds_what_is_odd(spark):
    x = risk.matrix(vectors(spark), risk.PER_RUNNABLE_FEATURES, risk.STATE_RISK_PER_RUNNABLE, False)
    z = risk.zscores(x, risk.scaler(x, (*risk.PER_RUNNABLE_FEATURES, "state_risk")))
    got = risk.over_percentile(risk.reconstruction(z)).collect()
    assert all(r.error >= -1e-9 for r in got) and 0 < sum(r.label == -1 for r in got) <= 20
    data = np.array([r.z for r in got if r.runnable == "b"])
    c = data - data.mean(0)
    values, directions = np.linalg.eigh(c.T @ c / len(c))
    p = directions[:, ::-1][:, :6]
    want = ((c - c @ p @ p.T) ** 2).mean(1)
    assert np.allclose([r.error for r in got if r.runnable == "b"], want, atol=1e-8)


def test_minus_one_becomes_zero(spark):
    v = vectors(spark, 10).withColumn("error_rate_delta", F.lit(-1.0))
    assert {r.x[5] for r in risk.matrix(v).collect()} == {0.0}


def test_top_features_prefer_the_later(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [0.4, -2.0, 2.0])], "x array<double>, z array<double>")
    assert [(f.feature, f.deviation_std) for f in risk.top_features(df, ("a", "b", "c")).collect()[0].top_features] == [("c", 2.0), ("b", -2.0)]


def test_features_as_csv(spark, tmp_path):
    v = features.thinned(features.log_vectors(records(spark, random_records(60, 2))))
    told = sinks.write_features(v, str(tmp_path / "f"), "csv")
    assert told == {"vectors": v.count(), "with_errors": v.where("error_count_1h > 0").count(), "with_infrastructure": 0, **v.selectExpr("min(t) AS first", "max(t) AS last").first().asDict()}
    some = records(spark, random_records(60, 2))
    assert sinks.write_records(some, str(tmp_path / "r"))["records"] == 60 == spark.read.parquet(str(tmp_path / "r")).count()
    got = sinks.read_features(spark, str(tmp_path / "f"))
    assert got.columns[:27] == list(sinks.COLUMNS) and got.count() == v.count() and got.where("heap_committed_mb <> -1").count() == 0


def test_files_to_features_and_alerts(spark, tmp_path):
    d = tmp_path / "runnable_arcm_s"
    d.mkdir()
    lines = [f"{datetime.fromtimestamp(1704067200 + 60 * k, timezone.utc):%Y-%m-%dT%H:%M:%S},000|ERROR|arcm0|d|||t|Pool - No free database connection {k}" for k in range(40)]
    (d / "arcm.log").write_text("\n".join(lines))
    got = pipelines.build_features(spark, str(tmp_path), str(tmp_path / "out"), kind="parquet").collect()
    assert got and all(r.pool_exhaustion_count_5m >= 5 for r in got)
    from emberlog.operators import parse
    from emberlog.sources import logs

    alerts = pipelines.records_to_alerts(pipelines.with_seq(parse.records(logs.read_lines(spark, str(tmp_path))))).collect()
    assert len(alerts) == 1 and alerts[0].rule_id == "C01"


def test_reports(spark):
    v = features.log_vectors(records(spark, random_records(200, 5)))
    assert report.by_hour(v, "error_count_5m").count() == 24
    assert report.recall_curve(v.withColumn("risk_score", F.lit(50.0))).where("recall = 1").count() == 11


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(0)
    for values in ([1.0], [2.0, 2.0, 2.0], [1.0, 2.0], rng.normal(size=500).tolist() + [3.0] * 100, (rng.pareto(0.3, 300)).tolist()):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        for buckets in (3, 4096):
            got = risk.exact_percentiles(df, F.col("v"), (0.0, 0.01, 0.5, 0.97, 1.0), buckets)
            assert np.allclose(got, np.quantile(values, [0.0, 0.01, 0.5, 0.97, 1.0]))
    assert risk.exact_percentiles(df.where("false"), F.col("v"), (0.5,)) == [None]


def test_states_without_followup_at_the_end_of_the_stream(spark):
    """A runnable that goes down and stays silent, told by the last record of any runnable."""
    from emberlog.operators import catalogue, detect

    rule = next(r for r in catalogue.DEFAULT.rules if r.rule_id == "S02")
    rows = [("a", 0, 0, "STARTED"), ("a", 60, 1, "DOWN"), ("b", 10, 2, "DOWN"), ("b", 20, 3, "STARTING"), ("c", 99_900, 4, "DOWN"), ("d", 100_000, 5, None)]
    df = spark.createDataFrame(rows, "runnable string, epoch long, seq long, state string")
    assert [(r.runnable, r.epoch, r.seq, r.detected_epoch) for r in detect.no_followup(df, rule).collect()] == [("a", 60, 1, 100_000)]
    whole = df.selectExpr("*", "'INFO' AS level", "'m' AS message", "CAST(null AS STRING) AS stack_trace")
    got = {(r.rule_id, r.runnable, r.epoch, r.seq) for r in detect.detect(whole, detect.Catalogue((rule,))).collect()}
    assert got == {("S02", "a", 60, 1), ("S02", "a", 60, -2)}


@pytest.mark.parametrize("seed, span, gap, share, chunks", [(5, 900, 7, 0.05, 1), (6, 900, 7, 0.05, 9), (7, 300, 40, 0.0, 12), (8, 5000, 40, 0.01, 12), (9, 60, 100, 0.02, 6)])
def test_throttle_forced_against_brute_force(spark, seed, span, gap, share, chunks):
    """Few keys over many ranges, with equal times on both sides of a range's end."""
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", None]), rng.randrange(span), i, rng.random() < share) for i in range(500)]
    rows += [("z", None, 1000, False), ("z", None, 1001, True), ("z", 5, 1002, False)]
    df = spark.createDataFrame(rows, "k string, epoch long, seq long, force boolean")
    got = {r.seq for r in throttle.throttle(df, ["k"], gap, force="force", chunks=chunks).where("kept").collect()}
    want, last = {1001}, {}
    for k, t, i, f in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1], r[2])):
        if f or k not in last or t - last[k] >= gap:
            want.add(i)
            last[k] = t
    assert got == want


def test_throttle_of_one_busy_key(spark):
    """A row a second: no two phases ever meet, so each range depends on all before it."""
    n, gap = 300_000, 77
    df = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") + F.floor(F.col("id") / 1000) * 3).alias("epoch"), F.col("id").alias("seq"))
    got = [r.epoch for r in throttle.throttle(df, ["k"], gap, chunks=16).where("kept").orderBy("epoch").collect()]
    want = []
    for k in range(n):
        t = k + k // 1000 * 3
        if not want or t - want[-1] >= gap:
            want.append(t)
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 50, 256])
def test_trees_part_their_rows(n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, 4)), 1)
    tree = iforest.grow(x, rng)
    assert [t[0] for t in tree] == list(range(len(tree))) and tree[0][5] == n
    seen = {0: np.arange(n)}
    for node, feature, threshold, left, right, size, depth in tree:
        rows = seen[node]
        assert len(rows) == size > 0 and depth <= max(1, np.ceil(np.log2(max(n, 2))))
        if feature < 0:
            assert left == right == node and (depth == np.ceil(np.log2(max(n, 2))) or (x[rows] == x[rows[0]]).all())
            continue
        goes = x[rows, feature] <= threshold
        seen[left], seen[right] = rows[goes], rows[~goes]
        assert goes.any() and not goes.all()
    assert len(seen) == len(tree)


def test_forest_by_key(spark):
    """Fifteen keys from 30 to 6,000 rows: samples and odd rows of each."""
    rng = np.random.default_rng(1)
    sizes = {f"k{k:02d}": n for k, n in enumerate([30, 31, 100, 255, 256, 257, 400, 639, 640, 641, 1000, 1281, 2000, 4000, 6000])}
    rows = [(k, i, [*(rng.normal(size=3) + (9.0 if i == 3 else 0.0)).tolist()]) for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "runnable string, t long, z array<double>").repartition(5)
    trees = iforest.fit_by(df, trees=40, sample=64)
    roots = trees.where("node = 0").collect()
    assert sorted((r.runnable, r.tree) for r in roots) == sorted((k, t) for k in sizes for t in range(40))
    for k, n in sizes.items():
        mine = [r.size for r in roots if r.runnable == k]
        assert max(mine) <= 64 and (min(mine) == n if n <= 64 else np.mean(mine) > 58)
    made = iforest.drawn(df.select("runnable", "t", F.col("z").alias("x")), "runnable", ("runnable", "t"), 40, 64, 42).groupBy("runnable").count().collect()
    assert all(r["count"] <= 40 * 64 * 2.6 for r in made)  # however many rows a key has
    got = iforest.score_by(df, trees, at_once=500).collect()
    assert len(got) == len(rows) and all(-1 <= r.score <= 0 for r in got)
    for k in sizes:
        assert min((r for r in got if r.runnable == k), key=lambda r: r.score).t == 3
    again = {(r.runnable, r.t): r.score for r in iforest.score_by(df.repartition(3), iforest.fit_by(df.repartition(2), trees=40, sample=64)).collect()}
    assert all(again[(r.runnable, r.t)] == pytest.approx(r.score) for r in got)


def test_gradients_of_the_net():
    rng = np.random.default_rng(0)
    x, masks = rng.normal(size=(7, 5)), (rng.random((7, autoencoder.HIDDEN[0])) > 0.2) / 0.8
    net = autoencoder.Net.fresh((5, *autoencoder.HIDDEN, 5), rng)
    for b in net.offsets:
        b += rng.normal(size=b.shape) * 0.1
    for values, grads in zip((net.weights, net.offsets), net.gradients(x, masks), strict=True):
        for v, g in zip(values, grads, strict=True):
            for at in np.ndindex(v.shape):
                old, ends = v[at], []
                for step in (1e-6, -1e-6):
                    v[at] = old + step
                    ends.append(float(((net.layers(x, masks)[-1] - x) ** 2).mean()))
                v[at] = old
                assert (ends[0] - ends[1]) / 2e-6 == pytest.approx(g[at], abs=1e-6)


def test_autoencoder_finds_what_a_projection_misses(spark):
    """Normal rows are rectified mixtures; odd ones are their negatives, which lie in the same directions."""
    rng = np.random.default_rng(3)
    rows = []
    for k in ("a", "b"):
        mixed = np.maximum(rng.normal(size=(3000, 2)) @ rng.normal(size=(2, 13)), 0)
        span = mixed[rng.permutation(3000)[:60]]
        every = np.concatenate([mixed, -span])
        rows += [(k, i, v.tolist()) for i, v in enumerate((every - mixed.mean(0)) / mixed.std(0))]
    df = spark.createDataFrame(rows, "runnable string, t long, z array<double>")
    nets = autoencoder.fit_by(df.where("t < 3000"), most=2000)
    got = {(r.runnable, r.t): r.error for r in autoencoder.errors_by(df, nets, at_once=1000).collect()}
    assert len(got) == len(rows)
    flat = {(r.runnable, r.t): r.error for r in risk.reconstruction(df.where("t < 3000").union(df.where("t >= 3000")), names=13).collect()}

    def order(errors):
        """How often an odd row's error is over a normal one's."""
        odd, normal = ([e for (_, t), e in errors.items() if (t >= 3000) == which] for which in (True, False))
        return np.mean(np.array(odd)[:, None] > np.array(normal)[None, ::7])

    assert order(got) > 0.95 and order(got) > order(flat)
    again = autoencoder.fit_by(df.where("t < 3000").repartition(5), most=2000).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, nets.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_windows_of_a_busy_key(spark, seed):
    """Counts, sequences and values as of a time, dealt out by buckets, against loops over one key."""
    rng = random.Random(seed)
    wide = rng.choice([1, 7, 60])
    rows = sorted((rng.choice("aab"), rng.randrange(400), k, rng.choice(["x", "y", "z", None])) for k in range(400))
    df = spark.createDataFrame(rows, "k string, t long, s long, state string")
    got = {r.s: r.n for r in windows.trailing_counts(df, ["k"], "t", "s", wide).collect()}
    assert got == {s: sum(k2 == k and t - wide <= t2 and (t2, s2) <= (t, s) for k2, t2, s2, _ in rows) for k, t, s, _ in rows}
    for steps in (["x"], ["x", "y"], ["x", "x", "z"], []):
        want = set()
        for k, t, s, _ in rows:
            left = list(steps)
            for k2, t2, s2, state in rows:
                if k2 == k and t - wide <= t2 and (t2, s2) <= (t, s) and left and state == left[0]:
                    left.pop(0)
            if steps and not left:
                want.add(s)
        assert {r.s for r in windows.in_order(df, ["k"], "t", "s", [F.col("state") == x for x in steps], wide).collect()} == want
    probes = spark.createDataFrame([(rng.choice("abc"), rng.randrange(-50, 500), k) for k in range(200)] + [("a", None, 999)], "k string, t long, id long")
    found = windows.as_of(probes, df.withColumnRenamed("s", "seq"), ["k"], "t", "state", span=rng.choice([10, 100_000])).collect()
    assert len(found) == 201
    for r in found:
        past = [state for k, t, _, state in rows if k == r.k and r.t is not None and t <= r.t and state]
        assert r.state == (past[-1] if past else None)


@pytest.mark.parametrize("buckets", [3, 4096])
def test_percent_ranks(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([0.0, 0.0, rng.gauss(0, 1), rng.paretovariate(0.5)])) for i in range(300)] + [("a", 900, None), ("one", 901, 5.0)]
    got = {r.i: r.rank for r in risk.percent_ranks(spark.createDataFrame(rows, "k string, i long, v double"), "v", ["k"], "rank", buckets).collect()}
    for k, i, v in rows:
        mine = [w for k2, _, w in rows if k2 == k and w is not None]
        want = None if v is None else 100 - (sum(w < v for w in mine) + sum(w <= v for w in mine) + 1) * 50 / len(mine)
        assert got[i] == (want if want is None else pytest.approx(want))


def test_json_fields(spark):
    texts = {'{"k": 3}': 3, '{ "a":{"k": 9}, "k"   :  4}': 4, '{"a": "\\"k\\": 5"}': None, '{"k": "x"}': None, '{"k": 7, "z": [1, {"k": 8}]}': 7, "not json": None, "": None, '{"k":null}': None}
    from emberlog.functions.text import json_field

    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert {r.t: r.k for r in df.select("t", json_field(F.col("t"), "k", "int").alias("k")).collect()} == {**texts, None: None}
    back = df.select(F.to_json(F.struct(json_field(F.col("t"), "k", "int").alias("k"), F.lit(1).alias("b"))).alias("j")).select(json_field(F.col("j"), "k", "int").alias("k")).collect()
    assert sorted((r.k for r in back), key=repr) == sorted([*texts.values(), None], key=repr)


def test_a_service_that_hangs_keeps_no_alert(spark):
    df = spark.createDataFrame([("C01", "arcm_s", "P1", 0, 0, 7), ("X", "zoo_s", "LOW", 0, 1, 1)], "rule_id string, runnable string, severity string, epoch long, seq long, match_count long")

    def call(prompt):
        if "C01" in prompt:
            import time

            time.sleep(30)
        return '{"title": "T", "narrative": "N"}'

    got = {r.rule_id: r.title for r in narrate.narrate_external(df, call, seconds=0.5).collect()}
    assert got["X"] == "T" and got["C01"].endswith("arcm_s")
