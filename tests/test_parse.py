"""Line formats, folding and times, on lines that cover each branch."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emberlog.operators import parse
from emberlog.sources import logs


def lines_of(spark, *texts):
    return spark.createDataFrame([("f.log", "runnable_arcm_s/f.log", None, i + 1, t) for i, t in enumerate(texts)], "source_file string, source_path string, runnable_hint string, line_number long, line string")


def test_formats(spark):
    texts = [
        "INFO   | jvm 1    | 2024/01/02 03:04:05 | 2024-01-02 03:04:05,006|ERROR|main| Core - boom",
        "2024-01-02T03:04:05,006|ERROR|arcm0000000000|default|| r1 |t-1|Pool - No free database connection",
        "2024-07-02T03:04:05,006 - TRACE [http-1:App@42] - slow call",
        "2024-01-02 03:04:05,006|abs_s - State change: STARTED -> DOWN.",
        "2024-01-02 03:04:05,006|WARNING|main| no separator",
        "2024-01-02 03:04:05.006 -- 2024-01-02 03:04:05.106 (0100ms) - v1 - 10.0.0.1 - ops - start failed abs_s",
        "2024-01-02T03:04:05.96Z Getting RuntimeMXBean",
        "2024-01-02T03:04:05,006 starting",
        "2024-13-02T03:04:05,006 starting",
        "INFO | jvm 1 | 2024/01/02 03:04:05 | not a record",
    ]
    got = parse.parse_lines(lines_of(spark, *texts)).orderBy("line_number").collect()
    assert [r.format_type for r in got] == ["WRAPPER", "PIPE_8FIELD", "SPRING", "RUNNABLE_HIST", "AGENT", "REST_OPS", "PLAIN_TS", "PLAIN_TS", None, None]
    assert [r.level for r in got[:8]] == ["ERROR", "ERROR", "UNKNOWN", "WARN", "UNKNOWN", "ERROR", "UNKNOWN", "UNKNOWN"]
    assert (got[0].logger, got[0].message) == ("Core", "boom")
    assert (got[1].session_id, got[1].request_id, got[1].thread, got[1].logger) == (None, "r1", "t-1", "Pool")
    assert (got[2].thread, got[2].logger, got[2].ts) == ("http-1", "App", datetime(2024, 7, 2, 1, 4, 5, 6000))
    assert got[3].content_runnable == "abs_s" and got[4].message == "no separator" and got[4].logger is None
    assert (got[5].thread, got[5].message, got[5].duration_ms) == ("10.0.0.1@ops", "[100ms] start failed abs_s", 100)
    assert got[6].ts == datetime(2024, 1, 2, 3, 4, 5, 960000) and got[7].ts == datetime(2024, 1, 2, 2, 4, 5, 6000)
    assert got[8].bad_time and not got[9].bad_time


def test_summer_time_changes_at_local_midnight(spark):
    times = ["2025-03-30 00:30:00", "2025-03-29 23:30:00", "2025-10-26 00:30:00", "2025-10-25 23:30:00"]
    from emberlog.functions.times import local_to_utc

    got = spark.createDataFrame([(t,) for t in times], "t string").select(local_to_utc(F.to_timestamp("t")).cast("string")).collect()
    assert [r[0] for r in got] == ["2025-03-29 22:30:00", "2025-03-29 22:30:00", "2025-10-25 23:30:00", "2025-10-25 21:30:00"]


def test_folding(spark):
    texts = ["orphan", "2024-01-02T03:04:05,006 first", "java.lang.RuntimeException: x", "    at a.b(C.java:1)", "Reusing existing ZKC instance 1", "BUS-1 more", "EHLO mail", "____", "2024-01-02T03:04:06,006 second", "", "2024-01-02T03:04:07,006 third 12345678 0a", "", ""]
    got = parse.records(lines_of(spark, *texts)).orderBy("line_number").collect()
    assert [r.line_number for r in got] == [2, 9, 11]
    assert got[0].stack_trace == "java.lang.RuntimeException: x\n    at a.b(C.java:1)" and got[0].message == "first\nBUS-1 more" and got[0].has_stack_trace
    assert got[1].stack_trace == "" and not got[1].has_stack_trace
    assert got[2].stack_trace == "\n" and got[2].has_stack_trace
    assert {r.runnable for r in got} == {"arcm_s"}


def test_normalised(spark):
    from emberlog.functions.text import normalised

    texts = ["id 123e4567-e89b-12d3-a456-426614174000", "n 12345678 deadbeef12", "ip 10.0.0.1", "x12y a1 77", "  t  "]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(normalised(F.col("t"))).collect()]
    assert got == ["id <UUID>", "n <HEX> <HEX>", "ip <IP>", "x12y a1 <N>", "t"]


def test_names(spark):
    df = spark.createDataFrame([("agent.login.log",), ("agent_login.log",), ("arcm-error.log",), ("x.log",), ("system_out_1.log",)], "n string")
    assert [r[0] for r in df.select(parse.log_family(F.col("n"))).collect()] == ["AGENT_LOG", "AGENT_LOGIN", "ARCM_APP", "UNKNOWN", "SYSTEM_OUT"]
    df = spark.createDataFrame([("runnable_abs_s/x", None, None), ("x", "arcm000", None), ("x", "nope1", "Loadbalancer loadbalancer_s Scan"), ("Agent/x", None, None), ("x", None, None)], "p string, i string, t string")
    assert [r[0] for r in df.select(parse.runnable_of(F.col("p"), F.col("i"), F.col("t"))).collect()] == ["abs_s", "arcm_s", "loadbalancer_s", "agent", "unknown"]


def test_files(spark, tmp_path):
    d = tmp_path / "runnable_arcm_s" / "logs"
    d.mkdir(parents=True)
    (d / "arcm.log").write_bytes("2024-01-02T03:04:05,006 eins\r\n\r\n2024-01-02T03:04:06,006 zwei é".encode())
    (d / "x.txt").write_text("no log")
    (tmp_path / "jvm").mkdir()
    (tmp_path / "jvm" / "heap_2025_11.csv").write_text("t,value\n10,1.5\n10,2.5\nx,1\n11,y\n12,3\n")
    (tmp_path / "jvm" / "login_duration.csv").write_text("t,count,mean,p95,m5_rate\n10,2,0.5,0.7,1.0\n11,2.0,1,1,1\n12,3\n")
    found = logs.discover(spark, str(tmp_path)).collect()
    assert [(r.runnable_hint, r.log_family) for r in found] == [("arcm_s", "ARCM_APP")]
    got = logs.read_lines(spark, str(tmp_path)).orderBy("line_number").collect()
    assert [(r.line_number, r.line) for r in got] == [(1, "2024-01-02T03:04:05,006 eins"), (2, ""), (3, "2024-01-02T03:04:06,006 zwei é")]
    assert sorted((r.metric, r.t, r.value) for r in logs.gauges(spark, str(tmp_path)).collect()) == [("jvm/heap_2025_11", 10, 2.5), ("jvm/heap_2025_11", 12, 3.0)]
    t = logs.timers(spark, str(tmp_path)).collect()
    assert [(r.t, r["count"], r["mean"], r["max"]) for r in t] == [(10, 2, 0.5, 0.0)]


def test_rules_from_yaml():
    text = "rules:\n- {rule_id: A, name: a, pattern_type: KEYWORD, severity: LOW, pattern: x}\n- {rule_id: B, name: b, pattern_type: REGEX, severity: LOW, enabled: false}\n"
    assert [r.rule_id for r in logs.rules(text).rules] == ["A"]


def folded(lines):
    """One file's lines by a plain loop: (line_number, message, stack_trace) of each record."""
    out = []
    for n, line in enumerate(lines, 1):
        if line.startswith("2024"):
            out.append([n, line.split("] - ", 1)[1], None])
        elif out and (line.startswith("\tat ") or not line.strip()):
            out[-1][2] = line if out[-1][2] is None else out[-1][2] + "\n" + line
        elif out and not line.startswith("EHLO"):
            out[-1][1] += "\n" + line.strip()
    return [tuple(r) for r in out]


def long_file(seed, n):
    import random

    rng = random.Random(seed)
    head = lambda k: f"2024-01-02T03:{k // 60 % 60:02d}:{k % 60:02d},000 - ERROR [t:App] - m {k}"
    return [head(k) if rng.random() < 0.2 else rng.choice(["\tat a.b(C.java:1)", "BUS-1 more", "EHLO x", "", "some words"]) for k in range(n)]


def test_a_file_of_many_blocks_and_pieces(spark, tmp_path):
    files = {f"arcm.log{k}": long_file(k, n) for k, n in ((1, 900), (2, 7), (3, 60))}
    files["arcm.log3"][1:] = ["\tat a.b(C.java:1)"] * 59  # a record longer than several pieces
    files["arcm.log3"][0] = "2024-01-02T03:04:05,000 - ERROR [t:App] - first"
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        lines = logs.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20
        got = lines.collect()
        for name, want in files.items():
            mine = sorted((r.line_number, r.line) for r in got if r.source_file.endswith("/" + name))
            assert mine == list(enumerate(want, 1))
        for piece in (5, 1 << 16):
            found = parse.records(lines, piece=piece).collect()
            for name, want in files.items():
                mine = sorted((r.line_number, r.message, r.stack_trace) for r in found if r.source_file.endswith("/" + name))
                assert mine == folded(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_named_metrics(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,value\n1,2\n1,3\nx,4\n")
    (tmp_path / "b.csv").write_text("t,count,max,mean\n5,2,1.5,1.0\n")
    gauges, timers = logs.metrics(spark, {"heap": (str(tmp_path / "a.csv"), "gauge"), "login": (str(tmp_path / "b.csv"), "timer"), "twin": (f"file://{tmp_path}/a.csv", "gauge")})
    assert sorted(map(tuple, gauges.collect())) == [("heap", 1, 3.0), ("twin", 1, 3.0)]
    assert [(r.metric, r.t, r["count"], r.mean) for r in timers.collect()] == [("login", 5, 2, 1.0)]
    assert logs.metrics(spark, {"heap": (str(tmp_path / "a.csv"), "gauge")})[1].count() == 0
    with pytest.raises(ValueError, match="gauge and timer"):
        logs.metrics(spark, {"heap": ("x", "histogram")})


def test_names_of_product_and_wrapper_reach_the_reader(spark, tmp_path):
    (tmp_path / "cloudagent.log").write_text("2024-01-02T03:04:05,000 - ERROR [t:App] - m\nABCD version 7\nWXYZ version 7\n")
    family = lambda **o: logs.read_lines(spark, str(tmp_path), **o).first().log_family
    assert family() == "WRAPPER_LOG" and family(wrapper_file="other.log") == "UNKNOWN" and family(wrapper_file="cloudagent.log") == "WRAPPER_LOG"
    assert logs.discover(spark, str(tmp_path), "other.log").first().log_family == "UNKNOWN"
    lines = logs.read_lines(spark, str(tmp_path))
    assert parse.records(lines).first().message == "m" and parse.records(lines, product="ABCD").first().message == "m\nWXYZ version 7"


def test_lines_that_hold_the_marks_between_fields(spark):
    one, two, three, four = "\x01", "\x02", "\x03", "\x04"
    odd = f"a{one}b{two}c{one}{three}{two}{four}{two}{three}"
    texts = [f"2024-01-02T03:04:05,006|ERROR|{odd}|default|| r1 |t-1|Pool - m {odd}", "2024-01-02T03:04:05,006|ERROR|x|default|| r1 |t-1|Pool - m"]
    got = parse.parse_lines(lines_of(spark, *texts)).orderBy("line_number").collect()
    assert (got[0].instance_id, got[0].tenant, got[0].logger, got[0].message) == (odd, "default", "Pool", f"m {odd}") and got[1].message == "m"
