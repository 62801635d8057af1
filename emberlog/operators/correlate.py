"""Incidents: detections merge by runnable, rule, severity and dependency within a sliding window; root causes by layer."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from emberlog.operators.chunks import dealt

WINDOW_MINUTES = 5
#: Severities in order, unknown ones are 0.
SEVERITIES = {"P1": 5, "CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
SIGNIFICANT = 3
#: Layer of each runnable, the lowest is the likeliest root; unknown ones are 99.
LAYERS = {
    "agent": -1, "zoo_s": 0, "elastic_s": 1, "cdf_s": 1, "cloudsearch_s": 1, "ces_s": 2, "umcadmin_s": 2, "adsadmin_s": 3, "abs_s": 4, "arcm_s": 4, "copernicus_s": 4, "ecp_s": 4,
    "dashboarding_s": 4, "apg_s": 4, "octopus_s": 4, "simulation_s": 4, "loadbalancer_s": 5,
}
UNKNOWN_LAYER = 99
#: Direct parents of each runnable.
PARENTS = {
    "elastic_s": ("zoo_s",), "cdf_s": ("zoo_s",), "cloudsearch_s": ("zoo_s",), "ces_s": ("elastic_s", "zoo_s"), "umcadmin_s": ("ces_s", "zoo_s"), "adsadmin_s": ("umcadmin_s",),
    "abs_s": ("adsadmin_s", "umcadmin_s", "ces_s", "cloudsearch_s"), "arcm_s": ("adsadmin_s", "umcadmin_s", "ces_s"), "copernicus_s": ("abs_s", "ces_s"), "ecp_s": ("abs_s",), "apg_s": ("abs_s",),
    "octopus_s": ("abs_s",), "simulation_s": ("abs_s",), "dashboarding_s": ("abs_s", "adsadmin_s"), "loadbalancer_s": ("abs_s", "arcm_s", "copernicus_s"),
}


def rank(severity: Column) -> Column:
    return F.coalesce(F.create_map(*[x for k, v in SEVERITIES.items() for x in (F.lit(k), F.lit(v))])[severity], F.lit(0))


def groups(parents: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Least member of each runnable's component of the undirected graph; runnables outside the graph stand alone."""
    root = {n: n for c, ps in parents.items() for n in (c, *ps)}

    def find(x: str) -> str:
        while root[x] != x:
            x = root[x]
        return x

    for c, ps in parents.items():
        for p in ps:
            a, b = sorted((find(c), find(p)))
            root[b] = a
    return {n: find(n) for n in root}


def neighbours(parents: dict[str, tuple[str, ...]]) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for c, ps in parents.items():
        for p in ps:
            out.setdefault(c, set()).add(p)
            out.setdefault(p, set()).add(c)
    return out


def place(open_: list[dict], detection_id: str, t: int, rule: str, severity: str, runnable: str, minutes: int, near: dict[str, set[str]]) -> tuple[list[dict], dict]:
    """Adds a detection to one of the open incidents (oldest first) or to a new one; returns the open ones and the one it went to."""
    s = SEVERITIES.get(severity, 0)
    live = [i for i in reversed(open_) if abs(t - i["updated"]) <= minutes * 60]
    found = next((i for i in live if runnable in i["runnables"] and (rule in i["rules"] or s >= SIGNIFICANT)), None)
    if found is None and s >= SIGNIFICANT:
        found = next((i for i in live if i["severity"] >= SIGNIFICANT and near.get(runnable, set()) & i["runnables"]), None)
    if found is None:
        found = {"id": detection_id, "updated": t, "runnables": set(), "rules": set(), "severity": s}
        open_ = [*live[::-1], found]  # older ones can't be met again: time only grows
    found["updated"] = max(found["updated"], t)
    found["runnables"].add(runnable)
    found["rules"].add(rule)
    found["severity"] = max(found["severity"], s)
    return open_, found


def _revived(state: list, ids: list) -> list[dict]:
    return [{"id": i, "updated": u, "runnables": set(r), "rules": set(q), "severity": s} for i, (_, u, r, q, s) in zip(ids, state, strict=True)]


def _placed(rows: Iterable[tuple], open_: list[dict], start: str | None, minutes: int, near: dict[str, set[str]]) -> Iterator[tuple[str, list[dict]]]:
    """For rows (component, detection_id, epoch, rule_id, severity, runnable) in order the incident's id and the component's open incidents.

    A significant detection that repeats the last one of its runnable within the window goes where that went: no incident
    with the runnable can have become newer or live again in between. So runs of equal detections take no search.
    """
    now, last = start, {}
    for component, d, t, rule, severity, runnable in rows:
        if component != now:
            now, open_, last = component, [], {}
        seen = last.get(runnable)
        if seen is not None and seen[0] == rule and seen[1] == severity and t - seen[2] <= minutes * 60 and SEVERITIES.get(severity, 0) >= SIGNIFICANT:
            found = seen[3]
            found["updated"] = t
        else:
            open_, found = place(open_, d, t, rule, severity, runnable, minutes, near)
        last[runnable] = (rule, severity, t, found)
        yield found["id"], open_


def assign(detections: DataFrame, minutes: int = WINDOW_MINUTES, parents: dict[str, tuple[str, ...]] = PARENTS, chunks: int | None = None) -> DataFrame:
    """Detections (detection_id, epoch, seq, rule_order, rule_id, severity, runnable, other columns) with incident_id.

    In time order each joins the newest incident in its window whose runnables hold its own and that has its rule, or any
    rule if it's significant; else the newest with a direct dependency either way, if both are significant; else it opens
    one. Detections of different components of the dependency graph never meet.

    Rows are dealt out by ranges of (component, time), the chunks, whatever gaps they have; a chunk is folded as a stream
    that keeps its open incidents only, and hands those still within the window on to the next one. All chunks begin at
    once, without any; those that turn out to be handed something else than they began with are folded anew, until none
    is. What is handed on, a few incidents a chunk, is all that the driver sees. An incident that lasts over chunks keeps
    the id of the chunk it opened in.
    """
    component, near = groups(parents), neighbours(parents)
    keys = F.create_map(*[x for k, v in component.items() for x in (F.lit(k), F.lit(v))]) if component else F.create_map()
    rows = detections.withColumn("__c", F.coalesce(keys[F.col("runnable")], F.concat(F.lit("~"), F.coalesce("runnable", F.lit("")))))
    order = ["__c", "epoch", "seq", "rule_order", "detection_id"]
    sorted_ = dealt(rows, order, chunks)
    at = [sorted_.columns.index(c) for c in ("__c", "detection_id", "epoch", "rule_id", "severity", "runnable")]
    columns = detections.columns

    def told(batches: Iterator) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(k).to_pylist() for k in at], strict=True)

    def ends(begun: dict[int, list]) -> Callable:
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            from pyspark import TaskContext

            pid = TaskContext.get().partitionId()
            rows = told(batches)
            first = next(rows, None)
            if first is None:
                return
            last, open_ = first, []
            state = begun.get(pid, [])

            def watched() -> Iterator[tuple]:
                nonlocal last
                yield first
                for last in rows:
                    yield last

            for _, open_ in _placed(watched(), _revived(state, [[pid, k] for k in range(len(state))]), first[0], minutes, near):
                pass
            left = [[i["id"], i["updated"], sorted(i["runnables"]), sorted(i["rules"]), i["severity"]] for i in open_ if last[2] - i["updated"] <= minutes * 60]
            told_ = {"first": [first[0], first[2]], "last": last[0], "left": left}
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([json.dumps(told_)])], ["pid", "told"])

        return run

    begun: dict[int, list] = {}
    known: dict[int, dict] = {}
    todo: set[int] | None = None
    while todo is None or todo:
        some = sorted_ if todo is None else sorted_.where(F.col("__pid").isin(*todo))  # a filter keeps the partitions
        known |= {r["pid"]: json.loads(r["told"]) for r in some.mapInArrow(ends(begun), "pid int, told string").collect()}
        todo, before = set(), None
        for pid in sorted(known):
            mine = known[pid]
            handed = [i for i in before["left"] if mine["first"][1] - i[1] <= minutes * 60] if before and before["last"] == mine["first"][0] else []
            if [i[1:] for i in handed] != [i[1:] for i in begun.get(pid, [])]:
                todo.add(pid)
            begun[pid], before = handed, mine
    names: dict[int, list[str]] = {}
    for pid in sorted(known):
        names[pid] = [i[0] if isinstance(i[0], str) else names[i[0][0]][i[0][1]] for i in begun[pid]]

    def finish(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        state, now = begun.get(pid, []), known[pid]["first"][0] if pid in known else None
        held: list = []

        def kept() -> Iterator[tuple]:
            for batch in batches:
                held.append(batch)
                yield from told([batch])

        ids = []
        for found, _ in _placed(kept(), _revived(state, names.get(pid, [])), now, minutes, near):
            ids.append(found)
            if len(ids) == held[0].num_rows:
                batch = held.pop(0)
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in columns], pa.array(ids, pa.string())], [*columns, "incident_id"])
                ids = []

    return sorted_.mapInArrow(finish, StructType([*detections.schema.fields, StructField("incident_id", StringType())]))


def incidents(assigned: DataFrame, parents: dict[str, tuple[str, ...]] = PARENTS, layers: dict[str, int] = LAYERS) -> DataFrame:
    """A row per incident: times, severity, counts, runnables and rules in order of appearance, root cause, status OPEN.

    Detections are summed up per incident, runnable and rule first, so lists only hold runnables and rules. Their
    events are rows of their own, see timeline().
    """
    place = F.struct("epoch", "seq", "rule_order")
    layer = F.coalesce(F.create_map(*[x for k, v in layers.items() for x in (F.lit(k), F.lit(v))])[F.col("runnable")], F.lit(UNKNOWN_LAYER))
    worst = F.struct(rank(F.col("severity")).alias("rank"), (-F.col("epoch")).alias("e"), (-F.col("seq")).alias("s"), (-F.col("rule_order")).alias("o"), "severity")
    parts = assigned.groupBy("incident_id", "runnable", "rule_id").agg(F.min(place).alias("at"), F.max("epoch").alias("updated"), F.max(worst).alias("worst"), F.count("*").alias("n"))
    parts = parts.withColumn("layer", layer)
    out = parts.groupBy("incident_id").agg(
        F.min("at.epoch").alias("created"), F.max("updated").alias("updated"), F.max("worst").getField("severity").alias("severity"), F.sum("n").alias("detection_count"),
        F.min(F.struct("layer", "at", "runnable", "rule_id")).alias("__root"), F.array_sort(F.collect_list(F.struct("at", "runnable", "rule_id"))).alias("__l"),
    )
    of = lambda name: F.array_distinct(F.transform("__l", lambda x: x[name]))
    out = out.withColumns({"root_cause_runnable": F.col("__root.runnable"), "root_layer": F.col("__root.layer"), "affected_runnables": of("runnable"), "rules_involved": of("rule_id")})
    out = out.withColumn("root_cause_rule", F.col("__root.rule_id"))
    family = F.create_map(*[x for k, v in parents.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))]) if parents else F.create_map()
    cascade = F.filter("affected_runnables", lambda r: F.coalesce(F.array_contains(family[r], F.col("root_cause_runnable")), F.lit(False)))
    out = out.withColumn("cascade", cascade)
    text = (
        F.when(F.size("affected_runnables") == 1, F.concat(F.lit("Isolated problem (isolato) on "), F.col("root_cause_runnable"), F.lit(".")))
        .when(F.size("cascade") > 0, F.concat(F.lit("Probable root cause: "), F.col("root_cause_runnable"), F.lit(" (layer "), F.col("root_layer").cast("string"), F.lit("). Cascade (cascata) to "), F.array_join("cascade", ", "), F.lit(".")))
        .otherwise(F.concat(F.lit("Affected: "), F.array_join("affected_runnables", ", "), F.lit(". Lowest layer: "), F.col("root_cause_runnable"), F.lit(" (layer "), F.col("root_layer").cast("string"), F.lit("). Check whether they belong together.")))
    )
    return out.withColumns({"root_cause_estimate": text, "status": F.lit("OPEN")}).drop("__l", "__root")


def timeline(assigned: DataFrame) -> DataFrame:
    """(incident_id, epoch, seq, rule_order, runnable, event): what happened in each incident, a row per detection."""
    summary = F.coalesce("summary", F.lit("")) if "summary" in assigned.columns else F.lit("")
    return assigned.select("incident_id", "epoch", "seq", "rule_order", "runnable", F.concat("rule_id", F.lit(": "), F.substring(summary, 1, 60)).alias("event"))


def with_status(found: DataFrame, changes: DataFrame) -> DataFrame:
    """found with the last status of changes (incident_id, epoch, status) that an operator has given each incident."""
    last = changes.groupBy("incident_id").agg(F.max(F.struct("epoch", "status")).getField("status").alias("__status"))
    return found.join(last, "incident_id", "left").withColumn("status", F.coalesce("__status", "status")).drop("__status")


def open_incidents(found: DataFrame) -> DataFrame:
    return found.where("status = 'OPEN'")


def run_stats(found: DataFrame) -> DataFrame:
    """One row: detections_processed, incidents_created, detections_correlated (that joined an incident), multi_runnable_incidents."""
    return found.agg(
        F.coalesce(F.sum("detection_count"), F.lit(0)).alias("detections_processed"), F.count("*").alias("incidents_created"),
        F.coalesce(F.sum(F.col("detection_count") - 1), F.lit(0)).alias("detections_correlated"), F.count_if(F.size("affected_runnables") > 1).alias("multi_runnable_incidents"),
    )


def size_bucket(n: Column) -> Column:
    return F.when(n == 1, "1").when(n <= 5, "2-5").when(n <= 20, "6-20").otherwise("20+")


def incident_stats(found: DataFrame) -> DataFrame:
    return found.groupBy("severity", size_bucket(F.col("detection_count")).alias("size")).agg(F.count("*").alias("n"))


def representatives(assigned: DataFrame) -> DataFrame:
    """The detection of the highest severity of each incident, the earliest of equals."""
    order = W.partitionBy("incident_id").orderBy(rank(F.col("severity")).desc(), "epoch", "seq", "rule_order")
    return assigned.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
