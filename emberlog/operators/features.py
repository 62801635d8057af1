"""Feature vectors of each runnable on a time grid, and which of them are worth keeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.text import message_hash
from emberlog.operators.throttle import throttle
from emberlog.operators.windows import GridWindows, distinct_in_windows, time_grid, within_tolerance

STEP = 300
#: Messages that are counted.
POOL, BUS, ZKC, RESTART = "No free database connection", "BUS-", "No registered Instance", "Getting RuntimeMXBean"
LOG_FEATURES = (
    "error_count_5m", "error_count_1h", "fatal_count_1h", "warn_count_1h", "distinct_errors_5m", "error_rate_delta", "has_stack_trace_5m", "current_state", "state_transitions_1h",
    "restarts_24h", "minutes_since_last_restart", "pool_exhaustion_count_5m", "bus_error_count_5m", "zkc_error_count_5m",
)
#: Part of the metric's name, for a gauge, by column; {None: what it must not have}.
GAUGES = {"heap_committed": "heap_committed", "heap_used": "heap_used", "cache_get": "cache-average-get-time", "available": "available-connections", "leased": "leased-connections", "pending": "pending-connections"}
INFRA = ("heap_committed_mb", "heap_used_pct", "cache_avg_get_time_ms", "login_count_5m", "login_mean_duration_ms", "login_p95_duration_ms", "login_rate_per_sec", "http_pool_available", "http_pool_leased", "http_pool_pending")


def measures() -> dict[str, Column]:
    level, message = F.col("level"), F.coalesce(F.col("message"), F.lit(""))
    starting = F.coalesce(F.col("state") == "STARTING", F.lit(False)).cast("int")
    return {
        "error": level.isin("ERROR", "FATAL"),
        "fatal": level == "FATAL",
        "warn": level == "WARN",
        "stack": F.coalesce(F.col("has_stack_trace"), F.lit(False)),
        "pool": F.contains(message, F.lit(POOL)),
        "bus": F.contains(message, F.lit(BUS)),
        "zkc": F.contains(message, F.lit(ZKC)),
        "change": F.col("state").isNotNull(),
        # A record may tell of a restart by its state and by its message.
        "restart": starting + F.contains(message, F.lit(RESTART)).cast("int"),
    }


def is_restart() -> Column:
    return F.coalesce(F.col("state") == "STARTING", F.lit(False)) | F.contains(F.coalesce(F.col("message"), F.lit("")), F.lit(RESTART))


def log_vectors(records: DataFrame, step: int = STEP) -> DataFrame:
    """(runnable, t, LOG_FEATURES) on every runnable's grid, of records (runnable, level, message, state, has_stack_trace, epoch, seq).

    All counts, the state and the last restart come from one aggregation and one sort by runnable; distinct messages
    need one more aggregation, at most two rows for each error.
    """
    w = GridWindows(records, time_grid(records, step=step), measures(), step=step, state={"state": F.col("state")}, latest={"restart": F.when(is_restart(), F.col("epoch"))})
    hour, day = 3600, 86400
    base = w.select(
        error_count_5m=w.count("error", step),
        previous=_previous(w, step),
        error_count_1h=w.count("error", hour),
        fatal_count_1h=w.count("fatal", hour),
        warn_count_1h=w.count("warn", hour),
        has_stack_trace_5m=w.count("stack", step),
        current_state=F.coalesce(w.state("state"), F.lit("UNKNOWN")),
        state_transitions_1h=w.count("change", hour),
        restarts_24h=w.count("restart", day),
        last_restart=w.latest("restart"),
        pool_exhaustion_count_5m=w.count("pool", step),
        bus_error_count_5m=w.count("bus", step),
        zkc_error_count_5m=w.count("zkc", step),
    )
    errors = records.where(F.col("level").isin("ERROR", "FATAL"))
    distinct = distinct_in_windows(errors, message_hash(F.col("message")), step, step=step, name="distinct_errors_5m")
    out = base.join(distinct, ["runnable", "t"], "left").withColumn("distinct_errors_5m", F.coalesce("distinct_errors_5m", F.lit(0)))
    delta = (F.col("error_count_5m") - F.col("previous")) / F.greatest(F.col("previous"), F.lit(1))
    minutes = F.when(F.col("last_restart").isNotNull(), (F.col("t") - F.col("last_restart")) / F.lit(60.0)).otherwise(F.lit(-1.0))
    return out.withColumns({"error_rate_delta": delta.cast("double"), "minutes_since_last_restart": minutes}).select("runnable", "t", *LOG_FEATURES)


def _previous(w: GridWindows, step: int) -> Column:
    """Errors in [t - 2 step, t - step) of whole seconds: the closed window one step back without its last point."""
    return w.count("error", step, step) - w.at("error", step)


def with_infra(vectors: DataFrame, gauges: DataFrame | None = None, timers: DataFrame | None = None) -> DataFrame:
    """Adds the infrastructure features from gauges (metric, t, value) and timers (metric, t, count, mean, p95, m5_rate), -1 where there's none.

    Of the metrics that fit a role all are taken together; of equal times the least name's value counts.
    """
    probes = vectors.select("t").distinct()
    out = probes
    m = F.lower("metric")
    for role, part in GAUGES.items() if gauges is not None else ():
        fit = F.contains(m, F.lit(part)) & (~F.contains(m, F.lit("pct")) if role == "heap_used" else F.lit(True))
        one = gauges.where(fit).groupBy("t").agg(F.min_by("value", "metric").alias("value"))
        out = within_tolerance(out, one, [], "t", "value").withColumnRenamed("value", role)
    if timers is not None:
        fit = F.contains(m, F.lit("login")) & F.contains(m, F.lit("duration"))
        one = timers.where(fit).groupBy("t").agg(F.min_by(F.struct("count", "mean", "p95", "m5_rate"), "metric").alias("value"))
        out = within_tolerance(out, one, [], "t", "value").withColumnRenamed("value", "login")
    have = lambda n: F.col(n) if n in out.columns else F.lit(None).cast("double")
    login = lambda n: F.col(f"login.{n}") if "login" in out.columns else F.lit(None).cast("double")
    committed = have("heap_committed")
    values = {
        "heap_committed_mb": committed / F.lit(2**20), "heap_used_pct": F.when(committed > 0, have("heap_used") / committed * 100), "cache_avg_get_time_ms": have("cache_get") * 1000,
        "login_count_5m": login("count").cast("long"), "login_mean_duration_ms": login("mean") * 1000, "login_p95_duration_ms": login("p95") * 1000, "login_rate_per_sec": login("m5_rate"),
        "http_pool_available": have("available").cast("long"), "http_pool_leased": have("leased").cast("long"), "http_pool_pending": have("pending").cast("long"),
    }
    table = out.select("t", *[F.coalesce(c, F.lit(-1)).alias(n) for n, c in values.items()])
    return vectors.join(table, "t", "left")


def meaningful() -> Column:
    """Whether a vector tells more than that all is well."""
    counts = ("error_count_5m", "error_count_1h", "fatal_count_1h", "state_transitions_1h", "restarts_24h", "pool_exhaustion_count_5m")
    out = ~F.col("current_state").isin("STARTED", "UNKNOWN")
    for c in counts:
        out = out | (F.col(c) > 0)
    return out


def thinned(vectors: DataFrame, gap: int = 3600) -> DataFrame:
    """Meaningful vectors, and of the others one an hour as a baseline."""
    extra = F.col("heap_committed_mb") > 0 if "heap_committed_mb" in vectors.columns else F.lit(False)
    flagged = vectors.withColumn("__meaningful", meaningful() | extra)
    quiet = throttle(flagged.where("NOT __meaningful").select("runnable", "t"), ["runnable"], gap, "t", "t").where("kept").select("runnable", "t", F.lit(True).alias("__baseline"))
    joined = flagged.join(quiet, ["runnable", "t"], "left")
    return joined.where(F.col("__meaningful") | F.col("__baseline")).withColumn("baseline", F.coalesce("__baseline", F.lit(False))).drop("__meaningful", "__baseline")
