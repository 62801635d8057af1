"""Log and metric files, rule catalogues and saved tables."""

from __future__ import annotations

import re

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.operators.detect import Catalogue, Escalation, Rule
from emberlog.operators.parse import log_family
from emberlog.session import cut

#: File name endings that are taken.
LOG_FILE = r"(?i)\.(?:log|log1[0-9]|log[1-9]|1[0-9]|[1-9])$"
#: Blocks of files (a row each, some 150 bytes) that are sent to all tasks; more are joined by a shuffle.
BLOCKS = 500_000
TIMER_FIELDS = ("max", "mean", "min", "stddev", "p50", "p75", "p95", "p99", "mean_rate", "m1_rate", "m5_rate")


def runnable_hint(path: Column) -> Column:
    """Runnable by a path part runnable_*_s, else agent if the path has the word."""
    part = F.nullif(F.regexp_extract(path, r"(?:^|/)runnable_(\w+_s)(?:/|$)", 1), F.lit(""))
    return F.coalesce(part, F.when(F.contains(F.lower(path), F.lit("agent")), "agent"))


def discover(spark: SparkSession, base: str, wrapper_file: str | None = None) -> DataFrame:
    """Log files below a folder: path, runnable_hint, log_family, size_mb; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(name.rlike(LOG_FILE)).select("path", runnable_hint(F.col("path")).alias("runnable_hint"), log_family(name, wrapper_file).alias("log_family"), (F.col("length") / F.lit(2**20)).alias("size_mb"))


def numbered(text: DataFrame) -> DataFrame:
    """text (value, p, b: file and the start of its block) with line_number, in as many tasks as files have blocks.

    A first pass counts the lines of each block, which is a row a block; a line's number is that of the lines in the
    blocks before it and its place within its own, which the scan's row ids give. Blocks have to be cut the same way in both
    passes, so the number of partitions that decides it is held; a block that the first pass didn't see is an error.
    """
    spark = text.sparkSession
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    rows = text.withColumn("i", F.monotonically_increasing_id())
    blocks = cut(rows.groupBy("p", "b").agg(F.min("i").alias("__first"), F.count("*").alias("__n")))
    before = F.sum("__n").over(W.partitionBy("p").orderBy("b")) - F.col("__n")
    starts = blocks.select("p", "b", "__first", before.alias("__before"))
    few = blocks.limit(BLOCKS + 1).count() <= BLOCKS
    met = rows.join(F.broadcast(starts) if few else starts, ["p", "b"], "left")
    number = F.when(F.col("__first").isNull(), F.raise_error(F.concat(F.lit("cut anew while it was read: "), "p")).cast("long")).otherwise(F.col("i") - F.col("__first") + F.col("__before") + 1)
    return met.withColumn("line_number", number).drop("i", "__first", "__before")


def read_lines(spark: SparkSession, base: str, hint: bool = True, wrapper_file: str | None = None) -> DataFrame:
    """Lines of all log files below a folder: source_file, source_path, runnable_hint, line_number, line.

    Every physical line counts, noise too, so numbers are given before anything is filtered.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(base).select("value", F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("b"))
    name = F.element_at(F.split("p", "/"), -1)
    rows = numbered(text).where(name.rlike(LOG_FILE))
    return rows.select(F.col("p").alias("source_file"), F.col("p").alias("source_path"), (runnable_hint(F.col("p")) if hint else F.lit(None).cast("string")).alias("runnable_hint"), log_family(name, wrapper_file).alias("log_family"), "line_number", F.col("value").alias("line"))


def metrics(spark: SparkSession, files: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(gauges, timers) of named files: {metric: (path, kind)}, kind gauge or timer, each under the name it's given here."""
    odd = sorted({k for _, k in files.values()} - {"gauge", "timer"})
    if odd:
        raise ValueError(f"kinds of metrics are gauge and timer, not {', '.join(odd)}")

    def of(kind: str) -> DataFrame | None:
        paths = {name: path for name, (path, k) in files.items() if k == kind}
        if not paths:
            return None
        plain = lambda path: re.sub("^[a-z]+:/*", "/", path)
        rows = spark.read.text(sorted({plain(p): p for p in paths.values()}.values())).select("value", F.regexp_replace("_metadata.file_path", "^[a-z]+:/*", "/").alias("path"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
        head = rows.groupBy("path").agg(F.min_by("value", F.struct("b", "i")).alias("header"))
        # The names are the caller's own list, one a file.
        names = spark.createDataFrame([(plain(p), n) for n, p in paths.items()], "path string, metric string")
        return rows.join(head, "path").join(F.broadcast(names), "path")

    gauge, timer = of("gauge"), of("timer")
    none = spark.createDataFrame([], "metric string, value string, b long, i long, header string")
    return _gauges(none if gauge is None else gauge), _timers(none if timer is None else timer)


def _csv_lines(spark: SparkSession, base: str) -> DataFrame:
    root = base.rstrip("/").removeprefix("file:").removeprefix("//")
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(base)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/")
    metric = F.regexp_replace(F.regexp_replace(F.replace(path, F.lit(root + "/"), F.lit("")), r"\.csv$", ""), "^/+", "")
    rows = text.select("value", metric.alias("metric"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    head = rows.groupBy("metric").agg(F.min_by("value", F.struct("b", "i")).alias("header"))
    return rows.join(head, "metric")


def gauges(spark: SparkSession, base: str) -> DataFrame:
    """(metric, t, value) of the gauge files below a folder: those whose header is t,value. Bad rows are left out; of equal times the last row counts."""
    return _gauges(_csv_lines(spark, base))


def _gauges(lines: DataFrame) -> DataFrame:
    rows = lines.where(F.trim("header") == "t,value").where("value != header")
    typed = rows.select("metric", "b", "i", F.expr("try_cast(trim(get(split(value, ','), 0)) AS BIGINT)").alias("t"), F.expr("try_cast(trim(get(split(value, ','), 1)) AS DOUBLE)").alias("v")).where("t IS NOT NULL AND v IS NOT NULL")
    return typed.groupBy("metric", "t").agg(F.max_by("v", F.struct("b", "i")).alias("value"))


def timers(spark: SparkSession, base: str) -> DataFrame:
    """(metric, t, count, max, ... m5_rate) of the timer files: those whose header has count and mean. A missing column is 0; a row that is short or has a bad number is left out."""
    return _timers(_csv_lines(spark, base))


def _timers(lines: DataFrame) -> DataFrame:
    rows = lines.where(F.array_contains(F.split("header", ","), "count") & F.array_contains(F.split("header", ","), "mean")).where("value != header")
    x = rows.withColumns({"h": F.split(F.trim("header"), ","), "x": F.split("value", ",")}).where("size(x) >= size(h)")
    at = lambda n, kind: F.expr(f"CASE WHEN array_position(h, '{n}') > 0 THEN try_cast(trim(get(x, cast(array_position(h, '{n}') AS INT) - 1)) AS {kind}) ELSE 0 END")
    typed = x.select("metric", "b", "i", at("t", "BIGINT").alias("t"), at("count", "BIGINT").alias("count"), *[at(n, "DOUBLE").alias(n) for n in TIMER_FIELDS]).dropna()
    fields = ["count", *TIMER_FIELDS]
    return typed.groupBy("metric", "t").agg(F.max_by(F.struct(*fields), F.struct("b", "i")).alias("s")).select("metric", "t", *[F.col(f"s.{n}").alias(n) for n in fields])


def rules(text: str) -> Catalogue:
    """Catalogue of a YAML list of rules, or of one below the key rules; only enabled ones."""
    loaded = yaml.safe_load(text) or []
    items = loaded.get("rules", []) if isinstance(loaded, dict) else loaded
    out = []
    for r in items:
        e = r.get("frequency_escalation")
        rule = Rule(
            str(r["rule_id"]), str(r["name"]), r["pattern_type"], r["severity"], r.get("pattern") or "", r.get("description") or "", r.get("enabled", True), tuple(r.get("runnable_filter") or ()), tuple(r.get("level_filter") or ()),
            bool(r.get("match_stack_trace", False)), tuple(r.get("state_sequence") or ()), int(r.get("window_minutes", 10)), r.get("no_followup_state"), Escalation(e["threshold"], e["window_minutes"], e["escalate_to"]) if e else None, tuple(r.get("tags") or ()), r.get("suggested_action") or "",
        )
        if rule.enabled:
            out.append(rule)
    return Catalogue(tuple(out))
