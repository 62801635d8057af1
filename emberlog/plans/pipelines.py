"""End-to-end plans: files to features, records to alerts, features to scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import sinks
from emberlog.operators import correlate, detect, features, iforest, narrate, parse, risk
from emberlog.operators.catalogue import DEFAULT
from emberlog.operators.detect import Catalogue
from emberlog.session import configure
from emberlog.sources import logs


def with_seq(records: DataFrame) -> DataFrame:
    """A number for each record that orders those of equal time: by file and line, the same in each run."""
    file = F.pmod(F.xxhash64("source_file"), F.lit(1 << 31))
    return records.withColumn("seq", file * F.lit(1 << 31) + F.col("line_number"))


def build_features(
    spark: SparkSession, base: str, out: str | None = None, step: int = features.STEP, metrics: str | dict[str, tuple[str, str]] | None = None, kind: str = "parquet", product: str | None = None, wrapper_file: str | None = None
) -> DataFrame:
    """Log files (and metric files: a folder of them, or {metric: (path, kind)}) to thinned feature vectors, written if out is given."""
    records = with_seq(parse.records(logs.read_lines(configure(spark), base, wrapper_file=wrapper_file), product=product))
    vectors = features.log_vectors(records, step)
    if metrics:
        gauges, timers = logs.metrics(spark, metrics) if isinstance(metrics, dict) else (logs.gauges(spark, metrics), logs.timers(spark, metrics))
        vectors = features.with_infra(vectors, gauges, timers)
    kept = features.thinned(vectors)
    if out:
        sinks.write_features(kept, out, kind)
    return kept


def records_to_alerts(records: DataFrame, catalogue: Catalogue = DEFAULT, minutes: int = correlate.WINDOW_MINUTES, cooldown: int = 30) -> DataFrame:
    """Detections merge into incidents; each incident's most severe detection becomes an alert unless its rule and runnable are cooling down."""
    assigned = correlate.assign(detect.detect(records, catalogue), minutes)
    return narrate.alerts(correlate.representatives(assigned), cooldown)


def train(vectors: DataFrame, names: tuple[str, ...] = risk.FEATURES, trees: int = iforest.TREES, seed: int = iforest.SEED) -> tuple[DataFrame, DataFrame]:
    """(trees, scaler) of feature vectors."""
    x = risk.matrix(vectors, names).select("runnable", "t", "x").persist()  # for scaler, count and sample
    fitted = risk.scaler(x, (*names, "state_risk"))
    return iforest.fit(risk.zscores(x, fitted), trees=trees, seed=seed), fitted


def predict(vectors: DataFrame, trees: DataFrame, fitted: DataFrame, names: tuple[str, ...] = risk.FEATURES) -> DataFrame:
    """Vectors with score, risk_score, risk_level and top_features."""
    z = risk.zscores(risk.matrix(vectors, names), fitted)
    scored = risk.normalised(iforest.score(z, iforest.forest(trees)))
    return risk.top_features(scored, (*names, "state_risk"))
