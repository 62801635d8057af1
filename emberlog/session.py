"""Session settings that the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def configure(spark: SparkSession) -> SparkSession:
    """Times are UTC instants; adaptive execution splits skewed joins; Python workers find this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if REPO not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, path) if x)
    return spark


def builder(app: str = "emberlog") -> SparkSession.Builder:
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint in the shared folder of spark.checkpoint.dir; a temporary one only where all runs on one machine."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        context.setCheckpointDir(root or "file://" + tempfile.mkdtemp(prefix="emberlog-"))
    return df.checkpoint(eager=True)
