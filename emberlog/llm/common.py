"""Helpers that the training-data operators share: reading tables, shared folders, checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows that one Arrow batch brings to a Python worker. Texts may be long, so batches are short.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Settings that every operator needs: short Arrow batches, this package on the workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if REPO not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, path) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where it is unset and all runs on one machine.

    A path without a scheme is one of the default file system.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            root = set_dir.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        else:
            root = "file://" + tempfile.mkdtemp(prefix="emberlog-")
            spark.sparkContext.setCheckpointDir(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of its own under the shared one."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder, which outlive an executor."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """As checkpoint(), but a table of columns, which takes less of the disk where rows repeat their values."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files that nothing refers to any more; lineage has to be cut before."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """On a worker: hands memory that Arrow and the C library hold free back to the system, as Spark keeps workers for later tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


#: Tables of up to so many keys (some 40 bytes each) are sent to all executors; larger ones are joined by a shuffle.
SMALL_TABLE = 200_000


def joined(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """big.join(small); small (a checkpointed table of short rows) is counted, and sent to all executors only if it's within SMALL_TABLE."""
    few = small.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    return big.join(F.broadcast(small) if few else small, on, how)


def file_system(uri: str):
    """(file system, path) of a URI, on a worker."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:///", "/") if uri.startswith("file:///") else uri.removeprefix("file:"))


def publish(uri: str, data: bytes) -> None:
    """Writes a file under another name and then moves it: a task that is tried again replaces it whole."""
    system, path = file_system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the key and the text; other columns, whatever their names, don't take part."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def gathered(batches, least: int = 8 << 20):
    """Joins short Arrow batches until they hold so many bytes: new chunks of more rows are then encoded together."""
    import pyarrow as pa

    some, held = [], 0
    for batch in batches:
        some.append(batch)
        held += batch.nbytes
        if held >= least:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, held = [], 0
    if held or some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()[:1]
