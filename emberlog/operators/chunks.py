"""Ranges of sorted rows, folded side by side: what one hands on to the next is all that goes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.session import cut


def dealt(rows: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """rows cut by ranges of the order and sorted within them, with __pid, the number of the range and of the task that reads it.

    The rows are written to the shared folder once, so every later pass sees the same ranges. Filters keep them.
    """
    some = rows.repartitionByRange(chunks, *order) if chunks else rows.repartitionByRange(*order)
    return cut(some.sortWithinPartitions(*order).withColumn("__pid", F.spark_partition_id()))
