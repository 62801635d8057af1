"""Positions and running sums over a whole table: a sort by ranges, sums within each range, and offsets of ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm import common


def ranked(df: DataFrame, order: list[str], sums: tuple[str, ...] = (), position: str = "pos") -> DataFrame:
    """df with each row's position in the order, from 0, and for every column of sums (long, no nulls) its sum up to this row as sum_<name>.

    The rows are dealt out by ranges of the order, which must tell all rows apart. Each range is summed in its own task;
    the ranges' totals, one row a partition, are summed up and sent to all tasks. No task sees more than its range.
    """
    common.prepare(df.sparkSession)
    names = ["__pid", position, *[f"sum_{s}" for s in sums]]
    at = [df.columns.index(s) for s in sums]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        done = np.zeros(len(at) + 1, np.int64)
        for batch in batches:
            n = batch.num_rows
            found = [np.arange(n, dtype=np.int64), *[np.cumsum(batch.column(k).to_numpy(zero_copy_only=False), dtype=np.int64) for k in at]]
            if n:
                columns = [f + d for f, d in zip(found, done, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, pid, np.int32)), *map(pa.array, columns)], [*batch.schema.names, *names])
                done += [n, *[int(f[-1]) for f in found[1:]]]

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*fields, "__pid int", *[f"`{n}` long" for n in names[1:]]])
    rows = common.checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    totals = rows.groupBy("__pid").agg((F.max(position) + 1).alias("n"), *[F.max_by(n, position).alias(n) for n in names[2:]])
    before = W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)  # a row a partition
    offsets = totals.select("__pid", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{k}") for k, c in enumerate(["n", *names[2:]])])
    met = rows.join(F.broadcast(offsets), "__pid")
    return met.select(*df.columns, *[(F.col(n) + F.col(f"__{k}")).alias(n) for k, n in enumerate(names[1:])])
