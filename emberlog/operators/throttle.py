"""Greedy throttle: a row is kept if at least a gap has passed since the last kept row of its key."""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from emberlog.operators.chunks import dealt

NEVER = np.iinfo(np.int64).max


def _runs(batch, key: int, time: int, force: int) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """(key, first row, times, forced) of each run of rows of one key in a batch; rows without a time come first and are left out."""
    keys, times = batch.column(key), batch.column(time)
    n = batch.num_rows
    if not n:
        return
    import pyarrow.compute as pc

    starts = [0, *(np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), n] if n > 1 else [0, n]
    forced = np.asarray(batch.column(force).to_numpy(zero_copy_only=False), bool)
    for a, b in zip(starts, starts[1:], strict=False):
        skip = times[a:b].null_count
        yield keys[a].as_py(), a + skip, times[a + skip : b].to_numpy(zero_copy_only=False).astype(np.int64), forced[a + skip : b]


def _next(last: np.ndarray, gap: int, times: np.ndarray, forced: np.ndarray) -> np.ndarray:
    """When the clock moves next after each of last: at the first time a gap later or the first forced one; NEVER within these rows."""
    by_gap, by_force = np.append(times, NEVER)[np.searchsorted(times, last + gap)], np.append(forced, NEVER)[np.searchsorted(forced, last, "right")]
    return np.minimum(by_gap, by_force)


def _ends(last: np.ndarray, gap: int, times: np.ndarray, forced: np.ndarray) -> np.ndarray:
    """The clock after these rows for each of last; those that meet go on as one."""
    while True:
        some, where = np.unique(last, return_inverse=True)
        then = _next(some, gap, times, forced)
        if (then == NEVER).all():
            return last
        last = np.where(then == NEVER, some, then)[where]


def throttle(df: DataFrame, keys: list[str], gap: int, time: str = "epoch", seq: str = "seq", force: str | None = None, chunks: int | None = None) -> DataFrame:
    """df with a column kept. Suppressed rows don't move the clock; rows with a true column `force` are kept always and move it.

    Of equal times the row with the least seq is kept. Rows without a time never are, unless they're forced. Rows are dealt
    out by ranges of (key, time), so a key may have as many as it likes. A first pass tells of each range where
    the clock stands at its end. If its first key goes on from the range before, that depends on where it stood there, but
    only by where it moves first: for each time within a gap of the range's first one the end is told, as a step function,
    since a later move never ends earlier. These are joined up range by range in the driver (at most a gap's distinct times
    a range); a second pass marks the rows.
    """
    if gap <= 0:
        return df.withColumn("kept", F.lit(True))
    forced = F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False)
    rows = df.select("*", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("__k"), F.col(time).cast("long").alias("__t"), forced.alias("__f"))
    sorted_ = dealt(rows, ["__k", "__t", seq], chunks)
    key, at, by_force = (sorted_.columns.index(c) for c in ("__k", "__t", "__f"))

    def ends(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        first = now = begin = clock = None
        starts, stops = np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_ = True  # a forced row ends the times at which the clock may move first
        for batch in batches:
            for k, _, times, flags in _runs(batch, 0, 1, 2):
                pushed = times[flags]
                if first is None:
                    first = now = k
                if k != now:
                    now, clock = k, None
                if not len(times):
                    continue
                if k == first:
                    begin = int(times[0]) if begin is None else begin
                    stops = _ends(stops, gap, times, pushed)
                    if open_:
                        limit = min(begin + gap, int(pushed[0]) if len(pushed) else NEVER - 1)
                        new = np.unique(times[times <= limit])
                        new = new[new > (starts[-1] if len(starts) else -NEVER)]
                        starts, stops = np.append(starts, new), np.append(stops, _ends(new, gap, times, pushed))
                        open_ = not len(pushed)
                else:
                    clock = int(_ends(np.array([times[0] if clock is None else clock]), gap, times, pushed)[0])
        if first is not None:
            turns = np.append(np.flatnonzero(stops[1:] != stops[:-1]), len(stops) - 1) if len(stops) else np.zeros(0, np.int64)
            told = {"first": first, "begin": begin, "starts": starts[turns].tolist(), "stops": stops[turns].tolist(), "forced": not open_, "last": now, "clock": clock}
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([json.dumps(told)])], ["pid", "told"])

    known = {r["pid"]: json.loads(r["told"]) for r in sorted_.select("__k", "__t", "__f").mapInArrow(ends, "pid int, told string").collect()}
    begun: dict[int, int] = {}
    clock, last = None, None
    for pid in sorted(known):
        mine = known[pid]
        if last != mine["first"]:
            clock = None
        if clock is not None:
            begun[pid] = clock
        if mine["starts"]:
            move = 0 if clock is None else bisect_left(mine["starts"], clock + gap)
            if move < len(mine["starts"]):
                clock = mine["stops"][move]
            elif mine["forced"]:
                clock = mine["stops"][-1]
        if mine["last"] != mine["first"]:
            clock = mine["clock"]
        last = mine["last"]
    columns = df.columns

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        clock, now = begun.get(TaskContext.get().partitionId()), None
        for batch in batches:
            kept = np.asarray(batch.column(by_force).to_numpy(zero_copy_only=False), bool).copy()
            for k, start, times, flags in _runs(batch, key, at, by_force):
                if k != now:
                    clock, now = (clock if now is None else None), k
                pushed = times[flags]
                while len(times):
                    then = int(times[0]) if clock is None else int(_next(np.array([clock]), gap, times, pushed)[0])
                    if then == NEVER:
                        break
                    if clock is None or then - clock >= gap:
                        kept[start + int(np.searchsorted(times, then))] = True
                    clock = then
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in columns], pa.array(kept)], [*columns, "kept"])

    return sorted_.mapInArrow(mark, StructType([*df.schema.fields, StructField("kept", BooleanType())]))
