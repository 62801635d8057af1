"""Closed sliding windows on a grid, as-of values, and peers-corrected trailing counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions.times import grid_down, grid_up


def time_grid(events: DataFrame, key: str = "runnable", epoch: str = "epoch", step: int = 300) -> DataFrame:
    """(key, t): per key the grid points after the one at or before its first event, up to its last event."""
    ends = events.groupBy(key).agg(F.min(epoch).alias("lo"), F.max(epoch).alias("hi"))
    start = grid_down(F.col("lo"), step) + F.lit(step)
    # A key whose events all stand at one time has no grid.
    some = ends.where((F.col("lo") < F.col("hi")) & (start <= F.col("hi")))
    return some.select(key, F.explode(F.sequence(start, F.col("hi"), F.lit(step).cast("long"))).alias("t"))


class GridWindows:
    """Sums over closed windows [t - length, t] at every grid point, by one shuffle of buckets.

    An event at e falls into the bucket that ends at the grid point at or after e. A window that ends at t is the
    buckets that end in (t - length, t] and the events at exactly t - length, which are kept apart for grid points.
    A key's rows are dense on its grid, so a sum over buckets is a running sum less the one some rows before: each
    window takes the same time whatever its length, and partial sums go before the shuffle.
    """

    def __init__(self, events: DataFrame, grid: DataFrame, measures: Mapping[str, Column], key: str = "runnable", epoch: str = "epoch", step: int = 300, state: Mapping[str, Column] | None = None, latest: Mapping[str, Column] | None = None):
        self.key, self.step, self.names = key, step, list(measures)
        e = F.col(epoch)
        flags = [m.cast("long").alias(f"m_{n}") for n, m in measures.items()]
        extra = [c.alias(f"s_{n}") for n, c in (state or {}).items()] + [c.alias(f"l_{n}") for n, c in (latest or {}).items()]
        rows = events.select(key, grid_up(e, step).alias("t"), (e % step == 0).alias("on"), e.alias("e"), "seq", *flags, *extra)
        aggs = [F.sum(f"m_{n}").alias(f"b_{n}") for n in self.names]
        aggs += [F.sum(F.when(F.col("on"), F.col(f"m_{n}"))).alias(f"a_{n}") for n in self.names]
        aggs += [F.max_by(f"s_{n}", F.when(F.col(f"s_{n}").isNotNull(), F.struct("e", "seq"))).alias(f"s_{n}") for n in (state or {})]
        aggs += [F.max(f"l_{n}").alias(f"l_{n}") for n in (latest or {})]
        buckets = rows.groupBy(key, "t").agg(*aggs).withColumn("is_grid", F.lit(0))
        both = buckets.unionByName(grid.select(key, "t", F.lit(1).alias("is_grid")), allowMissingColumns=True)
        merge = [F.max(c).alias(c) for c in buckets.columns if c not in (key, "t")]
        merged = both.groupBy(key, "t").agg(*merge)
        self.order = W.partitionBy(key).orderBy("t")
        running = self.order.rowsBetween(W.unboundedPreceding, 0)
        zero = F.lit(0).cast("long")
        sums = {f"c_{n}": F.sum(F.coalesce(f"b_{n}", zero)).over(running) for n in self.names}
        self.rows = merged.withColumns(sums | {f"a_{n}": F.coalesce(f"a_{n}", zero) for n in self.names})

    def _before(self, column: str, back: int) -> Column:
        return F.lag(column, back // self.step, 0).over(self.order) if back else F.col(column)

    def count(self, name: str, length: int, back: int = 0) -> Column:
        """Sum over [t - back - length, t - back]; both are multiples of the step."""
        return self._before(f"c_{name}", back) - self._before(f"c_{name}", back + length) + self.at(name, back + length)

    def at(self, name: str, back: int) -> Column:
        """Sum at exactly t - back, a grid point."""
        return self._before(f"a_{name}", back)

    def state(self, name: str) -> Column:
        """The last value at or before t."""
        return F.last(f"s_{name}", ignorenulls=True).over(self.order.rowsBetween(W.unboundedPreceding, 0))

    def latest(self, name: str) -> Column:
        return F.max(f"l_{name}").over(self.order.rowsBetween(W.unboundedPreceding, 0))

    def select(self, **columns: Column) -> DataFrame:
        """(key, t) of grid points with columns made by the methods above."""
        return self.rows.select(self.key, "t", "is_grid", *[c.alias(n) for n, c in columns.items()]).where("is_grid = 1").drop("is_grid")


def distinct_in_windows(events: DataFrame, value: Column, length: int = 300, key: str = "runnable", epoch: str = "epoch", step: int = 300, name: str = "n") -> DataFrame:
    """(key, t, name): exact number of distinct values in [t - length, t]; each event goes to the windows that hold it."""
    first = grid_up(F.col(epoch), step)
    last = grid_down(F.col(epoch) + F.lit(length), step)
    spread = events.select(key, value.alias("v"), F.explode(F.sequence(first, last, F.lit(step).cast("long"))).alias("t"))
    return spread.groupBy(key, "t").agg(F.count_distinct("v").alias(name))


#: Seconds of a key that one task orders, where a value from any time before may be asked for.
SPAN = 86_400


def with_context(rows: DataFrame, time: str, seconds: int) -> DataFrame:
    """rows with __b and __own: each in the bucket of its time, and once more, not its own, in the next one.

    So a bucket holds all that a window of so many seconds before any of its own rows holds, and a busy key is dealt out by
    buckets.
    """
    bucket = F.floor(F.col(time) / seconds)
    places = F.array(F.struct(bucket.alias("b"), F.lit(True).alias("own")), F.struct((bucket + 1).alias("b"), F.lit(False).alias("own")))
    return rows.select("*", F.explode(places).alias("__x")).withColumns({"__b": F.col("__x.b"), "__own": F.col("__x.own")}).drop("__x")


def trailing_counts(rows: DataFrame, keys: list[str], epoch: str, seq: str, seconds: int, name: str = "n") -> DataFrame:
    """rows with the number of the key's rows in [now - seconds, now] up to each one; of equal times those of a lesser or equal seq."""
    part = W.partitionBy(*keys, "__b")
    sofar = F.row_number().over(part.orderBy(epoch, seq))
    gone = F.count("*").over(part.orderBy(epoch).rangeBetween(W.unboundedPreceding, -seconds - 1))
    return with_context(rows, epoch, seconds).withColumn(name, (sofar - gone).cast("long")).where("__own").drop("__b", "__own")


def in_order(rows: DataFrame, keys: list[str], time: str, seq: str, steps: list[Column], seconds: int) -> DataFrame:
    """rows at which conditions have held one after the other, each at a later row, within [now - seconds, now].

    For each beginning of the steps the latest time at which it can have started is a running maximum, made of that of the
    beginning before, so a row takes the same time however many rows its window has.
    """
    if not steps:
        return rows.where("false")
    line = W.partitionBy(*keys, "__b").orderBy(time, seq)
    upto, before = line.rowsBetween(W.unboundedPreceding, 0), line.rowsBetween(W.unboundedPreceding, -1)
    out = with_context(rows, time, seconds).withColumn("__m0", F.when(steps[0], F.col(time)))
    for k, step in enumerate(steps[1:], 1):
        out = out.withColumn(f"__m{k}", F.when(step, F.max(f"__m{k - 1}").over(before)))
    started = F.max(f"__m{len(steps) - 1}").over(upto)
    return out.withColumn("__started", started).where(F.col("__own") & (F.col("__started") >= F.col(time) - seconds)).select(*rows.columns)


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, seq: str = "seq", span: int = SPAN) -> DataFrame:
    """left with the last value of right (not null) at or before its time (ties: the greatest seq).

    Both are dealt out by key and span of time; each span begins with the last value of the spans before it, which is a
    row a span.
    """
    columns = left.columns
    bucket = F.floor(F.col(time) / span).alias("__b")
    r = right.where(F.col(value).isNotNull()).select(*keys, F.col(time), bucket, F.col(seq).cast("long").alias("__seq"), F.col(value).alias("__value"), F.lit(1).alias("__kind"))
    ends = r.groupBy(*keys, "__b").agg(F.max_by("__value", F.struct(time, "__seq")).alias("__value"))
    spans = ends.unionByName(left.select(*keys, bucket).distinct(), allowMissingColumns=True).groupBy(*keys, "__b").agg(F.max("__value").alias("__value"))
    before = W.partitionBy(*keys).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    handed = spans.withColumn("__value", F.last("__value", ignorenulls=True).over(before)).where("__b IS NOT NULL").withColumn("__kind", F.lit(0))
    rows = left.withColumns({"__b": bucket, "__kind": F.lit(2)}).unionByName(r, allowMissingColumns=True).unionByName(handed, allowMissingColumns=True)
    # What is handed on has no time and so comes first.
    order = W.partitionBy(*keys, "__b").orderBy(time, "__kind", "__seq").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(value, F.last("__value", ignorenulls=True).over(order)).where("__kind = 2").select(*columns, value)


def within_tolerance(probes: DataFrame, values: DataFrame, keys: list[str], time: str, value: str, seconds: int = 30) -> DataFrame:
    """probes with a value at most so many seconds off: that at the same time, else the earliest of those. Joined by time buckets, each probe to the two that it can meet."""
    size = 2 * seconds + 1
    bucket = lambda c: F.floor(c / F.lit(size)).cast("long")
    left = probes.select("*", F.explode(F.array_distinct(F.array(bucket(F.col(time) - seconds), bucket(F.col(time) + seconds)))).alias("__b"))
    right = values.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(time).alias("__t"), F.col(value).alias("__v"), bucket(F.col(time)).alias("__b2"))
    on = [F.col("__b") == F.col("__b2"), *[F.col(k) == F.col(f"__{k}") for k in keys], F.col("__t").between(F.col(time) - seconds, F.col(time) + seconds)]
    best = F.min_by("__v", F.when(F.col("__t").isNotNull(), F.struct(F.col("__t") != F.col(time), F.col("__t"))))
    return left.join(right, on, "left").groupBy(*probes.columns).agg(best.alias(value))
