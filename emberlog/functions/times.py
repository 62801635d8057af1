"""Time functions, as Columns. Epochs are whole seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down, of a timestamp with or without time zone."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)).cast("long")


def last_sunday(day: Column) -> Column:
    """Last Sunday of a date's month."""
    end = F.last_day(day)
    return F.date_sub(end, F.dayofweek(end) - 1)


def summer(local: Column) -> Column:
    """Whether a local time counts as summer time: by date alone, from the last Sunday of March to the day before that of October."""
    day, month = F.to_date(local), F.month(local)
    return F.when(month.between(4, 9), F.lit(True)).when(month == 3, day >= last_sunday(day)).when(month == 10, day < last_sunday(day)).otherwise(F.lit(False))


def local_to_utc(local: Column, mode: str = "approx", zone: str = "Europe/Paris") -> Column:
    """UTC of a local time. approx: one hour less, in summer two; zoneinfo: by the time zone's own rules."""
    if mode == "zoneinfo":
        return F.to_utc_timestamp(local, zone)
    hours = F.when(summer(local), F.lit(2)).otherwise(F.lit(1))
    return F.timestamp_micros(F.unix_micros(local) - hours.cast("long") * F.lit(3_600_000_000))


def grid_up(e: Column, step: int) -> Column:
    """The grid point at or after an epoch."""
    return (F.floor((e + F.lit(step - 1)) / F.lit(step)) * F.lit(step)).cast("long")


def grid_down(e: Column, step: int) -> Column:
    return (F.floor(e / F.lit(step)) * F.lit(step)).cast("long")
