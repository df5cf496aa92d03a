"""Row-wise column expressions. All are built-in functions, none looks at another row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AIRPORT_ZONES, VOCABULARY, ZONE_COUNT


def number(name: str) -> Column:
    """Value as double; text that is no number, and NaN, become null."""
    v = F.col(name).try_cast("double")
    return F.when(~F.isnan(v), v)


def timestamp(name: str) -> Column:
    """Zone-less timestamp; unreadable text becomes null."""
    return F.col(name).try_cast("timestamp_ntz")


def duration_min(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def speed_mph(distance: Column, minutes: Column) -> Column:
    return F.try_divide(distance, minutes / F.lit(60.0))


def tip_pct(tip: Column, fare: Column) -> Column:
    return F.try_divide(tip, fare)


def hour_angle(ts: Column) -> Column:
    """Time of day to the minute as an angle on the 24 h circle."""
    hours = F.hour(ts) + F.minute(ts) / F.lit(60.0)
    return F.lit(2.0) * F.pi() * hours / F.lit(24.0)


def hour_sin(ts: Column) -> Column:
    return F.sin(hour_angle(ts))


def hour_cos(ts: Column) -> Column:
    return F.cos(hour_angle(ts))


def flag(cond: Column) -> Column:
    """1 where true, 0 where false or null."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def day_of_week(ts: Column) -> Column:
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return flag(F.weekday(ts) >= 5)


def is_night(ts: Column) -> Column:
    return flag((F.hour(ts) >= 22) | (F.hour(ts) < 6))


def store_and_fwd(name: str) -> Column:
    return F.col(name).eqNullSafe(F.lit("Y")).cast("int")


def is_airport(name: str) -> Column:
    return flag(F.col(name).isin(AIRPORT_ZONES))


def filled(name: str) -> Column:
    return F.coalesce(number(name), F.lit(0.0)).cast("float")


def category_code(name: str) -> Column:
    """Position in the pinned vocabulary; null when the value is not in it."""
    v = number(name)
    vocab = VOCABULARY[name]
    if isinstance(vocab, range):
        code = F.when(v.between(1, ZONE_COUNT) & (v == F.floor(v)), v - 1)
    else:
        code = F.when(v == vocab[0], 0)
        for i, item in enumerate(vocab[1:], start=1):
            code = code.when(v == item, i)
    return code.cast("int")


def pinned(c: Column) -> Column:
    """The same value, marked so that Catalyst keeps the projection it stands in as one step.

    Zero times the partition id is non-deterministic in Catalyst's eyes: filters are not
    pushed below such a projection, nor is its text copied into the expressions above it.
    Worth it only where that copying makes generated methods outgrow the JVM's compiler
    (8,000 bytes), never directly above a scan whose filters should reach the files.
    """
    return c + F.spark_partition_id() * 0
