"""Time arithmetic. Durations are kept as exact integer microseconds:
bounds like "between 1 and 1440 minutes" are evaluated on integers, and the
2-decimal minutes of the fact are rounded once from the exact value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_MINUTE = 60_000_000


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_us(start: str | Column, end: str | Column) -> Column:
    """end - start in microseconds (works for timestamp and timestamp_ntz)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes as double: the correctly rounded quotient of two
    exact integers, identical on every engine."""
    return duration_us(start, end) / F.lit(float(US_PER_MINUTE))


def duration_minutes_2dp(us: str | Column) -> Column:
    """Exact minutes rounded half away from zero to 2 decimals."""
    u = _c(us)
    hundredths = F.call_function(
        "div", F.abs(u) * 2 + F.lit(US_PER_MINUTE // 100), F.lit(2 * US_PER_MINUTE // 100))
    signed = F.when(u < 0, -hundredths).otherwise(hundredths)
    return (signed.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


def ntz_literal(value: dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal from a naive datetime, built from its
    text so no time zone (driver's or session's) is involved."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def iso_day_of_week(d: str | Column) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("int")
