"""Timestamp and interval expressions on TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on the session's timestamp type."""
    return F.lit(text).cast("timestamp_ntz")


def hours(n) -> Column:
    """An interval of ``n`` hours (n may be a column)."""
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def hours_between(start, end) -> Column:
    """``EXTRACT(epoch FROM end - start) / 3600`` as double."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(MICROS_PER_HOUR)


def micros_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def time_of_day(ts) -> Column:
    """``ts::time`` as the interval since midnight."""
    ts = _c(ts)
    return ts - F.to_date(ts).cast("timestamp_ntz")


def interval_micros(iv) -> Column:
    """A day-time interval as whole microseconds (for output and comparison)."""
    return F.timestamp_diff("MICROSECOND", ntz("2000-01-01 00:00:00"), ntz("2000-01-01 00:00:00") + _c(iv))
