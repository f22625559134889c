"""Run time, lookbacks and time differences."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime | str) -> datetime:
    """A UTC-aware instant; text and naive values are read as UTC."""
    value = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def ts_lit(as_of: datetime | str, **back: float) -> Column:
    """``as_of`` as a literal, moved back by e.g. ``days=7`` or ``minutes=5``."""
    return F.lit(instant(as_of) - timedelta(**back)).cast("timestamp")


def date_lit(as_of: datetime | str, days_back: int = 0) -> Column:
    return F.lit((instant(as_of) - timedelta(days=days_back)).date())


def within(column: Column, as_of: datetime | str, **back: float) -> Column:
    """Whether an instant lies in a lookback: not after ``as_of``, nor longer before it
    than e.g. ``hours=1``. Without a length only the upper end counts. A run repeated
    for an earlier time thus sees what the run of that time saw."""
    not_after = column <= ts_lit(as_of)
    return (column >= ts_lit(as_of, **back)) & not_after if back else not_after


def days_within(column: Column, as_of: datetime | str, days: int) -> Column:
    """The same for a date, by calendar days."""
    return column.between(date_lit(as_of, days), date_lit(as_of))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def whole_hours_between(start: Column, end: Column) -> Column:
    """Complete hours, the rest cut off: 1 h 59 min is 1."""
    return F.timestamp_diff("HOUR", start, end)


def _fraction(ts: Column) -> Column:
    return F.unix_micros(ts) % F.lit(1_000_000)


def iso_text(ts: Column) -> Column:
    """``2025-10-20T09:12:34+00:00``; microseconds appear only when not zero."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(_fraction(ts) != 0, F.date_format(ts, ".SSSSSS")).otherwise(F.lit("")),
        F.lit("+00:00"),
    )


def warehouse_text(ts: Column) -> Column:
    """``2025-10-20 09:12:34+00``, with three or six fraction digits when needed."""
    fraction = _fraction(ts)
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        F.when(fraction == 0, F.lit(""))
        .when(fraction % 1000 == 0, F.date_format(ts, ".SSS"))
        .otherwise(F.date_format(ts, ".SSSSSS")),
        F.lit("+00"),
    )
