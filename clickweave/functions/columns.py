"""Scalar column expressions (E1-E9). All built-in, JVM-side, codegen'd.

Inputs are ``timestamp_ntz`` values in UTC wall-clock time, so none of these
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def event_date(ts: str | Column) -> Column:
    """Calendar day of the event."""
    return F.to_date(_c(ts))


def hour_of_day(ts: str | Column) -> Column:
    """0-23."""
    return F.hour(_c(ts)).cast("int")


def day_of_week(ts: str | Column) -> Column:
    """English weekday name, ``Monday`` ... ``Sunday``."""
    return F.date_format(_c(ts), "EEEE")


def is_weekend(ts: str | Column) -> Column:
    """Saturday or Sunday (``dayofweek``: Sunday = 1, Saturday = 7)."""
    return F.dayofweek(_c(ts)).isin(1, 7)


def is_country(country: str | Column, code: str = "IN") -> Column:
    """Equality with a country code; a null country stays null."""
    return _c(country) == F.lit(code)


def device_category(device_type: str | Column) -> Column:
    """E5: mobile / tablet, everything else (smart_tv, unknown, null) desktop."""
    d = _c(device_type)
    return (F.when(d == "mobile", "mobile").when(d == "tablet", "tablet")
            .otherwise("desktop"))


def duration_secs(start: str | Column, end: str | Column) -> Column:
    """Whole seconds of ``end`` minus whole seconds of ``start``.

    Each side is floored to the second before subtracting, so 10:00:00.900 ->
    10:00:01.100 is 1 second.
    """
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def millis_between(start: str | Column, end: str | Column) -> Column:
    """Signed milliseconds from ``start`` to ``end`` (ingestion lag, Q9)."""
    return F.timestamp_diff("MILLISECOND", _c(start), _c(end))
