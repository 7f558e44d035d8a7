"""Time-zone and calendar expressions.

Intervals are kept as ``timestamp_ntz`` holding UTC wall time, so results never depend on
the session time zone.  Parsing uses ``try_cast``: malformed input becomes NULL instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_local_timestamp(col) -> Column:
    """ISO local time text (``2023-09-01T00:00:00``) -> ``timestamp_ntz``; NULL when unparsable."""
    return _c(col).try_cast("timestamp_ntz")


def local_to_utc(col, tz: str) -> Column:
    """Wall time in ``tz`` -> UTC wall time (both ``timestamp_ntz``)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(col))


def utc_to_local(col, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(col))


def local_hour(col, tz: str) -> Column:
    """Local hour 0..23 of a UTC wall time, as smallint."""
    return F.hour(utc_to_local(col, tz)).cast("smallint")


def floor_hours(col, hours: int = 1) -> Column:
    """Start of the ``hours``-wide bin (aligned to midnight) holding ``col``, as ``timestamp_ntz``."""
    c = _c(col)
    h = F.hour(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), h - h % F.lit(hours),
                                F.lit(0), F.lit(0))


def date_key(col) -> Column:
    """``yyyyMMdd`` integer key of a date."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (time-zone free)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(col))


def hours_between(start, end) -> Column:
    """Whole hours from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def utc_now(as_of: _dt.datetime | str | None = None) -> Column:
    """Current UTC wall time as ``timestamp_ntz``; a fixed ``as_of`` makes results reproducible."""
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp())
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz")


def ntz_to_instant(col) -> Column:
    """UTC wall time (``timestamp_ntz``) -> instant (``timestamp``), independent of the session zone."""
    return F.timestamp_micros(epoch_micros(col))


def instant_to_ntz(col) -> Column:
    """Instant (``timestamp``) -> UTC wall time (``timestamp_ntz``), independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH))
