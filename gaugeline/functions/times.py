"""Time column expressions.

Moments are TIMESTAMP columns in a UTC session. Bin arithmetic works on whole
epoch seconds, so it needs no calendar lookups and stays inside codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"s": 1, "sec": 1, "second": 1, "t": 60, "min": 60, "minute": 60,
                 "h": 3600, "hour": 3600, "d": 86400, "day": 86400, "w": 604800, "week": 604800}


def interval_seconds(interval: str) -> int:
    """Seconds of an interval such as ``1H``, ``30min``, ``7 hours`` or ``28 days``."""
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", interval)
    unit = match and match.group(2).lower()
    if unit and unit not in _UNIT_SECONDS and unit.endswith("s"):
        unit = unit[:-1]
    if not match or unit not in _UNIT_SECONDS:
        raise ValueError(f"not an interval: {interval!r}")
    seconds = int(match.group(1) or 1) * _UNIT_SECONDS[unit]
    if seconds <= 0:
        raise ValueError(f"interval must be positive: {interval!r}")
    return seconds


def as_moment(as_of) -> Column:
    """TIMESTAMP column of a literal, a column, or the current time when None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def epoch(moment: Column) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_seconds(moment.cast("timestamp"))


def time_bin(moment: Column, seconds: int, origin: Column | None = None) -> Column:
    """Start of the bin holding ``moment``; bins are counted from ``origin`` seconds."""
    shift = F.lit(0) if origin is None else origin
    offset = F.pmod(epoch(moment) - shift, F.lit(seconds))
    return F.timestamp_seconds(epoch(moment) - offset)


def parse_iso(text: Column) -> Column:
    """Moment of an ISO-8601 text, NULL when it is not one."""
    return text.try_cast("timestamp")


def clock_time(moment: Column) -> Column:
    return F.date_format(moment, "HH:mm:ss")


def add_hours(moment: Column, hours) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return moment + F.make_interval(hours=hours)


def age_days(moment: Column, now: Column) -> Column:
    """Whole days from ``moment`` to ``now``, rounded down."""
    micros = F.unix_micros(now) - F.unix_micros(moment.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")
