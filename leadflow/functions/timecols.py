"""Time helpers. All instants are timestamp_ntz so the session zone never leaks in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A timestamp_ntz literal (string cast, so no zone conversion happens)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: dt.date | str) -> Column:
    if isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d")
    return F.lit(value).cast("date")


def shift_minutes(ts: Column, minutes: int | Column) -> Column:
    n = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.timestamp_add("MINUTE", n, ts)


def local_date(ts: Column, offset_minutes: int = 330) -> Column:
    """Calendar date of a UTC instant in a fixed-offset local zone (IST = +330)."""
    return shift_minutes(ts, offset_minutes).cast("date")


def in_local_range(ts: Column, start: dt.date, end: dt.date | None, offset_minutes: int = 330) -> Column:
    """local_date(ts) in [start, end), written on the raw column so it reaches the Parquet reader.

    ``to_date(ts + off) >= d``  <=>  ``ts >= d - off`` (and likewise for ``<``), so the
    function on the column (which blocks pushdown) is folded into the literal bound.
    """
    lo = ts >= ts_lit(dt.datetime.combine(start, dt.time()) - dt.timedelta(minutes=offset_minutes))
    if end is None:
        return lo
    return lo & (ts < ts_lit(dt.datetime.combine(end, dt.time()) - dt.timedelta(minutes=offset_minutes)))


def sql_ts(value: dt.datetime | dt.date) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    return f"TIMESTAMP '{value:%Y-%m-%d} 00:00:00'"


def sql_date(value: dt.date) -> str:
    return f"DATE '{value:%Y-%m-%d}'"
