"""Time arithmetic on naive-UTC timestamps. Nothing here reads the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import _col

_ORIGIN = "0001-01-01 00:00:00"
_UNITS = {
    "day": T.DayTimeIntervalType(0, 0),
    "hour": T.DayTimeIntervalType(1, 1),
    "minute": T.DayTimeIntervalType(2, 2),
}


def _units_since_origin(ts: Column, unit: str) -> Column:
    origin = F.lit(_ORIGIN).cast("timestamp_ntz")
    return (ts - origin).cast(_UNITS[unit]).cast("bigint")


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of unit boundaries crossed from start to end (00:00:59 to 00:01:01 is one minute)."""
    return _units_since_origin(_col(end), unit) - _units_since_origin(_col(start), unit)


def local_date(ts_utc: Column | str, zone: Column | str) -> Column:
    """Calendar date of a naive-UTC timestamp in a per-row zone."""
    return F.convert_timezone(F.lit("UTC"), _col(zone), _col(ts_utc)).cast("date")


def local_to_utc(ts_local: Column, zone: Column) -> Column:
    return F.convert_timezone(zone, F.lit("UTC"), ts_local)


def utc_now() -> dt.datetime:
    """Driver clock, read once per run and passed down as a literal."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def ntz(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
