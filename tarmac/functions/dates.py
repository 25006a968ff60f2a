"""Date and time expressions. ``as_of`` is always an argument, never the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = date | datetime | str


def as_of_date(as_of: AsOf) -> Column:
    text = as_of.isoformat() if isinstance(as_of, (date, datetime)) else as_of
    return F.lit(text[:10]).cast("date")


def as_of_ts(as_of: AsOf) -> Column:
    """The instant as a zone-free timestamp; a bare date means its midnight."""
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text.replace("T", " ")).cast("timestamp_ntz")


def iso_day(as_of: AsOf, shift: int = 0) -> str:
    """ISO date ``shift`` days from ``as_of``, as a constant for scan filters."""
    text = as_of.isoformat() if isinstance(as_of, (date, datetime)) else as_of
    return (date.fromisoformat(text[:10]) + timedelta(days=shift)).isoformat()


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_of_date(as_of), days)


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_to_date(key: Column) -> Column:
    return F.make_date((key / 10000).cast("int"), ((key % 10000) / 100).cast("int"), key % 100)


def key_days_before(as_of: AsOf, days: int) -> Column:
    """Date key ``days`` before ``as_of``; foldable, so it reaches the parquet scan."""
    return date_key(days_before(as_of, days))


def trunc_ts(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed between two timestamps.

    Spark's own difference counts whole elapsed units; truncating both sides
    first gives the boundary count warehouses use for DATEDIFF.
    """
    return F.timestamp_diff(unit.upper(), trunc_ts(unit, start), trunc_ts(unit, end))


def in_last_days(day: Column, as_of: AsOf, days: int) -> Column:
    """``day >= as_of - days`` (open to the future, as the reports define it)."""
    return day >= days_before(as_of, days)


def between_days(day: Column, as_of: AsOf, first: int, last: int) -> Column:
    """``as_of + first <= day <= as_of + last``."""
    return day.between(F.date_add(as_of_date(as_of), first), F.date_add(as_of_date(as_of), last))


def after_days(day: Column, as_of: AsOf, days: int) -> Column:
    """Strictly later than ``as_of - days``."""
    return day > days_before(as_of, days)
