"""The tables every report reads, as one bundle of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


TABLE_NAMES = (
    "date", "airport", "aircraft", "passenger", "route", "weather",
    "flight", "booking", "delay", "feedback", "loyalty", "gate",
)


class Tables:
    """Star schema: dimensions and facts by name, and what the facts are known to carry.

    A table is given as a DataFrame, or as a function that makes one when it is
    first used, so a report opens only the tables it reads.

    ``facts_carry_flight_date``: bookings, delays and feedback repeat their
    flight's own date key, so a report over a date range can prune their
    partitions too, not only the flights'.
    ``booking_key_unique``: the booking key is known to be unique (see the key
    checks), so distinct bookings are counted without shuffling every one.
    ``flight_scan``: flights between two dates, for a source whose date filter
    must be put on the raw column to reach the scan.
    """

    def __init__(
        self,
        *,
        facts_carry_flight_date: bool = False,
        booking_key_unique: bool = False,
        flight_scan: Callable[[str | None, str | None], DataFrame] | None = None,
        **tables: DataFrame | Callable[[], DataFrame],
    ):
        unknown = set(tables) - set(TABLE_NAMES)
        if unknown:
            raise ValueError(f"unknown tables {sorted(unknown)}")
        self.facts_carry_flight_date = facts_carry_flight_date
        self.booking_key_unique = booking_key_unique
        self.flight_scan = flight_scan
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(f"table {name!r} was not given")
        if not isinstance(tables[name], DataFrame):
            tables[name] = tables[name]()
        return tables[name]

    def flights_between(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Flights dated ``first``..``last`` (ISO dates, both included, either open)."""
        if self.flight_scan:
            return self.flight_scan(first, last)
        return dated_between(self.flight, "flight_date_key", first, last)

    def flight_dates(self, columns: list[str]) -> DataFrame:
        """Date dimension columns keyed for a join on ``flight_date_key``."""
        return self.date.select(F.col("date_key").alias("flight_date_key"), *columns)


def dated_between(df: DataFrame, key: str, first: str | None, last: str | None) -> DataFrame:
    """Filter on a YYYYMMDD key with constants, so partitions and row groups are pruned."""
    if first:
        df = df.filter(F.col(key) >= int(first.replace("-", "")))
    if last:
        df = df.filter(F.col(key) <= int(last.replace("-", "")))
    return df
