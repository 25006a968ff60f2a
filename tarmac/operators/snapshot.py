"""Past states of a table, from an append-only change log or a versioned dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import AsOf, as_of_ts
from tarmac.operators.upsert import latest_per_key
from tarmac.sources.sinks import table_sink


def as_of_snapshot(log: DataFrame, keys: Sequence[str], ts: str, at: AsOf | Column) -> DataFrame:
    """State at an instant: the newest change of each key no later than ``at``."""
    instant = at if isinstance(at, Column) else as_of_ts(at)
    return latest_per_key(log.filter(F.col(ts) <= instant), keys, [ts])


def seconds_before(as_of: AsOf, seconds: int) -> Column:
    """Offset form: the instant so many seconds before ``as_of``."""
    return F.timestamp_add("SECOND", F.lit(-seconds), as_of_ts(as_of)).cast("timestamp_ntz")


def scd2_as_of(dim: DataFrame, at: AsOf | Column) -> DataFrame:
    """The versions of a dimension that were open at an instant."""
    instant = at if isinstance(at, Column) else as_of_ts(at)
    return dim.filter((F.col("effective_from") <= instant) & (instant < F.col("effective_to")))


def restore_snapshot(log: DataFrame, keys: Sequence[str], ts: str, at: AsOf, path: str) -> DataFrame:
    """Write the state at an instant to a new folder and return it as a table."""
    return table_sink(as_of_snapshot(log, keys, ts, at), path)
