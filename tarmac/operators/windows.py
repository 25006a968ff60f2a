"""Running values and generated keys, computed range by range (see ``ranges``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.operators.ranges import PART, ranged, running_in_ranges


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` up to and including each row, per ``keys`` in a total ``order``."""
    rows = ranged(df.withColumn("__value", value), keys, order)
    return running_in_ranges(rows, keys, order, "__value", name).drop(PART, "__value")


def row_number_key(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """ROW_NUMBER() over the whole table by a total order, without a one-task sort."""
    return running_sum(df, [], order, F.lit(1).cast("bigint"), name)


def surrogate_key(existing: DataFrame, key: str, new_rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """New rows numbered on from the largest key in use; the same input gives the same keys."""
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("__top"))
    numbered = row_number_key(new_rows, order, "__seq")
    # the one-row maximum rides along as a scalar subquery
    return numbered.withColumn(key, F.col("__seq") + top.scalar()).drop("__seq")


def running_total(daily: DataFrame, day: str, value: str, name: str) -> DataFrame:
    """Cumulative total by day. The input is already one row a day, so one task suffices."""
    return daily.withColumn(name, F.sum(value).over(Window.orderBy(day)))


def running_balance(activity: DataFrame) -> DataFrame:
    """Miles balance of each passenger after each transaction."""
    change = (
        F.coalesce(F.col("miles_earned"), F.lit(0))
        - F.coalesce(F.col("miles_redeemed"), F.lit(0))
        - F.coalesce(F.col("miles_expired"), F.lit(0))
    ).cast("bigint")
    order = ["activity_date_key", "activity_key"]
    return running_sum(activity, ["passenger_key"], order, change, "balance_after")
