"""Ordered computations on range partitions.

A window over a long ordering sorts a whole key (or the whole table) in one task.
Here rows are range-partitioned on (keys, order), so a hot key is spread over as
many ranges as its share of the rows asks for. Each range works on its own, and
only what crosses a range border is passed on: at most one key continues from a
range into the next, so there are fewer border rows than ranges. Keys and order
columns must not be null.

The ranges are written to the session's scratch folder first: range borders come
from a sample, and a task rerun after an executor loss must see the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.session import scratch_path

PART = "__part"
RANGE_ROWS = 200_000  # mean rows of a range: what one task sorts, whatever the table's size
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is run inside deletes its shuffle files as it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def ranged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], range_rows: int = RANGE_ROWS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The rows with the number of their range, fixed in a written table (by ``keep``, else ``stored``).

    There are as many ranges as the rows ask for. A null in a key or order column raises.
    """
    parts = max(1, math.ceil(df.count() / range_rows))
    named = [*keys, *order]
    for name in named:
        message = F.raise_error(F.lit(f"{name} must not be null in a range")).cast(df.schema[name].dataType)
        df = df.withColumn(name, F.when(F.col(name).isNull(), message).otherwise(F.col(name)))
    return (keep or stored)(df.repartitionByRange(parts, *named).withColumn(PART, F.spark_partition_id()))


def stored(df: DataFrame) -> DataFrame:
    """The rows by way of a table in the shared scratch folder: computed once, safe to rerun."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Kept:
    """Tables like those of ``stored`` that are deleted with the ``with`` block which made them.

    The shuffle files behind a table go once it is written. No DataFrame over the tables may be used
    after the block.
    """

    def __init__(self) -> None:
        self._made: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Kept:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, "rows")
        self._made.append((spark, path))
        with shuffles_released(spark):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        for spark, name in self._made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self._made = []


def _border_join(rows: DataFrame, keys: Sequence[str], border: DataFrame, name: str) -> DataFrame:
    """Attach border values; ``border`` has fewer rows than there are ranges, so it is broadcast."""
    known = border.filter(F.col(name).isNotNull())
    return rows.join(F.broadcast(known), [*keys, PART], "left")


def running_in_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` up to and including each row, per key."""
    totals = rows.groupBy(*keys, PART).agg(F.sum(value).alias("__total"))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    border = totals.select(*keys, PART, F.sum("__total").over(earlier).alias("__opening"))
    within = Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    moved = rows.withColumn("__moved", F.sum(value).over(within))
    joined = _border_join(moved, keys, border, "__opening")
    running = F.coalesce("__moved", F.lit(0)) + F.coalesce("__opening", F.lit(0))
    return joined.withColumn(name, running).drop("__moved", "__opening")


def _neighbour(
    rows: DataFrame, keys: Sequence[str], order: str, value: Column, name: str, back: bool
) -> DataFrame:
    edge, step = (F.max, F.lag) if back else (F.min, F.lead)
    outer = rows.groupBy(*keys, PART).agg(edge(F.struct(F.col(order), value.alias("v"))).alias("__edge"))
    by_part = Window.partitionBy(*keys).orderBy(PART)
    border = outer.select(*keys, PART, step(F.col("__edge.v")).over(by_part).alias("__border"))
    within = Window.partitionBy(*keys, PART).orderBy(order)
    local = rows.withColumn("__local", step(value).over(within))
    joined = _border_join(local, keys, border, "__border")
    return joined.withColumn(name, F.coalesce("__local", "__border")).drop("__local", "__border")


def previous_in_ranges(rows: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """``value`` of the row before, per key (LAG); ``value`` must not be null."""
    return _neighbour(rows, keys, order, value, name, back=True)


def next_in_ranges(rows: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """``value`` of the row after, per key (LEAD); ``value`` must not be null."""
    return _neighbour(rows, keys, order, value, name, back=False)
