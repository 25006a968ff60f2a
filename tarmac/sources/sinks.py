"""Table sinks on parquet."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create-table-as-select: overwrite ``path`` and return the stored table.

    ``path`` must not be one of the inputs of ``df``; use a new folder per version.
    """
    if partition_by:
        # small partitions share a task and a file, a hot one is split over several
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def with_defaults(df: DataFrame, columns: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Project to the table's column list; missing or null columns take their default."""
    out = []
    for name in columns:
        default = F.lit(defaults.get(name))
        value = F.col(name) if name in df.columns else F.lit(None)
        out.append((F.coalesce(value, default) if name in defaults else value).alias(name))
    return df.select(*out)


def append_sink(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """INSERT ... SELECT: append with a column list and default values."""
    rows = with_defaults(df, columns or df.columns, defaults or {})
    rows.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def clustered_layout(
    df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str], tie: str, file_rows: int = 1_000_000
) -> DataFrame:
    """Store partitioned by ``partition_col`` and sorted inside by the cluster columns.

    Rows are range-partitioned on (partition, cluster, tie): the high-cardinality
    ``tie`` column lets a hot date spread over several tasks and files, while the
    ranges keep neighbouring values together for min/max file skipping. There are
    as many ranges as ``file_rows`` rows each ask for.
    """
    files = max(1, math.ceil(df.count() / file_rows))
    order = [partition_col, *cluster_cols, tie]
    (
        df.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy(partition_col)
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)
