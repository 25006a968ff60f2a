"""Mergeable sketches: distinct counts and quantiles of any range out of one small state a day.

A state is the sketch of one group and day; states of a range are united, so a count over 90 days
reads 90 states a group and no row. Sketches estimate: a distinct count (HyperLogLog) has a
relative standard error of 1.04 / sqrt(2^precision), 1.6 % here; a quantile (KLL) is that of a rank
within about 1.65 % for the default size. ``exact_percentiles`` and ``count_distinct`` are the exact forms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12  # registers of a distinct count, as a power of two
COUNT_ERROR = 1.04 / 2 ** (PRECISION / 2)
RANK_ERROR = 0.0165


def daily_states(rows: DataFrame, groups: Sequence[str], day: str, distinct: Sequence[str] = (), measured: Sequence[str] = ()) -> DataFrame:
    """One row a group and day: number of rows, a distinct-count state and a quantile state of the named columns.

    Nulls are in no sketch; a column without a value has an empty state or a null one.
    """
    counts = [F.hll_sketch_agg(F.col(c), F.lit(PRECISION)).alias(f"{c}__distinct") for c in distinct]
    spread = [F.expr(f"kll_sketch_agg_double(CAST({c} AS DOUBLE))").alias(f"{c}__quantiles") for c in measured]
    return rows.groupBy(*groups, day).agg(F.count(F.lit(1)).alias("rows"), *counts, *spread)


def over_range(
    states: DataFrame, groups: Sequence[str], day: str, first: object, last: object,
    distinct: Sequence[str] = (), quantiles: Mapping[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """Per group, of the days from ``first`` to ``last``: rows, about how many distinct values, and quantiles.

    ``quantiles`` maps an output name to (column, rank between 0 and 1).
    """
    wanted = states.filter(F.col(day).between(first, last))
    counts = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}__distinct")).alias(c) for c in distinct]
    asked = quantiles or {}
    # One state a day and group is gathered: as many as the range has days.
    united = {c: F.collect_list(f"{c}__quantiles").alias(f"__{c}") for c, _ in asked.values()}
    merged = wanted.groupBy(*groups).agg(F.sum("rows").alias("rows"), *counts, *united.values())
    both = "aggregate(slice(__{0}, 2, size(__{0})), __{0}[0], (a, b) -> kll_sketch_merge_double(a, b))"
    for c in united:
        merged = merged.withColumn(f"__{c}", F.expr(both.format(c)))
    points = [F.expr(f"kll_sketch_get_quantile_double(__{c}, CAST({p} AS DOUBLE))").alias(n) for n, (c, p) in asked.items()]
    return merged.select(*groups, "rows", *distinct, *points)
