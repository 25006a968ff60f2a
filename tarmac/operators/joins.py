"""Join operators. No broadcast is forced: the planner broadcasts a side whose
measured size is under its threshold, and AQE splits skewed partitions otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import trunc_ts


@dataclass(frozen=True)
class Dim:
    """A dimension to attach: its rows, its key, and the fact column that refers to it."""

    rows: DataFrame
    key: str
    fact_key: str
    columns: Mapping[str, str] = field(default_factory=dict)  # output name -> dimension column
    how: str = "inner"


def star_join(fact: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Attach the wanted columns of each dimension to the fact by surrogate key."""
    out = fact
    for n, dim in enumerate(dims):
        key = f"__dim{n}"
        side = dim.rows.select(
            F.col(dim.key).alias(key), *[F.col(c).alias(name) for name, c in dim.columns.items()]
        )
        out = out.join(side, F.col(dim.fact_key) == F.col(key), dim.how).drop(key)
    return out


def role_playing_join(
    fact: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str], columns: Sequence[str]
) -> DataFrame:
    """Join one dimension several times; ``roles`` maps an output prefix to the fact column."""
    return star_join(
        fact,
        [Dim(dim, key, fact_key, {f"{role}_{c}": c for c in columns}) for role, fact_key in roles.items()],
    )


def left_join_on_filter(left: DataFrame, right: DataFrame, on: Sequence[str], condition: Column) -> DataFrame:
    """LEFT JOIN whose ON clause also restricts the right side: left rows are all kept."""
    return left.join(right.filter(condition), list(on), "left")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def scd2_current_join(fact: DataFrame, dim: DataFrame, business_key: str, how: str = "left") -> DataFrame:
    """Resolve a business key against the open version of a versioned dimension."""
    return fact.join(current_rows(dim), business_key, how)


def hour_bucket_join(
    left: DataFrame, right: DataFrame, left_place: str, left_ts: str, right_place: str, right_ts: str,
    columns: Sequence[str],
) -> DataFrame:
    """LEFT JOIN on place and the hour of both timestamps, as a plain equi-join."""
    side = right.select(
        F.col(right_place).alias("__place"), trunc_ts("hour", F.col(right_ts)).alias("__hour"), *columns
    )
    hour = trunc_ts("hour", F.col(left_ts))
    match = (F.col(left_place) == F.col("__place")) & (hour == F.col("__hour"))
    return left.join(side, match, "left").drop("__place", "__hour")


def grid(df: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every row combined with every value of short constant axes.

    Each axis is exploded from the row itself, so the work stays in the scan's
    partitions; there is no cross join and no exchange.
    """
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def unique_lookup(df: DataFrame, dim: DataFrame, code: str, dim_code: str, value: str, name: str) -> DataFrame:
    """Scalar lookup ``(SELECT value FROM dim WHERE dim_code = code)``.

    Null when nothing matches; a code that matches several dimension rows raises,
    as a scalar subquery does.
    """
    side = (
        dim.filter(F.col(dim_code).isNotNull())
        .groupBy(F.col(dim_code).alias("__code"))
        .agg(F.count(F.lit(1)).alias("__n"), F.max(value).alias("__value"))
    )
    found = F.when(
        F.col("__n") > 1,
        F.raise_error(F.concat(F.lit(f"several {value} for "), F.col("__code").cast("string"))),
    ).otherwise(F.col("__value"))
    joined = df.join(side, F.col(code) == F.col("__code"), "left")
    return joined.withColumn(name, found).drop("__code", "__n", "__value")


def correlated_agg(df: DataFrame, detail: DataFrame, key: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """Correlated aggregate subquery: aggregate the detail once per key, then LEFT JOIN."""
    per_key = detail.groupBy(key).agg(*[a.alias(n) for n, a in aggregates.items()])
    return df.join(per_key, key, "left")


def exists_probe(df: DataFrame, condition: Column) -> DataFrame:
    """One row telling whether any row satisfies ``condition``; stops at the first hit."""
    hit = df.filter(condition).select(F.lit(1).alias("hit")).limit(1)
    return hit.agg((F.count("hit") > 0).alias("fired"))


def orphan_check(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return child.filter(F.col(child_key).isNotNull()).join(
        keys, F.col(child_key) == F.col("__parent"), "left_anti"
    )
