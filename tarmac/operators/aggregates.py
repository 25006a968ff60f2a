"""Aggregation operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.functions.conditions import ratio
from tarmac.functions.dates import AsOf, as_of_date

ON_TIME_MINUTES = 15


def conditional_count(condition: Column) -> Column:
    return F.count_if(condition)


def on_time_pct(delay: Column) -> Column:
    """Share of rows at most 15 minutes late; rows without a delay stay in the divisor."""
    return ratio(F.count_if(delay <= ON_TIME_MINUTES) * F.lit(100.0), F.count(F.lit(1)))


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    return ratio(F.sum(numerator), F.sum(denominator))


def latest_activity(df: DataFrame, keys: Sequence[str], day: str, as_of: AsOf) -> DataFrame:
    last = df.groupBy(*keys).agg(F.max(day).alias("last_date"))
    return last.withColumn("days_since", F.datediff(as_of_date(as_of), F.col("last_date")))


def having_group(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], condition: Column
) -> DataFrame:
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()]).filter(condition)


def having_global(df: DataFrame, aggregates: Mapping[str, Column], condition: Column) -> DataFrame:
    """HAVING without GROUP BY: one row, or none when the condition fails."""
    return df.agg(*[a.alias(n) for n, a in aggregates.items()]).filter(condition)


def string_agg(
    df: DataFrame, text: str, order: str, name: str, keys: Sequence[str] = (), separator: str = "; "
) -> DataFrame:
    """Texts in one ordered string per group, for an already aggregated (so small) input."""
    joined = F.expr(f"listagg({text}, '{separator}') WITHIN GROUP (ORDER BY {order})")
    return df.groupBy(*keys).agg(joined.alias(name))


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


SPARE_RANKS = 4  # ranks that a percentile's bracket must leave on either side of it


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], accuracy: int = 10000
) -> DataFrame:
    """Exact interpolated percentiles per group, without holding a group in one task.

    The built-in exact percentile keeps all distinct values of a group in one
    buffer. Here a sketch brackets each percentile, everything below the bracket
    is only counted, and just the values inside it are ranked. Brackets of rising
    width come from one sketch; each group takes the narrowest that leaves a few
    ranks on either side of its percentile (about 4/accuracy of a large group).
    The sketch's rank error is within 1/accuracy, and a target outside its bracket
    raises instead of giving a wrong value.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    names, ps = list(points), list(points.values())
    margins = [2.0 / accuracy * 4**k for k in range(12) if 2.0 / accuracy * 4**k < 1] + [1.0]

    def edges(sign: int) -> Column:
        wanted = [min(1.0, max(0.0, p + sign * m)) for p in ps for m in margins]
        return F.percentile_approx("__v", wanted, accuracy)

    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        edges(-1).alias("__lo"), edges(1).alias("__hi"),
    )
    # how many of the margins are narrower than a few ranks of the group
    narrow = reduce(lambda a, b: a + b, [(F.lit(m) * F.col("__n") < SPARE_RANKS).cast("int") for m in margins[:-1]], F.lit(0))

    def target(i: int) -> Column:
        p, at, margin = F.lit(ps[i]), narrow + i * len(margins), F.element_at(F.array(*map(F.lit, margins)), narrow + 1)
        # an edge beyond the group's ends is the end itself
        low = F.when(p <= margin, F.col("__min")).otherwise(F.col("__lo")[at])
        high = F.when(p >= 1 - margin, F.col("__max")).otherwise(F.col("__hi")[at])
        return F.struct(
            F.lit(i).alias("i"), low.alias("low"), high.alias("high"),
            (p * (F.col("__n") - 1)).alias("rank"),
        )

    targets = sketch.select(
        *keys, F.explode(F.array(*[target(i) for i in range(len(ps))])).alias("__t")
    ).select(*keys, F.col("__t.i").alias("__i"), F.col("__t.low").alias("__low"),
             F.col("__t.high").alias("__high"), F.col("__t.rank").alias("__rank"))

    counts = rows.withColumn("__c", F.lit(1).cast("bigint"))  # targets are a few rows: nothing is shuffled before they apply
    same_group = [counts[k].eqNullSafe(targets[k]) for k in keys]
    match = reduce(lambda a, b: a & b, same_group, F.lit(True)) & (counts["__v"] <= targets["__high"])
    joined = counts.join(targets, match).select(
        *[counts[k] for k in keys], "__i", "__v", "__c", "__low", "__rank"
    )
    # below the bracket one count per group and target remains
    place = F.when(F.col("__v") >= F.col("__low"), F.col("__v"))
    slots = joined.groupBy(*keys, "__i", "__rank", place.alias("__slot")).agg(F.sum("__c").alias("__c"))
    order = Window.partitionBy(*keys, "__i").orderBy(F.asc_nulls_first("__slot"))
    ranked = slots.withColumn("__end", F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def at(rank: Column) -> Column:
        inside = (F.col("__end") - F.col("__c") <= rank) & (rank < F.col("__end"))
        return F.max(F.when(inside, F.col("__slot")))

    below, above = F.floor("__rank"), F.ceil("__rank")
    picked = ranked.groupBy(*keys, "__i", "__rank").agg(at(below).alias("__a"), at(above).alias("__b"))
    interpolated = F.coalesce(
        F.col("__a") + (F.col("__b") - F.col("__a")) * (F.col("__rank") - F.floor("__rank")),
        F.raise_error(F.lit("percentile outside its bracket")).cast("double"),
    )
    points_found = picked.select(*keys, "__i", interpolated.alias("__p"))
    columns = [F.max(F.when(F.col("__i") == i, F.col("__p"))).alias(n) for i, n in enumerate(names)]
    return points_found.groupBy(*keys).agg(*columns)
