"""Data quality checks: keys, value domains, consistency between columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed values of the coded columns.
FLIGHT_STATUS = ("SCHEDULED", "DEPARTED", "AIRBORNE", "LANDED", "CANCELLED", "DIVERTED")
BOOKING_STATUS = ("CONFIRMED", "CANCELLED", "NO_SHOW", "CHECKED_IN", "BOARDED", "FLOWN")
BOOKING_CHANNEL = ("WEB", "MOBILE", "CALL_CENTER", "TRAVEL_AGENT", "CORPORATE")
FEEDBACK_CHANNEL = ("NPS_SURVEY", "SOCIAL_MEDIA", "IN_APP", "EMAIL", "CALL_CENTER")
PRIORITY = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
RANGES = {"nps_score": (0, 10), "overall_rating": (1, 5), "sentiment_score": (-1.0, 1.0)}


def key_checks(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Counts of duplicated keys, surplus rows and nulls, as (check_name, violations)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = per_key.filter("n > 1").agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows")
    )
    required = list(dict.fromkeys([*keys, *not_null]))
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])
    return _long(repeated).unionByName(_long(nulls))


def _long(one_row: DataFrame) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("violations"))
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows break each rule (a null makes a rule unknown, not broken); one pass."""
    return _long(df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()]))


def domain_rules(allowed: Mapping[str, Sequence], ranges: Mapping[str, tuple]) -> dict[str, Column]:
    rules = {f"{c}_allowed": F.col(c).isin(*values) for c, values in allowed.items()}
    rules |= {f"{c}_range": F.col(c).between(low, high) for c, (low, high) in ranges.items()}
    return rules


def domain_checks(df: DataFrame, allowed: Mapping[str, Sequence], ranges: Mapping[str, tuple]) -> DataFrame:
    return rule_counts(df, domain_rules(allowed, ranges))


def total_is_sum(total: str, parts: Sequence[str], tolerance: float = 0.005) -> Column:
    added = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return F.abs(F.col(total) - added) <= tolerance


def load_factor_agrees(tolerance: float = 1.0) -> Column:
    implied = F.col("pax_flown") * 100.0 / F.nullif(F.col("seat_capacity"), F.lit(0))
    return F.abs(F.col("load_factor_pct") - implied) <= tolerance
