"""Risk and feature scores as native expressions (no Python worker in the plan)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.conditions import TIER_LEVEL, lookup

# Points per factor.
WEATHER_POINTS = {"NONE": 0, "MILD": 5, "MODERATE": 15, "SEVERE": 25}
CONGESTION_POINTS = {"LOW": 2, "MEDIUM": 6, "HIGH": 10}


def delay_risk(
    on_time_pct: Column,
    weather_severity: Column,
    hour: Column,
    iso_weekday: Column,
    congestion: Column,
    aircraft_age: Column,
) -> Column:
    """0..100 delay risk from six factors; a missing numeric input adds nothing."""
    zero = F.lit(0.0)
    route = F.greatest(zero, 100.0 - on_time_pct) * 0.3
    peak = hour.between(7, 9) | hour.between(17, 19)
    time_of_day = F.when(peak, 12.0).when((hour >= 21) | (hour <= 5), 3.0).otherwise(7.0)
    weekday = F.when(iso_weekday.isin(1, 5), 8.0).when(iso_weekday.isin(6, 7), 4.0).otherwise(6.0)
    age = F.least(F.lit(10.0), aircraft_age * 1.5)
    parts = [
        F.when(on_time_pct.isNotNull(), route),
        lookup(weather_severity, WEATHER_POINTS, 0).cast("double"),
        F.when(hour.isNotNull(), time_of_day),
        F.when(iso_weekday.isNotNull(), weekday),
        lookup(congestion, CONGESTION_POINTS, 5).cast("double"),
        F.when(aircraft_age.isNotNull(), age),
    ]
    total = zero
    for part in parts:
        total = total + F.coalesce(part, zero)
    return F.least(F.lit(100.0), F.greatest(zero, F.round(total, 2)))


def _clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def passenger_features(p: Mapping[str, Column]) -> dict[str, Column]:
    """Seven scores of one passenger row, keyed by feature name."""

    def known(name: str, default: float = 0.0) -> Column:
        # zero and missing are treated alike, as the scoring rule has it
        value = p[name].cast("double")
        return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)

    revenue = known("revenue_last_90d")
    engagement = F.least(F.lit(100.0), known("bookings_last_90d") * 15 + known("ytd_segments") * 2)
    recency = F.greatest(F.lit(0.0), 100 - known("days_since_last_booking", 180.0) * 0.5)
    monetary = F.least(F.lit(100.0), revenue / 50.0)
    satisfaction = _clip(
        50.0
        + F.coalesce(p["avg_sentiment"].cast("double") * 30, F.lit(0.0))
        - known("negative_feedback_count") * 10
        - known("major_delays_experienced") * 8,
        0.0,
        100.0,
    )
    churn = _clip(
        (1 - recency / 100) * 0.3
        + (1 - engagement / 100) * 0.25
        + (1 - satisfaction / 100) * 0.25
        + (1 - monetary / 100) * 0.2,
        0.0,
        1.0,
    )
    lifetime, ytd = known("lifetime_miles"), known("ytd_miles")
    years = F.greatest(F.lit(1.0), lifetime / F.greatest(F.lit(1.0), ytd))
    value = F.when(
        (lifetime != 0) & (ytd != 0), revenue * 4 * F.least(F.lit(10.0), years)
    ).otherwise(0.0)
    return {
        "tier_encoded": lookup(p["loyalty_tier"], TIER_LEVEL, 0).cast("double"),
        "engagement_score": engagement,
        "recency_score": recency,
        "monetary_score": monetary,
        "satisfaction_score": satisfaction,
        "churn_probability": churn,
        "estimated_clv": value,
    }


def feature_rows(p: Mapping[str, Column]) -> Column:
    """Array of (feature_name, feature_value); explode it for one row per feature."""
    return F.array(
        *[
            F.struct(F.lit(name).alias("feature_name"), value.alias("feature_value"))
            for name, value in passenger_features(p).items()
        ]
    )
