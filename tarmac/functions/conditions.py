"""Row rules: threshold bands, labels, flags and null guards, all native columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of the business rules, highest first.
DELAY_SEVERITY = [(180, "SEVERE"), (60, "SIGNIFICANT"), (15, "MINOR"), (0, "SLIGHT")]
DELAY_SEVERITY_BRIEF = [(180, "SEVERE"), (60, "SIGNIFICANT"), (15, "MINOR")]
FORECAST_RISK = [(45, "CRITICAL"), (25, "HIGH"), (15, "MODERATE")]
FORECAST_RISK_BRIEF = [(30, "HIGH RISK"), (15, "MODERATE")]
LEAD_TIME = [
    (60, "61+"),
    (30, "31-60_DAYS"),
    (14, "15-30_DAYS"),
    (7, "8-14_DAYS"),
    (3, "4-7_DAYS"),
    (0, "1-3_DAYS"),
]
TIER_LEVEL = {"BRONZE": 1, "SILVER": 2, "GOLD": 3, "PLATINUM": 4, "DIAMOND": 5}
CATEGORY_ACTION = {
    "WEATHER": "Predict and proactively rebook",
    "REACTIONARY": "Break the delay chain",
    "TECHNICAL": "Predictive maintenance",
    "ATC": "Optimize slot management",
}
CONGESTION = {"LHR": "HIGH", "JFK": "HIGH", "CDG": "MEDIUM", "FRA": "MEDIUM", "AMS": "MEDIUM"}


def band(value: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first step whose threshold ``value`` exceeds, else ``default``."""
    labels = [F.when(value > threshold, F.lit(label)) for threshold, label in steps]
    return F.coalesce(*labels, F.lit(default))


def lookup(code: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Simple CASE: map a code to a constant, anything else (or null) to ``default``."""
    hits = [F.when(code == key, F.lit(value)) for key, value in mapping.items()]
    return F.coalesce(*hits, F.lit(default))


def delay_severity(delay: Column) -> Column:
    return band(delay, DELAY_SEVERITY, "ON_TIME")


def lead_time_category(days: Column) -> Column:
    return F.when(days.isNotNull(), band(days, LEAD_TIME, "SAME_DAY"))


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0.3, "POSITIVE").when(score < -0.3, "NEGATIVE").otherwise("NEUTRAL")


def feedback_priority(score: Column) -> Column:
    """Band downwards by negating; a missing score is LOW."""
    return band(-score, [(0.7, "CRITICAL"), (0.5, "HIGH"), (0.3, "MEDIUM")], "LOW")


def action_required(score: Column, nps: Column) -> Column:
    return F.coalesce(score < -0.5, F.lit(False)) | F.coalesce(nps <= 3, F.lit(False))


def burns_over(consumed: Column, loaded: Column, ratio: float) -> Column:
    return consumed > loaded * F.lit(ratio)


def anomaly_rules(f: Mapping[str, Column]) -> dict[str, Column]:
    """The five operational rules by name, in order of precedence for the type."""
    return {
        "delay": f["departure_delay_min"] > 120,
        "taxi": f["taxi_out_min"] > 45,
        "fuel": burns_over(f["fuel_consumed_kg"], f["fuel_loaded_kg"], 0.95),
        "underbooked": f["load_factor_pct"] < 30,
        "overbooked": f["pax_booked"] > f["seat_capacity"],
    }


def anomaly_type(f: Mapping[str, Column]) -> Column:
    rule = anomaly_rules(f)
    return (
        F.when(rule["delay"] & (f["flight_status"] == "SCHEDULED"), "EXTENDED_GROUND_DELAY")
        .when(rule["taxi"], "EXCESSIVE_TAXI")
        .when(rule["fuel"], "HIGH_FUEL_BURN")
        .when(rule["underbooked"], "SEVERELY_UNDERBOOKED")
        .when(rule["overbooked"], "OVERBOOKED")
        .otherwise("NORMAL")
    )


def anomaly_severity(f: Mapping[str, Column]) -> Column:
    rule = anomaly_rules(f)
    return (
        F.when((f["departure_delay_min"] > 180) | rule["fuel"], "CRITICAL")
        .when(rule["delay"] | rule["taxi"], "HIGH")
        .when(rule["underbooked"] | rule["overbooked"], "MEDIUM")
        .otherwise("LOW")
    )


def any_anomaly(f: Mapping[str, Column]) -> Column:
    flag = F.lit(False)
    for condition in anomaly_rules(f).values():
        flag = flag | condition
    return flag


def delay_attribution(delay: Column, severity: Column) -> Column:
    weather = (delay > 30) & severity.isin("MODERATE", "SEVERE")
    return F.when(weather, "WEATHER_CORRELATED").otherwise("OTHER_CAUSE")


def late_departure(status: Column, scheduled: Column, now: Column) -> Column:
    return F.coalesce((status == "SCHEDULED") & (scheduled < now), F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null, not an error, on a zero divisor (ANSI mode is on)."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent_change(actual: Column, expected: Column) -> Column:
    return ratio(actual - expected, expected) * 100
