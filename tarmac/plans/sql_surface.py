"""The same scores as SQL functions, for users who write SQL.

Spark SQL functions are inlined into the caller's plan, so they run as native
expressions like the DataFrame forms.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tarmac.functions.conditions import TIER_LEVEL
from tarmac.functions.scoring import CONGESTION_POINTS, WEATHER_POINTS


def _points(column: str, points: dict[str, int], default: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {value}D" for name, value in points.items())
    return f"CASE {column} {cases} ELSE {default}D END"


DELAY_RISK_SQL = f"""
CREATE OR REPLACE TEMPORARY FUNCTION delay_risk(
    on_time_pct DOUBLE, weather_severity STRING, hour INT, iso_weekday INT, congestion STRING, age DOUBLE
) RETURNS DOUBLE
RETURN least(100D, greatest(0D, round(
    coalesce(greatest(0D, 100D - on_time_pct) * 0.3D, 0D) * CASE WHEN on_time_pct IS NULL THEN 0D ELSE 1D END
    + {_points("weather_severity", WEATHER_POINTS, 0)}
    + CASE WHEN hour IS NULL THEN 0D WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 THEN 12D
           WHEN hour >= 21 OR hour <= 5 THEN 3D ELSE 7D END
    + CASE WHEN iso_weekday IS NULL THEN 0D WHEN iso_weekday IN (1, 5) THEN 8D
           WHEN iso_weekday IN (6, 7) THEN 4D ELSE 6D END
    + {_points("congestion", CONGESTION_POINTS, 5)}
    + CASE WHEN age IS NULL THEN 0D ELSE least(10D, age * 1.5D) END, 2)))
"""


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(DELAY_RISK_SQL)


def _known(name: str, default: float = 0.0) -> str:
    """Zero and missing are treated alike, as the scoring rule has it."""
    return f"coalesce(nullif(CAST({name} AS DOUBLE), 0D), {default}D)"


def _limited(value: str, low: float, high: float) -> str:
    return f"greatest({low}D, least({high}D, {value}))"


_ENGAGEMENT = f"least(100D, {_known('bookings')} * 15D + {_known('segments')} * 2D)"
_RECENCY = f"greatest(0D, 100D - {_known('days', 180.0)} * 0.5D)"
_MONETARY = f"least(100D, {_known('revenue')} / 50D)"
_SATISFACTION = _limited(
    f"50D + coalesce(sentiment * 30D, 0D) - {_known('negative')} * 10D - {_known('major')} * 8D", 0.0, 100.0
)
FEATURES_SQL = {
    "tier_encoded": "CASE tier " + " ".join(f"WHEN '{t}' THEN {n}D" for t, n in TIER_LEVEL.items()) + " ELSE 0D END",
    "engagement_score": _ENGAGEMENT,
    "recency_score": _RECENCY,
    "monetary_score": _MONETARY,
    "satisfaction_score": _SATISFACTION,
    "churn_probability": _limited(
        f"(1D - {_RECENCY} / 100D) * 0.3D + (1D - {_ENGAGEMENT} / 100D) * 0.25D"
        f" + (1D - {_SATISFACTION} / 100D) * 0.25D + (1D - {_MONETARY} / 100D) * 0.2D", 0.0, 1.0
    ),
    "estimated_clv": f"CASE WHEN {_known('lifetime')} <> 0D AND {_known('ytd')} <> 0D THEN {_known('revenue')} * 4D"
    f" * least(10D, greatest(1D, {_known('lifetime')} / greatest(1D, {_known('ytd')}))) ELSE 0D END",
}
# The table form: SELECT ..., passenger_features(...) AS features, then LATERAL VIEW inline(features). The body is
# inlined into the caller's plan. (As RETURNS TABLE the optimiser refuses it: correlated columns in a generator.)
PASSENGER_FEATURES_SQL = f"""
CREATE OR REPLACE TEMPORARY FUNCTION passenger_features(
    tier STRING, bookings DOUBLE, segments DOUBLE, days DOUBLE, revenue DOUBLE, sentiment DOUBLE, negative DOUBLE,
    major DOUBLE, lifetime DOUBLE, ytd DOUBLE
) RETURNS ARRAY<STRUCT<feature_name: STRING, feature_value: DOUBLE>>
RETURN array({", ".join(
    f"named_struct('feature_name', '{name}', 'feature_value', {value})" for name, value in FEATURES_SQL.items())})
"""


def register_table_functions(spark: SparkSession) -> None:
    spark.sql(PASSENGER_FEATURES_SQL)
