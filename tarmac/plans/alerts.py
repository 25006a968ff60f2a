"""Alert rules: (tables, as_of) -> one row (rule, fired, n, evidence).

Each is one aggregate over the rows of its day, so it costs a pruned scan. A rule
defined by EXISTS fires at the first matching row; the count is kept as evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.conditions import burns_over
from tarmac.functions.dates import AsOf, as_of_ts, iso_day
from tarmac.operators.aggregates import on_time_pct
from tarmac.plans.gold import passenger_risk
from tarmac.tables import Tables

# Thresholds of the rules.
CRITICAL_DELAY_MIN = 120
CHURN_MEMBERS = 5
OTP_TARGET = 75
SURGE_SCORE, SURGE_COUNT = -0.6, 10
FUEL_RATIO = 0.92


def _alert(rows: DataFrame, rule: str, n: Column, fired: Column, evidence: Column) -> DataFrame:
    return rows.agg(n.cast("bigint").alias("n"), fired.alias("hit"), evidence.alias("evidence")).select(
        F.lit(rule).alias("rule"), F.coalesce("hit", F.lit(False)).alias("fired"), "n",
        F.col("evidence").cast("string").alias("evidence"),
    )


def _text(pattern: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string(pattern, value))


def _today(t: Tables, as_of: AsOf, status: str) -> DataFrame:
    today = iso_day(as_of)
    return t.flights_between(today, today).filter(F.col("flight_status") == status)


def alert_critical_delay(t: Tables, as_of: AsOf) -> DataFrame:
    """A flight of today still scheduled and over 120 minutes late; evidence: the longest delay."""
    n = F.count(F.lit(1))
    late = _today(t, as_of, "SCHEDULED").filter(F.col("departure_delay_min") > CRITICAL_DELAY_MIN)
    return _alert(late, "CRITICAL_DELAY", n, n > 0, F.max("departure_delay_min"))


def alert_churn_spike(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """More than 5 top-tier members at CRITICAL churn risk; evidence: the miles at stake."""
    n = F.count(F.lit(1))
    members = passenger_risk(t, as_of, literal).filter(
        (F.col("churn_risk_level") == "CRITICAL") & F.col("loyalty_tier").isin("DIAMOND", "PLATINUM")
    )
    return _alert(members, "CHURN_SPIKE", n, n > CHURN_MEMBERS, F.sum("lifetime_miles"))


def alert_otp(t: Tables, as_of: AsOf) -> DataFrame:
    """Under 75 % of today's landed flights on time; evidence: the share."""
    share = on_time_pct(F.col("arrival_delay_min"))
    return _alert(
        _today(t, as_of, "LANDED"), "OTP_BELOW_TARGET", F.count(F.lit(1)), share < OTP_TARGET,
        _text("%.2f", F.round(share, 2)),
    )


def alert_sentiment(t: Tables, as_of: AsOf) -> DataFrame:
    """More than 10 feedbacks below -0.6 in the last hour; evidence: the lowest score."""
    n = F.count(F.lit(1))
    hour_ago = F.timestamp_add("HOUR", F.lit(-1), as_of_ts(as_of))
    bad = t.feedback.filter((F.col("feedback_timestamp") >= hour_ago) & (F.col("sentiment_score") < SURGE_SCORE))
    return _alert(bad, "SENTIMENT_SURGE", n, n > SURGE_COUNT, _text("%.4f", F.min("sentiment_score")))


def alert_fuel(t: Tables, as_of: AsOf) -> DataFrame:
    """A landed flight of today that burnt over 92 % of its fuel; evidence: the most burnt."""
    n = F.count(F.lit(1))
    heavy = _today(t, as_of, "LANDED").filter(
        burns_over(F.col("fuel_consumed_kg"), F.col("fuel_loaded_kg"), FUEL_RATIO)
    )
    return _alert(heavy, "FUEL_ANOMALY", n, n > 0, F.max("fuel_consumed_kg"))
