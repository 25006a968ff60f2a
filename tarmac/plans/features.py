"""Training sets and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.conditions import TIER_LEVEL, lookup, ratio
from tarmac.functions.dates import AsOf, as_of_date, as_of_ts, iso_day, key_to_date
from tarmac.functions.scoring import feature_rows
from tarmac.operators.fanout import Branch, FanOut
from tarmac.operators.joins import Dim, current_rows, hour_bucket_join, star_join
from tarmac.plans.gold import MAJOR_DELAY, booking_count, booking_experience, columns_of
from tarmac.sources.sinks import table_sink
from tarmac.tables import Tables, dated_between

CHURN_DAYS, NEVER_ACTIVE = 60, 999


def churn_training(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """One labelled row per current passenger.

    ``literal`` weights sums and counts by the booking x feedback join and keeps
    the surrogate key and the column the label is made of; without it both go.
    """
    bookings = Branch("booking", booking_experience(t), {
        "ids": booking_count(t),
        "amount": F.sum("total_amount"), "amounts": F.count("total_amount"),
        "lead_sum": F.sum("days_before_departure"), "leads": F.count("days_before_departure"),
        "delay_sum": F.sum("arrival_delay_min"), "delays": F.count("arrival_delay_min"),
        "major": F.count_if(F.col("arrival_delay_min") > MAJOR_DELAY),
        "last_flight": F.max(key_to_date(F.col("flight_date_key"))),
    }, key="passenger_key")
    opinions = Branch("feedback", t.feedback, {
        "score_sum": F.sum("sentiment_score"), "scores": F.count("sentiment_score"),
        "nps_sum": F.sum("nps_score"), "npss": F.count("nps_score"),
        "negative": F.count_if(F.col("sentiment_label") == "NEGATIVE"),
    }, key="passenger_key")
    f = FanOut(current_rows(t.passenger), "passenger_key", [bookings, opinions], literal)

    def mean(total: str, filled: str, default: float) -> Column:
        return F.coalesce(ratio(F.col(total), F.col(filled)), F.lit(default))

    def counted(name: str, branch: str) -> Column:
        return (F.coalesce(F.col(name), F.lit(0)) * f.weight(branch)).cast("decimal(38,0)")

    idle = F.datediff(as_of_date(as_of), F.col("last_flight"))
    churned = F.coalesce(idle, F.lit(NEVER_ACTIVE)) > CHURN_DAYS
    out = f.rows.select(
        "passenger_key",
        lookup(F.col("loyalty_tier"), TIER_LEVEL, 0).alias("tier_level"),
        "lifetime_miles", "ytd_miles", "ytd_segments",
        F.coalesce("ids", F.lit(0)).alias("total_bookings"),
        F.coalesce(F.col("amount") * f.weight("booking"), F.lit(0.0)).alias("total_revenue"),
        mean("amount", "amounts", 0.0).alias("avg_booking_value"),
        mean("lead_sum", "leads", 30.0).alias("avg_advance_purchase"),
        mean("delay_sum", "delays", 0.0).alias("avg_delay_experienced"),
        counted("major", "booking").alias("major_delays"),
        mean("score_sum", "scores", 0.0).alias("avg_sentiment"),
        mean("nps_sum", "npss", 5.0).alias("avg_nps"),
        counted("negative", "feedback").alias("negative_feedbacks"),
        idle.alias("days_since_last_activity"),
        F.when(churned, "CHURNED").otherwise("ACTIVE").alias("churn_label"),
    )
    return out if literal else out.drop("passenger_key", "days_since_last_activity")


def cancel_training(t: Tables) -> DataFrame:
    """One labelled row per flight with calendar, route, aircraft, load and weather."""
    dated = t.flight.join(t.flight_dates(["day_of_week", "month_number", "is_weekend"]), "flight_date_key")
    wide = star_join(dated, [
        Dim(t.route, "route_key", "route_key", {"route_type": "route_type", "distance_km": "distance_km"}),
        Dim(t.aircraft, "aircraft_key", "aircraft_key",
            {"aircraft_age_years": "aircraft_age_years", "widebody": "is_widebody"}),
        Dim(t.airport, "airport_key", "origin_airport_key", {"origin_iata": "iata_code"}),
    ])
    wide = hour_bucket_join(
        wide, t.weather, "origin_iata", "scheduled_departure", "airport_iata", "observation_time",
        ["wind_speed_kts", "visibility_km", "precipitation_mm", F.col("weather_condition").alias("sky"),
         "severity", "is_deicing_required"],
    )
    return wide.select(
        "flight_event_key", "day_of_week", "month_number",
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.hour("scheduled_departure").alias("departure_hour"),
        "route_type", "distance_km", "aircraft_age_years",
        F.col("widebody").cast("int").alias("is_widebody"),
        "pax_booked", "seat_capacity", "load_factor_pct",
        F.coalesce("wind_speed_kts", F.lit(0.0)).alias("wind_speed"),
        F.coalesce("visibility_km", F.lit(10.0)).alias("visibility"),
        F.coalesce("precipitation_mm", F.lit(0.0)).alias("precipitation"),
        F.coalesce("sky", F.lit("CLEAR")).alias("weather_condition"),
        F.coalesce("severity", F.lit("NONE")).alias("weather_severity"),
        F.coalesce(F.col("is_deicing_required").cast("int"), F.lit(0)).alias("deicing_required"),
        F.when(F.col("flight_status") == "CANCELLED", "CANCELLED").otherwise("OPERATED").alias("cancellation_label"),
    )


def passenger_features(t: Tables, as_of: AsOf) -> DataFrame:
    """Booking (90 days), delay (180) and feedback (180) features per current passenger.

    Each source is reduced to one row per passenger before the joins, and its date
    window is a constant on the date key, so it reaches the scan.
    """
    recent = dated_between(t.booking, "flight_date_key", iso_day(as_of, -90), None)
    booked = recent.groupBy("passenger_key").agg(
        F.count("booking_key").alias("bookings_90d"),
        F.sum("total_amount").alias("revenue_90d"),
        F.avg("total_amount").alias("avg_booking_value"),
        F.sum("ancillary_revenue").alias("ancillary_90d"),
        F.max(key_to_date(F.col("flight_date_key"))).alias("last_booking_date"),
    )
    flown = t.flights_between(iso_day(as_of, -180)).select(
        "flight_event_key", "arrival_delay_min", "load_factor_pct"
    )
    felt = (
        t.booking.select("passenger_key", "flight_event_key")
        .join(flown, "flight_event_key")
        .groupBy("passenger_key")
        .agg(
            F.avg("arrival_delay_min").alias("avg_delay_experienced"),
            F.count_if(F.col("arrival_delay_min") > MAJOR_DELAY).alias("major_delays_180d"),
            F.avg("load_factor_pct").alias("avg_load_factor"),
        )
    )
    since = as_of_ts(iso_day(as_of, -180))
    said = (
        t.feedback.filter(F.col("feedback_timestamp") >= since)
        .groupBy("passenger_key")
        .agg(
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.count_if(F.col("sentiment_label") == "NEGATIVE").alias("negative_count"),
            F.avg("nps_score").alias("avg_nps"),
        )
    )
    members = current_rows(t.passenger).select(
        "passenger_key", "passenger_id", "loyalty_tier", "lifetime_miles", "ytd_miles", "ytd_segments"
    )
    return (
        members.join(booked, "passenger_key", "left")
        .join(felt, "passenger_key", "left")
        .join(said, "passenger_key", "left")
    )


def passenger_feature_rows(risk: DataFrame) -> DataFrame:
    """Seven (feature_name, feature_value) rows per row of the passenger risk table."""
    named = risk.withColumnRenamed("avg_sentiment_90d", "avg_sentiment")
    return named.select("passenger_key", F.inline(feature_rows(columns_of(named))))


def feature_procedure(t: Tables, as_of: AsOf, path: str) -> int:
    """Build the feature table, save it, return how many rows the saved table has."""
    return table_sink(passenger_features(t, as_of), path).count()
