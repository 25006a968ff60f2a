"""A hand-made airline: a few rows per table on the published reference tables."""

from datetime import date

from pyspark.sql import functions as F

from tarmac.sources import reference
from tarmac.sources.derived import calendar_dim
from tarmac.tables import Tables

AS_OF = "2026-06-15"
NOW = "2026-06-15 12:00:00"


def sql(spark, columns, rows):
    body = ", ".join(rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def flights(spark, rows):
    """(key, date key, status, departure delay, arrival delay, consumed of 1000 kg fuel) with fixed other columns."""
    base = spark.createDataFrame(
        rows, "flight_event_key long, flight_date_key int, flight_status string, departure_delay_min int, "
        "arrival_delay_min int, fuel_consumed_kg int")
    day = F.to_date(F.col("flight_date_key").cast("string"), "yyyyMMdd").cast("timestamp_ntz")
    hour = (F.col("flight_event_key") % 20).cast("int")
    return base.select(
        "*", F.concat(F.lit("SP"), F.lpad(F.col("flight_event_key").cast("string"), 4, "0")).alias("flight_number"),
        F.lit(1).alias("origin_airport_key"), F.lit(5).alias("dest_airport_key"), F.lit(10).alias("aircraft_key"),
        F.lit(1).alias("route_key"), F.timestamp_add("HOUR", hour, day).cast("timestamp_ntz").alias("scheduled_departure"),
        F.timestamp_add("HOUR", hour + 8, day).cast("timestamp_ntz").alias("scheduled_arrival"),
        F.lit(None).cast("timestamp_ntz").alias("actual_departure"), F.lit(None).cast("timestamp_ntz").alias("actual_arrival"),
        F.lit(20).alias("taxi_out_min"), F.lit(300).alias("pax_booked"), F.lit(290).alias("pax_flown"),
        F.lit(315).alias("seat_capacity"), F.lit(92.0).alias("load_factor_pct"), F.lit(1000.0).alias("revenue_total"),
        F.lit(3.0).alias("revenue_per_pax"), F.lit(1000).alias("fuel_loaded_kg"), F.lit(3.1).alias("fuel_efficiency_l_per_100km"),
        F.lit(5600).alias("distance_flown_km"),
    )


def passengers(spark):
    rows = spark.createDataFrame(
        [(1, "P1", "Ann", "Lee", "DIAMOND", True), (2, "P2", "Bob", "Ray", "GOLD", True), (3, "P3", "Cy", "Fox", "NONE", True),
         (4, "P1", "Ann", "Lee", "GOLD", False)],
        "passenger_key long, passenger_id string, first_name string, last_name string, loyalty_tier string, is_current boolean")
    return rows.select("*", F.lit(100).cast("bigint").alias("lifetime_miles"), F.lit(10).alias("ytd_miles"), F.lit(2).alias("ytd_segments"))


def airline(spark, flight_rows=(), bookings=(), feedback=(), **other):
    return Tables(
        date=calendar_dim(spark, date(2025, 1, 1), date(2026, 12, 31)),
        airport=reference.airports(spark), aircraft=reference.aircraft(spark), route=reference.routes(spark),
        passenger=passengers(spark),
        flight=flights(spark, list(flight_rows)),
        booking=spark.createDataFrame(
            list(bookings), "booking_key long, passenger_key long, flight_event_key long, booking_date_key int, "
            "flight_date_key int, total_amount double, ancillary_revenue double, days_before_departure int"),
        feedback=spark.createDataFrame(
            list(feedback), "feedback_key long, passenger_key long, flight_event_key long, feedback_timestamp string, "
            "sentiment_score double, nps_score int").select(
                "*", F.col("feedback_timestamp").cast("timestamp_ntz").alias("at"), F.lit(3).alias("overall_rating"),
                F.when(F.col("sentiment_score") < -0.3, "NEGATIVE").otherwise("NEUTRAL").alias("sentiment_label"),
                F.when(F.col("sentiment_score") < -0.7, "CRITICAL").otherwise("LOW").alias("ai_priority"),
                F.lit("Rude staff.").alias("feedback_text"), F.lit("EMAIL").alias("feedback_channel"), F.lit(1).alias("route_key"),
            ).drop("feedback_timestamp").withColumnRenamed("at", "feedback_timestamp"),
        **other,
    )
