"""Daily anomalies: train on one window, score the next, report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.conditions import percent_change
from tarmac.functions.dates import AsOf, iso_day
from tarmac.operators.ordering import top_k, union_all
from tarmac.plans.forecasting import score_series
from tarmac.tables import Tables

TRAIN_DAYS, SCORE_DAYS = 90, 15
DELAY_INTERVAL, FUEL_INTERVAL = 0.99, 0.95
NOISE = 1e-9


def _windows(t: Tables, as_of: AsOf) -> tuple[DataFrame, DataFrame]:
    """Flights of as_of-90..as_of-15, and those later than as_of-15."""
    train = t.flights_between(iso_day(as_of, -TRAIN_DAYS), iso_day(as_of, -SCORE_DAYS))
    return train, t.flights_between(iso_day(as_of, 1 - SCORE_DAYS))


def _daily(
    t: Tables, flights: DataFrame, key: str, names: DataFrame, value: Column
) -> DataFrame:
    daily = flights.groupBy(key, "flight_date_key").agg(value.alias("y"))
    return (
        daily.join(names, key)
        .join(t.flight_dates([F.col("full_date").alias("ds")]), "flight_date_key")
        .select("series", "ds", "y")
    )


def delay_windows(t: Tables, as_of: AsOf) -> tuple[DataFrame, DataFrame]:
    """Mean departure delay by origin airport and day, for training and scoring."""
    names = t.airport.select(F.col("airport_key").alias("origin_airport_key"), F.col("iata_code").alias("series"))
    value = F.avg("departure_delay_min")
    train, score = (_daily(t, w, "origin_airport_key", names, value) for w in _windows(t, as_of))
    return train, score


def fuel_windows(t: Tables, as_of: AsOf) -> tuple[DataFrame, DataFrame]:
    """Mean fuel efficiency by aircraft and day, for training and scoring."""
    names = t.aircraft.select("aircraft_key", F.col("registration").alias("series"))
    flown = (F.col("fuel_consumed_kg") > 0) & (F.col("distance_flown_km") > 0)
    value = F.avg("fuel_efficiency_l_per_100km")
    train, score = (_daily(t, w.filter(flown), "aircraft_key", names, value) for w in _windows(t, as_of))
    return train, score


def detect_anomalies(train: DataFrame, score: DataFrame, as_of: AsOf, interval: float) -> DataFrame:
    """Scored days with forecast, bounds and whether they fall outside."""
    scored = score_series(train, score, iso_day(as_of, -SCORE_DAYS), interval)
    # a series fitted exactly has no spread: rounding noise must not count as a deviation
    outside = F.abs(F.col("y") - F.col("forecast")) > F.col("upper_bound") - F.col("forecast") + NOISE
    return scored.withColumn("is_anomaly", outside)


def _largest(found: DataFrame, k: int) -> DataFrame:
    gap = F.abs(F.col("y") - F.col("forecast"))
    return top_k(found.filter("is_anomaly"), [F.desc(F.round(gap, 6))], ["series", "ts"], k)


def delay_anomaly_report(found: DataFrame, k: int = 20) -> DataFrame:
    gap = F.col("y") - F.col("forecast")
    kind = (
        F.when(gap > 30, "SEVERE_ABOVE_NORMAL")
        .when(gap > 15, "ABOVE_NORMAL")
        .when(gap < -15, "BELOW_NORMAL")
        .otherwise("WITHIN_RANGE")
    )
    return _largest(found, k).select(
        F.col("series").alias("airport_code"), F.col("ts").alias("anomaly_date"),
        F.col("y").alias("actual_avg_delay"), F.col("forecast").alias("expected_delay"),
        F.round(gap, 1).alias("deviation_minutes"), "is_anomaly", kind.alias("anomaly_type"),
    )


def fuel_anomaly_report(found: DataFrame, k: int = 15) -> DataFrame:
    y, expected = F.col("y"), F.col("forecast")
    advice = (
        F.when(y > expected * 1.15, "HIGH_BURN - Check engine")
        .when(y < expected * 0.85, "LOW_BURN - Verify sensor")
        .otherwise("MARGINAL")
    )
    return _largest(found, k).select(
        F.col("series").alias("aircraft_reg"), F.col("ts").alias("anomaly_date"),
        F.round(y, 2).alias("actual_fuel_eff"), F.round(expected, 2).alias("expected_fuel_eff"),
        F.round(percent_change(y, expected), 1).alias("pct_deviation"),
        "is_anomaly", advice.alias("maintenance_recommendation"),
    )


def anomalies_of(found: Mapping[str, DataFrame]) -> DataFrame:
    """The anomalies of several domains under one another."""

    def part(rows: DataFrame) -> DataFrame:
        return rows.filter("is_anomaly").select(
            F.col("series").alias("entity"), F.col("ts").alias("detected_at"),
            F.col("y").alias("actual_value"), F.col("forecast").alias("expected_value"), "is_anomaly",
        )

    return union_all({domain: part(rows) for domain, rows in found.items()})


def all_anomalies(delay: DataFrame, fuel: DataFrame) -> DataFrame:
    return anomalies_of({"DELAY": delay, "FUEL": fuel})
