"""Daily series, their forecast and its reports.

The model is a linear trend plus a mean residual per weekday; bounds are the
forecast plus or minus z times the standard deviation of what is left. It is
fitted with window aggregates over rows already reduced to one a day and series:
one shuffle by series, no loop over series and no Python worker.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.functions.conditions import FORECAST_RISK, FORECAST_RISK_BRIEF, band, ratio
from tarmac.functions.dates import AsOf, as_of_date, iso_day
from tarmac.operators.windows import running_total
from tarmac.tables import Tables

HISTORY_DAYS = 90
# Seats assumed by haul, and the share of them that counts as full.
WIDEBODY_SEATS, NARROWBODY_SEATS, FULL_SHARE = 315, 180, 0.95
LONG_HAUL = ("LONG_HAUL", "ULTRA_LONG_HAUL")


def _daily_by_route(t: Tables, flights: DataFrame, value: Column) -> DataFrame:
    """Aggregate on the keys first; names join afterwards, one row a day and route."""
    daily = flights.groupBy("route_key", "flight_date_key").agg(value.cast("double").alias("y"))
    return (
        daily.join(t.route.select("route_key", F.col("route_code").alias("series")), "route_key")
        .join(t.flight_dates([F.col("full_date").alias("ds")]), "flight_date_key")
        .select("series", "ds", "y")
    )


def delay_series(t: Tables, as_of: AsOf) -> DataFrame:
    """Mean arrival delay of landed flights by route and day."""
    landed = t.flights_between(iso_day(as_of, -HISTORY_DAYS)).filter(F.col("flight_status") == "LANDED")
    return _daily_by_route(t, landed, F.avg("arrival_delay_min"))


def demand_series(t: Tables, as_of: AsOf) -> DataFrame:
    """Booked passengers by route and day."""
    return _daily_by_route(t, t.flights_between(iso_day(as_of, -HISTORY_DAYS)), F.sum("pax_booked"))


def revenue_series(t: Tables, as_of: AsOf) -> DataFrame:
    """Revenue by day, as a single series."""
    earning = t.flights_between(iso_day(as_of, -HISTORY_DAYS)).filter(F.col("revenue_total") > 0)
    daily = earning.groupBy("flight_date_key").agg(F.sum("revenue_total").cast("double").alias("y"))
    dated = daily.join(t.flight_dates([F.col("full_date").alias("ds")]), "flight_date_key")
    return dated.filter(F.col("y") > 0).select(F.lit("ALL").alias("series"), "ds", "y")


def fit_series(daily: DataFrame, origin: AsOf) -> DataFrame:
    """One row of parameters per series: trend at ``origin``, weekday means, spread."""
    x = F.datediff("ds", as_of_date(origin)).cast("double")
    whole = Window.partitionBy("series")
    weekday = Window.partitionBy("series", "dow")
    points = daily.filter(F.col("y").isNotNull()).select("series", "y", x.alias("x"), F.weekday("ds").alias("dow"))
    trend = points.withColumns(
        {
            # a single day has no slope: a level line through it
            "slope": F.coalesce(F.regr_slope("y", "x").over(whole), F.lit(0.0)),
            "level": F.coalesce(F.regr_intercept("y", "x").over(whole), F.avg("y").over(whole)),
        }
    ).withColumn("rest", F.col("y") - (F.col("level") + F.col("slope") * F.col("x")))
    seasonal = trend.withColumn("season", F.avg("rest").over(weekday))
    return seasonal.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("slope").alias("slope"),
        F.max("level").alias("level"),
        F.coalesce(F.stddev_samp(F.col("rest") - F.col("season")), F.lit(0.0)).alias("sigma"),
        F.array(*[
            F.coalesce(F.max(F.when(F.col("dow") == d, F.col("season"))), F.lit(0.0)) for d in range(7)
        ]).alias("seasons"),
    )


def _expected(day: Column, origin: AsOf) -> Column:
    x = F.datediff(day, as_of_date(origin)).cast("double")
    return F.col("level") + F.col("slope") * x + F.element_at("seasons", F.weekday(day) + 1)


def z_value(interval: float) -> float:
    return NormalDist().inv_cdf((1 + interval) / 2)


def _with_bounds(df: DataFrame, interval: float) -> DataFrame:
    reach = F.lit(z_value(interval)) * F.col("sigma")
    return df.withColumns(
        {"lower_bound": F.col("forecast") - reach, "upper_bound": F.col("forecast") + reach}
    )


def forecast(daily: DataFrame, origin: AsOf, horizon: int, interval: float) -> DataFrame:
    """(series, ts, forecast, lower_bound, upper_bound) for the ``horizon`` days after ``origin``."""
    days = F.sequence(F.lit(1), F.lit(horizon))
    ahead = fit_series(daily, origin).withColumn("step", F.explode(days))
    dated = ahead.withColumn("ts", F.date_add(as_of_date(origin), F.col("step")))
    out = _with_bounds(dated.withColumn("forecast", _expected(F.col("ts"), origin)), interval)
    return out.select("series", "ts", "forecast", "lower_bound", "upper_bound")


def score_series(train: DataFrame, score: DataFrame, origin: AsOf, interval: float) -> DataFrame:
    """Actual rows beside the forecast of the fit on ``train`` (series unknown to it drop out)."""
    joined = score.join(fit_series(train, origin), "series")
    out = _with_bounds(joined.withColumn("forecast", _expected(F.col("ds"), origin)), interval)
    return out.select("series", F.col("ds").alias("ts"), "y", "forecast", "lower_bound", "upper_bound")


def forecast_metrics(daily: DataFrame, origin: AsOf, horizon: int, interval: float) -> DataFrame:
    """Errors on the last ``horizon`` days, held out of the fit."""
    cut = F.date_sub(as_of_date(origin), horizon)
    scored = score_series(
        daily.filter(F.col("ds") <= cut), daily.filter(F.col("ds") > cut), iso_day(origin, -horizon), interval
    )
    error = F.col("y") - F.col("forecast")
    inside = F.col("y").between(F.col("lower_bound"), F.col("upper_bound"))
    return scored.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(ratio(error, F.col("y")))) * 100).alias("mape"),
        (F.count_if(inside) * 100.0 / F.count(F.lit(1))).alias("coverage_pct"),
    )


def _next_week(forecasts: DataFrame, as_of: AsOf) -> DataFrame:
    return forecasts.filter(F.col("ts").between(as_of_date(as_of), F.date_add(as_of_date(as_of), 7)))


def delay_outlook(forecasts: DataFrame, as_of: AsOf) -> DataFrame:
    """Forecast delays of the next 7 days, banded two ways."""
    return _next_week(forecasts, as_of).select(
        F.col("series").alias("route_code"), F.col("ts").alias("forecast_date"),
        F.round("forecast", 1).alias("predicted_delay"), F.round("upper_bound", 1).alias("worst_case_delay"),
        band(F.col("forecast"), FORECAST_RISK, "LOW").alias("risk_level"),
        band(F.col("forecast"), FORECAST_RISK_BRIEF, "LOW").alias("risk_level_brief"),
    )


def capacity_risk(forecasts: DataFrame, routes: DataFrame, as_of: AsOf) -> DataFrame:
    """Forecast passengers against the seats of the haul type."""
    seats = F.when(F.col("route_type").isin(*LONG_HAUL), WIDEBODY_SEATS).otherwise(NARROWBODY_SEATS)
    named = _next_week(forecasts, as_of).join(
        routes.select(F.col("route_code").alias("series"), "flight_time_mins", "route_type"), "series"
    )
    full = F.col("forecast") > seats * FULL_SHARE
    return named.select(
        F.col("series").alias("route_code"), F.col("ts").alias("forecast_date"),
        F.round("forecast").alias("predicted_passengers"), "flight_time_mins",
        seats.alias("aircraft_capacity"),
        F.round(F.col("forecast") / seats * 100, 1).alias("predicted_load_factor"),
        F.when(full, "CAPACITY_RISK").otherwise("OK").alias("capacity_alert"),
    )


def revenue_outlook(forecasts: DataFrame) -> DataFrame:
    """Daily revenue forecast with its running total (one row a day, so one task)."""
    daily = forecasts.select(
        F.col("ts").alias("forecast_date"), F.round("forecast", 2).alias("predicted_daily_revenue"),
        F.round("lower_bound", 2).alias("revenue_lower"), F.round("upper_bound", 2).alias("revenue_upper"),
    )
    return running_total(daily, "forecast_date", "predicted_daily_revenue", "cumulative_revenue")
