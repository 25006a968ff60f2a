"""Registered queries: governance, series and models, features, text, quality."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import masks, text
from tarmac.functions.conditions import sentiment_label
from tarmac.functions.scoring import delay_risk as delay_risk_score
from tarmac.operators import governance, quality
from tarmac.operators.ordering import union_all
from tarmac.operators.history import History
from tarmac.operators.snapshot import as_of_snapshot as snapshot_at
from tarmac.operators.snapshot import restore_snapshot as restore_at
from tarmac.plans import anomalies, classify, features, forecasting, gold, prompts, semantic
from tarmac.plans.sql_surface import register_sql_functions
from tarmac.registry.base import query
from tarmac.registry.binding import AS_OF, NOW, bind, driver
from tarmac.registry.core import values_sql
from tarmac.registry.oracle import TODAY, oracle
from tarmac.registry.reports import CONTEXT_SQL, OTP_SQL, RISK_POINTS, risk_sql
from tarmac.session import scratch_path
from tarmac.sources import reference

# ---------------------------------------------------------------- L. governance


def _per_role(spark: SparkSession, sf: str, column: str, mask) -> DataFrame:
    people = bind(spark, sf).passenger
    return people.select(
        "passenger_key", *[mask(F.col(column), role).alias(role.lower()) for role in ("ADMIN", "ANALYST", "GUEST")]
    )


@query("mask_email", oracle("passenger_key:i admin:s analyst:s guest:s", """
    SELECT passenger_key, email AS admin, left(email, 2) || '***' || substr(email, instr(email, '@')) AS analyst,
      '***MASKED***' AS guest FROM passenger"""))
def mask_email(spark: SparkSession, sf: str) -> DataFrame:
    return _per_role(spark, sf, "email", masks.mask_email)


@query("mask_phone", oracle("passenger_key:i admin:s analyst:s guest:s", """
    SELECT passenger_key, phone AS admin, left(phone, 4) || '****' || right(phone, 4) AS analyst,
      left(phone, 4) || '****' || right(phone, 4) AS guest FROM passenger"""))
def mask_phone(spark: SparkSession, sf: str) -> DataFrame:
    return _per_role(spark, sf, "phone", masks.mask_phone)


@query("mask_name", oracle("passenger_key:i admin:s analyst:s guest:s", """
    SELECT passenger_key, last_name AS admin, 'L****' AS analyst, '***' AS guest FROM passenger"""))
def mask_name(spark: SparkSession, sf: str) -> DataFrame:
    return _per_role(spark, sf, "last_name", masks.mask_name)


DRIVER_REGION = ("NATION_0", "NATION_1", "NATION_2", "NATION_3")


@query("row_access", oracle("role:s visible:i", """
    SELECT 'ADMIN' AS role, count(*) AS visible FROM passenger
    UNION ALL SELECT 'ANALYST', count(*) FILTER (WHERE home_airport IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3')) FROM passenger
    UNION ALL SELECT 'GUEST', 0"""))
def row_access(spark: SparkSession, sf: str) -> DataFrame:
    people, roles = bind(spark, sf).passenger, ("ADMIN", "ANALYST", "GUEST")
    seen = people.agg(*[
        F.count_if(masks.row_access(F.col("home_airport"), role, DRIVER_REGION)).alias(role) for role in roles
    ])
    return seen.select(F.inline(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("visible")) for r in roles])))


@query("policy_apply", oracle(
    "passenger_key:i first_name:s last_name:s email:s phone:s loyalty_tier:s", """
    SELECT passenger_key, 'F****' AS first_name, 'L****' AS last_name,
      left(email, 2) || '***' || substr(email, instr(email, '@')) AS email, left(phone, 4) || '****' || right(phone, 4) AS phone,
      loyalty_tier FROM passenger WHERE loyalty_tier = 'DIAMOND'"""))
def policy_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Top-tier passengers as an analyst sees them."""
    people = bind(spark, sf).passenger.filter(F.col("loyalty_tier") == "DIAMOND").select(
        "passenger_key", "first_name", "last_name", "email", "phone", "loyalty_tier"
    )
    return governance.policy_apply(governance.tag_columns(people, governance.PASSENGER_TAGS), masks.ANALYST)


@query("tag_catalog", oracle("tag_name:s tag_value:s table_name:s column_name:s filled_values:i", """
    SELECT 'PII_CLASSIFICATION' AS tag_name, unnest(['EMAIL', 'NAME', 'NAME', 'PHONE']) AS tag_value, 'passenger' AS table_name,
      unnest(['email', 'first_name', 'last_name', 'phone']) AS column_name, n AS filled_values
    FROM (SELECT count(*) AS n FROM passenger)"""))
def tag_catalog(spark: SparkSession, sf: str) -> DataFrame:
    people = governance.tag_columns(bind(spark, sf).passenger, governance.PASSENGER_TAGS)
    return governance.tag_catalog({"passenger": people})


SNAPSHOT_SQL = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank
    FROM orders WHERE o_orderdate <= TIMESTAMP '1998-12-31 23:59:59') WHERE rank = 1"""


def _order_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the change log of their customer."""
    return driver(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("as_of_snapshot", oracle("o_custkey:i o_orderdate:t o_orderkey:i o_orderstatus:s o_totalprice:r", SNAPSHOT_SQL))
def as_of_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_at(_order_log(spark, sf), ["o_custkey"], "o_orderdate", "1998-12-31 23:59:59")


@query("as_of_checkpoint", oracle("o_custkey:i o_orderdate:t o_orderkey:i o_orderstatus:s o_totalprice:r", SNAPSHOT_SQL))
def as_of_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The same state out of a checkpoint and the changes after it; changes arrive in three batches."""
    log = _order_log(spark, sf)
    history = History(spark, scratch_path(spark, "orders"), log.schema, ["o_custkey"], "o_orderdate")
    for batch, (first, last) in enumerate([(1992, 1996), (1997, 1998), (1999, 9999)]):
        history.append(log.filter(F.year("o_orderdate").between(first, last)), batch)
        history.checkpoint(f"{min(last, 2001)}-06-30 00:00:00")
    return history.as_of("1998-12-31 23:59:59")


@query("restore_snapshot", oracle("o_orderstatus:s customers:i", f"""
    SELECT o_orderstatus, count(*) AS customers FROM ({SNAPSHOT_SQL}) GROUP BY 1"""))
def restore_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot written as a table; counts by status check the copy."""
    path = scratch_path(spark, "restored")
    restored = restore_at(_order_log(spark, sf), ["o_custkey"], "o_orderdate", "1998-12-31 23:59:59", path)
    return restored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- M. series, forecast, anomalies

DELAY_SERIES = f"""
    SELECT route_code AS series, flight_date AS ds, avg(arrival_delay_min) AS y FROM flight JOIN route USING (route_key)
    WHERE flight_status = 'LANDED' AND flight_date >= {TODAY} - 90 GROUP BY ALL"""
DEMAND_SERIES = f"""
    SELECT route_code AS series, flight_date AS ds, CAST(sum(pax_booked) AS DOUBLE) AS y FROM flight JOIN route USING (route_key)
    WHERE flight_date >= {TODAY} - 90 GROUP BY ALL"""
REVENUE_SERIES = f"""
    SELECT 'ALL' AS series, flight_date AS ds, sum(revenue_total) AS y FROM flight
    WHERE flight_date >= {TODAY} - 90 AND revenue_total > 0 GROUP BY ALL HAVING sum(revenue_total) > 0"""


def _fit(source: str, origin: str) -> dict[str, str]:
    """The model of one series table: trend by least squares, weekday means, spread."""
    return {
        "points": f"SELECT *, CAST(ds - {origin} AS DOUBLE) AS x, isodow(ds) AS dow FROM {source}",
        "trend": """SELECT series, coalesce(CASE WHEN count(*) > 1 THEN regr_slope(y, x) END, 0) AS slope,
            coalesce(CASE WHEN count(*) > 1 THEN regr_intercept(y, x) END, avg(y)) AS level FROM points GROUP BY 1""",
        "rests": "SELECT series, dow, y - (level + slope * x) AS rest FROM points JOIN trend USING (series)",
        "seasons": "SELECT series, dow, avg(rest) AS season FROM rests GROUP BY 1, 2",
        "spread": """SELECT series, coalesce(stddev_samp(rest - season), 0) AS sigma
            FROM rests JOIN seasons USING (series, dow) GROUP BY 1""",
    }


def _expected(day: str, origin: str) -> str:
    return f"level + slope * ({day} - {origin}) + coalesce(season, 0)"


def _forecast_sql(origin: str, horizon: int, interval: float) -> str:
    z = NormalDist().inv_cdf((1 + interval) / 2)
    return f"""
    SELECT series, ts, forecast, forecast - {z!r}::DOUBLE * sigma AS lower_bound, forecast + {z!r}::DOUBLE * sigma AS upper_bound
    FROM (SELECT series, {origin} + CAST(step AS INTEGER) AS ts, sigma, {_expected(f'({origin} + CAST(step AS INTEGER))', origin)} AS forecast
      FROM trend JOIN spread USING (series) CROSS JOIN range(1, {horizon + 1}) AS h(step)
      LEFT JOIN seasons ON seasons.series = trend.series AND seasons.dow = isodow({origin} + CAST(step AS INTEGER)))"""


@query("series_prep", oracle("kind:s series:s ds:d y:r", f"""
    SELECT 'DELAY' AS kind, * FROM ({DELAY_SERIES}) UNION ALL SELECT 'DEMAND', * FROM ({DEMAND_SERIES})
    UNION ALL SELECT 'REVENUE', * FROM ({REVENUE_SERIES})"""))
def series_prep(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    kinds = {
        "DELAY": forecasting.delay_series(t, AS_OF), "DEMAND": forecasting.demand_series(t, AS_OF),
        "REVENUE": forecasting.revenue_series(t, AS_OF),
    }
    return union_all(kinds, "kind")


FORECAST_COLUMNS = "series:s ts:d forecast:r lower_bound:r upper_bound:r"


def _history(series: DataFrame) -> DataFrame:
    """Past days only: flights already scheduled ahead are not history."""
    return series.filter(F.col("ds") <= F.lit(AS_OF).cast("date"))


PAST = f"SELECT * FROM raw WHERE ds <= {TODAY}"


@query("forecast", oracle(FORECAST_COLUMNS, _forecast_sql(TODAY, 14, 0.95), raw=DELAY_SERIES, hist=PAST, **_fit("hist", TODAY)))
def forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival delay by route, 14 days ahead at 95 %."""
    return forecasting.forecast(_history(forecasting.delay_series(bind(spark, sf), AS_OF)), AS_OF, 14, 0.95)


HELD = f"({TODAY} - 14)"


@query("forecast_metrics", oracle("series:s n:i mae:r rmse:r mape:r coverage_pct:r", f"""
    SELECT series, count(*) AS n, avg(abs(y - f)) AS mae, sqrt(avg((y - f) * (y - f))) AS rmse,
      avg(abs((y - f) / nullif(y, 0))) * 100 AS mape,
      count(*) FILTER (WHERE abs(y - f) <= {NormalDist().inv_cdf(0.95)!r}::DOUBLE * sigma) * 100.0::DOUBLE / count(*) AS coverage_pct
    FROM (SELECT d.series, y, sigma, {_expected('d.ds', HELD)} AS f FROM days d JOIN trend ON trend.series = d.series
      JOIN spread ON spread.series = d.series
      LEFT JOIN seasons ON seasons.series = d.series AND seasons.dow = isodow(d.ds) WHERE d.ds > {HELD}) GROUP BY 1""",
    raw=DEMAND_SERIES, days=PAST, hist=f"SELECT * FROM days WHERE ds <= {HELD}", **_fit("hist", HELD)))
def forecast_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Demand, the last 14 days held out, 90 % interval."""
    return forecasting.forecast_metrics(_history(forecasting.demand_series(bind(spark, sf), AS_OF)), AS_OF, 14, 0.9)


def _r(x: str, n: int) -> str:
    return f"round(CAST({x} AS DECIMAL(38, 10)), {n})"


@query("delay_outlook", oracle(
    "route_code:s forecast_date:d predicted_delay:r worst_case_delay:r risk_level:s risk_level_brief:s", f"""
    SELECT series AS route_code, ts AS forecast_date, {_r('forecast', 1)} AS predicted_delay, {_r('upper_bound', 1)} AS worst_case_delay,
      CASE WHEN forecast > 45 THEN 'CRITICAL' WHEN forecast > 25 THEN 'HIGH' WHEN forecast > 15 THEN 'MODERATE' ELSE 'LOW' END AS risk_level,
      CASE WHEN forecast > 30 THEN 'HIGH RISK' WHEN forecast > 15 THEN 'MODERATE' ELSE 'LOW' END AS risk_level_brief
    FROM ({_forecast_sql(TODAY, 14, 0.95)}) WHERE ts BETWEEN {TODAY} AND {TODAY} + 7""",
    raw=DELAY_SERIES, hist=PAST, **_fit("hist", TODAY)))
def delay_outlook(spark: SparkSession, sf: str) -> DataFrame:
    ahead = forecasting.forecast(_history(forecasting.delay_series(bind(spark, sf), AS_OF)), AS_OF, 14, 0.95)
    return forecasting.delay_outlook(ahead, AS_OF)


@query("capacity_risk", oracle(
    "route_code:s forecast_date:d predicted_passengers:r flight_time_mins:i aircraft_capacity:i predicted_load_factor:r capacity_alert:s", f"""
    SELECT series AS route_code, ts AS forecast_date, {_r('forecast', 0)} AS predicted_passengers, flight_time_mins,
      seats AS aircraft_capacity, {_r('forecast / seats * 100', 1)} AS predicted_load_factor,
      CASE WHEN forecast > seats * 0.95::DOUBLE THEN 'CAPACITY_RISK' ELSE 'OK' END AS capacity_alert
    FROM ({_forecast_sql(TODAY, 14, 0.9)})
    JOIN (SELECT route_code, flight_time_mins, CASE WHEN route_type LIKE '%LONG_HAUL' THEN 315 ELSE 180 END AS seats FROM route)
      ON series = route_code WHERE ts BETWEEN {TODAY} AND {TODAY} + 7""",
    raw=DEMAND_SERIES, hist=PAST, **_fit("hist", TODAY)))
def capacity_risk(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    ahead = forecasting.forecast(_history(forecasting.demand_series(t, AS_OF)), AS_OF, 14, 0.9)
    return forecasting.capacity_risk(ahead, t.route, AS_OF)


@query("revenue_outlook", oracle(
    "forecast_date:d predicted_daily_revenue:r revenue_lower:r revenue_upper:r cumulative_revenue:r", f"""
    SELECT ts AS forecast_date, {_r('forecast', 2)} AS predicted_daily_revenue, {_r('lower_bound', 2)} AS revenue_lower,
      {_r('upper_bound', 2)} AS revenue_upper, sum({_r('forecast', 2)}) OVER (ORDER BY ts) AS cumulative_revenue
    FROM ({_forecast_sql(TODAY, 30, 0.9)})""", raw=REVENUE_SERIES, hist=PAST, **_fit("hist", TODAY)))
def revenue_outlook(spark: SparkSession, sf: str) -> DataFrame:
    ahead = forecasting.forecast(_history(forecasting.revenue_series(bind(spark, sf), AS_OF)), AS_OF, 30, 0.9)
    return forecasting.revenue_outlook(ahead)


CUT = f"({TODAY} - 15)"
DELAY_DAYS = f"""
    SELECT iata_code AS series, flight_date AS ds, avg(departure_delay_min) AS y FROM flight
    JOIN airport ON airport_key = origin_airport_key WHERE flight_date >= {TODAY} - 90 GROUP BY ALL"""
FUEL_DAYS = f"""
    SELECT registration AS series, flight_date AS ds, avg(fuel_efficiency_l_per_100km) AS y FROM flight
    JOIN aircraft USING (aircraft_key) WHERE flight_date >= {TODAY} - 90 AND fuel_consumed_kg > 0 AND distance_flown_km > 0
    GROUP BY ALL"""
TRAIN = f"SELECT * FROM days WHERE ds <= {CUT}"


def _scored(source: str, interval: float) -> str:
    z = NormalDist().inv_cdf((1 + interval) / 2)
    return f"""
    SELECT series, ds AS ts, y, forecast, forecast - {z!r}::DOUBLE * sigma AS lower_bound,
      forecast + {z!r}::DOUBLE * sigma AS upper_bound, abs(y - forecast) > {z!r}::DOUBLE * sigma + 1e-9 AS is_anomaly
    FROM (SELECT d.series, d.ds, y, sigma, {_expected('d.ds', CUT)} AS forecast FROM {source} d
      JOIN trend ON trend.series = d.series JOIN spread ON spread.series = d.series
      LEFT JOIN seasons ON seasons.series = d.series AND seasons.dow = isodow(d.ds) WHERE d.ds > {CUT})"""


@query("anomaly_windows", oracle("part:s series:s ds:d y:r", f"""
    SELECT CASE WHEN ds <= {CUT} THEN 'DELAY_TRAIN' ELSE 'DELAY_SCORE' END AS part, * FROM ({DELAY_DAYS})
    UNION ALL SELECT CASE WHEN ds <= {CUT} THEN 'FUEL_TRAIN' ELSE 'FUEL_SCORE' END, * FROM ({FUEL_DAYS})"""))
def anomaly_windows(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    delay_train, delay_score = anomalies.delay_windows(t, AS_OF)
    fuel_train, fuel_score = anomalies.fuel_windows(t, AS_OF)
    return union_all({
        "DELAY_TRAIN": delay_train, "DELAY_SCORE": delay_score, "FUEL_TRAIN": fuel_train, "FUEL_SCORE": fuel_score,
    }, "part")


def _delay_found(spark: SparkSession, sf: str) -> DataFrame:
    train, score = anomalies.delay_windows(bind(spark, sf), AS_OF)
    return anomalies.detect_anomalies(train, score, AS_OF, anomalies.DELAY_INTERVAL)


def _fuel_found(spark: SparkSession, sf: str) -> DataFrame:
    train, score = anomalies.fuel_windows(bind(spark, sf), AS_OF)
    return anomalies.detect_anomalies(train, score, AS_OF, anomalies.FUEL_INTERVAL)


@query("detect_anomalies", oracle(
    "series:s ts:d y:r forecast:r lower_bound:r upper_bound:r is_anomaly:b", _scored("days", 0.99),
    days=DELAY_DAYS, hist=TRAIN, **_fit("hist", CUT)))
def detect_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return _delay_found(spark, sf)


@query("anomaly_report", oracle(
    "airport_code:s anomaly_date:d actual_avg_delay:r expected_delay:r deviation_minutes:r is_anomaly:b anomaly_type:s", f"""
    SELECT series AS airport_code, ts AS anomaly_date, y AS actual_avg_delay, forecast AS expected_delay,
      {_r('y - forecast', 1)} AS deviation_minutes, is_anomaly,
      CASE WHEN y - forecast > 30 THEN 'SEVERE_ABOVE_NORMAL' WHEN y - forecast > 15 THEN 'ABOVE_NORMAL'
        WHEN y - forecast < -15 THEN 'BELOW_NORMAL' ELSE 'WITHIN_RANGE' END AS anomaly_type
    FROM ({_scored('days', 0.99)}) WHERE is_anomaly ORDER BY {_r('abs(y - forecast)', 6)} DESC, series, ts LIMIT 20""",
    days=DELAY_DAYS, hist=TRAIN, **_fit("hist", CUT)))
def anomaly_report(spark: SparkSession, sf: str) -> DataFrame:
    return anomalies.delay_anomaly_report(_delay_found(spark, sf))


@query("fuel_anomaly_report", oracle(
    "aircraft_reg:s anomaly_date:d actual_fuel_eff:r expected_fuel_eff:r pct_deviation:r is_anomaly:b maintenance_recommendation:s", f"""
    SELECT series AS aircraft_reg, ts AS anomaly_date, {_r('y', 2)} AS actual_fuel_eff, {_r('forecast', 2)} AS expected_fuel_eff,
      {_r('(y - forecast) / nullif(forecast, 0) * 100', 1)} AS pct_deviation, is_anomaly,
      CASE WHEN y > forecast * 1.15::DOUBLE THEN 'HIGH_BURN - Check engine'
        WHEN y < forecast * 0.85::DOUBLE THEN 'LOW_BURN - Verify sensor' ELSE 'MARGINAL' END AS maintenance_recommendation
    FROM ({_scored('days', 0.95)}) WHERE is_anomaly ORDER BY {_r('abs(y - forecast)', 6)} DESC, series, ts LIMIT 15""",
    days=FUEL_DAYS, hist=TRAIN, **_fit("hist", CUT)))
def fuel_anomaly_report(spark: SparkSession, sf: str) -> DataFrame:
    return anomalies.fuel_anomaly_report(_fuel_found(spark, sf))


def _second(days: str) -> dict[str, str]:
    """CTEs that fit and score a further set of series, as ``found2``."""
    return {
        "days2": days,
        "points2": f"SELECT *, CAST(ds - {CUT} AS DOUBLE) AS x, isodow(ds) AS dow FROM days2 WHERE ds <= {CUT}",
        "trend2": """SELECT series, coalesce(CASE WHEN count(*) > 1 THEN regr_slope(y, x) END, 0) AS slope,
      coalesce(CASE WHEN count(*) > 1 THEN regr_intercept(y, x) END, avg(y)) AS level FROM points2 GROUP BY 1""",
        "rests2": "SELECT series, dow, y - (level + slope * x) AS rest FROM points2 JOIN trend2 USING (series)",
        "seasons2": "SELECT series, dow, avg(rest) AS season FROM rests2 GROUP BY 1, 2",
        "spread2": "SELECT series, coalesce(stddev_samp(rest - season), 0) AS sigma FROM rests2 JOIN seasons2 USING (series, dow) GROUP BY 1",
        "found2": f"""SELECT series, ds AS ts, y, forecast, abs(y - forecast) > {NormalDist().inv_cdf(0.975)!r}::DOUBLE * sigma + 1e-9 AS is_anomaly
      FROM (SELECT d.series, d.ds, y, sigma, {_expected('d.ds', CUT)} AS forecast FROM days2 d JOIN trend2 t ON t.series = d.series
        JOIN spread2 s ON s.series = d.series LEFT JOIN seasons2 w ON w.series = d.series AND w.dow = isodow(d.ds) WHERE d.ds > {CUT})""",
    }


ANOMALY_COLUMNS = "domain:s entity:s detected_at:d actual_value:r expected_value:r is_anomaly:b"


@query("all_anomalies", oracle(ANOMALY_COLUMNS, f"""
    SELECT 'DELAY' AS domain, series AS entity, ts AS detected_at, y AS actual_value, forecast AS expected_value, is_anomaly
    FROM ({_scored('days', 0.99)}) WHERE is_anomaly
    UNION ALL SELECT 'FUEL', series, ts, y, forecast, is_anomaly FROM found2 WHERE is_anomaly""",
    days=DELAY_DAYS, hist=TRAIN, **_fit("hist", CUT), **_second(FUEL_DAYS)))
def all_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Delay anomalies by airport beside fuel anomalies by aircraft."""
    return anomalies.all_anomalies(_delay_found(spark, sf), _fuel_found(spark, sf))


@query("demand_anomalies", oracle(ANOMALY_COLUMNS, """
    SELECT 'DEMAND' AS domain, series AS entity, ts AS detected_at, y AS actual_value, forecast AS expected_value, is_anomaly
    FROM found2 WHERE is_anomaly""",
    **_second(f"""SELECT route_code AS series, flight_date AS ds, CAST(sum(pax_booked) AS DOUBLE) AS y FROM flight
      JOIN route USING (route_key) WHERE flight_date >= {TODAY} - 90 GROUP BY ALL""")))
def demand_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Demand anomalies by route."""
    series = forecasting.demand_series(bind(spark, sf), AS_OF)
    cut = F.date_sub(F.lit(AS_OF).cast("date"), 15)
    found = anomalies.detect_anomalies(series.filter(F.col("ds") <= cut), series.filter(F.col("ds") > cut), AS_OF, 0.95)
    return anomalies.anomalies_of({"DEMAND": found})


# ---------------------------------------------------------------- M. training sets, classifiers, features

CHURN_COLUMNS = (
    "passenger_key:i tier_level:i lifetime_miles:i ytd_miles:i ytd_segments:i total_bookings:i total_revenue:r "
    "avg_booking_value:r avg_advance_purchase:r avg_delay_experienced:r major_delays:r avg_sentiment:r avg_nps:r "
    "negative_feedbacks:r days_since_last_activity:i churn_label:s"
)


@query("churn_training", oracle(CHURN_COLUMNS, f"""
    SELECT *, CASE WHEN coalesce(days_since_last_activity, 999) > 60 THEN 'CHURNED' ELSE 'ACTIVE' END AS churn_label
    FROM (SELECT p.passenger_key, list_position(['BRONZE', 'SILVER', 'GOLD', 'PLATINUM', 'DIAMOND'], loyalty_tier) AS tier_level,
        lifetime_miles, ytd_miles, ytd_segments, count(DISTINCT booking_key) AS total_bookings,
        coalesce(sum(total_amount), 0) AS total_revenue, coalesce(avg(total_amount), 0) AS avg_booking_value,
        coalesce(avg(days_before_departure), 30) AS avg_advance_purchase,
        coalesce(avg(arrival_delay_min), 0) AS avg_delay_experienced,
        count(*) FILTER (WHERE arrival_delay_min > 60) AS major_delays, coalesce(avg(sentiment_score), 0) AS avg_sentiment,
        coalesce(avg(nps_score), 5) AS avg_nps, count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS negative_feedbacks,
        {TODAY} - max(b.flight_date) AS days_since_last_activity
      FROM passenger p LEFT JOIN booking b ON b.passenger_key = p.passenger_key
      LEFT JOIN (SELECT flight_event_key, arrival_delay_min FROM flight) f ON f.flight_event_key = b.flight_event_key
      LEFT JOIN feedback o ON o.passenger_key = p.passenger_key GROUP BY 1, 2, 3, 4, 5)"""))
def churn_training(spark: SparkSession, sf: str) -> DataFrame:
    return features.churn_training(bind(spark, sf), AS_OF)


@query("cancel_training", oracle(
    "flight_event_key:i day_of_week:i month_number:i is_weekend:i departure_hour:i route_type:s distance_km:i "
    "aircraft_age_years:r is_widebody:i pax_booked:i seat_capacity:i load_factor_pct:r wind_speed:r visibility:r "
    "precipitation:r weather_condition:s weather_severity:s deicing_required:i cancellation_label:s", """
    SELECT flight_event_key, isodow(flight_date) AS day_of_week, month(flight_date) AS month_number,
      CASE WHEN isodow(flight_date) > 5 THEN 1 ELSE 0 END AS is_weekend, hour(scheduled_departure) AS departure_hour,
      route_type, distance_km, aircraft_age_years, CAST(is_widebody AS INTEGER) AS is_widebody, pax_booked, seat_capacity,
      load_factor_pct, coalesce(wind_speed_kts, 0) AS wind_speed, coalesce(visibility_km, 10) AS visibility,
      coalesce(precipitation_mm, 0) AS precipitation, coalesce(w.weather_condition, 'CLEAR') AS weather_condition,
      coalesce(severity, 'NONE') AS weather_severity, coalesce(CAST(is_deicing_required AS INTEGER), 0) AS deicing_required,
      CASE WHEN flight_status = 'CANCELLED' THEN 'CANCELLED' ELSE 'OPERATED' END AS cancellation_label
    FROM flight f JOIN route r ON r.route_key = f.route_key JOIN aircraft a ON a.aircraft_key = f.aircraft_key
    JOIN airport p ON p.airport_key = origin_airport_key
    LEFT JOIN weather w ON airport_iata = iata_code AND observation_time = date_trunc('hour', scheduled_departure)"""))
def cancel_training(spark: SparkSession, sf: str) -> DataFrame:
    return features.cancel_training(bind(spark, sf))


def _cancel_model(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, classify.Classifier]:
    rows = features.cancel_training(bind(spark, sf))
    train, test = classify.holdout(rows, "flight_event_key")
    model = classify.train(
        train, "cancellation_label", "CANCELLED", "OPERATED", exclude=["flight_event_key"]
    )
    return train, test, model


@query("classify")
def classify_churn(spark: SparkSession, sf: str) -> DataFrame:
    """Churn predicted from the leak-free training set, on held-out passengers."""
    t = bind(spark, sf)
    rows = features.churn_training(t, AS_OF).drop("days_since_last_activity")
    train, test = classify.holdout(rows, "passenger_key")
    model = classify.train(train, "churn_label", "CHURNED", "ACTIVE", exclude=["passenger_key"])
    return classify.predict(model, test, ["passenger_key", "churn_label"])


@query("classify_metrics")
def classify_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Cancellation classifier on held-out flights."""
    _, test, model = _cancel_model(spark, sf)
    predicted = classify.predict(model, test, ["flight_event_key", "cancellation_label"])
    return classify.classify_metrics(predicted, "cancellation_label", model)


@query("feature_importance")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, _, model = _cancel_model(spark, sf)
    return classify.feature_importance(model, train)


FEATURES_SQL = f"""
    SELECT p.passenger_key, passenger_id, loyalty_tier, lifetime_miles, ytd_miles, ytd_segments, b.* EXCLUDE (k),
      f.* EXCLUDE (k), o.* EXCLUDE (k) FROM passenger p
    LEFT JOIN (SELECT passenger_key AS k, count(*) AS bookings_90d, sum(total_amount) AS revenue_90d,
        avg(total_amount) AS avg_booking_value, sum(ancillary_revenue) AS ancillary_90d, max(flight_date) AS last_booking_date
      FROM booking WHERE flight_date >= {TODAY} - 90 GROUP BY 1) b ON b.k = passenger_key
    LEFT JOIN (SELECT passenger_key AS k, avg(arrival_delay_min) AS avg_delay_experienced,
        count(*) FILTER (WHERE arrival_delay_min > 60) AS major_delays_180d, avg(load_factor_pct) AS avg_load_factor
      FROM booking JOIN (SELECT flight_event_key, arrival_delay_min, load_factor_pct FROM flight
        WHERE flight_date >= {TODAY} - 180) USING (flight_event_key) GROUP BY 1) f ON f.k = passenger_key
    LEFT JOIN (SELECT passenger_key AS k, avg(sentiment_score) AS avg_sentiment,
        count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS negative_count, avg(nps_score) AS avg_nps
      FROM feedback WHERE feedback_timestamp >= {TODAY} - INTERVAL 180 DAY GROUP BY 1) o ON o.k = passenger_key"""


@query("passenger_features", oracle(
    "passenger_key:i passenger_id:s loyalty_tier:s lifetime_miles:i ytd_miles:i ytd_segments:i bookings_90d:i revenue_90d:r "
    "avg_booking_value:r ancillary_90d:r last_booking_date:d avg_delay_experienced:r major_delays_180d:i avg_load_factor:r "
    "avg_sentiment:r negative_count:i avg_nps:r", FEATURES_SQL))
def passenger_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.passenger_features(bind(spark, sf), AS_OF)


# ---------------------------------------------------------------- N. scores, text, semantic queries, quality


@query("delay_risk", oracle("flight_event_key:i score:r", f"""
    SELECT flight_event_key, {RISK_POINTS.format(
        otp="coalesce(greatest(0, 100 - otp) * 0.3::DOUBLE, 0)",
        congestion="CASE congestion WHEN 'LOW' THEN 2 WHEN 'MEDIUM' THEN 6 WHEN 'HIGH' THEN 10 ELSE 5 END")} AS score
    FROM (SELECT flight_event_key, CASE WHEN flight_event_key % 7 > 0 THEN load_factor_pct END AS otp,
        CASE flight_event_key % 5 WHEN 0 THEN 'NONE' WHEN 1 THEN 'MILD' WHEN 2 THEN 'MODERATE' WHEN 3 THEN 'SEVERE' END AS weather_severity,
        hour(scheduled_departure) AS h, isodow(flight_date) AS dow,
        CASE flight_event_key % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH' END AS congestion,
        taxi_out_min / 6.0::DOUBLE AS aircraft_age_years FROM flight)"""))
def delay_risk(spark: SparkSession, sf: str) -> DataFrame:
    """The six-factor score over every flight, with missing inputs."""
    key = F.col("flight_event_key")
    factors = bind(spark, sf).flight.select(
        key, F.when(key % 7 > 0, F.col("load_factor_pct")).alias("otp"),
        F.element_at(F.array(*[F.lit(s) for s in ("NONE", "MILD", "MODERATE", "SEVERE", None)]), (key % 5 + 1).cast("int")).alias("weather"),
        F.hour("scheduled_departure").alias("h"), (F.weekday("scheduled_departure") + 1).alias("dow"),
        F.element_at(F.array(*[F.lit(s) for s in ("LOW", "MEDIUM", "HIGH", None)]), (key % 4 + 1).cast("int")).alias("congestion"),
        (F.col("taxi_out_min") / 6.0).alias("age"),
    )
    score = delay_risk_score(
        F.col("otp"), F.col("weather"), F.col("h"), F.col("dow"), F.col("congestion"), F.col("age")
    )
    return factors.select("flight_event_key", score.alias("score"))


@query("delay_risk_sql", oracle("route_key:i score:r", f"""
    SELECT route_key, {RISK_POINTS.format(otp="greatest(0, 100 - otp) * 0.3::DOUBLE", congestion="10")} AS score
    FROM (SELECT route_key, {OTP_SQL} AS otp, 'MILD' AS weather_severity, 8 AS h, 1 AS dow, 4.5 AS aircraft_age_years
      FROM flight GROUP BY 1)"""))
def delayrisk_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same score as a SQL function, on the on-time share of each route."""
    register_sql_functions(spark)
    share = F.count_if(F.col("arrival_delay_min") <= 15) * 100.0 / F.count(F.lit(1))
    routes = bind(spark, sf).flight.groupBy("route_key").agg(share.alias("otp"))
    return routes.selectExpr("route_key", "delay_risk(otp, 'MILD', 8, 1, 'HIGH', 4.5D) AS score")


@query("passenger_feature_rows", oracle("passenger_key:i feature_name:s feature_value:r", f"""
    SELECT passenger_key, unnest(['tier_encoded', 'engagement_score', 'recency_score', 'monetary_score', 'satisfaction_score',
        'churn_probability', 'estimated_clv']) AS feature_name,
      unnest([tier, engagement, recency, monetary, satisfaction,
        greatest(0, least(1, (1 - recency / 100) * 0.3::DOUBLE + (1 - engagement / 100) * 0.25::DOUBLE
          + (1 - satisfaction / 100) * 0.25::DOUBLE + (1 - monetary / 100) * 0.2::DOUBLE)), clv]) AS feature_value
    FROM (SELECT passenger_key, coalesce(list_position(['BRONZE', 'SILVER', 'GOLD', 'PLATINUM', 'DIAMOND'], loyalty_tier), 0)::DOUBLE AS tier,
        least(100, bookings_last_90d * 15 + ytd_segments * 2)::DOUBLE AS engagement,
        greatest(0, 100 - coalesce(nullif(days_since_last_booking, 0), 180) * 0.5::DOUBLE) AS recency,
        least(100, coalesce(revenue_last_90d, 0) / 50.0::DOUBLE) AS monetary,
        greatest(0, least(100, 50 + coalesce(avg_sentiment_90d * 30, 0) - negative_feedback_count * 10 - major_delays_experienced * 8))::DOUBLE AS satisfaction,
        CASE WHEN lifetime_miles <> 0 AND ytd_miles <> 0 THEN coalesce(revenue_last_90d, 0) * 4
          * least(10, greatest(1, lifetime_miles / greatest(1, ytd_miles)::DOUBLE)) ELSE 0 END AS clv
      FROM ({risk_sql(False)}))"""))
def passenger_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Seven rows per passenger out of the safe risk table."""
    return features.passenger_feature_rows(gold.passenger_risk(bind(spark, sf), NOW, literal=False))


@query("feature_procedure", oracle("rows_saved:i", "SELECT count(*) AS rows_saved FROM passenger"))
def feature_procedure(spark: SparkSession, sf: str) -> DataFrame:
    saved = features.feature_procedure(bind(spark, sf), AS_OF, scratch_path(spark, "features"))
    return spark.range(1).select(F.lit(saved).alias("rows_saved"))


def _sql_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


WORDS_SQL = "string_split_regex(lower({0}), '[^a-z]+')"


def hits(passage: str, words: tuple[str, ...]) -> str:
    """Number of words of a passage that are in the list."""
    return f"len(list_filter({WORDS_SQL.format(passage)}, lambda w: list_contains({_sql_list(words)}, w)))"


SENTIMENT_SQL = "coalesce((pos - neg) / nullif(pos + neg, 0)::DOUBLE, 0)"
OPINION_WORDS = text.POSITIVE_WORDS + text.NEGATIVE_WORDS


@query("sentiment", oracle("doc_id:i score:r label:s", f"""
    SELECT doc_id, score, CASE WHEN score > 0.3 THEN 'POSITIVE' WHEN score < -0.3 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label
    FROM (SELECT doc_id, {SENTIMENT_SQL} AS score FROM (SELECT doc_id, {hits('text', text.POSITIVE_WORDS)} AS pos,
      {hits('text', text.NEGATIVE_WORDS)} AS neg FROM documents))"""))
def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    scored = driver(spark, sf, "documents").select("doc_id", text.sentiment(F.col("text")).alias("score"))
    return scored.withColumn("label", sentiment_label(F.col("score")))


SENTENCES_SQL = r"string_split(regexp_replace({0}, '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1))"


def best_sentence_sql(source: str, key: str, words: tuple[str, ...]) -> str:
    """The sentence with most listed words per text, the earliest of equals."""
    return f"""
    SELECT {key}, trim(sentence, ' ') AS sentence, n FROM (SELECT {key}, sentence, n,
        row_number() OVER (PARTITION BY {key} ORDER BY n DESC, i) AS rank
      FROM (SELECT {key}, i, sentence, {hits('sentence', words)} AS n FROM (
        SELECT {key}, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS i
        FROM (SELECT {key}, {SENTENCES_SQL.format('text')} AS parts FROM {source})))) WHERE rank = 1"""


@query("summarise", oracle("doc_id:i summary:s", f"SELECT doc_id, sentence AS summary FROM ({best_sentence_sql('documents', 'doc_id', OPINION_WORDS)})"))
def summarise(spark: SparkSession, sf: str) -> DataFrame:
    return driver(spark, sf, "documents").select("doc_id", text.summarise(F.col("text")).alias("summary"))


def _answer(words: tuple[str, ...]) -> str:
    return f"SELECT doc_id, CASE WHEN n > 0 THEN sentence END AS answer FROM ({best_sentence_sql('documents', 'doc_id', words)})"


@query("extract_answer", oracle(
    "doc_id:i extracted_problem:s desired_resolution:s delay_mentioned:s stated_duration:s", r"""
    SELECT d.doc_id, a.answer AS extracted_problem, b.answer AS desired_resolution, c.answer AS delay_mentioned,
      nullif(regexp_extract(lower(d.text), '([0-9]+(?:\.[0-9]+)?) ?-?(minutes?|mins?|hours?|hrs?|days?)', 0), '') AS stated_duration
    FROM documents d JOIN problem a USING (doc_id) JOIN wish b USING (doc_id) JOIN wait c USING (doc_id)""",
    **dict(zip(("problem", "wish", "wait"), (_answer(w) for w in text.QUESTION_CUES.values())))))
def extract_answer(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.extracted_issues(driver(spark, sf, "documents"), "doc_id", "text")


def _quoted(words: str) -> str:
    return words.replace("'", "''")


@query("prompt_assembly", oracle("kind:s key:i prompt:s", f"""
    SELECT 'APOLOGY' AS kind, feedback_key AS key, '{_quoted(prompts.APOLOGY)}'.replace('{{name}}', first_name)
      .replace('{{tier}}', loyalty_tier) || feedback_text AS prompt
    FROM feedback JOIN passenger USING (passenger_key) WHERE sentiment_score < -0.6 AND loyalty_tier IN ('DIAMOND', 'PLATINUM')
    UNION ALL SELECT 'BRIEFING', 0, '{_quoted(prompts.BRIEFING)}' || string_agg(line, '; ' ORDER BY line)
    FROM (SELECT delay_category || ': ' || count(*) || ' delays, avg '
        || CAST(round(CAST(avg(delay_minutes) AS DECIMAL(38, 10)), 0) AS BIGINT) || ' min, cost GBP'
        || CAST(sum(total_cost_impact) AS BIGINT) || ', ' || CAST(sum(pax_affected) AS BIGINT) || ' pax affected' AS line
      FROM delayed WHERE flight_date >= {TODAY} - 7 GROUP BY delay_category)
    UNION ALL SELECT 'ASSISTANT', 0, '{_quoted(prompts.ASSISTANT)}' || chr(10) || chr(10) || 'CONTEXT: Operational summary - ' || context
      || chr(10) || chr(10) || 'QUESTION: What is our on-time performance?' FROM ({CONTEXT_SQL})"""))
def prompt_assembly(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    none = F.lit(0).cast("bigint").alias("key")
    return union_all({
        "APOLOGY": prompts.apology_prompts(t).select(F.col("feedback_key").alias("key"), "prompt"),
        "BRIEFING": prompts.briefing_prompt(t, AS_OF).select(none, "prompt"),
        "ASSISTANT": prompts.assistant_prompt(t, AS_OF, "What is our on-time performance?").select(none, "prompt"),
    }, "kind")


@query("semantic_query", oracle("city_pair:s season:s flights:i mean_delay:r income:r", """
    SELECT route_code AS city_pair, season, count(*) AS flights, avg(arrival_delay_min) AS mean_delay, sum(revenue_total) AS income
    FROM flight JOIN route USING (route_key) JOIN cal ON date_key = flight_date_key GROUP BY 1, 2"""))
def semantic_query(spark: SparkSession, sf: str) -> DataFrame:
    """Flights, mean arrival delay and income by city pair and season."""
    wanted = [
        semantic.Metric("count", "rows", "flights"), semantic.Metric("avg", "arrived late", "mean_delay"),
        semantic.Metric("sum", "income", "income"),
    ]
    return semantic.semantic_query(bind(spark, sf), wanted, ["city pair", "season"])


@query("semantic_query_two_hops", oracle("haul:s price:r bookings:i", """
    SELECT route_type AS haul, sum(total_amount) AS price, count(total_amount) AS bookings
    FROM booking b JOIN flight f USING (flight_event_key) JOIN route r ON r.route_key = f.route_key GROUP BY 1"""))
def semantic_query_two_hops(spark: SparkSession, sf: str) -> DataFrame:
    """Booking value by haul type: booking to flight to route."""
    wanted = [semantic.Metric("sum", "ticket price", "price"), semantic.Metric("count", "ticket price", "bookings")]
    return semantic.semantic_query(bind(spark, sf), wanted, {"haul": "haul type"})


@query("semantic_on_time", oracle("otp_percentage:r", f"""
    SELECT count(*) FILTER (WHERE arrival_delay_min <= 15) * 100.0 / nullif(count(*), 0) AS otp_percentage
    FROM flight JOIN cal ON date_key = flight_date_key WHERE full_date >= {TODAY} - 7 AND flight_status = 'LANDED'"""))
def semantic_on_time(spark: SparkSession, sf: str) -> DataFrame:
    """Share of landed flights on time since a week ago."""
    wanted = [semantic.Metric("percent", "arrival delay", "otp_percentage", lambda delay: delay <= 15)]
    since = F.date_sub(F.lit(AS_OF).cast("date"), 7)
    only = {"day": lambda day: day >= since, "flight.flight_status": lambda status: status == "LANDED"}
    return semantic.semantic_query(bind(spark, sf), wanted, [], only=only)


@query("semantic_late_routes", oracle("route_code:s avg_delay:r flights:i", """
    SELECT route_code, avg(arrival_delay_min) AS avg_delay, count(*) AS flights
    FROM flight JOIN route USING (route_key) GROUP BY 1 ORDER BY avg_delay DESC NULLS LAST, route_code LIMIT 10"""))
def semantic_late_routes(spark: SparkSession, sf: str) -> DataFrame:
    """The ten routes of the greatest mean arrival delay."""
    wanted = [semantic.Metric("avg", "arrival delay", "avg_delay"), semantic.Metric("count", "rows", "flights")]
    return semantic.semantic_query(bind(spark, sf), wanted, {"route_code": "route"}, top=("avg_delay", 10))


@query("semantic_delay_cost", oracle("delay_category:s total_cost:r incidents:i", """
    SELECT delay_category, sum(total_cost_impact) AS total_cost, count(*) AS incidents FROM delayed GROUP BY 1"""))
def semantic_delay_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Cost and number of delays by category."""
    wanted = [semantic.Metric("sum", "delay cost", "total_cost"), semantic.Metric("count", "rows", "incidents")]
    return semantic.semantic_query(bind(spark, sf), wanted, {"delay_category": "cause"})


@query("semantic_unhappy_members", oracle("unhappy_diamond_members:i", """
    SELECT count(DISTINCT passenger_key) AS unhappy_diamond_members FROM feedback JOIN passenger USING (passenger_key)
    WHERE loyalty_tier = 'DIAMOND' AND sentiment_label = 'NEGATIVE'"""))
def semantic_unhappy_members(spark: SparkSession, sf: str) -> DataFrame:
    """How many members of the top tier gave negative feedback."""
    wanted = [semantic.Metric("count distinct", "feedback.passenger_key", "unhappy_diamond_members")]
    only = {
        "membership level": lambda tier: tier == "DIAMOND", "passenger.is_current": lambda current: current,
        "feedback.sentiment_label": lambda label: label == "NEGATIVE",
    }
    return semantic.semantic_query(bind(spark, sf), wanted, [], only=only)


@query("key_checks", oracle("check_name:s violations:i", """
    SELECT unnest(['duplicate_keys', 'surplus_rows', 'null_l_orderkey', 'null_l_linenumber', 'null_l_shipdate']) AS check_name,
      unnest([dup, surplus, 0, 0, 0]) AS violations
    FROM (SELECT count(*) AS dup, CAST(sum(n - 1) AS BIGINT) AS surplus
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1)"""))
def key_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_checks(driver(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("domain_checks", oracle("check_name:s violations:i", """
    SELECT unnest(['feedback_channel_allowed', 'ai_priority_allowed', 'nps_score_range', 'overall_rating_range',
        'sentiment_score_range', 'route_key_range']) AS check_name,
      unnest([count(*) FILTER (WHERE feedback_channel NOT IN ('NPS_SURVEY', 'SOCIAL_MEDIA', 'IN_APP', 'EMAIL', 'CALL_CENTER')),
        count(*) FILTER (WHERE ai_priority NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')),
        count(*) FILTER (WHERE nps_score NOT BETWEEN 0 AND 10), count(*) FILTER (WHERE overall_rating NOT BETWEEN 1 AND 5),
        count(*) FILTER (WHERE sentiment_score NOT BETWEEN -1 AND 1), count(*) FILTER (WHERE route_key NOT BETWEEN 1 AND 20)]) AS violations
    FROM feedback"""))
def domain_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Feedback against its value lists, and a route range that is broken on purpose."""
    allowed = {"feedback_channel": quality.FEEDBACK_CHANNEL, "ai_priority": quality.PRIORITY}
    return quality.domain_checks(bind(spark, sf).feedback, allowed, {**quality.RANGES, "route_key": (1, 20)})


@query("consistency_checks", oracle("check_name:s violations:i", """
    SELECT 'total_is_sum' AS check_name, count(*) FILTER (WHERE abs(total_cost_impact - compensation_amount - rebooking_cost
      - hotel_cost - meal_voucher_cost) > 0.005) AS violations FROM delayed
    UNION ALL SELECT 'reason_agrees', count(*) FILTER (WHERE r.delay_category <> d.delay_category) FROM delayed d
      JOIN reasons r ON r.k = d.delay_reason_key
    UNION ALL SELECT 'load_factor_agrees',
      count(*) FILTER (WHERE abs(load_factor_pct - pax_flown * 100.0::DOUBLE / seat_capacity) > 1) FROM flight""",
    reasons=values_sql(reference.DELAY_REASONS, reference.DELAY_REASON_COLUMNS)))
def consistency_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Totals, reason against category, and load factor against passengers."""
    t = bind(spark, sf)
    parts = ["compensation_amount", "rebooking_cost", "hotel_cost", "meal_voucher_cost"]
    reasons = reference.delay_reasons(spark).select("delay_reason_key", F.col("delay_category").alias("reason_category"))
    agree = F.col("reason_category") == F.col("delay_category")
    totals = quality.rule_counts(t.delay, {"total_is_sum": quality.total_is_sum("total_cost_impact", parts)})
    causes = quality.rule_counts(t.delay.join(reasons, "delay_reason_key"), {"reason_agrees": agree})
    loads = quality.rule_counts(t.flight, {"load_factor_agrees": quality.load_factor_agrees()})
    return totals.unionByName(causes).unionByName(loads)
