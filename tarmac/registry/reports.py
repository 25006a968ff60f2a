"""Registered queries: gold tables, report queries and alert rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.plans import alerts, gold, reports
from tarmac.registry.base import query
from tarmac.registry.binding import AS_OF, NOW, bind, driver
from tarmac.registry.core import ANOMALY_SQL, ANOMALY_WHERE
from tarmac.registry.oracle import THIS_INSTANT, TODAY, oracle

SEVERITY_SQL = """CASE WHEN arrival_delay_min > 180 THEN 'SEVERE' WHEN arrival_delay_min > 60 THEN 'SIGNIFICANT'
    WHEN arrival_delay_min > 15 THEN 'MINOR' WHEN arrival_delay_min > 0 THEN 'SLIGHT' ELSE 'ON_TIME' END"""
OTP_SQL = "count(*) FILTER (WHERE arrival_delay_min <= 15) * 100.0::DOUBLE / nullif(count(*), 0)"


@query("flight_status", oracle(
    "flight_event_key:i flight_number:s flight_date_key:i flight_date:d flight_status:s origin_airport_key:i "
    "origin_iata:s origin_airport:s dest_airport_key:i dest_iata:s dest_airport:s scheduled_departure:t "
    "scheduled_arrival:t actual_departure:t actual_arrival:t departure_delay_min:i arrival_delay_min:i "
    "delay_severity:s pax_booked:i seat_capacity:i load_factor_pct:r registration:s aircraft_type:s "
    "minutes_since_scheduled:i is_delayed_departure:b", f"""
    SELECT f.*, o.iata_code AS origin_iata, o.airport_name AS origin_airport, d.iata_code AS dest_iata,
      d.airport_name AS dest_airport, registration, aircraft_type, {SEVERITY_SQL} AS delay_severity,
      date_diff('minute', scheduled_departure, {THIS_INSTANT}) AS minutes_since_scheduled,
      flight_status = 'SCHEDULED' AND scheduled_departure < {THIS_INSTANT} AS is_delayed_departure
    FROM flight f JOIN airport o ON o.airport_key = origin_airport_key JOIN airport d ON d.airport_key = dest_airport_key
    JOIN aircraft USING (aircraft_key) WHERE flight_date BETWEEN {TODAY} - 1 AND {TODAY} + 1"""))
def flight_status(spark: SparkSession, sf: str) -> DataFrame:
    return gold.flight_status(bind(spark, sf), NOW)


def risk_sql(literal: bool) -> str:
    recent = f"max(booking_date) FILTER (WHERE booking_date >= {TODAY} - 90)" if literal else "max(booking_date)"
    feedbacks, bookings = ("greatest(coalesce(o.n, 0), 1)", "greatest(coalesce(b.n, 0), 1)") if literal else ("1", "1")
    return f"""
    SELECT *, CASE WHEN days_since_last_booking > 180 THEN 'CRITICAL'
        WHEN days_since_last_booking > 90 AND avg_sentiment_90d < -0.2 THEN 'HIGH'
        WHEN days_since_last_booking > 60 OR major_delays_experienced >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk_level,
      {THIS_INSTANT} AS scored_at
    FROM (SELECT p.*, p.first_name || ' ' || p.last_name AS full_name, coalesce(b.ids, 0) AS bookings_last_90d,
        b.amount * {feedbacks} AS revenue_last_90d, b.mean_amount AS avg_booking_value, b.last_date AS last_booking_date,
        {TODAY} - b.last_date AS days_since_last_booking, o.score AS avg_sentiment_90d,
        coalesce(o.negative, 0) * {bookings} AS negative_feedback_count, b.delay AS avg_delay_experienced,
        coalesce(b.major, 0) * {feedbacks} AS major_delays_experienced
      FROM passenger p
      LEFT JOIN (SELECT passenger_key, count(*) AS n, count(DISTINCT booking_key) AS ids, sum(total_amount) AS amount,
          avg(total_amount) AS mean_amount, {recent} AS last_date, avg(arrival_delay_min) AS delay,
          count(*) FILTER (WHERE arrival_delay_min > 60) AS major
        FROM booking LEFT JOIN (SELECT flight_event_key, arrival_delay_min FROM flight) USING (flight_event_key) GROUP BY 1) b
        USING (passenger_key)
      LEFT JOIN (SELECT passenger_key, count(*) AS n, avg(sentiment_score) AS score,
          count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS negative
        FROM feedback WHERE feedback_timestamp >= {THIS_INSTANT} - INTERVAL 90 DAY GROUP BY 1) o USING (passenger_key)
      WHERE loyalty_tier <> 'NONE')"""


RISK_COLUMNS = (
    "passenger_key:i passenger_id:s full_name:s loyalty_tier:s lifetime_miles:i ytd_miles:i ytd_segments:i "
    "bookings_last_90d:i revenue_last_90d:r avg_booking_value:r last_booking_date:d days_since_last_booking:i "
    "avg_sentiment_90d:r negative_feedback_count:r avg_delay_experienced:r major_delays_experienced:r "
    "churn_risk_level:s scored_at:t"
)


@query("passenger_risk", oracle(RISK_COLUMNS, risk_sql(True)))
def passenger_risk(spark: SparkSession, sf: str) -> DataFrame:
    return gold.passenger_risk(bind(spark, sf), NOW)


@query("passenger_risk_safe", oracle(RISK_COLUMNS, risk_sql(False)))
def passenger_risk_safe(spark: SparkSession, sf: str) -> DataFrame:
    """Without fan-out, and with recency over all bookings."""
    return gold.passenger_risk(bind(spark, sf), NOW, literal=False)


@query("route_performance", oracle(
    "route_key:i route_code:s origin_iata:s destination_iata:s route_type:s flight_date:d flights_operated:i "
    "total_pax:r avg_load_factor:r avg_arrival_delay:r otp_15min_pct:r cancellations:r total_revenue:r "
    "revenue_per_pax:r total_ancillary:r avg_fuel_efficiency:r avg_customer_rating:r avg_sentiment:r", f"""
    SELECT r.route_key, r.route_code, r.origin_iata, r.destination_iata, r.route_type, f.flight_date,
      count(DISTINCT f.flight_event_key) AS flights_operated, sum(f.pax_flown) AS total_pax,
      avg(f.load_factor_pct) AS avg_load_factor, avg(arrival_delay_min) AS avg_arrival_delay, {OTP_SQL} AS otp_15min_pct,
      count(*) FILTER (WHERE f.flight_status = 'CANCELLED') AS cancellations, sum(b.total_amount) AS total_revenue,
      sum(b.total_amount) / nullif(sum(f.pax_flown), 0) AS revenue_per_pax, sum(b.ancillary_revenue) AS total_ancillary,
      avg(f.fuel_efficiency_l_per_100km) AS avg_fuel_efficiency, avg(o.overall_rating) AS avg_customer_rating,
      avg(o.sentiment_score) AS avg_sentiment
    FROM flight f JOIN route r ON r.route_key = f.route_key
    LEFT JOIN booking b ON b.flight_event_key = f.flight_event_key
    LEFT JOIN feedback o ON o.flight_event_key = f.flight_event_key
    WHERE f.flight_date >= {TODAY} - 365 GROUP BY 1, 2, 3, 4, 5, 6"""))
def route_performance(spark: SparkSession, sf: str) -> DataFrame:
    return gold.route_performance(bind(spark, sf), AS_OF)


@query("ops_anomaly", oracle(
    "flight_event_key:i flight_number:s flight_date_key:i origin_airport_key:i origin_iata:s scheduled_departure:t "
    "anomaly_type:s severity:s departure_delay_min:i pax_booked:i seat_capacity:i detected_at:t", f"""
    SELECT *, iata_code AS origin_iata, {ANOMALY_SQL}, {THIS_INSTANT} AS detected_at
    FROM flight JOIN airport ON airport_key = origin_airport_key WHERE flight_date = {TODAY} AND {ANOMALY_WHERE}"""))
def ops_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.ops_anomaly(bind(spark, sf), NOW)


KPI_COLUMNS = (
    "report_date:d total_flights:i cancelled_flights:r otp_pct:r avg_delay_min:r total_passengers:r "
    "avg_load_factor:r total_revenue:r total_ancillary_revenue:r total_delay_cost:r avg_nps:r avg_sentiment:r "
    "critical_feedback_count:r total_fuel_kg:r avg_fuel_efficiency:r"
)


def kpi_sql(where: str) -> str:
    return f"""
    SELECT f.flight_date AS report_date, count(DISTINCT f.flight_event_key) AS total_flights,
      count(*) FILTER (WHERE f.flight_status = 'CANCELLED') AS cancelled_flights, {OTP_SQL} AS otp_pct,
      avg(arrival_delay_min) AS avg_delay_min, sum(f.pax_flown) AS total_passengers,
      avg(f.load_factor_pct) AS avg_load_factor, sum(b.total_amount) AS total_revenue,
      sum(b.ancillary_revenue) AS total_ancillary_revenue, sum(d.total_cost_impact) AS total_delay_cost,
      avg(o.nps_score) AS avg_nps, avg(o.sentiment_score) AS avg_sentiment,
      count(*) FILTER (WHERE o.ai_priority = 'CRITICAL') AS critical_feedback_count,
      sum(f.fuel_consumed_kg) AS total_fuel_kg, avg(f.fuel_efficiency_l_per_100km) AS avg_fuel_efficiency
    FROM flight f LEFT JOIN booking b ON b.flight_event_key = f.flight_event_key
    LEFT JOIN delayed d ON d.flight_event_key = f.flight_event_key
    LEFT JOIN feedback o ON o.flight_event_key = f.flight_event_key WHERE {where} GROUP BY 1"""


@query("daily_kpi", oracle(KPI_COLUMNS, kpi_sql(f"f.flight_date >= {TODAY} - 7")))
def daily_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_kpi(bind(spark, sf), AS_OF)


@query("critical_feedback", oracle(
    "feedback_key:i passenger_name:s loyalty_tier:s feedback_channel:s feedback_timestamp:t feedback_text:s "
    "ai_summary:s sentiment_score:r nps_score:i flight_number:s departure_delay_min:i route_code:s", """
    SELECT o.*, first_name || ' ' || last_name AS passenger_name, loyalty_tier, feedback_text AS ai_summary,
      flight_number, departure_delay_min, route_code
    FROM feedback o LEFT JOIN passenger p ON p.passenger_key = o.passenger_key
    LEFT JOIN flight f ON f.flight_event_key = o.flight_event_key LEFT JOIN route r ON r.route_key = o.route_key
    WHERE sentiment_score < -0.5"""))
def critical_feedback(spark: SparkSession, sf: str) -> DataFrame:
    """One-sentence texts, so the summary is the text itself (summarise has its own query)."""
    return reports.critical_feedback(bind(spark, sf))


@query("sentiment_distribution", oracle("sentiment_label:s feedback_count:i avg_score:r avg_nps:r avg_rating:r", """
    SELECT sentiment_label, count(*) AS feedback_count, round(CAST(avg(sentiment_score) AS DECIMAL(38, 10)), 3) AS avg_score,
      round(CAST(avg(nps_score) AS DECIMAL(38, 10)), 1) AS avg_nps,
      round(CAST(avg(overall_rating) AS DECIMAL(38, 10)), 1) AS avg_rating FROM feedback GROUP BY 1"""))
def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sentiment_distribution(bind(spark, sf).feedback)


DELAY_COST_COLUMNS = "delay_category:s incidents:i avg_minutes:r total_cost:r total_pax:i action:s"


def _delay_cost_sql(where: str) -> str:
    return f"""
    SELECT delay_category, count(*) AS incidents, avg(delay_minutes) AS avg_minutes, sum(total_cost_impact) AS total_cost,
      sum(pax_affected) AS total_pax, CASE delay_category WHEN 'WEATHER' THEN 'Predict and proactively rebook'
        WHEN 'REACTIONARY' THEN 'Break the delay chain' WHEN 'TECHNICAL' THEN 'Predictive maintenance'
        WHEN 'ATC' THEN 'Optimize slot management' ELSE 'Improve resource planning' END AS action
    FROM delayed WHERE {where} GROUP BY 1"""


@query("delay_cost_summary", oracle(DELAY_COST_COLUMNS, _delay_cost_sql("true")))
def delay_cost_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.delay_cost_summary(bind(spark, sf))


@query("delay_cost_summary_7d", oracle(DELAY_COST_COLUMNS, _delay_cost_sql(f"flight_date >= {TODAY} - 7")))
def delay_cost_summary_7d(spark: SparkSession, sf: str) -> DataFrame:
    return reports.delay_cost_summary(bind(spark, sf), AS_OF)


DRIVER_CONGESTION = {"NATION_0": "HIGH", "NATION_4": "HIGH", "NATION_8": "MEDIUM", "NATION_9": "MEDIUM"}
RISK_POINTS = """least(100, greatest(0, round(CAST(
      {otp} + CASE weather_severity WHEN 'MILD' THEN 5 WHEN 'MODERATE' THEN 15 WHEN 'SEVERE' THEN 25 ELSE 0 END
      + CASE WHEN h IN (7, 8, 9, 17, 18, 19) THEN 12 WHEN h > 20 OR h < 6 THEN 3 ELSE 7 END
      + CASE WHEN dow IN (1, 5) THEN 8 WHEN dow IN (6, 7) THEN 4 ELSE 6 END + {congestion}
      + least(10, aircraft_age_years * 1.5) AS DECIMAL(38, 10)), 2)))"""


@query("flight_delay_risk", oracle(
    "flight_event_key:i flight_number:s scheduled_departure:t origin:s destination:s aircraft_type:s "
    "aircraft_age_years:r load_factor_pct:r weather_condition:s weather_severity:s delay_risk_score:r risk_category:s", f"""
    SELECT *, CASE WHEN judged > 70 THEN 'HIGH' WHEN judged > 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
    FROM (SELECT *, {RISK_POINTS.format(otp="greatest(0, 100 - otp) * 0.3::DOUBLE", congestion='''
        CASE origin WHEN 'NATION_0' THEN 10 WHEN 'NATION_4' THEN 10 WHEN 'NATION_8' THEN 6 WHEN 'NATION_9' THEN 6 ELSE 2 END''')}
        AS delay_risk_score, {RISK_POINTS.format(otp="4.5", congestion="10")} AS judged
      FROM (SELECT f.*, o.iata_code AS origin, d.iata_code AS destination, aircraft_type, aircraft_age_years,
          weather_condition, severity AS weather_severity, hour(scheduled_departure) AS h, isodow(f.flight_date) AS dow, otp
        FROM flight f JOIN airport o ON o.airport_key = f.origin_airport_key
        JOIN airport d ON d.airport_key = f.dest_airport_key JOIN aircraft USING (aircraft_key)
        LEFT JOIN (SELECT route_key, {OTP_SQL} AS otp FROM flight WHERE flight_date >= {TODAY} - 30 GROUP BY 1)
          USING (route_key)
        LEFT JOIN weather ON airport_iata = o.iata_code AND observation_time = date_trunc('hour', scheduled_departure)
        WHERE f.flight_date = {TODAY} AND f.flight_status = 'SCHEDULED'))"""))
def flight_delay_risk(spark: SparkSession, sf: str) -> DataFrame:
    return reports.flight_delay_risk(bind(spark, sf), AS_OF, DRIVER_CONGESTION)


def _one(x: str, n: int = 1) -> str:
    return f"round(CAST({x} AS DECIMAL(38, 10)), {n})"


SHARE_SQL = f"""
    SELECT iata_code AS airport_code, airport_name, f.flight_date AS operation_date, strftime(f.flight_date, '%a') AS day_name,
      CASE WHEN month(f.flight_date) IN (12, 1, 2) THEN 'WINTER' WHEN month(f.flight_date) < 6 THEN 'SPRING'
        WHEN month(f.flight_date) < 9 THEN 'SUMMER' ELSE 'AUTUMN' END AS season,
      count(DISTINCT f.flight_event_key) AS total_departures,
      count(*) FILTER (WHERE arrival_delay_min <= 15) AS on_time_flights, {_one(OTP_SQL)} AS otp_percentage,
      {_one('avg(departure_delay_min)')} AS avg_departure_delay, {_one('avg(arrival_delay_min)')} AS avg_arrival_delay,
      count(*) FILTER (WHERE flight_status = 'CANCELLED') AS cancellations, {_one('avg(load_factor_pct)')} AS avg_load_factor,
      {_one('avg(taxi_out_min)')} AS avg_taxi_out, count(*) FILTER (WHERE delay_category = 'WEATHER') AS weather_delays,
      count(*) FILTER (WHERE delay_category = 'ATC') AS atc_delays,
      count(*) FILTER (WHERE delay_category = 'TECHNICAL') AS technical_delays,
      count(*) FILTER (WHERE delay_category = 'AIRPORT') AS airport_delays
    FROM flight f JOIN airport a ON a.airport_key = origin_airport_key
    LEFT JOIN (SELECT flight_event_key, delay_category FROM delayed) d USING (flight_event_key)
    WHERE f.flight_date >= {TODAY} - 90 GROUP BY 1, 2, 3 HAVING count(DISTINCT f.flight_event_key) >= 3"""


@query("airport_share", oracle(
    "airport_code:s airport_name:s operation_date:d day_name:s season:s total_departures:i on_time_flights:r "
    "otp_percentage:r avg_departure_delay:r avg_arrival_delay:r cancellations:r avg_load_factor:r avg_taxi_out:r "
    "weather_delays:r atc_delays:r technical_delays:r airport_delays:r", SHARE_SQL))
def airport_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.airport_share(bind(spark, sf), AS_OF)


@query("airport_share_latest", oracle(
    "airport_code:s operation_date:d total_departures:i otp_percentage:r avg_departure_delay:r",
    f"SELECT * FROM ({SHARE_SQL}) WHERE airport_code = 'NATION_21' ORDER BY operation_date DESC LIMIT 10"))
def airport_share_latest(spark: SparkSession, sf: str) -> DataFrame:
    return reports.airport_share_latest(reports.airport_share(bind(spark, sf), AS_OF), "NATION_21")


BENCHMARK_COLUMNS = (
    "route_type:s route_pair:s month_name:s year:i total_flights:i avg_load_factor:r avg_delay_min:r median_delay:r "
    "p95_delay:r avg_fuel_efficiency:r avg_yield_per_pax:r"
)


def _benchmark_sql(min_group: int) -> str:
    return f"""
    SELECT route_type, origin_iata || '-' || destination_iata AS route_pair, strftime(flight_date, '%b') AS month_name,
      year(flight_date) AS year, count(*) AS total_flights, {_one('avg(load_factor_pct)')} AS avg_load_factor,
      {_one('avg(arrival_delay_min)')} AS avg_delay_min, {_one('quantile_cont(arrival_delay_min, 0.5)')} AS median_delay,
      {_one('quantile_cont(arrival_delay_min, 0.95)')} AS p95_delay,
      {_one('avg(fuel_efficiency_l_per_100km)', 2)} AS avg_fuel_efficiency, {_one('avg(revenue_per_pax)', 2)} AS avg_yield_per_pax
    FROM flight JOIN route USING (route_key) GROUP BY 1, 2, 3, 4 HAVING count(*) >= {min_group}"""


@query("route_benchmarks", oracle(BENCHMARK_COLUMNS, _benchmark_sql(1)))
def route_benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    return reports.route_benchmarks(bind(spark, sf))


@query("route_benchmarks_safe", oracle(BENCHMARK_COLUMNS, _benchmark_sql(3)))
def route_benchmarks_safe(spark: SparkSession, sf: str) -> DataFrame:
    """With the same minimum group size as the airport share."""
    return reports.route_benchmarks(bind(spark, sf), reports.MIN_GROUP)


@query("weather_attribution", oracle(
    "flight_event_key:i flight_number:s scheduled_departure:t departure_delay_min:i weather_condition:s "
    "weather_severity:s wind_speed_kts:r visibility_km:r delay_attribution:s", """
    SELECT f.*, weather_condition, severity AS weather_severity, wind_speed_kts, visibility_km,
      CASE WHEN severity IN ('MODERATE', 'SEVERE') THEN 'WEATHER_CORRELATED' ELSE 'OTHER_CAUSE' END AS delay_attribution
    FROM flight f JOIN airport ON airport_key = origin_airport_key
    LEFT JOIN weather ON airport_iata = iata_code AND observation_time = date_trunc('hour', scheduled_departure)
    WHERE departure_delay_min > 30 ORDER BY departure_delay_min DESC, flight_event_key LIMIT 20"""))
def weather_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weather_attribution(bind(spark, sf))


@query("ops_wide", oracle(
    "flight_number:s flight_date:d day_name:s month_name:s season:s is_weekend:b origin:s origin_airport:s origin_city:s "
    "destination:s dest_airport:s route_type:s distance_km:i aircraft_type:s is_widebody:b flight_status:s "
    "departure_delay_min:i arrival_delay_min:i passengers_booked:i passengers_flown:i seat_capacity:i load_factor:r "
    "revenue_total:r revenue_per_pax:r fuel_consumed_kg:i fuel_efficiency:r punctuality:s", """
    SELECT f.*, c.day_name, c.month_name, c.season, c.is_weekend, o.iata_code AS origin, o.airport_name AS origin_airport,
      o.city AS origin_city, d.iata_code AS destination, d.airport_name AS dest_airport, r.route_type, r.distance_km,
      a.aircraft_type, a.is_widebody, pax_booked AS passengers_booked, pax_flown AS passengers_flown,
      load_factor_pct AS load_factor, fuel_efficiency_l_per_100km AS fuel_efficiency,
      CASE WHEN arrival_delay_min <= 15 THEN 'ON_TIME' ELSE 'DELAYED' END AS punctuality
    FROM flight f JOIN cal c ON c.date_key = f.flight_date_key JOIN airport o ON o.airport_key = origin_airport_key
    JOIN airport d ON d.airport_key = dest_airport_key JOIN route r ON r.route_key = f.route_key
    JOIN aircraft a ON a.aircraft_key = f.aircraft_key"""))
def ops_wide(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ops_wide(bind(spark, sf))


@query("gate_utilisation", oracle("airport_iata:s terminal:s total_gates:i available:i in_use:i utilization_pct:r", """
    SELECT airport_iata, terminal, count(*) AS total_gates, count(*) FILTER (WHERE assignment_status = 'AVAILABLE') AS available,
      count(*) FILTER (WHERE assignment_status <> 'AVAILABLE') AS in_use,
      round(CAST(count(*) FILTER (WHERE assignment_status <> 'AVAILABLE') * 100.0 / count(*) AS DECIMAL(38, 10)), 1) AS utilization_pct
    FROM gate GROUP BY 1, 2"""))
def gate_utilisation(spark: SparkSession, sf: str) -> DataFrame:
    return reports.gate_utilisation(bind(spark, sf).gate)


@query("ops_overview", oracle(
    "flight_number:s route:s flight_status:s departure_delay_min:i delay_severity:s load_factor:s aircraft_type:s", """
    SELECT f.*, o.iata_code || ' -> ' || d.iata_code AS route, CAST(load_factor_pct AS BIGINT) || '%' AS load_factor, aircraft_type,
      CASE WHEN arrival_delay_min > 180 THEN 'SEVERE' WHEN arrival_delay_min > 60 THEN 'SIGNIFICANT'
        WHEN arrival_delay_min > 15 THEN 'MINOR' ELSE 'ON_TIME' END AS delay_severity
    FROM flight f JOIN airport o ON o.airport_key = origin_airport_key JOIN airport d ON d.airport_key = dest_airport_key
    JOIN aircraft USING (aircraft_key) ORDER BY departure_delay_min DESC, flight_event_key LIMIT 10"""))
def ops_overview(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ops_overview(bind(spark, sf))


@query("feedback_preview", oracle("feedback_preview:s sentiment_score:r verdict:s nps_score:i feedback_channel:s", """
    SELECT left(feedback_text, 80) || '...' AS feedback_preview, 0.0 AS sentiment_score, 'NEUTRAL' AS verdict, nps_score,
      feedback_channel FROM feedback ORDER BY feedback_timestamp DESC, feedback_key LIMIT 5"""))
def feedback_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The event texts hold no polar word, so their score is 0 (sentiment has its own query)."""
    return reports.feedback_preview(bind(spark, sf).feedback)


@query("churn_shortlist", oracle(
    "passenger_name:s loyalty_tier:s lifetime_miles:i ytd_segments:i recent_bookings:i avg_sentiment:r major_delays:r "
    "churn_risk:s recommended_action:s", """
    SELECT passenger_name, loyalty_tier, lifetime_miles, ytd_segments, ids AS recent_bookings,
      round(CAST(score AS DECIMAL(38, 10)), 2) AS avg_sentiment, major_delays,
      CASE WHEN ids = 0 AND score < 0 THEN 'CRITICAL' WHEN ids <= 1 OR score < -0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS churn_risk,
      CASE WHEN ids = 0 THEN 'Personal call + 50K bonus miles' WHEN score < -0.3 THEN 'Service recovery + upgrade voucher'
        ELSE 'Re-engagement campaign' END AS recommended_action
    FROM (SELECT first_name || ' ' || last_name AS passenger_name, loyalty_tier, lifetime_miles, ytd_segments,
        count(DISTINCT booking_key) AS ids, coalesce(avg(sentiment_score), 0) AS score,
        count(*) FILTER (WHERE arrival_delay_min > 60) AS major_delays
      FROM passenger p LEFT JOIN booking b ON b.passenger_key = p.passenger_key
      LEFT JOIN (SELECT flight_event_key, arrival_delay_min FROM flight) f ON f.flight_event_key = b.flight_event_key
      LEFT JOIN feedback o ON o.passenger_key = p.passenger_key
      WHERE loyalty_tier IN ('DIAMOND', 'PLATINUM', 'GOLD') GROUP BY 1, 2, 3, 4)
    ORDER BY churn_risk, lifetime_miles DESC, passenger_name, ytd_segments LIMIT 10"""))
def churn_shortlist(spark: SparkSession, sf: str) -> DataFrame:
    return reports.churn_shortlist(bind(spark, sf))


@query("otp_week", oracle("otp_percentage:r", f"""
    SELECT {OTP_SQL} AS otp_percentage FROM flight WHERE flight_date >= {TODAY} - 7 AND flight_status = 'LANDED'"""))
def otp_week(spark: SparkSession, sf: str) -> DataFrame:
    return reports.otp_week(bind(spark, sf), AS_OF)


@query("worst_routes", oracle("route_code:s avg_delay:r flights:i", """
    SELECT route_code, avg(arrival_delay_min) AS avg_delay, count(*) AS flights FROM flight JOIN route USING (route_key)
    GROUP BY 1 ORDER BY avg_delay DESC, route_code LIMIT 10"""))
def worst_routes(spark: SparkSession, sf: str) -> DataFrame:
    return reports.worst_routes(bind(spark, sf))


@query("unhappy_top_tier", oracle("unhappy_members:i", """
    SELECT count(DISTINCT passenger_key) AS unhappy_members FROM feedback JOIN passenger USING (passenger_key)
    WHERE loyalty_tier = 'DIAMOND' AND sentiment_label = 'NEGATIVE'"""))
def unhappy_top_tier(spark: SparkSession, sf: str) -> DataFrame:
    return reports.unhappy_top_tier(bind(spark, sf))


CONTEXT_SQL = f"""
    SELECT 'Total flights: ' || count(*) || ', On-time: ' || count(*) FILTER (WHERE arrival_delay_min <= 15)
      || ', Delayed: ' || count(*) FILTER (WHERE arrival_delay_min > 15)
      || ', Cancelled: ' || count(*) FILTER (WHERE flight_status = 'CANCELLED')
      || ', Avg delay: ' || CAST(round(CAST(avg(arrival_delay_min) AS DECIMAL(20, 10)), 1) AS DECIMAL(20, 1))
      || ' min, Total pax: ' || CAST(sum(coalesce(pax_flown, 0)) AS BIGINT)
      || ', Avg load: ' || CAST(round(CAST(avg(load_factor_pct) AS DECIMAL(20, 10)), 1) AS DECIMAL(20, 1)) || '%' AS context
    FROM flight WHERE flight_date >= {TODAY} - 7"""


@query("ops_context", oracle("context:s", CONTEXT_SQL))
def ops_context(spark: SparkSession, sf: str) -> DataFrame:
    return reports.ops_context(bind(spark, sf), AS_OF)


@query("loyalty_by_type", oracle("activity_type:s transactions:i miles_earned:i miles_redeemed:i miles_expired:i", """
    SELECT activity_type, count(*) AS transactions, sum(miles_earned) AS miles_earned, sum(miles_redeemed) AS miles_redeemed,
      sum(miles_expired) AS miles_expired FROM loyalty GROUP BY 1"""))
def loyalty_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.loyalty_by_type(bind(spark, sf).loyalty)


@query("tier_counts", oracle("loyalty_tier:s passengers:i",
       "SELECT loyalty_tier, count(*) AS passengers FROM passenger GROUP BY 1"))
def tier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.tier_counts(bind(spark, sf).passenger)


@query("historic_delay_cost", oracle("delay_category:s delay_count:i avg_delay:r total_cost:r", """
    SELECT delay_category, count(*) AS delay_count, round(CAST(avg(delay_minutes) AS DECIMAL(38, 10)), 1) AS avg_delay,
      sum(total_cost_impact) AS total_cost
    FROM (SELECT * FROM (SELECT d.*, p.at_day, row_number() OVER (PARTITION BY slot ORDER BY p.at_day DESC, d.flight_event_key DESC) AS rank
        FROM delayed d JOIN (SELECT o_orderkey AS flight_event_key, o_custkey AS slot, o_orderdate AS at_day FROM orders) p
        USING (flight_event_key) WHERE p.at_day <= TIMESTAMP '1999-06-30 09:00:00') WHERE rank = 1) GROUP BY 1"""))
def historic_delay_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Delays as a change log per customer: the newest one each had at an instant of 1999."""
    stamped = driver(spark, sf, "orders").selectExpr(
        "o_orderkey AS flight_event_key", "o_custkey AS slot", "o_orderdate AS changed_at"
    )
    delays = bind(spark, sf).delay.select("flight_event_key", "delay_category", "delay_minutes", "total_cost_impact")
    log = delays.join(stamped, "flight_event_key")
    return reports.historic_delay_cost(log, ["slot"], "changed_at", "1999-06-30 09:00:00")


# ---------------------------------------------------------------- K. alert rules

ALERT_COLUMNS = "rule:s fired:b n:i evidence:s"


@query("alert_critical_delay", oracle(ALERT_COLUMNS, f"""
    SELECT 'CRITICAL_DELAY' AS rule, count(*) > 0 AS fired, count(*) AS n, CAST(max(departure_delay_min) AS VARCHAR) AS evidence
    FROM flight WHERE flight_date = {TODAY} AND flight_status = 'SCHEDULED' AND departure_delay_min > 120"""))
def alert_critical_delay(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_critical_delay(bind(spark, sf), NOW)


@query("alert_churn_spike", oracle(ALERT_COLUMNS, f"""
    SELECT 'CHURN_SPIKE' AS rule, count(*) > 5 AS fired, count(*) AS n, CAST(sum(lifetime_miles) AS VARCHAR) AS evidence
    FROM ({risk_sql(False)}) WHERE churn_risk_level = 'CRITICAL' AND loyalty_tier IN ('DIAMOND', 'PLATINUM')"""))
def alert_churn_spike(spark: SparkSession, sf: str) -> DataFrame:
    """On the safe risk table: the literal one can never hold a CRITICAL row."""
    return alerts.alert_churn_spike(bind(spark, sf), NOW, literal=False)


@query("alert_otp", oracle(ALERT_COLUMNS, f"""
    SELECT 'OTP_BELOW_TARGET' AS rule, coalesce({OTP_SQL} < 75, false) AS fired, count(*) AS n,
      printf('%.2f', {OTP_SQL}) AS evidence
    FROM flight WHERE flight_date = {TODAY} AND flight_status = 'LANDED'"""))
def alert_otp(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_otp(bind(spark, sf), NOW)


SURGE_AT = "2001-07-20 12:00:00"


@query("alert_sentiment", oracle(ALERT_COLUMNS, f"""
    SELECT 'SENTIMENT_SURGE' AS rule, count(*) > 10 AS fired, count(*) AS n, printf('%.4f', min(sentiment_score)) AS evidence
    FROM feedback WHERE feedback_timestamp >= TIMESTAMP '{SURGE_AT}' - INTERVAL 1 HOUR AND sentiment_score < -0.6"""))
def alert_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """As of a busy noon (the window is open to later feedback, as the rule is written)."""
    return alerts.alert_sentiment(bind(spark, sf), SURGE_AT)


@query("alert_fuel", oracle(ALERT_COLUMNS, f"""
    SELECT 'FUEL_ANOMALY' AS rule, count(*) > 0 AS fired, count(*) AS n, CAST(max(fuel_consumed_kg) AS VARCHAR) AS evidence
    FROM flight WHERE flight_date = {TODAY} AND flight_status = 'LANDED'
      AND fuel_consumed_kg > fuel_loaded_kg * 0.92::DOUBLE"""))
def alert_fuel(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_fuel(bind(spark, sf), NOW)
