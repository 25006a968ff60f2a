"""Building blocks of the oracle SQL (DuckDB dialect).

The driver tables take the same roles as in ``binding``; each role is a common
table expression, and a query text pulls in the ones it names.
"""

from __future__ import annotations

import re

from tarmac.registry.binding import AS_OF, EVENT_SHIFT_DAYS, NOW

YMD = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"


def ymd(x: str) -> str:
    return YMD.format(x)


ROLES = {
    "cal": f"""
        SELECT full_date, {ymd('full_date')} AS date_key, isodow(full_date) AS day_of_week,
          strftime(full_date, '%a') AS day_name, day(full_date) AS day_of_month,
          dayofyear(full_date) AS day_of_year, weekofyear(full_date) AS iso_week,
          month(full_date) AS month_number, strftime(full_date, '%b') AS month_name,
          quarter(full_date) AS quarter, year(full_date) AS year,
          isodow(full_date) > 5 AS is_weekend,
          CASE month(full_date) // 3 WHEN 1 THEN 'SPRING' WHEN 2 THEN 'SUMMER' WHEN 3 THEN 'AUTUMN'
            ELSE CASE WHEN month(full_date) = 12 OR month(full_date) < 3 THEN 'WINTER' END END AS season
        FROM (SELECT CAST(unnest(range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY)) AS DATE) AS full_date)""",
    "airport": """
        SELECT n_nationkey AS airport_key, n_name AS iata_code, n_name || ' Intl' AS airport_name,
          'City ' || n_nationkey AS city, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "aircraft": """
        SELECT p_partkey AS aircraft_key, p_brand || '/' || p_partkey AS registration, p_type AS aircraft_type,
          p_size / 4.0::DOUBLE AS aircraft_age_years, p_size > 25 AS is_widebody FROM part""",
    "passenger": """
        SELECT c_custkey AS passenger_key, 'P' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS passenger_id,
          'First' || (c_custkey % 50) AS first_name, 'Last' || (c_custkey % 70) AS last_name,
          lower(c_mktsegment) || '.' || c_custkey || '@mail.example' AS email,
          '+44' || lpad(CAST(c_custkey * 7919 % 1000000000 AS VARCHAR), 9, '0') AS phone,
          n_name AS home_airport,
          CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BRONZE' WHEN 'BUILDING' THEN 'SILVER'
            WHEN 'FURNITURE' THEN 'GOLD' WHEN 'HOUSEHOLD' THEN 'PLATINUM' WHEN 'MACHINERY' THEN 'DIAMOND'
            ELSE 'NONE' END AS loyalty_tier,
          CAST(floor(c_acctbal) AS BIGINT) * 100 AS lifetime_miles, CAST(floor(c_acctbal) AS BIGINT) AS ytd_miles,
          c_custkey % 40 AS ytd_segments
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "route": """
        SELECT *, distance_km * 54 // 100 AS distance_nm, 60 + distance_km // 12 AS flight_time_mins,
          CASE WHEN distance_km > 8000 THEN 'ULTRA_LONG_HAUL' WHEN distance_km > 4000 THEN 'LONG_HAUL'
            WHEN distance_km > 2000 THEN 'MEDIUM_HAUL' WHEN distance_km > 500 THEN 'SHORT_HAUL'
            ELSE 'DOMESTIC' END AS route_type
        FROM (SELECT n_nationkey AS route_key, n_name || '-' || r_name AS route_code, n_name AS origin_iata,
                r_name AS destination_iata, 300 + n_nationkey * 617 % 9000 AS distance_km,
                n_nationkey % 5 = 0 AS is_seasonal
              FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "flight": f"""
        SELECT *, CASE WHEN flight_status <> 'SCHEDULED' THEN pax_booked - flight_event_key % 9 END AS pax_flown,
          CAST(pax_booked * 100 // seat_capacity AS DOUBLE) AS load_factor_pct,
          floor(o_totalprice) AS revenue_total, floor(o_totalprice / pax_booked) AS revenue_per_pax,
          fuel_loaded_kg * (80 + flight_event_key * 13 % 21) // 100 AS fuel_consumed_kg,
          scheduled_departure + to_minutes(60 + flight_event_key % 300) AS scheduled_arrival,
          CASE WHEN flight_status = 'LANDED'
            THEN scheduled_departure + to_minutes(departure_delay_min) END AS actual_departure,
          CASE WHEN flight_status = 'LANDED'
            THEN scheduled_departure + to_minutes(60 + flight_event_key % 300 + arrival_delay_min) END AS actual_arrival
        FROM (SELECT o_orderkey AS flight_event_key, o_totalprice, CAST(o_orderdate AS DATE) AS flight_date,
            'TM' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS flight_number,
            {ymd('o_orderdate')} AS flight_date_key, o_orderkey % 25 AS origin_airport_key,
            (o_orderkey + o_custkey) % 25 AS dest_airport_key, o_orderkey * 3 % 200 AS aircraft_key,
            o_orderkey * 7 % 25 AS route_key,
            CASE o_orderstatus WHEN 'F' THEN 'LANDED' WHEN 'O' THEN 'SCHEDULED' ELSE 'CANCELLED' END AS flight_status,
            o_orderdate + to_minutes(o_orderkey * 37 % 1440) AS scheduled_departure,
            o_orderkey * 37 % 400 - 60 AS departure_delay_min,
            o_orderkey * 37 % 400 - 60 - o_orderkey % 11 AS arrival_delay_min,
            8 + o_orderkey * 13 % 45 AS taxi_out_min, 60 + o_orderkey * 7 % 260 AS pax_booked,
            180 + o_orderkey % 3 * 60 AS seat_capacity, 10000 + o_orderkey * 11 % 5000 AS fuel_loaded_kg,
            (22 + o_orderkey % 12) / 8.0::DOUBLE AS fuel_efficiency_l_per_100km,
            300 + o_orderkey * 17 % 9000 AS distance_flown_km
          FROM orders)""",
    "booking": f"""
        SELECT *, fare_amount + tax_amount AS total_amount, {ymd('l_shipdate')} AS flight_date_key,
          CAST(l_shipdate AS DATE) AS flight_date,
          CAST(l_shipdate AS DATE) - CAST(days_before_departure AS INTEGER) AS booking_date
        FROM (SELECT l_orderkey * 10 + l_linenumber AS booking_key, l_partkey * 3 // 4 AS passenger_key,
            l_orderkey AS flight_event_key, l_orderkey * 7 % 25 AS route_key, l_shipdate,
            l_linenumber * 9 % 70 AS days_before_departure, l_linenumber % 4 + 1 AS cabin_class_key,
            CASE l_linenumber % 5 WHEN 0 THEN 'WEB' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'CALL_CENTER'
              WHEN 3 THEN 'TRAVEL_AGENT' ELSE 'CORPORATE' END AS booking_channel,
            CASE l_returnflag WHEN 'R' THEN 'CANCELLED' WHEN 'A' THEN 'CONFIRMED' ELSE 'FLOWN' END AS booking_status,
            floor(l_extendedprice * (1 - l_discount)) AS fare_amount, floor(l_extendedprice * l_tax) AS tax_amount,
            floor(l_quantity) * 2 AS ancillary_revenue
          FROM lineitem)""",
    "delayed": """
        SELECT *, compensation_amount + rebooking_cost + hotel_cost + meal_voucher_cost AS total_cost_impact
        FROM (SELECT o_orderkey AS flight_event_key, CAST(o_orderdate AS DATE) AS flight_date,
            o_orderkey % 25 AS airport_key, o_orderkey % 33 + 1 AS delay_reason_key,
            o_orderkey * 37 % 400 - 60 AS delay_minutes,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'WEATHER' WHEN '2-HIGH' THEN 'ATC'
              WHEN '3-MEDIUM' THEN 'TECHNICAL' WHEN '4-NOT SPECIFIED' THEN 'AIRPORT'
              ELSE 'REACTIONARY' END AS delay_category,
            60 + o_orderkey * 7 % 260 - o_orderkey % 9 AS pax_affected,
            floor(o_totalprice / 10) AS compensation_amount, CAST(o_orderkey % 50 * 10 AS DOUBLE) AS rebooking_cost,
            CAST(o_orderkey % 30 * 8 AS DOUBLE) AS hotel_cost, CAST(o_orderkey % 20 * 4 AS DOUBLE) AS meal_voucher_cost
          FROM orders WHERE o_orderkey * 37 % 400 - 60 > 15 AND o_orderstatus <> 'P')""",
    "feedback": f"""
        SELECT *, CASE WHEN sentiment_score > 0.3 THEN 'POSITIVE' WHEN sentiment_score < -0.3 THEN 'NEGATIVE'
            ELSE 'NEUTRAL' END AS sentiment_label,
          CASE WHEN sentiment_score < -0.7 THEN 'CRITICAL' WHEN sentiment_score < -0.5 THEN 'HIGH'
            WHEN sentiment_score < -0.3 THEN 'MEDIUM' ELSE 'LOW' END AS ai_priority
        FROM (SELECT event_id AS feedback_key, user_id AS passenger_key, event_id AS flight_event_key,
            event_id % 25 AS route_key,
            CASE event_type WHEN 'click' THEN 'NPS_SURVEY' WHEN 'error' THEN 'SOCIAL_MEDIA'
              WHEN 'purchase' THEN 'IN_APP' WHEN 'signup' THEN 'EMAIL' ELSE 'CALL_CENTER' END AS feedback_channel,
            ts - INTERVAL {EVENT_SHIFT_DAYS} DAY AS feedback_timestamp, props AS feedback_text,
            event_id * 7 % 11 AS nps_score, 1 + event_id % 5 AS overall_rating,
            greatest(-1.0::DOUBLE, least(1.0::DOUBLE, floor((value - 35) / 35 * 1024) / 1024)) AS sentiment_score
          FROM events)""",
    "weather": f"""
        SELECT n_name AS airport_iata, hour AS observation_time, floor(peak / 8) AS wind_speed_kts,
          CAST(greatest(0, 10 - floor(peak / 50)) AS DOUBLE) AS visibility_km, floor(peak / 20) / 4 AS precipitation_mm,
          CASE WHEN peak > 120 THEN 'SNOW' WHEN peak > 60 THEN 'RAIN' ELSE 'CLEAR' END AS weather_condition,
          CASE WHEN peak > 120 THEN 'SEVERE' WHEN peak > 60 THEN 'MODERATE' WHEN peak > 30 THEN 'MILD'
            ELSE 'NONE' END AS severity, peak > 100 AS is_deicing_required
        FROM (SELECT user_id % 25 AS place, date_trunc('hour', ts - INTERVAL {EVENT_SHIFT_DAYS} DAY) AS hour,
            max(value) AS peak FROM events GROUP BY ALL) JOIN nation ON place = n_nationkey""",
    "loyalty": f"""
        SELECT l_orderkey * 10 + l_linenumber AS activity_key, l_partkey * 3 // 4 AS passenger_key,
          {ymd('l_shipdate')} AS activity_date_key,
          CASE l_returnflag WHEN 'R' THEN 'EARN_FLIGHT' WHEN 'A' THEN 'REDEEM_FLIGHT' ELSE 'EXPIRE' END AS activity_type,
          CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) * 100 ELSE 0 END AS miles_earned,
          CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) * 40 ELSE 0 END AS miles_redeemed,
          CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) * 10 ELSE 0 END AS miles_expired
        FROM lineitem""",
    "gate": """
        SELECT s_suppkey AS assignment_id, n_name AS airport_iata, 'T' || (s_suppkey % 3 + 1) AS terminal,
          'T' || (s_suppkey % 3 + 1) || lpad(CAST(s_suppkey % 20 + 1 AS VARCHAR), 2, '0') AS gate_number,
          CASE WHEN s_suppkey // 20 % 4 = 0 THEN 'ASSIGNED' ELSE 'AVAILABLE' END AS assignment_status
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}
TODAY = f"DATE '{AS_OF}'"
THIS_INSTANT = f"TIMESTAMP '{NOW}'"

# how a result column of each kind is written: s text, i integer, r number, d date, t timestamp, b boolean
KINDS = {
    "s": "{0}",
    "i": "CAST({0} AS BIGINT)",
    "r": "CAST(round(CAST({0} AS DECIMAL(38, 10)), 4) AS DOUBLE)",
    "d": "strftime({0}, '%Y-%m-%d')",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
    "b": "CAST({0} AS BOOLEAN)",
}


def oracle(columns: str, body: str, **ctes: str) -> str:
    """Query text: ``columns`` is ``name:kind ...``; ``ctes`` are extra named parts in order."""
    text = " ".join([body, *ctes.values()])
    named: list[str] = []

    def need(fragment: str) -> None:
        for role in ROLES:
            if role not in named and re.search(rf"\b(FROM|JOIN)\s+{role}\b", fragment):
                named.append(role)

    need(text)
    parts = [f"{r} AS ({ROLES[r]})" for r in named] + [f"{n} AS ({q})" for n, q in ctes.items()]
    chosen = [c.rsplit(":", 1) for c in columns.split()]
    outer = ", ".join(f"{KINDS[kind].format(name)} AS {name}" for name, kind in chosen)
    head = f"WITH {', '.join(parts)} " if parts else ""
    return f"{head}SELECT {outer} FROM ({body}) AS result"
