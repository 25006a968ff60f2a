"""Registered queries: sources, predicates, joins, aggregates, windows, limits, upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import conditions as C
from tarmac.functions.dates import (
    after_days, as_of_ts, between_days, boundary_diff, in_last_days, iso_day,
)
from tarmac.functions.text import sentiment
from tarmac.operators import aggregates as A
from tarmac.operators import joins as J
from tarmac.operators import ordering as O
from tarmac.operators import upsert as U
from tarmac.operators import windows as W
from tarmac.operators.fanout import Branch, FanOut
from tarmac.operators.ranges import stored
from tarmac.plans.gold import columns_of
from tarmac.registry.base import query
from tarmac.registry.binding import AS_OF, FIRST_DAY, LAST_DAY, NOW, bind, driver
from tarmac.registry.oracle import THIS_INSTANT, TODAY, oracle
from tarmac.session import scratch_path
from tarmac.sources import derived, raw, reference, sinks

# ---------------------------------------------------------------- A. sources and sinks


@query("json_landing", oracle("event_id:i user_id:i event_type:s value:r k:i", """
    SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""))
def json_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as JSON lines, landed as VARIANT and projected by path."""
    folder = scratch_path(spark, "landing")
    events = driver(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    events.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    landed = raw.json_landing(spark, folder, "OPS")
    fields = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
    typed = landed.select(*raw.payload("raw_data", fields))
    nested = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return typed.select("event_id", "user_id", "event_type", "value", nested.alias("k"))


@query("csv_source", oracle("c_custkey:i c_name:s c_acctbal:r c_mktsegment:s", """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
      nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer"""))
def csv_source(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through CSV with NULL, null and empty tokens."""
    folder = scratch_path(spark, "csv")
    customer = driver(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_custkey") % 14 == 0, "NULL").when(F.col("c_custkey") % 7 == 0, "null")
        .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    customer.write.csv(folder, header=True)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")
    return raw.csv_source(spark, folder, schema)


@query("json_array_source", oracle("c_custkey:i c_name:s c_acctbal:r", "SELECT c_custkey, c_name, c_acctbal FROM customer"))
def json_array_source(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as files of one JSON array each (500 rows a file)."""
    folder = scratch_path(spark, "arrays")
    chunk = F.floor(F.col("c_custkey") / 500)
    arrays = (
        driver(spark, sf, "customer").groupBy(chunk.alias("chunk"))
        .agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal"))).alias("value"))
    )
    arrays.write.partitionBy("chunk").text(folder)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double")
    return raw.json_array_source(spark, f"{folder}/chunk=*", schema)


@query("parquet_source", oracle("p_type:s parts:i price:r", """
    SELECT p_type, count(*) AS parts, avg(p_retailprice) AS price FROM part WHERE p_size > 20 GROUP BY p_type"""))
def parquet_source(spark: SparkSession, sf: str) -> DataFrame:
    """Three columns of a parquet table, the filter pushed to the scan."""
    part = raw.parquet_source(spark, f"{sf.rstrip('/')}/part.parquet")
    return part.filter(F.col("p_size") > 20).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("parts"), F.avg("p_retailprice").alias("price")
    )


@query("calendar_dim", oracle(
    "date_key:i full_date:d day_of_week:i day_name:s day_of_month:i day_of_year:i week_of_year:i iso_week:i "
    "month_number:i month_name:s quarter:i year:i is_weekend:b is_holiday:b holiday_name:s fiscal_quarter:i "
    "fiscal_year:i season:s flights:i", """
    SELECT cal.*, iso_week AS week_of_year,
      CASE strftime(full_date, '%m-%d') WHEN '01-01' THEN 'New Year''s Day' WHEN '12-25' THEN 'Christmas Day'
        WHEN '12-26' THEN 'Boxing Day' END AS holiday_name,
      strftime(full_date, '%m-%d') IN ('01-01', '12-25', '12-26')
        OR (month_number = 5 AND day_of_month > 24 AND day_of_week = 1) AS is_holiday,
      quarter(full_date - INTERVAL 3 MONTH) AS fiscal_quarter, year(full_date - INTERVAL 3 MONTH) AS fiscal_year,
      coalesce(n, 0) AS flights
    FROM cal LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS n FROM orders GROUP BY 1) USING (full_date)"""))
def calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar with the orders of each day."""
    daily = driver(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = derived.calendar_dim(spark, FIRST_DAY, LAST_DAY)
    return days.join(daily, "full_date", "left").withColumn("flights", F.coalesce("n", F.lit(0))).drop("n")


@query("minute_dim", oracle(
    "time_key:i full_time:s hour_24:i hour_12:i minute:i am_pm:s time_band:s is_peak_hour:b events:i", """
    SELECT h * 100 + m AS time_key, lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') || ':00' AS full_time,
      h AS hour_24, (h + 11) % 12 + 1 AS hour_12, m AS minute, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
      CASE WHEN h <= 4 THEN 'RED_EYE' WHEN h <= 7 THEN 'EARLY_MORNING' WHEN h <= 11 THEN 'MORNING'
        WHEN h <= 13 THEN 'MIDDAY' WHEN h <= 16 THEN 'AFTERNOON' WHEN h <= 20 THEN 'EVENING' ELSE 'NIGHT' END AS time_band,
      h IN (7, 8, 9, 17, 18, 19) AS is_peak_hour, coalesce(n, 0) AS events
    FROM (SELECT i // 60 AS h, i % 60 AS m FROM range(1440) AS minutes(i))
    LEFT JOIN (SELECT hour(ts) AS h, minute(ts) AS m, count(*) AS n FROM events GROUP BY 1, 2) USING (h, m)"""))
def minute_dim(spark: SparkSession, sf: str) -> DataFrame:
    """The minutes of the day with the events of each."""
    per_minute = driver(spark, sf, "events").groupBy(
        (F.hour("ts") * 100 + F.minute("ts")).alias("time_key")
    ).agg(F.count(F.lit(1)).alias("n"))
    out = derived.minute_dim(spark).join(per_minute, "time_key", "left")
    return out.withColumn("events", F.coalesce("n", F.lit(0))).drop("n")


def values_sql(rows: list[tuple], columns: str) -> str:
    """The inline rows as a SQL VALUES table keyed from 1."""

    def literal(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join(f"({n}, {', '.join(literal(v) for v in row)})" for n, row in enumerate(rows, start=1))
    names = ", ".join(c.strip().split(" ")[0] for c in columns.split(","))
    return f"SELECT * FROM (VALUES {body}) AS v(k, {names})"


@query("inline_reference", oracle(
    "iata_delay_code:s delay_category:s is_airline_fault:b route_code:s origin_name:s origin_region:s "
    "registration:s seats:i cabin_name:s flights:i", """
    SELECT iata_delay_code, delay_category, is_airline_fault, route_code, ports.airport_name AS origin_name,
      ports.region AS origin_region, registration, seat_capacity_total AS seats, cabin_name, count(*) AS flights
    FROM orders JOIN reasons ON reasons.k = o_orderkey % 33 + 1 JOIN lines ON lines.k = o_orderkey % 20 + 1
    JOIN ports ON ports.iata_code = lines.origin_iata JOIN fleet ON fleet.k = o_orderkey % 16 + 1
    JOIN cabs ON cabin_class_key = o_orderkey % 4 + 1 GROUP BY ALL""",
    reasons=values_sql(reference.DELAY_REASONS, reference.DELAY_REASON_COLUMNS),
    lines=values_sql(reference.ROUTES, reference.ROUTE_COLUMNS),
    ports=values_sql(reference.AIRPORTS, reference.AIRPORT_COLUMNS),
    fleet=values_sql(reference.AIRCRAFT, reference.AIRCRAFT_COLUMNS),
    cabs=values_sql(reference.CABINS, reference.CABIN_COLUMNS)))
def inline_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined to the five inline tables."""
    key = F.col("o_orderkey")
    keyed = driver(spark, sf, "orders").select(
        (key % 33 + 1).alias("reason"), (key % 20 + 1).alias("line"), (key % 16 + 1).alias("craft"),
        (key % 4 + 1).alias("cabin"),
    ).groupBy("reason", "line", "craft", "cabin").agg(F.count(F.lit(1)).alias("n"))
    wide = J.star_join(keyed, [
        J.Dim(reference.delay_reasons(spark), "delay_reason_key", "reason",
              {c: c for c in ("iata_delay_code", "delay_category", "is_airline_fault")}),
        J.Dim(reference.routes(spark), "route_key", "line", {"route_code": "route_code", "origin": "origin_iata"}),
        J.Dim(reference.airports(spark), "iata_code", "origin",
              {"origin_name": "airport_name", "origin_region": "region"}),
        J.Dim(reference.aircraft(spark), "aircraft_key", "craft",
              {"registration": "registration", "seats": "seat_capacity_total"}),
        J.Dim(reference.cabins(spark), "cabin_class_key", "cabin", {"cabin_name": "cabin_name"}),
    ])
    return wide.groupBy(
        "iata_delay_code", "delay_category", "is_airline_fault", "route_code", "origin_name", "origin_region",
        "registration", "seats", "cabin_name",
    ).agg(F.sum("n").alias("flights"))


@query("schedule_expand", oracle(
    "route_code:s flight_date:d flight_number:s route_type:s flown_on_day:i", f"""
    SELECT route_code, flight_date, 'SP' || lpad(route_key::VARCHAR, 2, '0') || lpad(f::VARCHAR, 2, '0') AS flight_number,
      route_type, coalesce(n, 0) AS flown_on_day
    FROM (SELECT r.*, d.full_date AS flight_date, f FROM route r CROSS JOIN cal d CROSS JOIN range(1, 4) AS t(f)
          WHERE full_date BETWEEN {TODAY} - 90 AND {TODAY} AND (NOT is_seasonal OR season = 'SUMMER')
            AND f <= CASE WHEN route_type IN ('DOMESTIC', 'SHORT_HAUL') THEN 3 WHEN route_type = 'MEDIUM_HAUL' THEN 2 ELSE 1 END)
    LEFT JOIN (SELECT route_key, flight_date, count(*) AS n FROM flight GROUP BY ALL) USING (route_key, flight_date)"""))
def schedule_expand(spark: SparkSession, sf: str) -> DataFrame:
    """90 days of planned departures beside the flights that operated."""
    t = bind(spark, sf)
    first = iso_day(AS_OF, -90)
    flown = t.flights_between(first, AS_OF).groupBy("route_key", "flight_date_key").agg(F.count(F.lit(1)).alias("n"))
    plan = derived.schedule_expand(t.route, date.fromisoformat(first), date.fromisoformat(AS_OF))
    return plan.join(flown, ["route_key", "flight_date_key"], "left").select(
        "route_code", "flight_date", "flight_number", "route_type", F.coalesce("n", F.lit(0)).alias("flown_on_day")
    )


@query("delay_costs", oracle(
    "flight_event_key:i delay_minutes:i pax_affected:i compensation_amount:r rebooking_cost:r hotel_cost:r "
    "meal_voucher_cost:r total_cost_impact:r", """
    SELECT *, compensation_amount + rebooking_cost + hotel_cost + meal_voucher_cost AS total_cost_impact
    FROM (SELECT flight_event_key, departure_delay_min AS delay_minutes, pax_flown AS pax_affected,
        CASE WHEN departure_delay_min >= 180 THEN coalesce(pax_flown, 0) * 400.0 ELSE 0 END AS compensation_amount,
        CASE WHEN departure_delay_min >= 300 THEN 4000.0 ELSE 0 END AS rebooking_cost,
        CASE WHEN departure_delay_min >= 480 THEN 3000.0 ELSE 0 END AS hotel_cost,
        CASE WHEN departure_delay_min >= 120 THEN coalesce(pax_flown, 0) * 12.0 ELSE 0 END AS meal_voucher_cost
      FROM flight WHERE departure_delay_min > 15 AND flight_status <> 'CANCELLED')"""))
def delay_costs(spark: SparkSession, sf: str) -> DataFrame:
    costs = derived.delay_costs(bind(spark, sf).flight, 400.0, 4000.0, 3000.0, 12.0)
    return costs.drop("flight_date_key", "airport_key")


@query("miles_earned", oracle(
    "passenger_key:i activity_source:s activity_date_key:i activity_type:s miles_earned:i miles_redeemed:i "
    "miles_expired:i qualifying_miles:i monetary_value:r booking_key:i", """
    SELECT b.passenger_key, f.flight_number AS activity_source, b.flight_date_key AS activity_date_key,
      'EARN_FLIGHT' AS activity_type,
      round(r.distance_nm * CASE b.cabin_class_key WHEN 1 THEN 3.0 WHEN 2 THEN 2.0 WHEN 3 THEN 1.5 ELSE 1.0 END) AS miles_earned,
      0 AS miles_redeemed, 0 AS miles_expired, r.distance_nm AS qualifying_miles,
      r.distance_nm * 0.01 AS monetary_value, b.booking_key
    FROM booking b JOIN flight f USING (flight_event_key) JOIN route r ON r.route_key = b.route_key
    WHERE b.booking_status = 'FLOWN'"""))
def miles_earned(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    return derived.miles_earned(t.booking, t.flight, t.route)


@query("table_sink", oracle("o_orderstatus:s o_orderpriority:s orders:i value:r", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS orders, sum(floor(o_totalprice)) AS value FROM orders GROUP BY ALL"""))
def table_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A grouped table saved partitioned and read back."""
    totals = driver(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.floor("o_totalprice")).cast("double").alias("value")
    )
    return sinks.table_sink(totals, scratch_path(spark, "table"), ["o_orderstatus"])


@query("append_sink", oracle("event_id:i channel:s currency:s value:r", """
    SELECT event_id, coalesce(nullif(event_type, 'error'), 'UNKNOWN') AS channel, 'GBP' AS currency, value FROM events"""))
def append_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends with a column list and defaults."""
    folder = scratch_path(spark, "append")
    events = driver(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("channel"), "value"
    )
    columns, defaults = ["event_id", "channel", "currency", "value"], {"channel": "UNKNOWN", "currency": "GBP"}
    early = F.col("event_id") % 2 == 0
    sinks.append_sink(events.filter(early), folder, columns, defaults)
    return sinks.append_sink(events.filter(~early), folder, columns, defaults)


@query("clustered_layout", oracle("year:i month:i airport:i flights:i first_key:i last_key:i", f"""
    SELECT year(flight_date) AS year, month(flight_date) AS month, origin_airport_key AS airport, count(*) AS flights,
      min(flight_event_key) AS first_key, max(flight_event_key) AS last_key FROM flight GROUP BY ALL"""))
def clustered_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Flights stored by year, sorted by date and airport, then read back."""
    flights = bind(spark, sf).flight.select(
        "flight_event_key", "flight_date_key", "origin_airport_key",
        F.floor(F.col("flight_date_key") / 10000).cast("int").alias("year"),
    )
    stored = sinks.clustered_layout(
        flights, scratch_path(spark, "clustered"), "year", ["flight_date_key", "origin_airport_key"],
        "flight_event_key", file_rows=100_000,
    )
    month = F.floor(F.col("flight_date_key") / 100) % 100
    return stored.groupBy("year", month.alias("month"), F.col("origin_airport_key").alias("airport")).agg(
        F.count(F.lit(1)).alias("flights"), F.min("flight_event_key").alias("first_key"),
        F.max("flight_event_key").alias("last_key"),
    )


@query("surrogate_key", oracle("c_custkey:i o_orderkey:i o_custkey:i", """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderkey) AS c_custkey,
      o_orderkey, o_custkey FROM orders"""))
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    """Orders numbered on from the largest customer key, by order key."""
    orders = driver(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return W.surrogate_key(driver(spark, sf, "customer"), "c_custkey", orders, ["o_orderkey"])


# ---------------------------------------------------------------- B. predicates


def _flights(spark: SparkSession, sf: str) -> DataFrame:
    return bind(spark, sf).flight


@query("band", oracle("flight_event_key:i severity:s brief:s", """
    SELECT flight_event_key,
      CASE WHEN arrival_delay_min > 180 THEN 'SEVERE' WHEN arrival_delay_min > 60 THEN 'SIGNIFICANT'
        WHEN arrival_delay_min > 15 THEN 'MINOR' WHEN arrival_delay_min > 0 THEN 'SLIGHT' ELSE 'ON_TIME' END AS severity,
      CASE WHEN arrival_delay_min > 180 THEN 'SEVERE' WHEN arrival_delay_min > 60 THEN 'SIGNIFICANT'
        WHEN arrival_delay_min > 15 THEN 'MINOR' ELSE 'ON_TIME' END AS brief FROM flight"""))
def band(spark: SparkSession, sf: str) -> DataFrame:
    late = F.col("arrival_delay_min")
    return _flights(spark, sf).select(
        "flight_event_key", C.delay_severity(late).alias("severity"),
        C.band(late, C.DELAY_SEVERITY_BRIEF, "ON_TIME").alias("brief"),
    )


@query("sentiment_label", oracle("feedback_key:i sentiment_score:r label:s",
       "SELECT feedback_key, sentiment_score, sentiment_label AS label FROM feedback"))
def sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    return bind(spark, sf).feedback.select(
        "feedback_key", "sentiment_score", C.sentiment_label(F.col("sentiment_score")).alias("label")
    )


@query("feedback_priority", oracle("feedback_key:i priority:s action:b", """
    SELECT feedback_key, ai_priority AS priority, sentiment_score < -0.5 OR nps_score <= 3 AS action FROM feedback"""))
def feedback_priority(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("sentiment_score")
    return bind(spark, sf).feedback.select(
        "feedback_key", C.feedback_priority(score).alias("priority"),
        C.action_required(score, F.col("nps_score")).alias("action"),
    )


ANOMALY_SQL = """
    CASE WHEN departure_delay_min > 120 AND flight_status = 'SCHEDULED' THEN 'EXTENDED_GROUND_DELAY'
      WHEN taxi_out_min > 45 THEN 'EXCESSIVE_TAXI' WHEN fuel_consumed_kg > fuel_loaded_kg * 0.95::DOUBLE THEN 'HIGH_FUEL_BURN'
      WHEN load_factor_pct < 30 THEN 'SEVERELY_UNDERBOOKED' WHEN pax_booked > seat_capacity THEN 'OVERBOOKED'
      ELSE 'NORMAL' END AS anomaly_type,
    CASE WHEN departure_delay_min > 180 OR fuel_consumed_kg > fuel_loaded_kg * 0.95::DOUBLE THEN 'CRITICAL'
      WHEN departure_delay_min > 120 OR taxi_out_min > 45 THEN 'HIGH'
      WHEN load_factor_pct < 30 OR pax_booked > seat_capacity THEN 'MEDIUM' ELSE 'LOW' END AS severity"""
ANOMALY_WHERE = """(departure_delay_min > 120 OR taxi_out_min > 45 OR load_factor_pct < 30
      OR fuel_consumed_kg > fuel_loaded_kg * 0.95::DOUBLE OR pax_booked > seat_capacity)"""


@query("anomaly_rules", oracle("flight_event_key:i anomaly_type:s severity:s",
       f"SELECT flight_event_key, {ANOMALY_SQL} FROM flight WHERE {ANOMALY_WHERE}"))
def anomaly_rules(spark: SparkSession, sf: str) -> DataFrame:
    flights = _flights(spark, sf)
    col = columns_of(flights)
    return flights.filter(C.any_anomaly(col)).select(
        "flight_event_key", C.anomaly_type(col).alias("anomaly_type"), C.anomaly_severity(col).alias("severity")
    )


@query("delay_attribution", oracle("flight_event_key:i attribution:s", """
    SELECT flight_event_key, CASE WHEN departure_delay_min > 30 AND severity IN ('MODERATE', 'SEVERE')
      THEN 'WEATHER_CORRELATED' ELSE 'OTHER_CAUSE' END AS attribution
    FROM flight JOIN airport ON origin_airport_key = airport_key
    LEFT JOIN weather ON airport_iata = iata_code AND observation_time = date_trunc('hour', scheduled_departure)"""))
def delay_attribution(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    placed = J.star_join(t.flight, [J.Dim(t.airport, "airport_key", "origin_airport_key", {"origin_iata": "iata_code"})])
    seen = J.hour_bucket_join(
        placed, t.weather, "origin_iata", "scheduled_departure", "airport_iata", "observation_time", ["severity"]
    )
    cause = C.delay_attribution(F.col("departure_delay_min"), F.col("severity"))
    return seen.select("flight_event_key", cause.alias("attribution"))


@query("code_mapping", oracle("loyalty_tier:s tier_level:i passengers:i", """
    SELECT loyalty_tier, coalesce(list_position(['BRONZE', 'SILVER', 'GOLD', 'PLATINUM', 'DIAMOND'], loyalty_tier), 0)
      AS tier_level, count(*) AS passengers FROM passenger GROUP BY ALL"""))
def code_mapping(spark: SparkSession, sf: str) -> DataFrame:
    per_tier = bind(spark, sf).passenger.groupBy("loyalty_tier").agg(F.count(F.lit(1)).alias("passengers"))
    return per_tier.withColumn("tier_level", C.lookup(F.col("loyalty_tier"), C.TIER_LEVEL, 0))


@query("lead_time_category", oracle("category:s bookings:i shortest:i longest:i", """
    SELECT CASE WHEN d = 0 THEN 'SAME_DAY' WHEN d <= 3 THEN '1-3_DAYS' WHEN d <= 7 THEN '4-7_DAYS' WHEN d <= 14
      THEN '8-14_DAYS' WHEN d <= 30 THEN '15-30_DAYS' WHEN d <= 60 THEN '31-60_DAYS' ELSE '61+' END AS category,
      count(*) AS bookings, min(d) AS shortest, max(d) AS longest
    FROM (SELECT (l_orderkey + l_linenumber * 9) % 70 AS d FROM lineitem) GROUP BY 1"""))
def lead_time_category(spark: SparkSession, sf: str) -> DataFrame:
    days = (F.col("l_orderkey") + F.col("l_linenumber") * 9) % 70
    booked = driver(spark, sf, "lineitem").select(days.alias("d"))
    return booked.groupBy(C.lead_time_category(F.col("d")).alias("category")).agg(
        F.count(F.lit(1)).alias("bookings"), F.min("d").alias("shortest"), F.max("d").alias("longest")
    )


@query("rolling_window_filter", oracle("rule:s orders:i", f"""
    SELECT unnest(['from_90', 'around', 'after_15']) AS rule, unnest([
      count(*) FILTER (WHERE d >= {TODAY} - 90), count(*) FILTER (WHERE d BETWEEN {TODAY} - 90 AND {TODAY} - 15),
      count(*) FILTER (WHERE d > {TODAY} - 15)]) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"""))
def rolling_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The three window forms; the widest one is pushed to the scan."""
    orders = driver(spark, sf, "orders")
    first = F.lit(iso_day(AS_OF, -90)).cast("timestamp_ntz")
    recent = orders.filter(F.col("o_orderdate") >= first).select(F.col("o_orderdate").cast("date").alias("d"))
    day = F.col("d")
    rules = {
        "from_90": in_last_days(day, AS_OF, 90), "around": between_days(day, AS_OF, -90, -15),
        "after_15": after_days(day, AS_OF, 15),
    }
    counts = recent.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("orders")) for n in rules]
    return counts.select(F.inline(F.array(*pairs)))


@query("late_departure_flag", oracle("flight_event_key:i minutes_since_scheduled:i is_delayed_departure:b", f"""
    SELECT flight_event_key, date_diff('minute', scheduled_departure, {THIS_INSTANT}) AS minutes_since_scheduled,
      flight_status = 'SCHEDULED' AND scheduled_departure < {THIS_INSTANT} AS is_delayed_departure FROM flight"""))
def late_departure_flag(spark: SparkSession, sf: str) -> DataFrame:
    due, now = F.col("scheduled_departure"), as_of_ts(NOW)
    return _flights(spark, sf).select(
        "flight_event_key", boundary_diff("minute", due, now).alias("minutes_since_scheduled"),
        C.late_departure(F.col("flight_status"), due, now).alias("is_delayed_departure"),
    )


@query("null_guards", oracle("l_orderkey:i lines:i tax_share:r mean_tax:r known_tax:b", """
    SELECT l_orderkey, count(*) AS lines, sum(t) * 1.0 / nullif(sum(CASE WHEN t > 3 THEN 1 ELSE 0 END), 0) AS tax_share,
      coalesce(sum(CASE WHEN t > 0 THEN t END), -1) AS mean_tax, sum(CASE WHEN t > 0 THEN t END) IS NOT NULL AS known_tax
    FROM (SELECT l_orderkey, CAST(round(l_tax * 100) AS BIGINT) AS t FROM lineitem) GROUP BY 1"""))
def null_guards(spark: SparkSession, sf: str) -> DataFrame:
    tax = F.round(F.col("l_tax") * 100).cast("bigint")
    rows = driver(spark, sf, "lineitem").select("l_orderkey", tax.alias("t"))
    positive = F.sum(F.when(F.col("t") > 0, F.col("t")))
    return rows.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), C.ratio(F.sum("t"), F.count_if(F.col("t") > 3)).alias("tax_share"),
        F.coalesce(positive, F.lit(-1)).alias("mean_tax"), positive.isNotNull().alias("known_tax"),
    )


@query("percent_change", oracle("o_orderkey:i pct:r", """
    SELECT o_orderkey, (o_orderkey % 97 - o_orderkey % 13) * 100.0::DOUBLE / nullif(o_orderkey % 13, 0) AS pct FROM orders"""))
def percent_change(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return driver(spark, sf, "orders").select("o_orderkey", C.percent_change(key % 97, key % 13).alias("pct"))


# ---------------------------------------------------------------- C. joins


@query("star_join", oracle("region:s aircraft_type:s route_type:s flights:i revenue:r", """
    SELECT region, aircraft_type, route_type, count(*) AS flights, sum(revenue_total) AS revenue
    FROM flight JOIN airport ON airport_key = origin_airport_key JOIN aircraft USING (aircraft_key)
    JOIN route USING (route_key) GROUP BY ALL"""))
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    wide = J.star_join(t.flight, [
        J.Dim(t.airport, "airport_key", "origin_airport_key", {"region": "region"}),
        J.Dim(t.aircraft, "aircraft_key", "aircraft_key", {"aircraft_type": "aircraft_type"}),
        J.Dim(t.route, "route_key", "route_key", {"route_type": "route_type"}),
    ])
    return wide.groupBy("region", "aircraft_type", "route_type").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("revenue_total").alias("revenue")
    )


@query("role_playing_join", oracle("origin_iata_code:s dest_iata_code:s dest_region:s flights:i", """
    SELECT o.iata_code AS origin_iata_code, d.iata_code AS dest_iata_code, d.region AS dest_region, count(*) AS flights
    FROM flight JOIN airport o ON o.airport_key = origin_airport_key JOIN airport d ON d.airport_key = dest_airport_key
    GROUP BY ALL"""))
def role_playing_join(spark: SparkSession, sf: str) -> DataFrame:
    """Flights between airports, counted on the keys before the names are joined twice."""
    t = bind(spark, sf)
    pairs = t.flight.groupBy("origin_airport_key", "dest_airport_key").agg(F.count(F.lit(1)).alias("flights"))
    roles = {"origin": "origin_airport_key", "dest": "dest_airport_key"}
    named = J.role_playing_join(pairs, t.airport, "airport_key", roles, ["iata_code", "region"])
    return named.select("origin_iata_code", "dest_iata_code", "dest_region", "flights")


@query("left_join_on_filter", oracle("passenger_key:i loyalty_tier:s bookings:i", f"""
    SELECT p.passenger_key, loyalty_tier, count(b.passenger_key) AS bookings FROM passenger p
    LEFT JOIN booking b ON b.passenger_key = p.passenger_key AND flight_date >= {TODAY} - 30 GROUP BY 1, 2"""))
def left_join_on_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every passenger with the bookings flown in the last 30 days (none kept as 0)."""
    t = bind(spark, sf)
    recent = F.col("flight_date_key") >= int(iso_day(AS_OF, -30).replace("-", ""))
    bookings = t.booking.select("passenger_key", "flight_date_key", F.lit(1).alias("hit"))
    joined = J.left_join_on_filter(t.passenger.select("passenger_key", "loyalty_tier"), bookings, ["passenger_key"], recent)
    return joined.groupBy("passenger_key", "loyalty_tier").agg(F.count("hit").alias("bookings"))


@query("scd2_current_join", oracle("loyalty_tier:s feedbacks:i", """
    SELECT loyalty_tier, count(*) AS feedbacks FROM feedback LEFT JOIN passenger USING (passenger_key) GROUP BY 1"""))
def scd2_current_join(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    fact = t.feedback.groupBy("passenger_key").agg(F.count(F.lit(1)).alias("n"))
    joined = J.scd2_current_join(fact, t.passenger, "passenger_key")
    return joined.groupBy("loyalty_tier").agg(F.sum("n").alias("feedbacks"))


@query("hour_bucket_join", oracle("flight_event_key:i weather_condition:s wind_speed_kts:r", """
    SELECT flight_event_key, weather_condition, wind_speed_kts
    FROM flight JOIN airport ON origin_airport_key = airport_key
    LEFT JOIN weather ON airport_iata = iata_code AND observation_time = date_trunc('hour', scheduled_departure)"""))
def hour_bucket_join(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    placed = J.star_join(t.flight, [J.Dim(t.airport, "airport_key", "origin_airport_key", {"origin_iata": "iata_code"})])
    seen = J.hour_bucket_join(
        placed, t.weather, "origin_iata", "scheduled_departure", "airport_iata", "observation_time",
        ["weather_condition", "wind_speed_kts"],
    )
    return seen.select("flight_event_key", "weather_condition", "wind_speed_kts")


@query("cross_join", oracle("s_suppkey:i terminal:s gate_number:s is_widebody:b", """
    SELECT s_suppkey, terminal, terminal || lpad(n::VARCHAR, 2, '0') AS gate_number, n <= 10 AS is_widebody
    FROM supplier, (VALUES ('T2'), ('T5')) AS t(terminal), range(1, 21) AS g(n)"""))
def cross_join(spark: SparkSession, sf: str) -> DataFrame:
    """Gates of every supplier as airport: 2 terminals by 20 numbers."""
    gates = J.grid(driver(spark, sf, "supplier").select("s_suppkey"), {"terminal": ["T2", "T5"], "n": range(1, 21)})
    return gates.select(
        "s_suppkey", "terminal", F.concat("terminal", F.lpad(F.col("n").cast("string"), 2, "0")).alias("gate_number"),
        (F.col("n") <= 10).alias("is_widebody"),
    )


@query("scalar_lookup_subquery", oracle("o_orderkey:i customer_nation:s", """
    SELECT o_orderkey, (SELECT any_value(n_name) FROM customer JOIN nation ON n_nationkey = c_nationkey
      WHERE c_custkey = o_custkey) AS customer_nation FROM orders"""))
def scalar_lookup_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """Two scalar lookups in a row: order to customer, customer to nation."""
    orders = driver(spark, sf, "orders").select("o_orderkey", "o_custkey")
    step = J.unique_lookup(orders, driver(spark, sf, "customer"), "o_custkey", "c_custkey", "c_nationkey", "place")
    named = J.unique_lookup(step, driver(spark, sf, "nation"), "place", "n_nationkey", "n_name", "customer_nation")
    return named.select("o_orderkey", "customer_nation")


@query("correlated_agg_subquery", oracle("flight_event_key:i route_key:i route_otp:r", f"""
    SELECT flight_event_key, route_key, (SELECT count(*) FILTER (WHERE h.arrival_delay_min <= 15) * 100.0::DOUBLE / count(*)
      FROM flight h WHERE h.route_key = f.route_key AND h.flight_date >= {TODAY} - 30) AS route_otp
    FROM flight f WHERE f.flight_date >= {TODAY} - 7"""))
def correlated_agg_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """Flights of the last week with the 30-day on-time share of their route."""
    t = bind(spark, sf)
    share = A.on_time_pct(F.col("arrival_delay_min"))
    week = t.flights_between(iso_day(AS_OF, -7)).select("flight_event_key", "route_key")
    return J.correlated_agg(week, t.flights_between(iso_day(AS_OF, -30)), "route_key", {"route_otp": share})


@query("exists_probe", oracle("fired:b", f"""
    SELECT EXISTS (SELECT 1 FROM flight WHERE departure_delay_min > 120 AND flight_status = 'SCHEDULED'
      AND flight_date >= {TODAY} - 7) AS fired"""))
def exists_probe(spark: SparkSession, sf: str) -> DataFrame:
    late = (F.col("departure_delay_min") > 120) & (F.col("flight_status") == "SCHEDULED")
    return J.exists_probe(bind(spark, sf).flights_between(iso_day(AS_OF, -7)), late)


@query("orphan_check", oracle("feedback_key:i flight_event_key:i", """
    SELECT feedback_key, flight_event_key + 5 AS flight_event_key FROM feedback
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = flight_event_key + 5 AND o_orderstatus <> 'P')"""))
def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    """Feedback whose flight (five keys on) was cancelled or is unknown."""
    t = bind(spark, sf)
    child = t.feedback.select("feedback_key", (F.col("flight_event_key") + 5).alias("flight_event_key"))
    operated = t.flight.filter(F.col("flight_status") != "CANCELLED")
    return J.orphan_check(child, "flight_event_key", operated, "flight_event_key")


@query("multi_fact_fanout", oracle(
    "route_key:i joined_rows:i flights:i revenue:r pax:i avg_rating:r on_time_pct:r safe_revenue:r safe_pax:i", """
    SELECT l.*, safe_revenue, safe_pax FROM
      (SELECT f.route_key, count(*) AS joined_rows, count(DISTINCT f.flight_event_key) AS flights,
         sum(b.total_amount) AS revenue, sum(f.pax_flown) AS pax, avg(o.overall_rating) AS avg_rating,
         count(*) FILTER (WHERE f.arrival_delay_min <= 15) * 100.0::DOUBLE / count(*) AS on_time_pct
       FROM flight f LEFT JOIN booking b ON b.flight_event_key = f.flight_event_key
       LEFT JOIN feedback o ON o.flight_event_key = f.flight_event_key
       LEFT JOIN delayed d ON d.flight_event_key = f.flight_event_key GROUP BY 1) l
    JOIN (SELECT route_key, sum(amount) AS safe_revenue, sum(pax_flown) AS safe_pax
       FROM flight LEFT JOIN (SELECT flight_event_key, sum(total_amount) AS amount FROM booking GROUP BY 1)
       USING (flight_event_key) GROUP BY 1) s USING (route_key)"""))
def multi_fact_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Flights with bookings, feedback and delays: the literal and the safe totals."""
    t = bind(spark, sf)
    branches = [
        Branch("booking", t.booking, {"amount": F.sum("total_amount")}),
        Branch("feedback", t.feedback, {"rating": F.sum("overall_rating"), "ratings": F.count("overall_rating")}),
        Branch("delay", t.delay, {}),
    ]
    f = FanOut(t.flight, "flight_event_key", branches)
    return f.rows.groupBy("route_key").agg(
        f.count_rows().cast("bigint").alias("joined_rows"), F.count(F.lit(1)).alias("flights"),
        f.sum("amount", "booking").alias("revenue"), f.sum("pax_flown").cast("bigint").alias("pax"),
        f.avg_of("rating", "ratings", "feedback").alias("avg_rating"),
        f.share_if(F.col("arrival_delay_min") <= 15).alias("on_time_pct"),
        F.sum("amount").alias("safe_revenue"), F.sum("pax_flown").alias("safe_pax"),
    )


# ---------------------------------------------------------------- D. aggregates


@query("group_multi_agg", oracle("booking_channel:s booking_status:s bookings:i fare:r highest:r lowest:r mean_lead:r", """
    SELECT booking_channel, booking_status, count(*) AS bookings, sum(fare_amount) AS fare, max(total_amount) AS highest,
      min(total_amount) AS lowest, avg(days_before_departure) AS mean_lead FROM booking GROUP BY ALL"""))
def group_multi_agg(spark: SparkSession, sf: str) -> DataFrame:
    return bind(spark, sf).booking.groupBy("booking_channel", "booking_status").agg(
        F.count(F.lit(1)).alias("bookings"), F.sum("fare_amount").alias("fare"), F.max("total_amount").alias("highest"),
        F.min("total_amount").alias("lowest"), F.avg("days_before_departure").alias("mean_lead"),
    )


@query("count_distinct", oracle("l_returnflag:s orders:i parts:i lines:i", """
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) AS lines
    FROM lineitem GROUP BY 1"""))
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct keys spread over (group, key) before the final count, so a hot group is split."""
    return driver(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"),
        F.count(F.lit(1)).alias("lines"),
    )


@query("conditional_count", oracle("origin_airport_key:i cancelled:i severe:i flights:i", """
    SELECT origin_airport_key, count(*) FILTER (WHERE flight_status = 'CANCELLED') AS cancelled,
      count(*) FILTER (WHERE arrival_delay_min > 180) AS severe, count(*) AS flights FROM flight GROUP BY 1"""))
def conditional_count(spark: SparkSession, sf: str) -> DataFrame:
    return _flights(spark, sf).groupBy("origin_airport_key").agg(
        A.conditional_count(F.col("flight_status") == "CANCELLED").alias("cancelled"),
        A.conditional_count(F.col("arrival_delay_min") > 180).alias("severe"), F.count(F.lit(1)).alias("flights"),
    )


@query("on_time_pct", oracle("route_key:i otp:r", """
    SELECT route_key, count(*) FILTER (WHERE arrival_delay_min <= 15) * 100.0::DOUBLE / count(*) AS otp FROM flight GROUP BY 1"""))
def on_time_pct(spark: SparkSession, sf: str) -> DataFrame:
    return _flights(spark, sf).groupBy("route_key").agg(A.on_time_pct(F.col("arrival_delay_min")).alias("otp"))


@query("ratio_of_sums", oracle("route_key:i revenue_per_pax:r", """
    SELECT route_key, sum(revenue_total) / nullif(sum(pax_flown), 0) AS revenue_per_pax FROM flight GROUP BY 1"""))
def ratio_of_sums(spark: SparkSession, sf: str) -> DataFrame:
    share = A.ratio_of_sums(F.col("revenue_total"), F.col("pax_flown"))
    return _flights(spark, sf).groupBy("route_key").agg(share.alias("revenue_per_pax"))


@query("percentile_cont", oracle("l_returnflag:s median:r p95:r", """
    SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median,
      quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY ALL"""))
def percentile_cont(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentiles of a continuous measure over three huge groups."""
    lines = driver(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return A.exact_percentiles(lines, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "p95": 0.95})


@query("string_agg", oracle("flight_status:s parts:s", """
    SELECT flight_status, string_agg(hub || ': ' || n, '; ' ORDER BY hub) AS parts
    FROM (SELECT flight_status, iata_code AS hub, count(*) AS n FROM flight JOIN airport ON airport_key = origin_airport_key
      GROUP BY ALL) GROUP BY 1"""))
def string_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by status and airport, then one text per status (25 parts each)."""
    t = bind(spark, sf)
    counts = t.flight.groupBy("flight_status", "origin_airport_key").agg(F.count(F.lit(1)).alias("n"))
    named = J.star_join(counts, [J.Dim(t.airport, "airport_key", "origin_airport_key", {"hub": "iata_code"})])
    line = F.concat("hub", F.lit(": "), F.col("n").cast("string"))
    return A.string_agg(named.withColumn("line", line), "line", "hub", "parts", keys=["flight_status"])


@query("having_group", oracle("origin_airport_key:i flight_date_key:i flights:i", """
    SELECT origin_airport_key, flight_date_key, count(*) AS flights FROM flight GROUP BY ALL HAVING count(*) >= 3"""))
def having_group(spark: SparkSession, sf: str) -> DataFrame:
    return A.having_group(
        _flights(spark, sf), ["origin_airport_key", "flight_date_key"], {"flights": F.count(F.lit(1))},
        F.col("flights") >= 3,
    )


@query("having_global", oracle("negatives:i lowest:r", """
    SELECT count(*) AS negatives, min(sentiment_score) AS lowest FROM feedback WHERE sentiment_score < -0.6
    HAVING count(*) > 10"""))
def having_global(spark: SparkSession, sf: str) -> DataFrame:
    bad = bind(spark, sf).feedback.filter(F.col("sentiment_score") < -0.6)
    totals = {"negatives": F.count(F.lit(1)), "lowest": F.min("sentiment_score")}
    return A.having_global(bad, totals, F.col("negatives") > 10)


@query("latest_activity", oracle("o_custkey:i last_date:d days_since:i", f"""
    SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_date, {TODAY} - CAST(max(o_orderdate) AS DATE) AS days_since
    FROM orders GROUP BY 1"""))
def latest_activity(spark: SparkSession, sf: str) -> DataFrame:
    orders = driver(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return A.latest_activity(orders, ["o_custkey"], "day", AS_OF)


REPORTED = ("nation", "customer", "part", "supplier", "orders", "lineitem", "events", "documents")


@query("row_count_report", oracle("table_name:s row_count:i", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in REPORTED)))
def row_count_report(spark: SparkSession, sf: str) -> DataFrame:
    return A.row_count_report({n: driver(spark, sf, n) for n in REPORTED})


# ---------------------------------------------------------------- E. windows


@query("row_number_key", oracle("seq:i l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i lines:i", """
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq, *
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) AS lines FROM lineitem GROUP BY ALL)"""))
def row_number_key(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem keys numbered in order."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = driver(spark, sf, "lineitem").groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    return W.row_number_key(lines, keys, "seq")


@query("running_total", oracle("day:d revenue:r cumulative:r", """
    SELECT day, revenue, sum(revenue) OVER (ORDER BY day) AS cumulative
    FROM (SELECT flight_date AS day, sum(revenue_total) AS revenue FROM flight GROUP BY 1)"""))
def running_total(spark: SparkSession, sf: str) -> DataFrame:
    t = bind(spark, sf)
    daily = t.flight.groupBy("flight_date_key").agg(F.sum("revenue_total").alias("revenue"))
    dated = daily.join(t.flight_dates([F.col("full_date").alias("day")]), "flight_date_key").drop("flight_date_key")
    return W.running_total(dated, "day", "revenue", "cumulative")


@query("running_balance", oracle("passenger_key:i activity_date_key:i activity_key:i change:i balance_after:i", """
    SELECT *, sum(change) OVER (PARTITION BY passenger_key ORDER BY activity_date_key, activity_key) AS balance_after
    FROM (SELECT passenger_key, activity_date_key, activity_key,
        sum(miles_earned - miles_redeemed - miles_expired) AS change FROM loyalty GROUP BY ALL)"""))
def running_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Balance after each transaction."""
    activity = bind(spark, sf).loyalty.groupBy("passenger_key", "activity_date_key", "activity_key").agg(
        F.sum("miles_earned").alias("miles_earned"), F.sum("miles_redeemed").alias("miles_redeemed"),
        F.sum("miles_expired").alias("miles_expired"),
    )
    change = F.col("miles_earned") - F.col("miles_redeemed") - F.col("miles_expired")
    return W.running_balance(activity).select(
        "passenger_key", "activity_date_key", "activity_key", change.alias("change"), "balance_after"
    )


# ---------------------------------------------------------------- F. limits and samples, G. set operations


@query("top_k", oracle("o_orderkey:i o_totalprice:r", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""))
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    orders = driver(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(orders, [F.desc("o_totalprice")], ["o_orderkey"], 10)


@query("limit_only", oracle("c_custkey:i c_name:s", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5"))
def limit_only(spark: SparkSession, sf: str) -> DataFrame:
    return O.limit_only(driver(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"], 5)


DRAW_SQL = "CAST('0x' || substr(md5('7:' || {0}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


@query("random_sample", oracle("kind:s key:i", f"""
    (SELECT 'ordered' AS kind, o_orderkey AS key FROM orders ORDER BY {DRAW_SQL.format('o_orderkey')}, o_orderkey LIMIT 500)
    UNION ALL
    SELECT 'bernoulli', event_id FROM events WHERE {DRAW_SQL.format('event_id')} < 0.1::DOUBLE"""))
def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    """500 orders in seeded random order, and a 10 % sample of the events."""
    orders = driver(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    events = driver(spark, sf, "events").select(F.col("event_id").alias("key"))
    parts = {
        "ordered": O.random_sample(orders, "key", 500, 7, portable=True),
        "bernoulli": O.bernoulli_sample(events, "key", 0.1, 7, portable=True),
    }
    return O.union_all(parts, "kind")


@query("union_all", oracle("domain:s entity:s n:i", """
    SELECT 'ORDERS' AS domain, o_orderpriority AS entity, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'EVENTS', event_type, count(*) FROM events GROUP BY ALL"""))
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    def counted(table: str, column: str) -> DataFrame:
        return driver(spark, sf, table).groupBy(F.col(column).alias("entity")).agg(F.count(F.lit(1)).alias("n"))

    return O.union_all({"ORDERS": counted("orders", "o_orderpriority"), "EVENTS": counted("events", "event_type")})


# ---------------------------------------------------------------- H. upserts


LINE_KEYS = ["order_key", "line"]
LINE_SQL = """
    SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
      l_returnflag AS status, l_quantity AS quantity, l_shipdate AS seen, l_linestatus AS side FROM lineitem"""
NEWEST_SQL = """
    SELECT * EXCLUDE (rank) FROM (SELECT *, row_number() OVER (PARTITION BY order_key, line
      ORDER BY seen DESC, part DESC, supp DESC, status DESC, quantity DESC) AS rank FROM {0}) WHERE rank = 1"""


def _lines(spark: SparkSession, sf: str, side: str) -> DataFrame:
    """Lineitems of one status as booking versions: key, time, content."""
    return driver(spark, sf, "lineitem").filter(F.col("l_linestatus") == side).selectExpr(
        "l_orderkey AS order_key", "l_linenumber AS line", "l_partkey AS part", "l_suppkey AS supp",
        "l_returnflag AS status", "l_quantity AS quantity", "l_shipdate AS at",
    )


@query("merge_upsert", oracle("order_key:i line:i part:i status:s quantity:r updated_at:t", f"""
    SELECT order_key, line, coalesce(t.part, s.part) AS part, coalesce(s.status, t.status) AS status,
      coalesce(t.quantity, s.quantity) AS quantity,
      CASE WHEN t.order_key IS NULL OR t.status <> s.status THEN {THIS_INSTANT} ELSE t.seen END AS updated_at
    FROM target t FULL JOIN source s USING (order_key, line)""",
    lines=LINE_SQL, target=NEWEST_SQL.format("(SELECT * FROM lines WHERE side = 'O')"),
    source=NEWEST_SQL.format("(SELECT * FROM lines WHERE side = 'F')")))
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of status F merged into those of status O (keys repeat on both sides)."""
    order = ["at", "part", "supp"]
    target = U.latest_per_key(_lines(spark, sf, "O"), LINE_KEYS, order).withColumnRenamed("at", "updated_at")
    merged = U.merge_upsert(
        target, _lines(spark, sf, "F"), LINE_KEYS, "status", "updated_at", as_of_ts(NOW), order
    )
    return merged.drop("supp")


@query("merge_update_only", oracle(
    "flight_event_key:i flight_status:s arrival_delay_min:i pax_flown:i load_factor_pct:r touched:b", """
    SELECT flight_event_key, coalesce(u.status, flight_status) AS flight_status,
      coalesce(u.delay, arrival_delay_min) AS arrival_delay_min, coalesce(u.pax, pax_flown) AS pax_flown,
      CASE WHEN u.k IS NULL THEN load_factor_pct ELSE coalesce(u.pax, pax_flown) * 100.0::DOUBLE / seat_capacity END AS load_factor_pct,
      u.k IS NOT NULL AS touched
    FROM flight LEFT JOIN updates u ON u.k = flight_event_key""",
    updates="""SELECT event_id AS k, CASE event_type WHEN 'click' THEN 'DEPARTED' WHEN 'error' THEN 'DIVERTED'
      ELSE 'LANDED' END AS status, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 240 END AS delay,
      CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_id % 180 END AS pax FROM events"""))
def merge_update_only(spark: SparkSession, sf: str) -> DataFrame:
    """Events as status messages; missing measures keep the old value."""
    t = bind(spark, sf)
    target = t.flight.select(
        "flight_event_key", "flight_status", "arrival_delay_min", "pax_flown", "seat_capacity", "load_factor_pct",
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    updates = driver(spark, sf, "events").selectExpr(
        "event_id AS flight_event_key", "ts",
        "CASE event_type WHEN 'click' THEN 'DEPARTED' WHEN 'error' THEN 'DIVERTED' ELSE 'LANDED' END AS flight_status",
        "CASE WHEN event_id % 3 <> 0 THEN event_id % 240 END AS arrival_delay_min",
        "CASE WHEN event_id % 2 <> 0 THEN event_id % 180 END AS pax_flown",
    )
    load = F.col("pax_flown") * 100.0 / F.nullif(F.col("seat_capacity"), F.lit(0))
    merged = U.merge_update_only(
        target, updates, ["flight_event_key"], ["flight_status"], ["arrival_delay_min", "pax_flown"],
        {"load_factor_pct": load}, "updated_at", as_of_ts(NOW), ["ts"],
    )
    return merged.withColumn("touched", F.col("updated_at").isNotNull()).drop("updated_at", "seat_capacity")


@query("batch_enrich", oracle("feedback_key:i score:r stamped_now:b", """
    SELECT feedback_key, CASE WHEN feedback_key % 2 = 0 THEN sentiment_score ELSE 0 END AS score,
      feedback_key % 2 = 1 AS stamped_now FROM feedback"""))
def batch_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Only the feedback never processed is scored (its texts hold no polar word: 0)."""
    rows = bind(spark, sf).feedback.select("feedback_key", "feedback_text", "sentiment_score", "processed_at")
    done = U.batch_enrich(
        rows, "feedback_text", "processed_at", {"sentiment_score": sentiment(F.col("feedback_text"))}, as_of_ts(NOW)
    )
    return done.select(
        "feedback_key", F.col("sentiment_score").alias("score"), (F.col("processed_at") == as_of_ts(NOW)).alias("stamped_now")
    )


@query("derived_update", oracle("flight_event_key:i total_cost_impact:r",
       "SELECT flight_event_key, total_cost_impact FROM delayed"))
def derived_update(spark: SparkSession, sf: str) -> DataFrame:
    parts = ["compensation_amount", "rebooking_cost", "hotel_cost", "meal_voucher_cost"]
    delays = bind(spark, sf).delay.withColumn("total_cost_impact", F.lit(0.0))
    return U.derived_update(delays, "total_cost_impact", parts).select("flight_event_key", "total_cost_impact")


@query("keyed_override", oracle("c_custkey:i c_mktsegment:s c_acctbal:r", """
    SELECT c_custkey, coalesce(s_name, c_mktsegment) AS c_mktsegment, coalesce(s_acctbal, c_acctbal) AS c_acctbal
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""))
def keyed_override(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose key is listed among the suppliers take the supplier's values."""
    listed = driver(spark, sf, "supplier").selectExpr(
        "s_suppkey AS c_custkey", "s_name AS c_mktsegment", "s_acctbal AS c_acctbal"
    )
    customers = driver(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return U.keyed_override(customers, listed, "c_custkey")


@query("guarded_update", oracle("assignment_id:i assignment_status:s flight_number:s", """
    SELECT assignment_id, CASE WHEN hit THEN 'ASSIGNED' ELSE assignment_status END AS assignment_status,
      CASE WHEN hit THEN 'TM0101' END AS flight_number
    FROM (SELECT *, gate_number = 'T201' AND assignment_status = 'AVAILABLE' AS hit FROM gate)"""))
def guarded_update(spark: SparkSession, sf: str) -> DataFrame:
    gates = bind(spark, sf).gate.select("assignment_id", "gate_number", "assignment_status", "flight_number")
    done = U.guarded_update(
        gates, F.col("gate_number") == "T201", F.col("assignment_status") == "AVAILABLE",
        {"assignment_status": F.lit("ASSIGNED"), "flight_number": F.lit("TM0101")},
    )
    return done.drop("gate_number")


@query("scd2_apply", oracle(
    "passenger_key:i passenger_id:s loyalty_tier:s effective_from:t effective_to:t is_current:b", """
    SELECT CASE WHEN is_new THEN (SELECT max(c_custkey) FROM customer)
        + row_number() OVER (PARTITION BY is_new ORDER BY passenger_id, effective_from) ELSE c_custkey END AS passenger_key,
      passenger_id, tier AS loyalty_tier, effective_from,
      coalesce(lead(effective_from) OVER w, TIMESTAMP '9999-12-31 23:59:59') AS effective_to,
      lead(effective_from) OVER w IS NULL AS is_current
    FROM (SELECT *, lag(tier) OVER (PARTITION BY c_custkey ORDER BY effective_from) AS before FROM versions)
    WHERE before IS NULL OR before <> tier
    WINDOW w AS (PARTITION BY c_custkey ORDER BY effective_from)""",
    versions="""
      SELECT c_custkey, passenger_id, loyalty_tier AS tier, TIMESTAMP '1994-01-01' AS effective_from, false AS is_new
      FROM (SELECT passenger_key AS c_custkey, passenger_id, loyalty_tier FROM passenger)
      UNION ALL
      SELECT o_custkey, 'P' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), max(CASE o_orderpriority
        WHEN '1-URGENT' THEN 'DIAMOND' WHEN '2-HIGH' THEN 'PLATINUM' WHEN '3-MEDIUM' THEN 'GOLD' ELSE 'SILVER' END),
        o_orderdate, true FROM orders GROUP BY o_custkey, o_orderdate"""))
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Passenger tiers versioned by the priority of their orders."""
    dim = bind(spark, sf).passenger.select(
        "passenger_key", "passenger_id", "loyalty_tier",
        F.lit("1994-01-01").cast("timestamp_ntz").alias("effective_from"), "effective_to", "is_current",
    )
    changes = driver(spark, sf, "orders").selectExpr(
        "concat('P', lpad(CAST(o_custkey AS string), 9, '0')) AS passenger_id", "o_orderdate AS changed_at",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'DIAMOND' WHEN '2-HIGH' THEN 'PLATINUM'
           WHEN '3-MEDIUM' THEN 'GOLD' ELSE 'SILVER' END AS loyalty_tier""",
    )
    return U.scd2_apply(dim, changes, "passenger_id", "changed_at", ["loyalty_tier"], "passenger_key")


@query("scd2_late", oracle("passenger_id:s loyalty_tier:s effective_from:t effective_to:t is_current:b one_key:b", """
    SELECT passenger_id, tier AS loyalty_tier, effective_from, true AS one_key,
      coalesce(lead(effective_from) OVER w, TIMESTAMP '9999-12-31 23:59:59') AS effective_to, lead(effective_from) OVER w IS NULL AS is_current
    FROM (SELECT *, lag(tier) OVER (PARTITION BY c_custkey ORDER BY effective_from) AS before FROM versions)
    WHERE before IS NULL OR before <> tier
    WINDOW w AS (PARTITION BY c_custkey ORDER BY effective_from)""",
    versions="""
      SELECT c_custkey, passenger_id, loyalty_tier AS tier, TIMESTAMP '1994-01-01' AS effective_from
      FROM (SELECT passenger_key AS c_custkey, passenger_id, loyalty_tier FROM passenger)
      UNION ALL
      SELECT o_custkey, 'P' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), max(CASE o_orderpriority
        WHEN '1-URGENT' THEN 'DIAMOND' WHEN '2-HIGH' THEN 'PLATINUM' WHEN '3-MEDIUM' THEN 'GOLD' ELSE 'SILVER' END),
        o_orderdate FROM orders GROUP BY o_custkey, o_orderdate"""))
def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    """The same tiers from changes that arrive in three batches, the latest first; each version has a key of its own."""
    dim = bind(spark, sf).passenger.select(
        "passenger_key", "passenger_id", "loyalty_tier",
        F.lit("1994-01-01").cast("timestamp_ntz").alias("effective_from"), "effective_to", "is_current",
    )
    changes = driver(spark, sf, "orders").selectExpr(
        "concat('P', lpad(CAST(o_custkey AS string), 9, '0')) AS passenger_id", "o_orderdate AS changed_at", "2 - year(o_orderdate) % 3 AS part",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'DIAMOND' WHEN '2-HIGH' THEN 'PLATINUM'
           WHEN '3-MEDIUM' THEN 'GOLD' ELSE 'SILVER' END AS loyalty_tier""",
    )
    for part in range(3):
        arrived = changes.filter(F.col("part") == part)
        dim = stored(U.scd2_apply_late(dim, arrived, changes.filter(F.col("part") < part), "passenger_id", "changed_at", ["loyalty_tier"], "passenger_key"))
    shared = dim.groupBy("passenger_key").agg(F.count("*").alias("rows"))
    return dim.join(shared, "passenger_key").select(
        "passenger_id", "loyalty_tier", "effective_from", "effective_to", "is_current", (F.col("rows") == 1).alias("one_key"))


