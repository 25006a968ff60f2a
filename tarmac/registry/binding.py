"""Driver tables in the role of the airline tables.

Orders play flights, lineitems bookings, customers passengers, nations airports,
parts aircraft, events feedback and hourly weather. Measures the driver tables
lack are integer arithmetic on keys, so another engine gets the same values, and
money is in whole units so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.sources.derived import calendar_dim
from tarmac.tables import Tables

AS_OF = "2001-07-28"
NOW = "2001-07-28 12:00:00"
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)
# events end on 2024-01-30; this shift puts them just before AS_OF
EVENT_SHIFT_DAYS = 8222
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[str, StructType] = {}


def driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once and then given, which saves a job a read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _ymd(ts: str) -> str:
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))"


def airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = driver(spark, sf_dir, "nation"), driver(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS airport_key",
        "n_name AS iata_code",
        "concat(n_name, ' Intl') AS airport_name",
        "concat('City ', n_nationkey) AS city",
        "r_name AS region",
        "CASE WHEN n_nationkey % 8 = 0 THEN 'PRIMARY_HUB' ELSE 'OUTSTATION' END AS hub_type",
    )


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver(spark, sf_dir, "part").selectExpr(
        "p_partkey AS aircraft_key",
        "concat(p_brand, '/', p_partkey) AS registration",
        "p_type AS aircraft_type",
        "100 + p_size * 4 AS seat_capacity_total",
        "p_size / 4.0D AS aircraft_age_years",
        "p_size > 25 AS is_widebody",
    )


def passenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = driver(spark, sf_dir, "customer"), driver(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey AS passenger_key",
        "concat('P', lpad(CAST(c_custkey AS string), 9, '0')) AS passenger_id",
        "concat('First', c_custkey % 50) AS first_name",
        "concat('Last', c_custkey % 70) AS last_name",
        "concat(lower(c_mktsegment), '.', c_custkey, '@mail.example') AS email",
        "concat('+44', lpad(CAST(c_custkey * 7919 % 1000000000 AS string), 9, '0')) AS phone",
        "n_name AS home_airport",
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BRONZE' WHEN 'BUILDING' THEN 'SILVER'
           WHEN 'FURNITURE' THEN 'GOLD' WHEN 'HOUSEHOLD' THEN 'PLATINUM'
           WHEN 'MACHINERY' THEN 'DIAMOND' ELSE 'NONE' END AS loyalty_tier""",
        "CAST(floor(c_acctbal) AS bigint) * 100 AS lifetime_miles",
        "CAST(floor(c_acctbal) AS bigint) AS ytd_miles",
        "CAST(c_custkey % 40 AS int) AS ytd_segments",
        "timestamp_ntz'1995-01-01 00:00:00' AS effective_from",
        "timestamp_ntz'9999-12-31 23:59:59' AS effective_to",
        "true AS is_current",
    )


def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = driver(spark, sf_dir, "nation"), driver(spark, sf_dir, "region")
    base = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS route_key",
        "concat(n_name, '-', r_name) AS route_code",
        "n_name AS origin_iata",
        "r_name AS destination_iata",
        "300 + n_nationkey * 617 % 9000 AS distance_km",
        "n_nationkey % 5 = 0 AS is_seasonal",
    )
    return base.selectExpr(
        "*",
        "distance_km * 54 DIV 100 AS distance_nm",
        "60 + distance_km DIV 12 AS flight_time_mins",
        """CASE WHEN distance_km > 8000 THEN 'ULTRA_LONG_HAUL' WHEN distance_km > 4000 THEN 'LONG_HAUL'
           WHEN distance_km > 2000 THEN 'MEDIUM_HAUL' WHEN distance_km > 500 THEN 'SHORT_HAUL'
           ELSE 'DOMESTIC' END AS route_type""",
    )


def flight(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Orders as flights. Measures are spread by key arithmetic; scheduled ones have no pax flown."""
    orders = driver(spark, sf_dir, "orders")
    if first:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if last:
        day_after = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
        orders = orders.filter(F.col("o_orderdate") < day_after)
    base = orders.selectExpr(
        "o_orderkey AS flight_event_key",
        "o_custkey",
        "o_orderpriority",
        "o_totalprice",
        "concat('TM', lpad(CAST(o_orderkey % 10000 AS string), 4, '0')) AS flight_number",
        f"{_ymd('o_orderdate')} AS flight_date_key",
        "o_orderkey % 25 AS origin_airport_key",
        "(o_orderkey + o_custkey) % 25 AS dest_airport_key",
        "o_orderkey * 3 % 200 AS aircraft_key",
        "o_orderkey * 7 % 25 AS route_key",
        "CASE o_orderstatus WHEN 'F' THEN 'LANDED' WHEN 'O' THEN 'SCHEDULED' ELSE 'CANCELLED' END AS flight_status",
        "timestampadd(MINUTE, o_orderkey * 37 % 1440, o_orderdate) AS scheduled_departure",
        "o_orderkey * 37 % 400 - 60 AS departure_delay_min",
        "o_orderkey * 37 % 400 - 60 - o_orderkey % 11 AS arrival_delay_min",
        "8 + o_orderkey * 13 % 45 AS taxi_out_min",
        "60 + o_orderkey * 7 % 260 AS pax_booked",
        "180 + o_orderkey % 3 * 60 AS seat_capacity",
        "10000 + o_orderkey * 11 % 5000 AS fuel_loaded_kg",
        "(22 + o_orderkey % 12) / 8.0D AS fuel_efficiency_l_per_100km",
        "300 + o_orderkey * 17 % 9000 AS distance_flown_km",
    )
    return base.selectExpr(
        "* EXCEPT (o_custkey, o_orderpriority, o_totalprice)",
        "timestampadd(MINUTE, 60 + flight_event_key % 300, scheduled_departure) AS scheduled_arrival",
        """CASE WHEN flight_status = 'LANDED'
           THEN timestampadd(MINUTE, departure_delay_min, scheduled_departure) END AS actual_departure""",
        """CASE WHEN flight_status = 'LANDED'
           THEN timestampadd(MINUTE, 60 + flight_event_key % 300 + arrival_delay_min, scheduled_departure)
           END AS actual_arrival""",
        "CASE WHEN flight_status <> 'SCHEDULED' THEN pax_booked - flight_event_key % 9 END AS pax_flown",
        "floor(pax_booked * 100 DIV seat_capacity) * 1.0D AS load_factor_pct",
        "floor(o_totalprice) * 1.0D AS revenue_total",
        "floor(o_totalprice / pax_booked) * 1.0D AS revenue_per_pax",
        "fuel_loaded_kg * (80 + flight_event_key * 13 % 21) DIV 100 AS fuel_consumed_kg",
    )


def booking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as bookings of the flight that is their order."""
    base = driver(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS booking_key",
        "l_partkey * 3 DIV 4 AS passenger_key",
        "l_orderkey AS flight_event_key",
        "l_orderkey * 7 % 25 AS route_key",
        "l_shipdate",
        "CAST(l_linenumber * 9 % 70 AS int) AS days_before_departure",
        "l_linenumber % 4 + 1 AS cabin_class_key",
        """CASE l_linenumber % 5 WHEN 0 THEN 'WEB' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'CALL_CENTER'
           WHEN 3 THEN 'TRAVEL_AGENT' ELSE 'CORPORATE' END AS booking_channel""",
        "CASE l_returnflag WHEN 'R' THEN 'CANCELLED' WHEN 'A' THEN 'CONFIRMED' ELSE 'FLOWN' END AS booking_status",
        "floor(l_extendedprice * (1 - l_discount)) * 1.0D AS fare_amount",
        "floor(l_extendedprice * l_tax) * 1.0D AS tax_amount",
        "floor(l_quantity) * 2.0D AS ancillary_revenue",
    )
    return base.selectExpr(
        "* EXCEPT (l_shipdate)",
        "fare_amount + tax_amount AS total_amount",
        f"{_ymd('l_shipdate')} AS flight_date_key",
        f"{_ymd('date_sub(CAST(l_shipdate AS date), days_before_departure)')} AS booking_date_key",
    )


def delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders more than 15 minutes late that were not cancelled."""
    base = driver(spark, sf_dir, "orders").filter("o_orderkey * 37 % 400 - 60 > 15 AND o_orderstatus <> 'P'")
    costs = base.selectExpr(
        "o_orderkey AS delay_key",
        "o_orderkey AS flight_event_key",
        f"{_ymd('o_orderdate')} AS flight_date_key",
        "o_orderkey % 25 AS airport_key",
        "o_orderkey % 33 + 1 AS delay_reason_key",
        "o_orderkey * 37 % 400 - 60 AS delay_minutes",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'WEATHER' WHEN '2-HIGH' THEN 'ATC'
           WHEN '3-MEDIUM' THEN 'TECHNICAL' WHEN '4-NOT SPECIFIED' THEN 'AIRPORT'
           ELSE 'REACTIONARY' END AS delay_category""",
        "60 + o_orderkey * 7 % 260 - o_orderkey % 9 AS pax_affected",
        "floor(o_totalprice / 10) * 1.0D AS compensation_amount",
        "o_orderkey % 50 * 10.0D AS rebooking_cost",
        "o_orderkey % 30 * 8.0D AS hotel_cost",
        "o_orderkey % 20 * 4.0D AS meal_voucher_cost",
    )
    return costs.selectExpr(
        "*", "compensation_amount + rebooking_cost + hotel_cost + meal_voucher_cost AS total_cost_impact"
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feedback; the score is a multiple of 1/1024, so averages are exact."""
    base = driver(spark, sf_dir, "events").selectExpr(
        "event_id AS feedback_key",
        "user_id AS passenger_key",
        "event_id AS flight_event_key",
        "event_id % 25 AS route_key",
        """CASE event_type WHEN 'click' THEN 'NPS_SURVEY' WHEN 'error' THEN 'SOCIAL_MEDIA'
           WHEN 'purchase' THEN 'IN_APP' WHEN 'signup' THEN 'EMAIL' ELSE 'CALL_CENTER' END AS feedback_channel""",
        f"timestampadd(DAY, -{EVENT_SHIFT_DAYS}, ts) AS feedback_timestamp",
        "props AS feedback_text",
        "event_id * 7 % 11 AS nps_score",
        "1 + event_id % 5 AS overall_rating",
        "greatest(-1.0D, least(1.0D, floor((value - 35) / 35 * 1024) / 1024.0D)) AS sentiment_score",
    )
    return base.selectExpr(
        "*",
        f"{_ymd('feedback_timestamp')} AS flight_date_key",
        """CASE WHEN sentiment_score > 0.3 THEN 'POSITIVE' WHEN sentiment_score < -0.3 THEN 'NEGATIVE'
           ELSE 'NEUTRAL' END AS sentiment_label""",
        """CASE WHEN sentiment_score < -0.7 THEN 'CRITICAL' WHEN sentiment_score < -0.5 THEN 'HIGH'
           WHEN sentiment_score < -0.3 THEN 'MEDIUM' ELSE 'LOW' END AS ai_priority""",
        "CASE WHEN feedback_key % 2 = 0 THEN feedback_timestamp END AS processed_at",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per place and hour as hourly observations."""
    hourly = (
        driver(spark, sf_dir, "events")
        .selectExpr(
            "user_id % 25 AS place",
            f"CAST(date_trunc('HOUR', timestampadd(DAY, -{EVENT_SHIFT_DAYS}, ts)) AS timestamp_ntz) AS observation_time",
            "value",
        )
        .groupBy("place", "observation_time")
        .agg({"value": "max"})
        .withColumnRenamed("max(value)", "peak")
    )
    nation = driver(spark, sf_dir, "nation")
    return hourly.join(nation, hourly.place == nation.n_nationkey).selectExpr(
        "n_name AS airport_iata",
        "observation_time",
        "floor(peak / 8) * 1.0D AS wind_speed_kts",
        "greatest(0, 10 - floor(peak / 50)) * 1.0D AS visibility_km",
        "floor(peak / 20) / 4.0D AS precipitation_mm",
        "CASE WHEN peak > 120 THEN 'SNOW' WHEN peak > 60 THEN 'RAIN' ELSE 'CLEAR' END AS weather_condition",
        """CASE WHEN peak > 120 THEN 'SEVERE' WHEN peak > 60 THEN 'MODERATE'
           WHEN peak > 30 THEN 'MILD' ELSE 'NONE' END AS severity""",
        "peak > 100 AS is_deicing_required",
    )


def loyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as miles transactions."""
    return driver(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS activity_key",
        "l_partkey * 3 DIV 4 AS passenger_key",
        f"{_ymd('l_shipdate')} AS activity_date_key",
        "CASE l_returnflag WHEN 'R' THEN 'EARN_FLIGHT' WHEN 'A' THEN 'REDEEM_FLIGHT' ELSE 'EXPIRE' END AS activity_type",
        "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS bigint) * 100 ELSE 0 END AS miles_earned",
        "CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS bigint) * 40 ELSE 0 END AS miles_redeemed",
        "CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS bigint) * 10 ELSE 0 END AS miles_expired",
    )


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as gates of their nation."""
    supplier, nation = driver(spark, sf_dir, "supplier"), driver(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        "s_suppkey AS assignment_id",
        "n_name AS airport_iata",
        "concat('T', s_suppkey % 3 + 1) AS terminal",
        "concat('T', s_suppkey % 3 + 1, lpad(CAST(s_suppkey % 20 + 1 AS string), 2, '0')) AS gate_number",
        "CAST(NULL AS string) AS flight_number",
        "CASE WHEN s_suppkey DIV 20 % 4 = 0 THEN 'ASSIGNED' ELSE 'AVAILABLE' END AS assignment_status",
        "s_suppkey % 20 + 1 <= 10 AS is_widebody_capable",
    )


_BOUND: dict[tuple[int, str], tuple[SparkSession, Tables]] = {}


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """The bound tables; their (lazy) plans are built once a session and folder."""
    key = (id(spark), sf_dir)
    if key not in _BOUND or _BOUND[key][0] is not spark:
        _BOUND[key] = (spark, _bind(spark, sf_dir))
    return _BOUND[key][1]


def _bind(spark: SparkSession, sf_dir: str) -> Tables:
    makers = {
        "airport": airport, "aircraft": aircraft, "passenger": passenger, "route": route, "weather": weather,
        "flight": flight, "booking": booking, "delay": delay, "feedback": feedback, "loyalty": loyalty, "gate": gate,
    }
    return Tables(
        date=lambda: calendar_dim(spark, FIRST_DAY, LAST_DAY),
        flight_scan=lambda first, last: flight(spark, sf_dir, first, last),
        **{name: partial(make, spark, sf_dir) for name, make in makers.items()},
    )
