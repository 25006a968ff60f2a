"""Tables derived by rule: calendar, minutes of the day, schedule, delay costs, miles."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.conditions import lookup
from tarmac.functions.dates import date_key

# month/day holidays and the season of each month.
NAMED_HOLIDAYS = {(1, 1): "New Year's Day", (12, 25): "Christmas Day", (12, 26): "Boxing Day"}
SEASONS = {"WINTER": (12, 1, 2), "SPRING": (3, 4, 5), "SUMMER": (6, 7, 8), "AUTUMN": (9, 10, 11)}
# First hour of each band of the day.
TIME_BANDS = [
    (0, "RED_EYE"), (5, "EARLY_MORNING"), (8, "MORNING"), (12, "MIDDAY"),
    (14, "AFTERNOON"), (17, "EVENING"), (21, "NIGHT"),
]
# Departures a day by haul type, and miles per distance by cabin key.
DAILY_FREQUENCY = {"DOMESTIC": 3, "SHORT_HAUL": 3, "MEDIUM_HAUL": 2, "LONG_HAUL": 1, "ULTRA_LONG_HAUL": 1}
CABIN_MULTIPLE = {1: 3.0, 2: 2.0, 3: 1.5}
MILE_VALUE = 0.01


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date, usable directly on a fact without a join."""
    month, dom, dow = F.month(day), F.dayofmonth(day), F.weekday(day) + 1
    quarter, year = F.quarter(day), F.year(day)
    named = reduce(
        lambda acc, item: F.when((month == item[0][0]) & (dom == item[0][1]), item[1]).otherwise(acc),
        NAMED_HOLIDAYS.items(),
        F.lit(None).cast("string"),
    )
    last_monday_of_may = (month == 5) & (dom >= 25) & (dow == 1)
    season = F.coalesce(*[F.when(month.isin(*months), name) for name, months in SEASONS.items()])
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_week": dow,
        "day_name": F.date_format(day, "EEE"),
        "day_of_month": dom,
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "iso_week": F.weekofyear(day),
        "month_number": month,
        "month_name": F.date_format(day, "MMM"),
        "quarter": quarter,
        "year": year,
        "is_weekend": dow >= 6,
        "is_holiday": named.isNotNull() | last_monday_of_may,
        "holiday_name": named,
        # April starts the fiscal year
        "fiscal_quarter": (quarter + 2) % 4 + 1,
        "fiscal_year": year - F.when(month < 4, 1).otherwise(0),
        "season": season,
    }


def calendar_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range((end - start).days + 1)
    day = F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int"))
    dated = days.select(day.alias("day"))
    return dated.select(*[c.alias(n) for n, c in calendar_columns(F.col("day")).items()])


def minute_columns(minute_of_day: Column) -> dict[str, Column]:
    """Attributes of a minute 0..1439 (whole hours and minutes, key HHMM)."""
    hour = F.floor(minute_of_day / 60).cast("int")
    minute = (minute_of_day % 60).cast("int")
    hour_12 = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    bands = [F.when(hour >= start, name) for start, name in reversed(TIME_BANDS)]
    return {
        "time_key": hour * 100 + minute,
        "full_time": F.format_string("%02d:%02d:00", hour, minute),
        "hour_24": hour,
        "hour_12": hour_12,
        "minute": minute,
        "am_pm": F.when(hour < 12, "AM").otherwise("PM"),
        "time_band": F.coalesce(*bands),
        "is_peak_hour": hour.between(7, 9) | hour.between(17, 19),
    }


def minute_dim(spark: SparkSession) -> DataFrame:
    minutes = spark.range(1440).select(F.col("id").cast("int").alias("m"))
    return minutes.select(*[c.alias(n) for n, c in minute_columns(F.col("m")).items()])


def schedule_expand(routes: DataFrame, start: date, end: date, carrier: str = "SP") -> DataFrame:
    """Every planned departure: route x day x daily frequency.

    The days and the frequency number are exploded from the route row, so only
    departures that exist are produced; there is no product to filter afterwards.
    """
    first, last = (F.lit(d.isoformat()).cast("date") for d in (start, end))
    frequency = lookup(F.col("route_type"), DAILY_FREQUENCY, 0)
    planned = (
        routes.filter(frequency > 0)
        .withColumn("flight_date", F.explode(F.sequence(first, last)))
        .filter(~F.col("is_seasonal") | F.month("flight_date").isin(*SEASONS["SUMMER"]))
        .withColumn("frequency", F.explode(F.sequence(F.lit(1), frequency)))
    )
    number = F.concat(
        F.lit(carrier),
        F.lpad(F.col("route_key").cast("string"), 2, "0"),
        F.lpad(F.col("frequency").cast("string"), 2, "0"),
    )
    return planned.select(
        "route_key", "route_code", "origin_iata", "destination_iata", "route_type",
        date_key(F.col("flight_date")).alias("flight_date_key"),
        "flight_date", "frequency", number.alias("flight_number"),
    )


def delay_costs(
    flights: DataFrame,
    compensation_per_pax: float,
    rebooking: float,
    hotel: float,
    meal_per_pax: float,
) -> DataFrame:
    """Delay fact of flights over 15 minutes late that were not cancelled, with its costs."""
    late = F.col("departure_delay_min")
    pax = F.coalesce(F.col("pax_flown"), F.lit(0))

    def charge(threshold: int, amount: Column | float) -> Column:
        cost = amount if isinstance(amount, Column) else F.lit(amount)
        return F.when(late >= threshold, cost).otherwise(0.0)

    costs = {
        "compensation_amount": charge(180, pax * compensation_per_pax),
        "rebooking_cost": charge(300, rebooking),
        "hotel_cost": charge(480, hotel),
        "meal_voucher_cost": charge(120, pax * meal_per_pax),
    }
    out = flights.filter((late > 15) & (F.col("flight_status") != "CANCELLED")).select(
        "flight_event_key",
        "flight_date_key",
        F.col("origin_airport_key").alias("airport_key"),
        late.alias("delay_minutes"),
        F.col("pax_flown").alias("pax_affected"),
        *[c.alias(n) for n, c in costs.items()],
    )
    total = reduce(lambda a, b: a + b, [F.col(n) for n in costs])
    return out.withColumn("total_cost_impact", total)


def miles_earned(bookings: DataFrame, flights: DataFrame, routes: DataFrame) -> DataFrame:
    """Loyalty earnings of flown bookings: distance times the cabin multiple."""
    multiple = lookup(F.col("cabin_class_key"), CABIN_MULTIPLE, 1.0)
    distance = F.col("distance_nm")
    return (
        bookings.filter(F.col("booking_status") == "FLOWN")
        .select("booking_key", "passenger_key", "flight_event_key", "flight_date_key", "route_key", "cabin_class_key")
        .join(flights.select("flight_event_key", "flight_number"), "flight_event_key")
        .join(routes.select("route_key", "distance_nm"), "route_key")
        .select(
            "booking_key",
            "passenger_key",
            F.col("flight_date_key").alias("activity_date_key"),
            F.lit("EARN_FLIGHT").alias("activity_type"),
            F.col("flight_number").alias("activity_source"),
            F.round(distance * multiple).cast("bigint").alias("miles_earned"),
            F.lit(0).cast("bigint").alias("miles_redeemed"),
            F.lit(0).cast("bigint").alias("miles_expired"),
            distance.cast("bigint").alias("qualifying_miles"),
            F.round(distance * MILE_VALUE, 2).alias("monetary_value"),
        )
    )
