"""The auto-refreshed business tables. Each is (tables, as_of) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import conditions as C
from tarmac.functions.dates import AsOf, as_of_date, as_of_ts, boundary_diff, iso_day, key_days_before, key_to_date
from tarmac.operators.fanout import Branch, FanOut
from tarmac.operators.joins import Dim, star_join
from tarmac.schemas import struct
from tarmac.streaming.incremental import Definition, Detail
from tarmac.tables import Tables, dated_between


def columns_of(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def origin_and_destination(t: Tables) -> list[Dim]:
    """The airport dimension in both its roles."""
    return [
        Dim(t.airport, "airport_key", "origin_airport_key",
            {"origin_iata": "iata_code", "origin_airport": "airport_name", "origin_city": "city"}),
        Dim(t.airport, "airport_key", "dest_airport_key",
            {"dest_iata": "iata_code", "dest_airport": "airport_name"}),
    ]


def flight_status(t: Tables, as_of: AsOf) -> DataFrame:
    """Flights of yesterday, today and tomorrow with delay severity and lateness."""
    flights = t.flights_between(iso_day(as_of, -1), iso_day(as_of, 1)).join(
        t.flight_dates(["full_date"]), "flight_date_key"
    )
    craft = Dim(t.aircraft, "aircraft_key", "aircraft_key",
                {"registration": "registration", "aircraft_type": "aircraft_type"})
    now = as_of_ts(as_of)
    wide = star_join(flights, [*origin_and_destination(t), craft])
    return wide.select(
        "flight_event_key", "flight_number", "flight_date_key", F.col("full_date").alias("flight_date"),
        "flight_status", "origin_airport_key", "origin_iata", "origin_airport",
        "dest_airport_key", "dest_iata", "dest_airport",
        "scheduled_departure", "scheduled_arrival", "actual_departure", "actual_arrival",
        "departure_delay_min", "arrival_delay_min",
        C.delay_severity(F.col("arrival_delay_min")).alias("delay_severity"),
        "pax_booked", "seat_capacity", "load_factor_pct", "registration", "aircraft_type",
        boundary_diff("minute", F.col("scheduled_departure"), now).alias("minutes_since_scheduled"),
        C.late_departure(F.col("flight_status"), F.col("scheduled_departure"), now).alias("is_delayed_departure"),
    )


def booking_experience(t: Tables) -> DataFrame:
    """Bookings with the arrival delay of their flight (null when it has none)."""
    delays = t.flight.select("flight_event_key", "arrival_delay_min")
    return t.booking.join(delays, "flight_event_key", "left")


def booking_count(t: Tables) -> Column:
    """COUNT(DISTINCT booking): a plain count, combined map-side, where the key is known to be unique."""
    return F.count("booking_key") if t.booking_key_unique else F.count_distinct("booking_key")


MAJOR_DELAY = 60


def passenger_risk(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """Churn risk of every current loyalty member.

    ``literal`` keeps the published definition: bookings times feedback weight
    the sums, and the 90-day limit hides older booking dates (so only MEDIUM and
    LOW occur). Without it sums are plain and recency looks at all bookings.
    """
    day = key_to_date(F.col("booking_date_key"))
    recent = F.when(F.col("booking_date_key") >= key_days_before(as_of, 90), day) if literal else day
    bookings = Branch(
        "booking", booking_experience(t), {
            "bookings": booking_count(t),
            "amount": F.sum("total_amount"), "amounts": F.count("total_amount"),
            "last_booking_date": F.max(recent),
            "delay_sum": F.sum("arrival_delay_min"), "delays": F.count("arrival_delay_min"),
            "major": F.count_if(F.col("arrival_delay_min") > MAJOR_DELAY),
        }, key="passenger_key",
    )
    window = F.timestamp_add("DAY", F.lit(-90), as_of_ts(as_of))
    opinions = Branch(
        "feedback", t.feedback.filter(F.col("feedback_timestamp") >= window), {
            "score_sum": F.sum("sentiment_score"), "scores": F.count("sentiment_score"),
            "negative": F.count_if(F.col("sentiment_label") == "NEGATIVE"),
        }, key="passenger_key",
    )
    members = t.passenger.filter(F.col("is_current") & (F.col("loyalty_tier") != "NONE"))
    f = FanOut(members, "passenger_key", [bookings, opinions], literal)
    days = F.datediff(as_of_date(as_of), F.col("last_booking_date"))
    sentiment = C.ratio(F.col("score_sum"), F.col("scores"))
    major = F.coalesce(F.col("major"), F.lit(0)) * f.weight("booking")
    risk = (
        F.when(days > 180, "CRITICAL")
        .when((days > 90) & (sentiment < -0.2), "HIGH")
        .when((days > 60) | (major >= 3), "MEDIUM")
        .otherwise("LOW")
    )
    return f.rows.select(
        "passenger_key", "passenger_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "loyalty_tier", "lifetime_miles", "ytd_miles", "ytd_segments",
        F.coalesce("bookings", F.lit(0)).alias("bookings_last_90d"),
        (F.col("amount") * f.weight("booking")).alias("revenue_last_90d"),
        C.ratio(F.col("amount"), F.col("amounts")).alias("avg_booking_value"),
        "last_booking_date",
        days.alias("days_since_last_booking"),
        sentiment.alias("avg_sentiment_90d"),
        (F.coalesce("negative", F.lit(0)) * f.weight("feedback")).cast("decimal(38,0)").alias("negative_feedback_count"),
        C.ratio(F.col("delay_sum"), F.col("delays")).alias("avg_delay_experienced"),
        major.cast("decimal(38,0)").alias("major_delays_experienced"),
        risk.alias("churn_risk_level"),
        as_of_ts(as_of).alias("scored_at"),
    )


def _branches(t: Tables, first: str | None, delays: bool) -> list[Branch]:
    """Booking, feedback (and delay) totals per flight, pruned by date where possible."""

    def rows(df: DataFrame) -> DataFrame:
        return dated_between(df, "flight_date_key", first, None) if t.facts_carry_flight_date else df

    out = [
        Branch("booking", rows(t.booking), {
            "amount": F.sum("total_amount"), "ancillary": F.sum("ancillary_revenue"),
        }),
        Branch("feedback", rows(t.feedback), {
            "rating_sum": F.sum("overall_rating"), "ratings": F.count("overall_rating"),
            "score_sum": F.sum("sentiment_score"), "scores": F.count("sentiment_score"),
            "nps_sum": F.sum("nps_score"), "npss": F.count("nps_score"),
            "critical": F.count_if(F.col("ai_priority") == "CRITICAL"),
        }),
    ]
    if delays:
        out.append(Branch("delay", rows(t.delay), {"cost": F.sum("total_cost_impact")}))
    return out


def route_performance(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """Route and day KPIs over 365 days."""
    first = iso_day(as_of, -365)
    flights = t.flights_between(first).join(t.flight_dates(["full_date"]), "flight_date_key")
    routes = t.route.select("route_key", "route_code", "origin_iata", "destination_iata", "route_type")
    f = FanOut(flights, "flight_event_key", _branches(t, first, delays=False), literal, prune=True)
    keys = ["route_key", "route_code", "origin_iata", "destination_iata", "route_type", "full_date"]
    cancelled = F.col("flight_status") == "CANCELLED"
    return (
        f.rows.join(routes, "route_key")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("flights_operated"),
            f.sum("pax_flown").alias("total_pax"),
            f.avg("load_factor_pct").alias("avg_load_factor"),
            f.avg("arrival_delay_min").alias("avg_arrival_delay"),
            f.share_if(F.col("arrival_delay_min") <= 15).alias("otp_15min_pct"),
            f.count_if(cancelled).alias("cancellations"),
            f.sum("amount", "booking").alias("total_revenue"),
            C.ratio(f.sum("amount", "booking"), f.sum("pax_flown")).alias("revenue_per_pax"),
            f.sum("ancillary", "booking").alias("total_ancillary"),
            f.avg("fuel_efficiency_l_per_100km").alias("avg_fuel_efficiency"),
            f.avg_of("rating_sum", "ratings", "feedback").alias("avg_customer_rating"),
            f.avg_of("score_sum", "scores", "feedback").alias("avg_sentiment"),
        )
        .withColumnRenamed("full_date", "flight_date")
    )


def ops_anomaly(t: Tables, as_of: AsOf) -> DataFrame:
    """Today's flights that break any operational rule."""
    today = iso_day(as_of)
    flights = t.flights_between(today, today).join(t.flight_dates([]), "flight_date_key")
    col = columns_of(flights)
    origin = Dim(t.airport, "airport_key", "origin_airport_key", {"origin_iata": "iata_code"})
    return star_join(flights.filter(C.any_anomaly(col)), [origin]).select(
        "flight_event_key", "flight_number", "flight_date_key", "origin_airport_key", "origin_iata",
        "scheduled_departure",
        C.anomaly_type(col).alias("anomaly_type"),
        C.anomaly_severity(col).alias("severity"),
        "departure_delay_min", "pax_booked", "seat_capacity",
        as_of_ts(as_of).alias("detected_at"),
    )


def daily_kpi(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """One row a day over the last 7 days and later."""
    return daily_kpi_of(t, t.flights_between(iso_day(as_of, -7)), iso_day(as_of, -7), literal)


def daily_kpi_of(t: Tables, flights: DataFrame, first: str | None, literal: bool = True) -> DataFrame:
    """The daily measures of a given set of flights (whole days)."""
    dated = flights.join(t.flight_dates(["full_date"]), "flight_date_key")
    f = FanOut(dated, "flight_event_key", _branches(t, first, delays=True), literal, prune=True)
    cancelled = F.col("flight_status") == "CANCELLED"
    return (
        f.rows.groupBy("full_date")
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            f.count_if(cancelled).alias("cancelled_flights"),
            f.share_if(F.col("arrival_delay_min") <= 15).alias("otp_pct"),
            f.avg("arrival_delay_min").alias("avg_delay_min"),
            f.sum("pax_flown").alias("total_passengers"),
            f.avg("load_factor_pct").alias("avg_load_factor"),
            f.sum("amount", "booking").alias("total_revenue"),
            f.sum("ancillary", "booking").alias("total_ancillary_revenue"),
            f.sum("cost", "delay").alias("total_delay_cost"),
            f.avg_of("nps_sum", "npss", "feedback").alias("avg_nps"),
            f.avg_of("score_sum", "scores", "feedback").alias("avg_sentiment"),
            f.count("critical", "feedback").alias("critical_feedback_count"),
            f.sum("fuel_consumed_kg").alias("total_fuel_kg"),
            f.avg("fuel_efficiency_l_per_100km").alias("avg_fuel_efficiency"),
        )
        .withColumnRenamed("full_date", "report_date")
    )


def daily_kpi_definition(literal: bool = True) -> Definition:
    """``daily_kpi`` as sums that can be kept up to date; ``daily_kpi_shown`` makes its rows out of them."""
    details = [
        Detail("booking", {"amount": F.col("total_amount"), "ancillary": F.col("ancillary_revenue")}),
        Detail("feedback", {
            "nps_sum": F.col("nps_score"), "npss": F.col("nps_score").isNotNull().cast("int"),
            "score_sum": F.col("sentiment_score"), "scores": F.col("sentiment_score").isNotNull().cast("int"),
            "critical": (F.coalesce(F.col("ai_priority"), F.lit("")) == "CRITICAL").cast("int"),
        }),
        Detail("delay", {"cost": F.col("total_cost_impact")}),
    ]

    def weight(excluding: str | None = None) -> Column:
        product = F.lit(1.0)
        for d in details if literal else []:
            if d.name != excluding:
                product = product * F.greatest(F.col(d.rows), F.lit(1.0))
        return product

    def of(name: str, detail: str) -> Column:
        """A detail total, null for a base row that has no such detail."""
        return F.when(F.col(f"{detail}__rows") > 0, F.col(name) * weight(detail))

    every = weight()
    measured = {n: F.col(n) * every for n in ("arrival_delay_min", "pax_flown", "load_factor_pct", "fuel_consumed_kg", "fuel_efficiency_l_per_100km")}
    counted = {f"{n}_count": F.when(F.col(n).isNotNull(), every) for n in ("arrival_delay_min", "load_factor_pct", "fuel_efficiency_l_per_100km")}
    base = struct(
        "flight_event_key bigint, flight_date_key int, flight_status string, arrival_delay_min double, pax_flown double, "
        "load_factor_pct double, fuel_consumed_kg double, fuel_efficiency_l_per_100km double"
    )
    return Definition("flight_event_key", "flight_date_key", base, details, {
        "weighted": every, "cancelled": F.when(F.col("flight_status") == "CANCELLED", every),
        "on_time": F.when(F.col("arrival_delay_min") <= 15, every), **measured, **counted,
        **{n: of(n, "booking") for n in ("amount", "ancillary")}, "cost": of("cost", "delay"),
        **{n: of(n, "feedback") for n in ("nps_sum", "npss", "score_sum", "scores", "critical")},
    })


def daily_kpi_shown(view: DataFrame) -> DataFrame:
    """The columns of ``daily_kpi`` from the sums of its definition."""
    def per(total: str, count: str) -> Column:
        return F.col(total) / F.nullif(F.col(count), F.lit(0.0))

    whole = lambda c: F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(38,0)")
    return view.select(
        key_to_date(F.col("flight_date_key")).alias("report_date"), F.col("rows").alias("total_flights"),
        whole("cancelled").alias("cancelled_flights"),
        (F.coalesce("on_time", F.lit(0.0)) * 100.0 / F.nullif(F.col("weighted"), F.lit(0.0))).alias("otp_pct"),
        per("arrival_delay_min", "arrival_delay_min_count").alias("avg_delay_min"), F.col("pax_flown").alias("total_passengers"),
        per("load_factor_pct", "load_factor_pct_count").alias("avg_load_factor"), F.col("amount").alias("total_revenue"),
        F.col("ancillary").alias("total_ancillary_revenue"), F.col("cost").alias("total_delay_cost"),
        per("nps_sum", "npss").alias("avg_nps"), per("score_sum", "scores").alias("avg_sentiment"),
        whole("critical").alias("critical_feedback_count"), F.col("fuel_consumed_kg").alias("total_fuel_kg"),
        per("fuel_efficiency_l_per_100km", "fuel_efficiency_l_per_100km_count").alias("avg_fuel_efficiency"),
    )
