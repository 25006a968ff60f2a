"""Views and report queries over the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import conditions as C
from tarmac.functions.dates import AsOf, iso_day
from tarmac.functions.scoring import delay_risk
from tarmac.functions.text import sentiment, summarise
from tarmac.operators.aggregates import on_time_pct, string_agg
from tarmac.operators.fanout import Branch, FanOut
from tarmac.operators.joins import Dim, current_rows, hour_bucket_join, star_join
from tarmac.operators.ordering import top_k
from tarmac.operators.snapshot import as_of_snapshot
from tarmac.plans.gold import MAJOR_DELAY, booking_count, booking_experience, origin_and_destination
from tarmac.tables import Tables, dated_between

TOP_TIERS = ("DIAMOND", "PLATINUM", "GOLD")
SHARED_CAUSES = ("WEATHER", "ATC", "TECHNICAL", "AIRPORT")
MIN_GROUP = 3


def rounded(value: Column, digits: int) -> Column:
    """Half-up on the decimal value: binary noise (15.2499999999 for 15.25) is shed first."""
    return F.round(F.round(value, digits + 8), digits)


def full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def critical_feedback(t: Tables) -> DataFrame:
    """Feedback below -0.5 with passenger, flight, route and a one-line summary."""
    bad = t.feedback.filter(F.col("sentiment_score") < -0.5)
    members = current_rows(t.passenger).select("passenger_key", "first_name", "last_name", "loyalty_tier")
    flights = t.flight.select("flight_event_key", "flight_number", "departure_delay_min")
    routes = t.route.select("route_key", "route_code")
    joined = (
        bad.join(members, "passenger_key", "left")
        .join(flights, "flight_event_key", "left")
        .join(routes, "route_key", "left")
    )
    return joined.select(
        "feedback_key", full_name().alias("passenger_name"), "loyalty_tier", "feedback_channel",
        "feedback_timestamp", "feedback_text", summarise(F.col("feedback_text")).alias("ai_summary"),
        "sentiment_score", "nps_score", "flight_number", "departure_delay_min", "route_code",
    )


def sentiment_distribution(feedback: DataFrame) -> DataFrame:
    return (
        feedback.filter(F.col("sentiment_label").isNotNull())
        .groupBy("sentiment_label")
        .agg(
            F.count(F.lit(1)).alias("feedback_count"),
            rounded(F.avg("sentiment_score"), 3).alias("avg_score"),
            rounded(F.avg("nps_score"), 1).alias("avg_nps"),
            rounded(F.avg("overall_rating"), 1).alias("avg_rating"),
        )
    )


def delay_cost_summary(t: Tables, as_of: AsOf | None = None, days: int = 7) -> DataFrame:
    """Delays by category: count, mean, cost, passengers, and the suggested action.

    With ``as_of`` the last ``days`` days, without it all time.
    """
    rows = t.delay
    if as_of is not None:
        rows = dated_between(rows, "flight_date_key", iso_day(as_of, -days), None).join(
            t.flight_dates([]), "flight_date_key"
        )
    return (
        rows.groupBy("delay_category")
        .agg(
            F.count(F.lit(1)).alias("incidents"),
            F.avg("delay_minutes").alias("avg_minutes"),
            F.sum("total_cost_impact").alias("total_cost"),
            F.sum("pax_affected").alias("total_pax"),
        )
        .withColumn("action", C.lookup(F.col("delay_category"), C.CATEGORY_ACTION, "Improve resource planning"))
    )


def flight_delay_risk(
    t: Tables, as_of: AsOf, congestion: Mapping[str, str] = C.CONGESTION, literal: bool = True
) -> DataFrame:
    """Risk score of today's scheduled flights.

    ``literal`` takes the published category rule (fixed on-time share 85 and
    congestion HIGH); otherwise the category follows the score itself.
    """
    today = iso_day(as_of)
    flights = t.flights_between(today, today).filter(F.col("flight_status") == "SCHEDULED")
    history = (
        t.flights_between(iso_day(as_of, -30))
        .groupBy("route_key")
        .agg(on_time_pct(F.col("arrival_delay_min")).alias("route_otp"))
    )
    craft = Dim(t.aircraft, "aircraft_key", "aircraft_key",
                {"aircraft_type": "aircraft_type", "aircraft_age_years": "aircraft_age_years"})
    wide = star_join(
        flights.join(t.flight_dates(["day_of_week"]), "flight_date_key"), [*origin_and_destination(t), craft]
    ).join(history, "route_key", "left")
    wide = hour_bucket_join(
        wide, t.weather, "origin_iata", "scheduled_departure", "airport_iata", "observation_time",
        ["weather_condition", F.col("severity").alias("weather_severity")],
    )
    hour, dow = F.hour("scheduled_departure"), F.col("day_of_week")
    severity, age = F.col("weather_severity"), F.col("aircraft_age_years")
    level = C.lookup(F.col("origin_iata"), congestion, "LOW")
    score = delay_risk(F.col("route_otp"), severity, hour, dow, level, age)
    judged = delay_risk(F.lit(85.0), severity, hour, dow, F.lit("HIGH"), age) if literal else score
    return wide.select(
        "flight_event_key", "flight_number", "scheduled_departure",
        F.col("origin_iata").alias("origin"), F.col("dest_iata").alias("destination"),
        "aircraft_type", "aircraft_age_years", "load_factor_pct", "weather_condition", "weather_severity",
        score.alias("delay_risk_score"),
        C.band(judged, [(70, "HIGH"), (40, "MEDIUM")], "LOW").alias("risk_category"),
    )


def airport_share(t: Tables, as_of: AsOf, literal: bool = True) -> DataFrame:
    """Airport and day metrics of 90 days for partners; groups under 3 flights are withheld."""
    first = iso_day(as_of, -90)
    delays = dated_between(t.delay, "flight_date_key", first, None) if t.facts_carry_flight_date else t.delay
    causes = {
        f"{cause.lower()}_n": F.count_if(F.col("delay_category") == cause) for cause in SHARED_CAUSES
    }
    dated = t.flights_between(first).join(t.flight_dates(["full_date", "day_name", "season"]), "flight_date_key")
    f = FanOut(dated, "flight_event_key", [Branch("delay", delays, causes)], literal, prune=True)
    origin = Dim(t.airport, "airport_key", "origin_airport_key",
                 {"airport_code": "iata_code", "airport_name": "airport_name"})
    on_time = F.col("arrival_delay_min") <= 15
    return (
        star_join(f.rows, [origin])
        .groupBy("airport_code", "airport_name", F.col("full_date").alias("operation_date"), "day_name", "season")
        .agg(
            F.count(F.lit(1)).alias("total_departures"),
            f.count_if(on_time).alias("on_time_flights"),
            rounded(f.share_if(on_time), 1).alias("otp_percentage"),
            rounded(f.avg("departure_delay_min"), 1).alias("avg_departure_delay"),
            rounded(f.avg("arrival_delay_min"), 1).alias("avg_arrival_delay"),
            f.count_if(F.col("flight_status") == "CANCELLED").alias("cancellations"),
            rounded(f.avg("load_factor_pct"), 1).alias("avg_load_factor"),
            rounded(f.avg("taxi_out_min"), 1).alias("avg_taxi_out"),
            *[f.count(f"{cause.lower()}_n", "delay").alias(f"{cause.lower()}_delays") for cause in SHARED_CAUSES],
        )
        .filter(F.col("total_departures") >= MIN_GROUP)
    )


def airport_share_latest(share: DataFrame, airport: str, days: int = 10) -> DataFrame:
    rows = share.filter(F.col("airport_code") == airport).select(
        "airport_code", "operation_date", "total_departures", "otp_percentage", "avg_departure_delay"
    )
    return top_k(rows, [F.desc("operation_date")], [], days)


def route_benchmarks(t: Tables, min_group: int = 1) -> DataFrame:
    """Route and month benchmarks with exact median and p95 delay.

    Delays are whole minutes, so a group's distinct values (all the exact
    percentile keeps) number a few thousand however many flights it has.
    ``min_group`` withholds small groups, as the airport share does.
    """
    delay = F.col("arrival_delay_min")
    return (
        t.flight.join(t.flight_dates(["month_name", "year"]), "flight_date_key")
        .join(t.route.select("route_key", "route_type", "origin_iata", "destination_iata"), "route_key")
        .groupBy("route_type", "origin_iata", "destination_iata", "month_name", "year")
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            rounded(F.avg("load_factor_pct"), 1).alias("avg_load_factor"),
            rounded(F.avg(delay), 1).alias("avg_delay_min"),
            rounded(F.percentile(delay, 0.5), 1).alias("median_delay"),
            rounded(F.percentile(delay, 0.95), 1).alias("p95_delay"),
            rounded(F.avg("fuel_efficiency_l_per_100km"), 2).alias("avg_fuel_efficiency"),
            rounded(F.avg("revenue_per_pax"), 2).alias("avg_yield_per_pax"),
        )
        .filter(F.col("total_flights") >= min_group)
        .select(
            "route_type", F.concat("origin_iata", F.lit("-"), "destination_iata").alias("route_pair"),
            "month_name", "year", "total_flights", "avg_load_factor", "avg_delay_min", "median_delay",
            "p95_delay", "avg_fuel_efficiency", "avg_yield_per_pax",
        )
    )


def weather_attribution(t: Tables, k: int = 20) -> DataFrame:
    """The k longest departure delays with the weather of their hour.

    A LEFT JOIN gives every flight at least one row, so the k longest delays are
    picked before the weather is joined: only k rows take part in that join.
    """
    late = t.flight.filter(F.col("departure_delay_min") > 30).select(
        "flight_event_key", "flight_number", "scheduled_departure", "departure_delay_min", "origin_airport_key"
    )
    placed = star_join(late, [Dim(t.airport, "airport_key", "origin_airport_key", {"origin_iata": "iata_code"})])
    order = [F.desc("departure_delay_min")]
    worst = top_k(placed, order, ["flight_event_key"], k)
    observed = hour_bucket_join(
        worst, t.weather, "origin_iata", "scheduled_departure", "airport_iata", "observation_time",
        ["weather_condition", F.col("severity").alias("weather_severity"), "wind_speed_kts", "visibility_km"],
    )
    cause = C.delay_attribution(F.col("departure_delay_min"), F.col("weather_severity"))
    return top_k(
        observed.select(
            "flight_event_key", "flight_number", "scheduled_departure", "departure_delay_min",
            "weather_condition", "weather_severity", "wind_speed_kts", "visibility_km",
            cause.alias("delay_attribution"),
        ),
        order, ["flight_event_key", "weather_condition"], k,
    )


def ops_wide(t: Tables) -> DataFrame:
    """Denormalised flight view, one row per flight."""
    dated = t.flight.join(
        t.flight_dates(["full_date", "day_name", "month_name", "season", "is_weekend"]), "flight_date_key"
    )
    dims = [
        *origin_and_destination(t),
        Dim(t.route, "route_key", "route_key", {"route_type": "route_type", "distance_km": "distance_km"}),
        Dim(t.aircraft, "aircraft_key", "aircraft_key",
            {"aircraft_type": "aircraft_type", "is_widebody": "is_widebody"}),
    ]
    late = F.when(F.col("arrival_delay_min") <= 15, "ON_TIME").otherwise("DELAYED")
    return star_join(dated, dims).select(
        "flight_number", F.col("full_date").alias("flight_date"), "day_name", "month_name", "season", "is_weekend",
        F.col("origin_iata").alias("origin"), "origin_airport", "origin_city",
        F.col("dest_iata").alias("destination"), "dest_airport", "route_type", "distance_km",
        "aircraft_type", "is_widebody", "flight_status", "departure_delay_min", "arrival_delay_min",
        F.col("pax_booked").alias("passengers_booked"), F.col("pax_flown").alias("passengers_flown"),
        "seat_capacity", F.col("load_factor_pct").alias("load_factor"), "revenue_total", "revenue_per_pax",
        "fuel_consumed_kg", F.col("fuel_efficiency_l_per_100km").alias("fuel_efficiency"),
        late.alias("punctuality"),
    )


def gate_utilisation(gate: DataFrame) -> DataFrame:
    free = F.col("assignment_status") == "AVAILABLE"
    return gate.groupBy("airport_iata", "terminal").agg(
        F.count(F.lit(1)).alias("total_gates"),
        F.count_if(free).alias("available"),
        F.count_if(~free).alias("in_use"),
        F.round(F.count_if(~free) * 100.0 / F.count(F.lit(1)), 1).alias("utilization_pct"),
    )


def ops_overview(t: Tables, k: int = 10) -> DataFrame:
    """The k most delayed departures."""
    craft = Dim(t.aircraft, "aircraft_key", "aircraft_key", {"aircraft_type": "aircraft_type"})
    flights = t.flight.select(
        "flight_event_key", "flight_number", "flight_status", "departure_delay_min", "arrival_delay_min",
        "load_factor_pct", "origin_airport_key", "dest_airport_key", "aircraft_key",
    )
    wide = star_join(flights, [*origin_and_destination(t), craft])
    worst = top_k(wide, [F.desc("departure_delay_min")], ["flight_event_key"], k)
    return worst.select(
        "flight_number", F.concat("origin_iata", F.lit(" -> "), "dest_iata").alias("route"), "flight_status",
        "departure_delay_min",
        C.band(F.col("arrival_delay_min"), C.DELAY_SEVERITY_BRIEF, "ON_TIME").alias("delay_severity"),
        F.concat(F.col("load_factor_pct").cast("decimal(10,0)").cast("string"), F.lit("%")).alias("load_factor"),
        "aircraft_type",
    )


def feedback_preview(feedback: DataFrame, k: int = 5) -> DataFrame:
    """The newest k texts, cut for display, scored on the whole text."""
    newest = top_k(
        feedback.filter(F.col("feedback_text").isNotNull()), [F.desc("feedback_timestamp")], ["feedback_key"], k
    )
    score = sentiment(F.col("feedback_text"))
    return newest.select(
        F.concat(F.left("feedback_text", F.lit(80)), F.lit("...")).alias("feedback_preview"),
        score.alias("sentiment_score"), C.sentiment_label(score).alias("verdict"),
        "nps_score", "feedback_channel",
    )


def churn_shortlist(t: Tables, k: int = 10, literal: bool = True) -> DataFrame:
    """High-tier members by risk with a recommended action.

    ``literal`` groups by name and status, merging namesakes, and weights delays
    by feedback rows; otherwise there is one unweighted row per passenger.
    """
    members = current_rows(t.passenger).filter(F.col("loyalty_tier").isin(*TOP_TIERS))
    bookings = Branch("booking", booking_experience(t), {
        "ids": booking_count(t),
        "major": F.count_if(F.col("arrival_delay_min") > MAJOR_DELAY),
    }, key="passenger_key")
    opinions = Branch("feedback", t.feedback, {
        "score_sum": F.sum("sentiment_score"), "scores": F.count("sentiment_score"),
    }, key="passenger_key")
    f = FanOut(members, "passenger_key", [bookings, opinions], literal)
    keys = ["first_name", "last_name", "loyalty_tier", "lifetime_miles", "ytd_segments"]
    grouped = f.rows.groupBy(*keys, *([] if literal else ["passenger_key"])).agg(
        # a booking belongs to one passenger, so distinct counts of namesakes add up
        F.coalesce(F.sum("ids"), F.lit(0)).alias("recent_bookings"),
        F.coalesce(f.avg_of("score_sum", "scores", "feedback"), F.lit(0.0)).alias("mean_score"),
        f.count("major", "booking").alias("major_delays"),
    )
    none, mean = F.col("recent_bookings") == 0, F.col("mean_score")
    risk = (
        F.when(none & (mean < 0), "CRITICAL")
        .when((F.col("recent_bookings") <= 1) | (mean < -0.3), "HIGH")
        .otherwise("MEDIUM")
    )
    action = (
        F.when(none, "Personal call + 50K bonus miles")
        .when(mean < -0.3, "Service recovery + upgrade voucher")
        .otherwise("Re-engagement campaign")
    )
    rows = grouped.select(
        full_name().alias("passenger_name"), "loyalty_tier", "lifetime_miles", "ytd_segments", "recent_bookings",
        F.round(mean, 2).alias("avg_sentiment"), "major_delays",
        risk.alias("churn_risk"), action.alias("recommended_action"),
    )
    return top_k(rows, [F.asc("churn_risk"), F.desc("lifetime_miles")], ["passenger_name", "ytd_segments"], k)


def otp_week(t: Tables, as_of: AsOf) -> DataFrame:
    """On-time share of landed flights in the last 7 days."""
    landed = t.flights_between(iso_day(as_of, -7)).filter(F.col("flight_status") == "LANDED")
    return landed.agg(on_time_pct(F.col("arrival_delay_min")).alias("otp_percentage"))


def worst_routes(t: Tables, k: int = 10) -> DataFrame:
    """Routes by mean delay: aggregated on the key first, named after."""
    per_route = t.flight.groupBy("route_key").agg(
        F.avg("arrival_delay_min").alias("avg_delay"), F.count(F.lit(1)).alias("flights")
    )
    named = per_route.join(t.route.select("route_key", "route_code"), "route_key")
    return top_k(named.drop("route_key"), [F.desc("avg_delay")], ["route_code"], k)


def unhappy_top_tier(t: Tables, tier: str = "DIAMOND") -> DataFrame:
    members = current_rows(t.passenger).filter(F.col("loyalty_tier") == tier).select("passenger_key")
    unhappy = t.feedback.filter(F.col("sentiment_label") == "NEGATIVE").select("passenger_key").distinct()
    return unhappy.join(members, "passenger_key").agg(F.count_distinct("passenger_key").alias("unhappy_members"))


def ops_context(t: Tables, as_of: AsOf) -> DataFrame:
    """The last 7 days in one line of text."""
    late = F.col("arrival_delay_min")

    def text(value: Column) -> Column:
        return value.cast("string")

    def one_decimal(value: Column) -> Column:
        return F.format_string("%.1f", F.round(value, 1))

    totals = t.flights_between(iso_day(as_of, -7)).agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(late <= 15).alias("on_time"),
        F.count_if(late > 15).alias("delayed"),
        F.count_if(F.col("flight_status") == "CANCELLED").alias("cancelled"),
        F.avg(late).alias("delay"),
        F.sum(F.coalesce("pax_flown", F.lit(0))).alias("pax"),
        F.avg("load_factor_pct").alias("load"),
    )
    parts = [
        ("Total flights: ", text(F.col("flights"))), (", On-time: ", text(F.col("on_time"))),
        (", Delayed: ", text(F.col("delayed"))), (", Cancelled: ", text(F.col("cancelled"))),
        (", Avg delay: ", one_decimal(F.col("delay"))), (" min, Total pax: ", text(F.col("pax"))),
        (", Avg load: ", one_decimal(F.col("load"))), ("%", F.lit("")),
    ]
    return totals.select(F.concat(*[c for label, value in parts for c in (F.lit(label), value)]).alias("context"))


def loyalty_by_type(loyalty: DataFrame) -> DataFrame:
    return loyalty.groupBy("activity_type").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("miles_earned").alias("miles_earned"),
        F.sum("miles_redeemed").alias("miles_redeemed"),
        F.sum("miles_expired").alias("miles_expired"),
    )


def tier_counts(passenger: DataFrame) -> DataFrame:
    return current_rows(passenger).groupBy("loyalty_tier").agg(F.count(F.lit(1)).alias("passengers"))


def historic_delay_cost(log: DataFrame, keys: Sequence[str], ts: str, at: AsOf) -> DataFrame:
    """Delay cost by category as the table stood at an instant."""
    return (
        as_of_snapshot(log, keys, ts, at)
        .groupBy("delay_category")
        .agg(
            F.count(F.lit(1)).alias("delay_count"),
            rounded(F.avg("delay_minutes"), 1).alias("avg_delay"),
            F.round(F.sum("total_cost_impact"), 2).alias("total_cost"),
        )
    )


def delay_briefing(t: Tables, as_of: AsOf) -> DataFrame:
    """The 7-day delay summary as one text, a category per part."""
    summary = delay_cost_summary(t, as_of)
    line = F.concat(
        "delay_category", F.lit(": "), F.col("incidents").cast("string"), F.lit(" delays, avg "),
        F.round("avg_minutes").cast("bigint").cast("string"), F.lit(" min, cost GBP"),
        F.round("total_cost").cast("bigint").cast("string"), F.lit(", "),
        F.col("total_pax").cast("string"), F.lit(" pax affected"),
    )
    return string_agg(summary.select(line.alias("line")), "line", "line", "briefing")
