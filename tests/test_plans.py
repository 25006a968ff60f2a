"""Reports, alerts, models and the semantic builder on a hand-made airline."""

from datetime import date, timedelta

import pytest
from airline import AS_OF, NOW, airline
from pyspark.sql import functions as F

from tarmac.functions.scoring import delay_risk
from tarmac.plans import alerts, anomalies, classify, features, forecasting, gold, prompts, reports, semantic
from tarmac.plans.sql_surface import register_sql_functions

TODAY = 20260615


def first(df):
    return df.first().asDict()


def test_flight_status_window_and_lateness(spark):
    t = airline(spark, [(1, 20260613, "LANDED", 0, 0, 1), (2, 20260614, "LANDED", 5, 16, 1), (3, TODAY, "SCHEDULED", 0, 181, 1),
                        (4, 20260616, "SCHEDULED", 0, 0, 1), (5, 20260617, "SCHEDULED", 0, 0, 1)])
    rows = {r.flight_event_key: r for r in gold.flight_status(t, NOW).collect()}
    assert sorted(rows) == [2, 3, 4]
    assert rows[3].delay_severity == "SEVERE" and rows[3].is_delayed_departure and rows[3].minutes_since_scheduled == 540
    assert not rows[2].is_delayed_departure and not rows[4].is_delayed_departure
    assert (rows[3].origin_iata, rows[3].dest_iata, rows[3].registration) == ("LHR", "JFK", "G-SPCA")


def test_passenger_risk_literal_and_safe(spark):
    """Literal: old bookings hide their date and feedback doubles revenue. Safe: neither."""
    t = airline(
        spark, [(1, 20260101, "LANDED", 70, 70, 1)],
        bookings=[(1, 1, 1, 20251001, 20251005, 100.0, 5.0, 4)],
        feedback=[(1, 1, 1, "2026-06-01 10:00:00", -0.5, 2), (2, 1, 1, "2026-06-02 10:00:00", -0.1, 5)],
    )
    literal = {r.passenger_key: r for r in gold.passenger_risk(t, NOW).collect()}
    assert sorted(literal) == [1, 2]  # NONE and closed versions are out
    one = literal[1]
    assert one.last_booking_date is None and one.churn_risk_level == "LOW" and one.revenue_last_90d == 200.0
    assert one.bookings_last_90d == 1 and one.major_delays_experienced == 2 and one.negative_feedback_count == 1
    assert literal[2].revenue_last_90d is None and literal[2].bookings_last_90d == 0
    safe = {r.passenger_key: r for r in gold.passenger_risk(t, NOW, literal=False).collect()}[1]
    assert safe.revenue_last_90d == 100.0 and safe.days_since_last_booking == 257 and safe.churn_risk_level == "CRITICAL"
    assert safe.major_delays_experienced == 1
    t.booking_key_unique = True
    assert sorted(map(str, gold.passenger_risk(t, NOW).collect())) == sorted(map(str, literal.values()))


@pytest.mark.parametrize("carry", [False, True])
def test_daily_kpi(spark, carry):
    t = airline(
        spark, [(1, 20260607, "LANDED", 0, 0, 1), (2, 20260608, "LANDED", 0, 15, 100), (3, 20260608, "CANCELLED", 0, None, 200)],
        bookings=[(1, 1, 2, 20260601, 20260608, 100.0, 5.0, 7), (2, 2, 2, 20260601, 20260608, 50.0, 5.0, 7)],
        feedback=[(1, 1, 2, "2026-06-08 10:00:00", -0.9, 2)],
        delay=spark.createDataFrame([(2, 20260608, 7.0)], "flight_event_key long, flight_date_key int, total_cost_impact double"),
    )
    t.facts_carry_flight_date = carry
    t._tables["feedback"] = t.feedback.withColumn("flight_date_key", F.lit(20260608))
    rows = gold.daily_kpi(t, AS_OF).collect()
    assert [r.report_date for r in rows] == [date(2026, 6, 8)]
    kpi = rows[0].asDict()
    assert kpi["total_flights"] == 2 and kpi["cancelled_flights"] == 1
    assert kpi["otp_pct"] == pytest.approx(200 / 3)  # the landed flight counts once per booking
    assert kpi["total_revenue"] == 150.0 and kpi["total_delay_cost"] == 14.0 and kpi["total_fuel_kg"] == 400.0
    safe = first(gold.daily_kpi(t, AS_OF, literal=False))
    assert safe["otp_pct"] == 50.0 and safe["total_delay_cost"] == 7.0 and safe["total_fuel_kg"] == 300.0


def alert(df):
    return tuple(df.first())


def test_alert_thresholds(spark):
    def delayed(*delays):
        return airline(spark, [(n, TODAY, "SCHEDULED", d, 0, 1) for n, d in enumerate(delays)])

    assert alert(alerts.alert_critical_delay(delayed(120), NOW)) == ("CRITICAL_DELAY", False, 0, None)
    assert alert(alerts.alert_critical_delay(delayed(120, 121), NOW)) == ("CRITICAL_DELAY", True, 1, "121")

    def landed(arrivals, fuel=1):
        return airline(spark, [(n, TODAY, "LANDED", 0, a, fuel) for n, a in enumerate(arrivals)])

    assert alert(alerts.alert_otp(landed([0, 0, 15, 16]), NOW))[1:] == (False, 4, "75.00")
    assert alert(alerts.alert_otp(landed([0, 15, 16]), NOW))[1:] == (True, 3, "66.67")
    assert alert(alerts.alert_otp(landed([]), NOW))[1:] == (False, 0, None)
    assert alert(alerts.alert_fuel(landed([0], 920), NOW))[1] is False
    assert alert(alerts.alert_fuel(landed([0], 921), NOW))[1:] == (True, 1, "921")


@pytest.mark.parametrize(("count", "fired"), [(10, False), (11, True)])
def test_sentiment_surge(spark, count, fired):
    late = [(n, 1, 1, "2026-06-15 11:30:00", -0.7, 1) for n in range(count)]
    other = [(90, 1, 1, "2026-06-15 10:59:59", -0.9, 1), (91, 1, 1, "2026-06-15 11:30:00", -0.6, 1)]
    assert alert(alerts.alert_sentiment(airline(spark, feedback=late + other), NOW))[1:3] == (fired, count)


def test_reports_on_a_tiny_airline(spark):
    t = airline(
        spark, [(1, TODAY, "SCHEDULED", 130, 20, 990), (2, TODAY, "LANDED", 0, 0, 10), (3, TODAY, "LANDED", 40, 35, 10)],
        feedback=[(1, 1, 1, "2026-06-15 09:00:00", -0.9, 1), (2, None, 9, "2026-06-15 09:00:00", -0.9, 1)],
    )
    bad = {r.feedback_key: r for r in reports.critical_feedback(t).collect()}
    assert bad[1].passenger_name == "Ann Lee" and bad[1].route_code == "LHR-JFK" and bad[1].ai_summary == "Rude staff."
    assert bad[2].passenger_name is None and bad[2].flight_number is None  # kept by the left joins
    assert first(reports.otp_week(t, AS_OF)) == {"otp_percentage": 50.0}
    assert first(reports.unhappy_top_tier(t)) == {"unhappy_members": 1}
    assert first(reports.ops_context(t, AS_OF))["context"] == (
        "Total flights: 3, On-time: 1, Delayed: 2, Cancelled: 0, Avg delay: 18.3 min, Total pax: 870, Avg load: 92.0%")
    assert [r.flight_number for r in reports.ops_overview(t, 2).collect()] == ["SP0001", "SP0003"]
    found = {r.flight_event_key: (r.anomaly_type, r.severity) for r in gold.ops_anomaly(t, NOW).collect()}
    assert found == {1: ("EXTENDED_GROUND_DELAY", "CRITICAL")}
    prompt = first(prompts.assistant_prompt(t, AS_OF, "Why?"))["prompt"]
    assert prompt.endswith("\n\nQUESTION: Why?") and "CONTEXT: Operational summary - Total flights: 3" in prompt
    apologies = prompts.apology_prompts(t).collect()
    assert len(apologies) == 1 and "to Ann, a DIAMOND member" in apologies[0].prompt and apologies[0].prompt.endswith("Rude staff.")


def test_share_withholds_small_groups(spark):
    rows = [(n, 20260610, "LANDED", 0, 0, 1) for n in range(3)] + [(n, 20260611, "LANDED", 0, 0, 1) for n in (5, 6)]
    t = airline(spark, rows, delay=spark.createDataFrame(
        [(0, "WEATHER"), (0, "ATC")], "flight_event_key long, delay_category string"))
    share = reports.airport_share(t, AS_OF).collect()
    assert len(share) == 1 and share[0].total_departures == 3 and share[0].on_time_flights == 4  # two causes of one flight
    assert share[0].weather_delays == 1 and share[0].atc_delays == 1
    assert reports.airport_share(t, AS_OF, literal=False).first().on_time_flights == 3


def series(spark, values, start=date(2026, 3, 20), name="A"):
    return spark.createDataFrame([(name, start + timedelta(days=n), float(v)) for n, v in enumerate(values)], "series string, ds date, y double")


def test_forecast_learns_trend_and_weekday(spark):
    days = series(spark, [10 + 0.5 * n + (7 if n % 7 == 3 else 0) for n in range(84)])
    origin = "2026-06-11"
    got = forecasting.forecast(days, origin, 14, 0.95).orderBy("ts").collect()
    assert len(got) == 14 and got[0].ts == date(2026, 6, 12)
    for k, row in enumerate(got, start=84):
        assert row.forecast == pytest.approx(10 + 0.5 * k + (7 if k % 7 == 3 else 0), abs=0.2)
        assert row.lower_bound <= row.forecast <= row.upper_bound
    wide = forecasting.forecast(days, origin, 1, 0.99).first()
    assert wide.upper_bound - wide.lower_bound >= got[0].upper_bound - got[0].lower_bound
    metrics = forecasting.forecast_metrics(days, origin, 14, 0.95).first()
    assert metrics.n == 14 and metrics.mae < 0.3 and metrics.rmse >= metrics.mae


def test_forecast_of_one_day_is_level(spark):
    row = forecasting.forecast(series(spark, [5]), "2026-03-20", 1, 0.9).first()
    assert (row.forecast, row.lower_bound, row.upper_bound) == (5.0, 5.0, 5.0)


def test_anomaly_is_found(spark):
    noise = [20 + (n * 7919 % 5) for n in range(75)]
    train = series(spark, noise)
    score = series(spark, [22, 95, 21], start=date(2026, 6, 4))
    found = {r.ts: r for r in anomalies.detect_anomalies(train, score, AS_OF, 0.99).collect()}
    assert [found[d].is_anomaly for d in sorted(found)] == [False, True, False]
    report = anomalies.delay_anomaly_report(anomalies.detect_anomalies(train, score, AS_OF, 0.99)).collect()
    assert len(report) == 1 and report[0].anomaly_type == "SEVERE_ABOVE_NORMAL"
    assert anomalies.detect_anomalies(train, series(spark, [1], name="B"), AS_OF, 0.99).count() == 0


def test_outlooks(spark):
    ahead = spark.createDataFrame(
        [("LHR-JFK", date(2026, 6, 16), 300.0, 1.0, 400.0), ("LHR-CDG", date(2026, 6, 16), 171.0, 1.0, 9.0),
         ("LHR-CDG", date(2026, 6, 23), 999.0, 1.0, 9.0)], "series string, ts date, forecast double, lower_bound double, upper_bound double")
    routes = airline(spark).route
    got = {r.route_code: (r.aircraft_capacity, r.capacity_alert) for r in forecasting.capacity_risk(ahead, routes, AS_OF).collect()}
    assert got == {"LHR-JFK": (315, "CAPACITY_RISK"), "LHR-CDG": (180, "OK")}
    total = forecasting.revenue_outlook(ahead.filter("series = 'LHR-CDG'")).orderBy("forecast_date").collect()
    assert [r.cumulative_revenue for r in total] == [171.0, 1170.0]


def test_churn_training_labels(spark):
    t = airline(spark, bookings=[(1, 1, None, 20260101, 20260416, 10.0, 0.0, 3), (2, 2, None, 20260101, 20260415, 10.0, 0.0, 3)])
    rows = {r.passenger_key: r for r in features.churn_training(t, AS_OF).collect()}
    assert (rows[1].days_since_last_activity, rows[1].churn_label) == (60, "ACTIVE")
    assert (rows[2].days_since_last_activity, rows[2].churn_label) == (61, "CHURNED")
    assert rows[3].churn_label == "CHURNED" and rows[3].avg_advance_purchase == 30.0 and rows[3].avg_nps == 5.0
    assert "days_since_last_activity" not in features.churn_training(t, AS_OF, literal=False).columns


def test_classifier_learns_and_skips_bad_rows(spark):
    rows = spark.range(600).select(
        "id", (F.col("id") % 10).alias("x"), F.when(F.col("id") % 50 == 0, None).otherwise(F.rand(1)).alias("noise"),
        F.when(F.col("id") % 3 == 0, "red").otherwise("blue").alias("colour"),
        F.when(F.col("id") % 10 > 6, "YES").otherwise("NO").alias("label"))
    train, test = classify.holdout(rows, "id")
    model = classify.train(train, "label", "YES", "NO", exclude=["id"], trees=2, depth=3)
    predicted = classify.predict(model, test, ["id", "label"])
    metrics = classify.classify_metrics(predicted, "label", model).first()
    assert metrics.accuracy == 1.0 and metrics.f1 == 1.0
    assert predicted.count() == test.count()  # a row without an input has a null prediction
    assert predicted.filter("predicted IS NULL").count() == test.filter("noise IS NULL").count() > 0
    unseen = classify.predict(model, test.withColumn("colour", F.lit("green")), ["id"])
    assert unseen.filter("predicted IS NOT NULL").count() == test.filter("noise IS NOT NULL").count()
    ranked = classify.feature_importance(model, rows).collect()
    assert ranked[0].feature == "x" and [r["rank"] for r in ranked] == [1, 2, 3]


def test_sql_function_agrees(spark):
    register_sql_functions(spark)
    rows = spark.sql(
        "SELECT * FROM VALUES (85.0D, 'MODERATE', 8, 1, 'HIGH', 4.5D), (95.0D, 'NONE', 14, 3, 'LOW', 2.0D), "
        "(72.0D, 'SEVERE', 18, 5, 'HIGH', 6.0D), (NULL, NULL, NULL, NULL, NULL, NULL), (120.0D, 'x', 22, 6, 'x', 99D) "
        "AS t(otp, w, h, d, c, a)")
    native = delay_risk(*[F.col(c) for c in ("otp", "w", "h", "d", "c", "a")])
    got = rows.select(F.expr("delay_risk(otp, w, h, d, c, a)").alias("s"), native.alias("n")).collect()
    assert [r.s for r in got] == [r.n for r in got]


def test_semantic_names():
    assert semantic.resolve("PNR") == ("booking", "booking_reference")
    assert semantic.resolve("cost", ["delay"]) == ("delay", "total_cost_impact")
    with pytest.raises(KeyError, match="ambiguous"):
        semantic.resolve("status")
    with pytest.raises(KeyError, match="unknown"):
        semantic.resolve("shoe size")
    assert [step[2] for step in semantic.path_to("booking", "route")] == ["flight", "route"]
    with pytest.raises(KeyError, match="no relationship"):
        semantic.path_to("feedback", "route")


def test_semantic_roles_and_filters(spark):
    t = airline(spark, [(1, TODAY, "LANDED", 5, 10, 1), (2, TODAY, "LANDED", 5, 20, 1)])
    mean = [semantic.Metric("avg", "arrival delay", "late")]
    assert semantic.semantic_query(t, mean, {"to": "airport code"}, via="dest_airport_key").collect()[0].asDict() == {"to": "JFK", "late": 15.0}
    assert semantic.semantic_query(t, mean, {"from_": "airport code"}).collect()[0].from_ == "LHR"
    some = semantic.semantic_query(t, mean, ["day"], where=F.col("arrival_delay_min") > 15)
    assert some.first().late == 20.0 and some.first().day == date(2026, 6, 15)
    landed = semantic.semantic_query(t, mean, ["day"], where=F.col("flight_status") == "LANDED")  # a column that is not selected
    assert landed.first().late == 15.0
    share = [semantic.Metric("percent", "arrival delay", "on_time", lambda delay: delay <= 15)]
    assert semantic.semantic_query(t, share, []).first().on_time == 50.0
    from_lhr = {"airport code": lambda code: code == "LHR"}
    assert semantic.semantic_query(t, mean, [], only=from_lhr).first().late == 15.0
    assert semantic.semantic_query(t, share, [], only={"airport code": lambda code: code == "none"}).first().on_time is None
    latest = semantic.semantic_query(t, mean, ["flight.flight_event_key"], top=("late", 1)).collect()
    assert [(r[0], r.late) for r in latest] == [(2, 20.0)]
    with pytest.raises(KeyError, match="one fact table"):
        semantic.semantic_query(t, [*mean, semantic.Metric("sum", "ticket price", "p")], ["day"])


def test_salience_of_a_long_text_takes_time_by_its_words(spark):
    import time

    from tarmac.plans.passages import salient_sentences

    letters = "abcdefghijklmnopqrstuvwxyz"
    unlike = [letters[n % 26] + letters[n // 26 % 26] + letters[n // 676 % 26] + letters[n // 17576] for n in range(24_000)]
    parts = [" ".join(unlike[n : n + 10]) + "." for n in range(0, len(unlike), 10)]

    def seconds(texts):
        rows = spark.createDataFrame([*enumerate(texts)], "k long, text string").coalesce(1)
        began = time.time()
        told = salient_sentences(rows, "k", "text").collect()
        assert {r.k: r.summary for r in told} == {k: text.split(". ")[0].rstrip(".") + "." for k, text in enumerate(texts)}  # all alike: the first
        return time.time() - began

    dealt = [" ".join(parts[n : n + 20]) for n in range(0, len(parts), 20)]
    seconds(dealt[:2])  # compiles
    assert seconds([" ".join(parts)]) < 3 * seconds(dealt) + 2
