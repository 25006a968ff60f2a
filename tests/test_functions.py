"""Row rules at their thresholds, dates, masks, scores, text."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tarmac.functions import conditions as C
from tarmac.functions import masks, text
from tarmac.functions.dates import as_of_ts, boundary_diff, date_key, iso_day, key_to_date
from tarmac.functions.scoring import delay_risk, passenger_features



@pytest.mark.parametrize(
    ("delay", "label"),
    [(None, "ON_TIME"), (-5, "ON_TIME"), (0, "ON_TIME"), (1, "SLIGHT"), (15, "SLIGHT"), (16, "MINOR"), (60, "MINOR"),
     (61, "SIGNIFICANT"), (180, "SIGNIFICANT"), (181, "SEVERE")],
)
def test_delay_severity(one_row, delay, label):
    assert one_row(C.delay_severity(F.lit(delay).cast("int"))) == (label,)


@pytest.mark.parametrize(
    ("days", "label"),
    [(None, None), (0, "SAME_DAY"), (1, "1-3_DAYS"), (3, "1-3_DAYS"), (4, "4-7_DAYS"), (8, "8-14_DAYS"),
     (15, "15-30_DAYS"), (31, "31-60_DAYS"), (60, "31-60_DAYS"), (61, "61+")],
)
def test_lead_time(one_row, days, label):
    assert one_row(C.lead_time_category(F.lit(days).cast("int"))) == (label,)


@pytest.mark.parametrize(
    ("score", "label", "priority"),
    [(None, "NEUTRAL", "LOW"), (0.3, "NEUTRAL", "LOW"), (0.31, "POSITIVE", "LOW"), (-0.3, "NEUTRAL", "LOW"),
     (-0.31, "NEGATIVE", "MEDIUM"), (-0.5, "NEGATIVE", "MEDIUM"), (-0.51, "NEGATIVE", "HIGH"), (-0.7, "NEGATIVE", "HIGH"),
     (-0.71, "NEGATIVE", "CRITICAL")],
)
def test_sentiment_bands(one_row, score, label, priority):
    value = F.lit(score).cast("double")
    assert one_row(C.sentiment_label(value), C.feedback_priority(value)) == (label, priority)


@pytest.mark.parametrize(
    ("score", "nps", "flag"), [(None, None, False), (-0.51, None, True), (-0.5, 4, False), (0.9, 3, True), (None, 3, True)]
)
def test_action_required(one_row, score, nps, flag):
    assert one_row(C.action_required(F.lit(score).cast("double"), F.lit(nps).cast("int"))) == (flag,)


def test_normal_type_can_pass_the_filter(spark):
    """A long delay of a flight no longer scheduled is listed, with type NORMAL and severity HIGH."""
    row = spark.sql(
        "SELECT 121 departure_delay_min, 'LANDED' flight_status, 10 taxi_out_min, 10 fuel_consumed_kg, "
        "100 fuel_loaded_kg, 80.0D load_factor_pct, 5 pax_booked, 9 seat_capacity"
    )
    col = {c: F.col(c) for c in row.columns}
    got = row.select(C.any_anomaly(col), C.anomaly_type(col), C.anomaly_severity(col)).first()
    assert tuple(got) == (True, "NORMAL", "HIGH")


def test_guards(one_row):
    zero = F.lit(0)
    assert one_row(C.ratio(F.lit(3), zero), C.percent_change(F.lit(3.0), zero), C.ratio(F.lit(3), F.lit(2))) == (None, None, 1.5)


def test_boundary_diff_counts_boundaries(one_row):
    def ts(x):
        return F.lit(x).cast("timestamp_ntz")

    got = one_row(
        boundary_diff("minute", ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
        boundary_diff("minute", ts("2024-01-01 00:01:00"), ts("2024-01-01 00:01:59")),
        boundary_diff("minute", ts("2024-01-01 00:02:00"), ts("2024-01-01 00:00:30")),
    )
    assert got == (1, 0, -2)


def test_date_keys(one_row):
    day = F.lit("2024-02-29").cast("date")
    assert one_row(date_key(day), key_to_date(F.lit(20240229))) == (20240229, date(2024, 2, 29))
    assert iso_day("2024-03-01", -1) == "2024-02-29"
    assert str(one_row(as_of_ts("2024-03-01"))[0]) == "2024-03-01 00:00:00"


@pytest.mark.parametrize("role", ["ANALYST", "GUEST"])
@pytest.mark.parametrize("value", ["jo.smith@mail.example", "ab@x", "a@x", "not a mail", ""])
def test_mail_mask_never_leaks(one_row, role, value):
    got = one_row(masks.mask_email(F.lit(value), role))[0]
    middle = value.split("@")[0][2:]
    assert not middle or middle not in got
    assert got.startswith("***") or "***" in got


def test_masks(one_row):
    mail, phone, name = F.lit("jo.smith@mail.example"), F.lit("+44123456789"), F.lit("Smith")
    assert one_row(masks.mask_email(mail, "ADMIN"), masks.mask_email(mail, "ANALYST"), masks.mask_email(mail, "GUEST")) == (
        "jo.smith@mail.example", "jo***@mail.example", "***MASKED***")
    assert one_row(masks.mask_phone(phone, "ADMIN"), masks.mask_phone(phone, "DATA_ENGINEER")) == ("+44123456789", "+441****6789")
    assert one_row(masks.mask_phone(F.lit("1234567"), "ANALYST")) == ("***MASKED***",)
    assert one_row(masks.mask_name(name, "ADMIN"), masks.mask_name(name, "ANALYST"), masks.mask_name(name, "X")) == ("Smith", "S****", "***")
    assert one_row(masks.mask_email(F.lit(None).cast("string"), "ANALYST")) == (None,)


@pytest.mark.parametrize(
    ("args", "score"),
    [((85.0, "MODERATE", 8, 1, "HIGH", 4.5), 56.25), ((95.0, "NONE", 14, 3, "LOW", 2.0), 19.5),
     ((72.0, "SEVERE", 18, 5, "HIGH", 6.0), 72.4), ((None, None, None, None, None, None), 5.0)],
)
def test_delay_risk(one_row, args, score):
    kinds = ("double", "string", "int", "int", "string", "double")
    assert one_row(delay_risk(*[F.lit(a).cast(k) for a, k in zip(args, kinds)])) == (score,)


def test_passenger_features(spark):
    row = spark.sql(
        "SELECT 'GOLD' loyalty_tier, 100000L lifetime_miles, 5000 ytd_miles, 10 ytd_segments, 20 days_since_last_booking, "
        "0.5D avg_sentiment, 1 negative_feedback_count, 2 major_delays_experienced, 3 bookings_last_90d, 1000.0D revenue_last_90d"
    )
    got = row.select(*[c.alias(n) for n, c in passenger_features({c: F.col(c) for c in row.columns}).items()]).first().asDict()
    assert got["tier_encoded"] == 3.0
    assert got["engagement_score"] == 65.0
    assert got["recency_score"] == 90.0
    assert got["monetary_score"] == 20.0
    assert got["satisfaction_score"] == 39.0
    assert got["churn_probability"] == pytest.approx(0.1 * 0.3 + 0.35 * 0.25 + 0.61 * 0.25 + 0.8 * 0.2)
    assert got["estimated_clv"] == 40000.0


def test_passenger_features_of_nulls(spark):
    row = spark.sql(
        "SELECT CAST(NULL AS string) loyalty_tier, CAST(NULL AS bigint) lifetime_miles, CAST(NULL AS int) ytd_miles, "
        "CAST(NULL AS int) ytd_segments, CAST(NULL AS int) days_since_last_booking, CAST(NULL AS double) avg_sentiment, "
        "CAST(NULL AS int) negative_feedback_count, CAST(NULL AS int) major_delays_experienced, "
        "CAST(NULL AS int) bookings_last_90d, CAST(NULL AS double) revenue_last_90d"
    )
    got = row.select(*[c.alias(n) for n, c in passenger_features({c: F.col(c) for c in row.columns}).items()]).first()
    assert tuple(got) == (0.0, 0.0, 10.0, 0.0, 50.0, pytest.approx(0.27 + 0.25 + 0.125 + 0.2), 0.0)


def test_sentiment_polarity(one_row):
    good = "The crew was friendly and the seat comfortable. Great flight, thank you!"
    bad = "Terrible. My bag was lost, staff were rude and the flight was delayed 3 hours."
    scores = one_row(*[text.sentiment(F.lit(t)) for t in (good, bad, "We flew to Rome.", "")])
    assert scores[0] == 1.0 and scores[1] == -1.0 and scores[2:] == (0.0, 0.0)
    assert one_row(text.sentiment(F.lit(None).cast("string"))) == (None,)


def test_whole_text_is_scored(one_row):
    """A polar word at the very end of a long text counts."""
    assert one_row(text.sentiment(F.concat(F.repeat(F.lit("word "), 50000), F.lit("awful")))) == (-1.0,)


def test_summary_and_answers(one_row):
    complaint = "We boarded on time. The flight was delayed 3 hours and staff were rude! I want a refund. Bye."
    problem, wish, wait = text.QUESTION_CUES
    got = one_row(
        text.summarise(F.lit(complaint)), text.extract_answer(F.lit(complaint), problem),
        text.extract_answer(F.lit(complaint), wish), text.extract_answer(F.lit(complaint), wait),
        text.first_duration(F.lit(complaint)), text.extract_answer(F.lit("All fine."), wish),
    )
    assert got == (
        "The flight was delayed 3 hours and staff were rude!", "The flight was delayed 3 hours and staff were rude!",
        "I want a refund.", "The flight was delayed 3 hours and staff were rude!", "3 hours", None,
    )
