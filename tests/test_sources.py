"""Sources, derived tables, sinks."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import scratch_path
from tarmac.sources import derived, raw, reference, sinks


def test_csv_null_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,n\n1,"a, b",5\nNULL,null,x\n3,,7\n')
    schema = T.StructType.fromDDL("id int, name string, n int")
    rows = sorted(map(tuple, raw.csv_source(spark, str(tmp_path), schema).collect()), key=str)
    assert rows == [(1, "a, b", 5), (3, None, 7), (None, None, None)]


def test_json_landing_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\nnot json\n{"a": "oops"}\n')
    landed = raw.json_landing(spark, str(tmp_path), "PSS")
    rows = landed.select("source_system", "raw_text", *raw.payload("raw_data", {"a": "int", "b": "string"})).collect()
    assert {(r.source_system, r.a, r.b) for r in rows} == {("PSS", 1, "x"), ("PSS", None, None)}
    assert sum(r.raw_text == "not json" for r in rows) == 1
    assert landed.filter("file_name LIKE '%a.json' AND ingest_timestamp IS NOT NULL").count() == 3


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    rows = raw.json_array_source(spark, str(tmp_path), T.StructType.fromDDL("a int"))
    assert sorted(r.a for r in rows.collect()) == [1, 2]


def test_calendar(spark):
    days = derived.calendar_dim(spark, date(2024, 1, 1), date(2026, 12, 31))
    assert days.count() == 1096
    rows = {r.full_date: r for r in days.collect()}
    assert rows[date(2024, 3, 31)].fiscal_year == 2023 and rows[date(2024, 3, 31)].fiscal_quarter == 4
    assert rows[date(2024, 4, 1)].fiscal_year == 2024 and rows[date(2024, 4, 1)].fiscal_quarter == 1
    holiday = rows[date(2024, 5, 27)]  # flagged but without a name
    assert holiday.is_holiday and holiday.holiday_name is None
    assert rows[date(2024, 12, 25)].holiday_name == "Christmas Day" and not rows[date(2024, 12, 24)].is_holiday
    assert rows[date(2024, 1, 6)].day_name == "Sat" and rows[date(2024, 1, 6)].is_weekend
    assert rows[date(2024, 12, 30)].iso_week == 1


def test_minutes(spark):
    rows = {r.time_key: r for r in derived.minute_dim(spark).collect()}
    assert len(rows) == 1440 and max(rows) == 2359
    assert rows[0].hour_12 == 12 and rows[0].am_pm == "AM" and rows[0].time_band == "RED_EYE"
    assert rows[1259].time_band == "MIDDAY" and rows[1259].hour_12 == 12
    assert rows[130].full_time == "01:30:00"
    assert [k for k in (700, 959, 1000, 1700, 1959, 2000) if rows[k].is_peak_hour] == [700, 959, 1700, 1959]


def test_reference_counts(spark):
    sizes = [f(spark).count() for f in (reference.airports, reference.aircraft, reference.routes, reference.delay_reasons, reference.cabins)]
    assert sizes == [20, 16, 20, 33, 4]
    assert reference.delay_reasons(spark).select("delay_category").distinct().count() == 9


def test_schedule_frequency(spark):
    """33 departures on a normal day, 39 in summer when the seasonal routes fly."""
    routes = reference.routes(spark)
    plan = derived.schedule_expand(routes, date(2024, 5, 31), date(2024, 6, 1))
    counts = {r.flight_date: r["count"] for r in plan.groupBy("flight_date").count().collect()}
    assert counts == {date(2024, 5, 31): 33, date(2024, 6, 1): 39}
    assert plan.filter("route_code = 'EDI-LHR'").select("flight_number").distinct().orderBy("flight_number").first()[0] == "SP1901"


def test_delay_cost_thresholds(spark):
    flights = spark.createDataFrame(
        [(n, 20240101, 1, d, "LANDED", 10) for n, d in enumerate([15, 16, 119, 120, 180, 300, 480])]
        + [(9, 20240101, 1, 200, "CANCELLED", 10)],
        "flight_event_key long, flight_date_key int, origin_airport_key int, departure_delay_min int, flight_status string, pax_flown int",
    )
    costs = derived.delay_costs(flights, 400.0, 1000.0, 700.0, 12.0)
    got = {r.delay_minutes: r.total_cost_impact for r in costs.collect()}
    assert got == {16: 0.0, 119: 0.0, 120: 120.0, 180: 4120.0, 300: 5120.0, 480: 5820.0}


def test_append_defaults_and_layout(spark):
    rows = spark.createDataFrame([(1, None), (2, "EUR")], "id int, currency string")
    path = scratch_path(spark, "t")
    out = sinks.append_sink(rows, path, ["id", "currency", "flag"], {"currency": "GBP", "flag": False})
    out = sinks.append_sink(rows, path, ["id", "currency", "flag"], {"currency": "GBP", "flag": False})
    assert sorted(map(tuple, out.collect())) == [(1, "GBP", False)] * 2 + [(2, "EUR", False)] * 2


def test_hot_partition_is_spread_over_files(spark):
    """One date holds nearly all rows, yet its partition is written by several tasks."""
    rows = spark.range(20000).select(
        F.col("id"), F.when(F.col("id") < 100, 20240102).otherwise(20240101).alias("d"), (F.col("id") % 3).alias("a")
    )
    stored = sinks.clustered_layout(rows, scratch_path(spark, "l"), "d", ["a"], "id", file_rows=100)
    assert stored.count() == 20000
    assert stored.filter("d = 20240101").select(F.input_file_name()).distinct().count() >= 6
