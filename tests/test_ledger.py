"""No message is lost, keys are stable, and a batch opens few files of a long history."""

import json

import pytest
from airline import airline
from pyspark.sql import functions as F
from test_streaming import message

from tarmac.schemas import struct
from tarmac.session import scratch_path
from tarmac.sources import reference
from tarmac.sources.raw import json_landing
from tarmac.streaming import feeds
from tarmac.streaming.keyed import KeyedState
from tarmac.streaming.ledger import BOOKING_GOLD, FEEDBACK_GOLD, Ledger, add_feedback_messages, allot, balanced, bookings_batch, merge_booking_messages
from tarmac.tables import Tables

FLIGHTS = [(1, 20260611, "LANDED", 0, 0, 5), (2, 20260611, "LANDED", 0, 0, 5)]
ON = {"flight_number": "SP0001", "flight_date": "2026-06-11"}


@pytest.fixture
def feed(spark, tmp_path):
    """Run a ledger over arrivals of lines; each names the passengers and flights known by then."""
    ledger = Ledger(scratch_path(spark, "bookings"), BOOKING_GOLD)
    ledger.start(spark)
    folder, mark = tmp_path / "raw", scratch_path(spark, "mark")
    folder.mkdir()
    t, cabins = airline(spark, FLIGHTS), reference.cabins(spark)

    def arrive(n, lines, passengers="passenger_id <> 'P3'", flights="true"):
        (folder / f"{n}.json").write_text("\n".join(lines) + "\n")
        now = Tables(passenger=t.passenger.filter(passengers), route=t.route, airport=t.airport)
        batch = bookings_batch(spark, now, cabins, ledger, t.flight.filter(flights))
        feeds.start_batches(feeds.append_stream(spark, str(folder), "PSS"), batch, mark).awaitTermination()
        return batch, folder / f"{n}.json"

    return ledger, arrive


def accounts(spark, ledger):
    rows = {r.batch_id: r for r in ledger.accounts(spark).collect()}
    assert balanced(ledger.accounts(spark)).isEmpty()
    return rows


def state(spark, ledger):
    return {r.booking_reference: r for r in feeds.current_state(spark, ledger.log, BOOKING_GOLD, feeds.BOOKING_KEY).collect()}


def test_every_message_is_accounted_for_and_comes_back_once(spark, feed):
    ledger, arrive = feed
    arrive(0, [message("A", **ON), message("A", **ON), message("B", person="P3", **ON), "not json", message(None, **ON),
               message("C", flight_number="SP0002", flight_date="2026-06-11"), message("D", flight_number="SP0009", flight_date="2026-06-11")],
           flights="flight_event_key = 1")
    first = accounts(spark, ledger)[0]
    assert (first.messages, first.inserted, first.superseded, first.not_json, first.no_reference) == (7, 1, 1, 1, 1)
    assert (first.unknown_passenger, first.unknown_flight, first.released, first.last_key) == (1, 2, 0, 1)
    batch, file = arrive(1, [message("A", status="CANCELLED", **ON), message("E", **ON)], passengers="true")
    before = sorted(map(str, state(spark, ledger).values()))
    rows = accounts(spark, ledger)
    assert (rows[1].messages, rows[1].released, rows[1].inserted, rows[1].changed, rows[1].last_key) == (2, 2, 3, 1, 4)
    now = state(spark, ledger)
    assert {k: r.booking_key for k, r in now.items()} == {"A": 1, "B": 2, "C": 3, "E": 4}
    assert now["A"].booking_status == "CANCELLED" and now["C"].flight_event_key == 2 and now["B"].passenger_key == 3
    assert [r.reason for r in ledger.open_rejects(spark).orderBy("reason").collect()] == ["no_reference", "not_json", "unknown_flight"]
    batch(json_landing(spark, str(file), "PSS"), 1)  # a replay: the same keys, released once
    assert sorted(map(str, state(spark, ledger).values())) == before
    assert accounts(spark, ledger)[1] == rows[1]
    arrive(2, [message("A", status="CANCELLED", **ON)], passengers="true")
    last = accounts(spark, ledger)[2]
    assert (last.messages, last.released, last.unchanged, last.inserted) == (1, 0, 1, 0)


def test_an_old_message_does_not_undo_a_newer_one(spark, feed):
    ledger, _ = feed
    t, cabins = airline(spark, FLIGHTS), reference.cabins(spark)

    def raw(lines):
        rows = spark.createDataFrame([(json.loads(x).pop("at"), x) for x in lines], "at string, raw_text string")
        return rows.select(F.col("at").cast("timestamp_ntz").alias("ingest_timestamp"), F.lit("PSS").alias("source_system"),
                           F.lit("f").alias("file_name"), "raw_text", F.try_parse_json("raw_text").alias("raw_data"))

    def run(lines, n, flights):
        merge_booking_messages(spark, raw(lines), t, cabins, ledger, n, t.flight.filter(flights))

    two = {"flight_number": "SP0002", "flight_date": "2026-06-11"}
    run([message("A", status="HELD", at="2026-06-01 10:00:00", **two)], 0, "flight_event_key = 1")
    run([message("A", status="FLOWN", at="2026-06-02 10:00:00", **ON)], 1, "flight_event_key = 1")
    run([message("Z", at="2026-06-03 10:00:00", **ON)], 2, "true")
    last = accounts(spark, ledger)[2]
    assert (last.released, last.superseded, last.inserted) == (1, 1, 1) and state(spark, ledger)["A"].booking_status == "FLOWN"


def scratch_tables(spark):
    from pathlib import Path

    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir() if p.name.startswith("rows-")}


def test_a_batch_in_slices_is_the_same_and_leaves_only_its_logs(spark, monkeypatch):
    t, cabins = airline(spark, FLIGHTS), reference.cabins(spark)
    lines = [message(f"B{n % 7}", person=("P1", "P2", "P9")[n % 3], total_amount=n, **ON) for n in range(20)]
    lines += [lines[0], "not json", message(None, **ON), message("C", flight_number="SP0009", flight_date="2026-06-11")]
    raw = spark.createDataFrame([(x,) for x in lines], "raw_text string").select(
        F.lit("2026-06-01").cast("timestamp_ntz").alias("ingest_timestamp"), F.lit("PSS").alias("source_system"),
        F.lit("f").alias("file_name"), "raw_text", F.try_parse_json("raw_text").alias("raw_data"))
    told = []
    for size in (1_000_000, 6):  # a slice, then four
        monkeypatch.setattr("tarmac.streaming.ledger.SLICE_MESSAGES", size)
        ledger = Ledger(scratch_path(spark, "bookings"), BOOKING_GOLD)
        ledger.start(spark)
        before = scratch_tables(spark)
        merge_booking_messages(spark, raw, t, cabins, ledger, 0, t.flight, ["ingest_timestamp", "total_amount"])
        assert scratch_tables(spark) == before
        told.append([sorted(map(str, ledger.read(spark, name).collect())) for name in ("log", "quarantine", "released", "accounts")])
    assert told[0] == told[1] and len(told[0][1]) == 9
    assert all("raw_text='" in x and "message_id='" in x for x in told[0][1])


def test_feedback_gets_keys_and_refused_lines_are_kept(spark, tmp_path):
    t = airline(spark, FLIGHTS)
    ledger = Ledger(scratch_path(spark, "feedback"), FEEDBACK_GOLD)
    ledger.start(spark)
    lines = [json.dumps({"passenger_id": p, "feedback_text": "Terrible, rude crew.", "nps_score": 1, **on}) for p, on in (("P1", ON), ("P9", {}))]
    (tmp_path / "a.json").write_text("\n".join([*lines, "broken"]) + "\n")
    for _ in range(2):  # a replay
        add_feedback_messages(spark, json_landing(spark, str(tmp_path / "a.json"), "F"), t.passenger, t.flight, ledger, 0)
    (tmp_path / "b.json").write_text(lines[0] + "\n")
    add_feedback_messages(spark, json_landing(spark, str(tmp_path / "b.json"), "F"), t.passenger, t.flight, ledger, 1)
    rows = ledger.read(spark, "log").orderBy("feedback_key").collect()
    assert [r.feedback_key for r in rows] == [1, 2, 3]
    assert {(r.passenger_key, r.flight_event_key, r.route_key, r.ai_priority) for r in rows} == {(1, 1, 1, "CRITICAL"), (None, None, None, "CRITICAL")}
    assert ledger.open_rejects(spark).count() == 1 and balanced(ledger.accounts(spark)).isEmpty()


def test_keys_over_many_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [(r.k, r.key) for r in allot(rows, "key", ["k"], 50).orderBy("k").collect()] == [(i, 51 + i) for i in range(1000)]


STATE = struct("k bigint, v string, gone boolean")


def test_lookups_open_few_files_whatever_the_age(spark):
    path = scratch_path(spark, "keyed")
    keyed = KeyedState(spark, path, STATE, ["k"], fanout=3, base_buckets=2, max_level=3, deleted="gone")
    keyed.start(spark.range(40).select(F.col("id").alias("k"), F.lit("base").alias("v"), F.lit(False).alias("gone")))
    expected, opened = {k: "base" for k in range(40)}, []
    asked = spark.createDataFrame([(3,), (4,), (999,)], "k long")
    for n in range(14):
        told = {k: r.v for k, r in ((r.k, r) for r in keyed.lookup(asked, n).collect())}
        assert told == {k: expected[k] for k in (3, 4) if k in expected}
        opened.append(keyed.opened)
        keys = {(n * 5 + i) % 60 for i in range(7)}
        rows = [(k, f"b{n}", k % 9 == 4 and n % 2 == 1) for k in keys]
        for _ in range(1 + (n % 5 == 0)):  # some batches are replayed
            keyed.write(spark.createDataFrame(rows, STATE), n)
        expected = {k: v for k, v in {**expected, **{k: v for k, v, _ in rows}}.items() if (k, True) not in {(k, g) for k, _, g in rows}}
    assert {r.k: r.v for r in keyed.current().collect()} == expected
    assert {r.k: r.v for r in keyed.lookup(spark.range(100).select(F.col("id").alias("k")), 14).collect()} == expected
    # two keys that exist meet at most two files of each of at most two runs on a level and one of the base
    assert max(opened) <= 3 * (2 * 3 + 1) and max(opened[7:]) <= max(opened[:7]) + 4
    assert len(keyed.runs()) <= 9
    with pytest.raises(ValueError, match="would replace a past batch"):
        keyed.write(spark.createDataFrame([], STATE), 3)


def test_flights_and_alerts_through_keyed_states(spark):
    t = airline(spark, [(1, 20260615, "SCHEDULED", 130, 130, 5), (2, 20260615, "SCHEDULED", 0, 0, 5)])
    base = t.flight.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    log = scratch_path(spark, "log")
    feeds.start_log(spark, log, base.schema, base)
    keyed = KeyedState(spark, scratch_path(spark, "state"), base.schema, feeds.FLIGHT_KEY, ["flight_event_key"])
    keyed.start(base)
    names = "flight_number string, flight_date_key int, flight_status string, actual_departure timestamp_ntz, actual_arrival timestamp_ntz, " \
        "departure_delay_min int, arrival_delay_min int, pax_flown int, fuel_consumed_kg int, ingest_timestamp timestamp_ntz"
    update = spark.createDataFrame([("SP0001", 20260615, "LANDED", None, None, None, None, 63, None, None), ("SP0099", 20260615, "LANDED", *[None] * 7)], names)
    feeds.merge_flights(spark, update, log, base.schema, 0, keyed=keyed)
    for rows in (keyed.current(), feeds.current_state(spark, log, base.schema, ["flight_event_key"])):
        got = {r.flight_event_key: (r.flight_status, r.pax_flown) for r in rows.collect()}
        assert got == {1: ("LANDED", 63), 2: ("SCHEDULED", 290)}
    alerts, known = scratch_path(spark, "alerts"), KeyedState(spark, scratch_path(spark, "known"), feeds.ALERT_LOG, ["delay_key"])
    feeds.start_log(spark, alerts, feeds.ALERT_LOG)
    known.start()
    delays = spark.createDataFrame([(7, 1, 130, "ATC")], "delay_key long, flight_event_key long, delay_minutes int, delay_category string")
    run = feeds.delay_alerts_batch(spark, t.flight, alerts, "at", keyed=known)
    for n in (0, 1, 1):
        run(delays.withColumn("at", F.lit("2026-06-15 10:00:00").cast("timestamp_ntz")), n)
    assert feeds.read_log(spark, alerts, feeds.ALERT_LOG).count() == 1


def test_a_unit_that_empties_leaves_the_gold_table(spark):
    path = scratch_path(spark, "gold")
    content = {}

    def recompute(units):
        rows = spark.createDataFrame([(u, v) for u, v in content.items()] or [], "unit string, v long")
        return rows.join(units, "unit", "left_semi")

    run = feeds.gold_refresh_batch(recompute, "unit", path, "unit")
    touched = spark.createDataFrame([("a b/c",), ("2",)], "unit string")
    content.update({"a b/c": 1, "2": 2})
    run(touched, 0)
    del content["a b/c"]
    for _ in range(2):
        run(touched, 1)
    assert [(r.unit, r.v) for r in spark.read.schema("v long, unit string").parquet(path).collect()] == [("2", 2)]


def test_late_and_repeated_versions_are_counted_and_listed(spark):
    from datetime import datetime, timedelta

    from tarmac.streaming.changes import ChangeFeed

    schema = struct("k bigint, at timestamp_ntz, v string")
    feed = ChangeFeed(spark, scratch_path(spark, "changes"), schema, ["k"], "at", timedelta(hours=1))
    feed.start()
    t = lambda h: datetime(2024, 1, 1, h)
    batches = [[(1, t(5), "a"), (1, t(5), "a"), (2, t(3), "b"), (None, t(4), "?")], [(1, t(5), "a"), (2, t(2), "old"), (2, t(9), "c")], [(3, t(8), "d"), (3, t(7), "late")]]
    for n, rows in enumerate(batches):
        for _ in range(2):  # every batch is replayed
            feed.take(spark.createDataFrame(rows, schema), n)
    got = [(r.messages, r.late, r.repeated, r.passed) for r in feed.read("accounts").orderBy("batch_id").collect()]
    assert got == [(4, 1, 1, 2), (3, 1, 1, 1), (2, 1, 0, 1)]
    assert sorted(r.v for r in feed.read().collect()) == ["a", "b", "c", "d"]
    assert sorted(r.v for r in feed.read("late").collect()) == ["?", "late", "old"]
