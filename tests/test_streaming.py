"""Streams: one batch or many give the same table, replays change nothing."""

import json

import pytest
from airline import airline
from pyspark.sql import functions as F

from tarmac.session import scratch_path
from tarmac.sources import reference
from tarmac.sources.raw import json_landing
from tarmac.streaming import feeds


def message(ref, person="P1", status="CONFIRMED", **more):
    base = {
        "booking_reference": ref, "passenger_id": person, "route_code": "LHR-JFK", "booking_date": "2026-06-01",
        "flight_date": "2026-06-11", "cabin_class": "J", "origin": "LHR", "destination": "JFK", "channel": "WEB",
        "status": status, "fare_class": "Y", "fare_amount": 90.5, "total_amount": 100.25,
    }
    return json.dumps({**base, **more})


BATCHES = [
    [message("A"), message("B"), message("C", person="P9"), "not json"],
    [message("A", status="CANCELLED"), message("B", total_amount="oops"), message("D", total_amount="oops", flight_date=None)],
    [message("A", status=None), message("E", person="P2", cabin_class="?")],
]


def run_bookings(spark, tmp_path, groups):
    t, cabins = airline(spark), reference.cabins(spark)
    folder, log, mark = tmp_path / "raw", scratch_path(spark, "log"), scratch_path(spark, "mark")
    folder.mkdir()
    feeds.start_log(spark, log, feeds.BOOKING_FACT)
    for n, group in enumerate(groups):
        (folder / f"{n}.json").write_text("\n".join(group) + "\n")
        feeds.stream_bookings(spark, str(folder), t, cabins, log, mark).awaitTermination()
    state = feeds.current_state(spark, log, feeds.BOOKING_FACT, feeds.BOOKING_KEY)
    return log, {r.booking_reference: r for r in state.collect()}


def test_bookings(spark, tmp_path):
    log, rows = run_bookings(spark, tmp_path, BATCHES)
    assert sorted(rows) == ["A", "B", "D", "E"]  # C has no known passenger
    a = rows["A"]
    assert (a.booking_status, a.passenger_key, a.route_key, a.cabin_class_key, a.origin_airport_key, a.dest_airport_key) == ("CANCELLED", 1, 1, 2, 1, 5)
    assert (a.booking_date_key, a.flight_date_key, a.days_before_departure, a.currency_code) == (20260601, 20260611, 10, "GBP")
    assert float(rows["B"].total_amount) == 100.25  # same status: nothing moves
    assert rows["D"].total_amount is None and rows["D"].flight_date_key is None and not rows["D"].has_checked_bag
    assert rows["E"].cabin_class_key is None and rows["E"].passenger_key == 2
    assert a.updated_at > a.created_at
    before = sorted(map(str, rows.values()))
    replay = json_landing(spark, str(tmp_path / "raw" / "2.json"), "PSS")  # the last batch; earlier ones are final
    feeds.bookings_batch(spark, airline(spark), reference.cabins(spark), log)(replay, 2)
    state = feeds.current_state(spark, log, feeds.BOOKING_FACT, feeds.BOOKING_KEY)
    assert sorted(map(str, state.collect())) == before
    compact = scratch_path(spark, "compact")
    feeds.compact_log(spark, log, feeds.BOOKING_FACT, feeds.BOOKING_KEY, compact)
    kept = feeds.read_log(spark, compact, feeds.BOOKING_FACT).drop("batch_id")
    assert sorted(map(str, kept.collect())) == before


def test_one_batch_gives_the_same_keys(spark, tmp_path):
    _, rows = run_bookings(spark, tmp_path, [BATCHES[0] + BATCHES[1][1:] + BATCHES[2][1:]])
    assert sorted(rows) == ["A", "B", "D", "E"]


@pytest.mark.parametrize("partition_by", [(), ("flight_date_key",)])
def test_flight_updates(spark, tmp_path, partition_by):
    t = airline(spark, [(1, 20260615, "SCHEDULED", 0, 0, 5), (2, 20260615, "SCHEDULED", 0, 0, 5)])
    base = t.flight.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    folder, log, mark = tmp_path / "raw", scratch_path(spark, "log"), scratch_path(spark, "mark")
    folder.mkdir()
    feeds.start_log(spark, log, base.schema, base, partition_by)
    update = {"flight_number": "SP0001", "flight_date": "2026-06-15", "status": "LANDED", "pax_flown": 63, "arrival_delay_min": None}
    (folder / "a.json").write_text(json.dumps(update) + "\n" + json.dumps({**update, "flight_number": "SP0099"}) + "\n")
    feeds.stream_flights(spark, str(folder), log, base.schema, mark, partition_by=partition_by).awaitTermination()
    rows = {r.flight_event_key: r for r in feeds.current_state(spark, log, base.schema, ["flight_event_key"]).collect()}
    assert len(rows) == 2 and rows[2].flight_status == "SCHEDULED" and rows[2].updated_at is None
    assert rows[1].flight_status == "LANDED" and rows[1].arrival_delay_min == 0 and rows[1].load_factor_pct == 20.0
    then = feeds.read_log(spark, log, base.schema, before=0)
    assert then.filter("flight_status = 'LANDED'").count() == 0  # the past is still there


def test_batch_days_prune_the_log(spark):
    path = scratch_path(spark, "days")
    spark.range(1000).select(F.col("id"), (F.col("id") % 500).cast("int").alias("day")).write.partitionBy("day").parquet(path)
    log_rows = spark.read.schema("id long, day int").parquet(path)
    for first, last in ((2, 4), (0, 450)):  # many days are pruned like few
        batch = spark.range(first, last).select(F.col("id").cast("int").alias("day"))
        kept = feeds.on_days_of(log_rows, batch, "day")
        assert sorted({r.day for r in kept.collect()}) == list(range(first, last))
        assert "PartitionFilters: [isnotnull(day" in kept._jdf.queryExecution().executedPlan().toString()
    assert feeds.on_days_of(log_rows, spark.range(0).select(F.col("id").cast("int").alias("day")), "day").count() == 0


def test_a_lost_checkpoint_does_not_replace_past_batches(spark):
    log = scratch_path(spark, "log")
    rows = spark.range(3).select(F.col("id").alias("delay_key"))
    for batch in (-1, 0, 1, 1):  # the last batch may be replayed
        feeds.write_batch(rows, log, batch)
    with pytest.raises(ValueError, match="would replace a past batch"):
        feeds.write_batch(rows.limit(0), log, 0)
    assert spark.read.parquet(log).count() == 9


def test_feedback_is_scored_once(spark, tmp_path):
    folder, sink, mark = tmp_path / "raw", scratch_path(spark, "sink"), scratch_path(spark, "mark")
    folder.mkdir()
    rows = [("P1", "Terrible, rude crew.", 9), ("P9", "Great flight, thank you!", 2), (None, None, 8)]
    for n, (person, words, nps) in enumerate(rows):
        body = {"passenger_id": person, "flight_date": "2026-06-11", "feedback_text": words, "nps_score": nps, "channel": "EMAIL"}
        (folder / f"{n}.json").write_text(json.dumps(body))
    for _ in range(2):
        feeds.stream_feedback(spark, str(folder), airline(spark).passenger, sink, mark).awaitTermination()
    got = {r.nps_score: r for r in spark.read.parquet(sink).collect()}
    assert len(got) == 3
    assert (got[9].passenger_key, got[9].sentiment_label, got[9].ai_priority, got[9].ai_action_required) == (1, "NEGATIVE", "CRITICAL", True)
    assert (got[2].passenger_key, got[2].sentiment_label, got[2].ai_action_required) == (None, "POSITIVE", True)
    assert got[8].sentiment_score is None and got[8].ai_priority == "LOW" and got[8].processed_at is not None


def test_alert_once_per_delay(spark):
    t = airline(spark, [(1, 20260615, "LANDED", 130, 130, 5)])
    changes = spark.createDataFrame([(7, 1, 130, "ATC"), (7, 1, 140, "ATC"), (8, 1, 120, "CREW")],
                                    "delay_key long, flight_event_key long, delay_minutes int, delay_category string")
    changes = changes.withColumn("at", F.lit("2026-06-15 10:00:00").cast("timestamp_ntz"))
    log = scratch_path(spark, "alerts")
    feeds.start_log(spark, log, feeds.ALERT_LOG)
    run = feeds.delay_alerts_batch(spark, t.flight, log, "at")
    for n in (0, 1, 1):
        run(changes, n)
    alerts = feeds.read_log(spark, log, feeds.ALERT_LOG).collect()
    assert len(alerts) == 1 and alerts[0].message.startswith("Flight SP0001 delayed 1") and alerts[0].severity == "HIGH"
    literal = scratch_path(spark, "literal")
    feeds.start_log(spark, literal, feeds.ALERT_LOG)
    feeds.delay_alerts_batch(spark, t.flight, literal, "at", once=False)(changes, 0)
    assert feeds.read_log(spark, literal, feeds.ALERT_LOG).count() == 2


def test_landed_lines_are_packed_and_read_as_they_were(spark, tmp_path, monkeypatch):
    from tarmac.registry import streams

    monkeypatch.setattr(streams, "FILE_LINES", 300)
    rows = spark.range(1000, numPartitions=1).select("id", F.lit("the same in every line, over and over again").alias("told"))
    streams.land(rows, str(tmp_path / "raw"))
    files = [*(tmp_path / "raw").glob("part-*")]
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 20_000  # 60,000 as plain text
    landed = json_landing(spark, str(tmp_path / "raw"), "PSS")
    assert sorted(json.loads(r.raw_text)["id"] for r in landed.collect()) == [*range(1000)]


def test_a_written_batch_leaves_no_shuffle_files(spark):
    import time

    def files():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before, log = files(), scratch_path(spark, "log")
    rows = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.max("id").alias("v")).orderBy("v")
    feeds.write_batch(rows, log, 0)
    until = time.time() + 20  # they are deleted a moment later
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.read.parquet(log).count() == 100


def test_merged_bookings_leave_only_the_log(spark):
    from pathlib import Path

    log = scratch_path(spark, "log")
    feeds.start_log(spark, log, feeds.BOOKING_FACT)
    rows = spark.createDataFrame([(f"B{n % 3}", n % 2, n, "HELD") for n in range(12)], "booking_reference string, passenger_key long, seq long, booking_status string")
    there = {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}
    feeds.merge_bookings(spark, rows.withColumn("ingest_timestamp", F.lit("2026-06-01").cast("timestamp_ntz")), log, 0, ["seq"])
    assert {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()} == there
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert feeds.read_log(spark, log, feeds.BOOKING_FACT).count() == 6


def test_empty_batches_are_skipped(spark):
    calls = []
    run = feeds.skip_when_empty(lambda rows, n: calls.append(n))
    run(spark.range(0), 0)
    run(spark.range(1), 1)
    assert calls == [1]
