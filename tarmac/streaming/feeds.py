"""Streaming ingest: raw JSON feeds into fact tables kept as change logs.

A fact fed by a stream is an append-only log: micro-batch n writes the rows it
inserted or changed to ``batch_id=n``, overwriting that folder only. A replayed
batch therefore writes the same rows to the same place, a batch costs what it
changes and not the whole table, and past states stay readable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.functions.conditions import action_required, feedback_priority, sentiment_label
from tarmac.functions.dates import date_key
from tarmac.functions.text import sentiment, summarise
from tarmac.operators.joins import current_rows, unique_lookup
from tarmac.operators.ranges import Kept, shuffles_released, stored
from tarmac.operators.upsert import latest_per_key, merge_changes, merge_update_only, with_keys
from tarmac.schemas import struct
from tarmac.sources.raw import json_landing, payload
from tarmac.streaming.keyed import KeyedState
from tarmac.tables import Tables

BatchFn = Callable[[DataFrame, int], None]
BASE_BATCH = -1
DAYS_LISTED = 366  # days of a batch that a scan is given one by one

# Payload fields and their types.
BOOKING_FIELDS = {
    "booking_reference": "string", "passenger_id": "string", "flight_number": "string", "route_code": "string",
    "booking_date": "date", "flight_date": "date", "cabin_class": "string", "origin": "string",
    "destination": "string", "channel": "string", "status": "string", "fare_class": "string",
    "fare_amount": "decimal(10,2)", "tax_amount": "decimal(10,2)", "total_amount": "decimal(10,2)",
    "ancillary_revenue": "decimal(8,2)", "has_checked_bag": "boolean", "has_seat_selection": "boolean",
}
FLIGHT_FIELDS = {
    "flight_number": "string", "flight_date": "date", "status": "string", "actual_departure": "timestamp_ntz",
    "actual_arrival": "timestamp_ntz", "departure_delay_min": "int", "arrival_delay_min": "int",
    "pax_flown": "int", "fuel_consumed_kg": "int",
}
FEEDBACK_FIELDS = {
    "passenger_id": "string", "flight_date": "date", "feedback_text": "string", "subject": "string",
    "nps_score": "int", "overall_rating": "int", "channel": "string",
}
BOOKING_FACT = struct(
    "booking_reference string, passenger_key bigint, route_key bigint, booking_date_key int, "
    "flight_date_key int, cabin_class_key int, origin_airport_key bigint, dest_airport_key bigint, "
    "booking_channel string, booking_status string, fare_class string, fare_amount money, "
    "tax_amount money, total_amount money, ancillary_revenue extras, "
    "currency_code string, has_checked_bag boolean, has_seat_selection boolean, "
    "days_before_departure int, created_at timestamp_ntz, updated_at timestamp_ntz"
)
BOOKING_DEFAULTS = {"currency_code": "GBP", "has_checked_bag": False, "has_seat_selection": False}
BOOKING_KEY = ["booking_reference", "passenger_key"]
FLIGHT_KEY = ["flight_number", "flight_date_key"]


def append_stream(
    spark: SparkSession, path: str, source_system: str, max_files: int | None = None
) -> DataFrame:
    """Only the rows not consumed yet; the checkpoint of the query is the consumer's offset."""
    return json_landing(spark, path, source_system, stream=True, max_files=max_files)


def change_stream(changes: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """A feed of row versions, each version once although files or retries repeat it."""
    timed = changes.withColumn("__at", F.col(ts).cast("timestamp"))
    return timed.withWatermark("__at", late).dropDuplicatesWithinWatermark([*keys, ts]).drop("__at")


def skip_when_empty(batch_fn: BatchFn) -> BatchFn:
    """Run a batch only if it has rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch_fn(batch, batch_id)

    return run


def start_batches(
    stream: DataFrame, batch_fn: BatchFn, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run per micro-batch: on a schedule, or once over what is available."""
    writer = stream.writeStream.foreachBatch(skip_when_empty(batch_fn)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def write_batch(rows: DataFrame, log: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write (or, on a replay, rewrite) the folder of one batch, partitioned inside if asked for.

    Only the last batch may be rewritten. A checkpoint that was lost starts to count
    anew, and would replace the past batch by batch: that raises.
    """
    if (newest := last_batch(rows.sparkSession, log)) is not None and newest > batch_id:
        raise ValueError(f"batch {batch_id} would replace a past batch of {log}, whose last is {newest}")
    if partition_by:
        # evens out files: small partitions share a task, a hot one is split
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    with shuffles_released(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(f"{log}/batch_id={batch_id}")


def last_batch(spark: SparkSession, log: str) -> int | None:
    """The largest batch number of a log, by the names of its folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return None
    names = [f.getPath().getName() for f in store.listStatus(path)]
    return max((int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")), default=None)


def read_log(spark: SparkSession, log: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The change log with its ``batch_id``; ``before`` hides the batch being replayed and later ones.

    The schema is given, so no file is opened for inference and an empty log is no error.
    """
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(with_batch).option("basePath", log).option("pathGlobFilter", "*.parquet").parquet(log)
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def start_log(
    spark: SparkSession, log: str, schema: T.StructType, base: DataFrame | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Create the log with the rows known before the stream starts."""
    rows = base if base is not None else spark.createDataFrame([], schema)
    write_batch(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]), log, BASE_BATCH, partition_by)


def current_state(spark: SparkSession, log: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The table as of now: the newest version of every key."""
    return latest_per_key(read_log(spark, log, schema), keys, ["batch_id"]).drop("batch_id")


def compact_log(
    spark: SparkSession, log: str, schema: T.StructType, keys: Sequence[str], to: str, partition_by: Sequence[str] = ()
) -> None:
    """Start a new log from the current state; switch the stream to it between two runs."""
    start_log(spark, to, schema, current_state(spark, log, schema, keys), partition_by)


def state_of(
    spark: SparkSession, log: str, schema: T.StructType, keys: Sequence[str], batch_keys: DataFrame, batch_id: int
) -> DataFrame:
    """Current versions of just the keys a batch touches."""
    touched = read_log(spark, log, schema, batch_id).join(batch_keys.distinct(), list(keys), "left_semi")
    return latest_per_key(touched, keys, ["batch_id"]).drop("batch_id")


def write_changes(
    changes: DataFrame, log: str, batch_id: int, keyed: KeyedState | None, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Append a batch's changes to the log, and to the keyed state if there is one.

    The state takes the rows as they stand in the log. A replay of a batch that ended between
    the two writes finds the state as it was before the batch, and repeats both.
    """
    write_batch(changes, log, batch_id, partition_by)
    if keyed:
        spark = changes.sparkSession
        keyed.write(read_log(spark, log, schema).filter(F.col("batch_id") == batch_id).drop("batch_id"), batch_id)


def parse_bookings(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Typed booking messages (``extra``: columns of the raw rows to carry along)."""
    rows = raw.select("ingest_timestamp", *extra, *payload("raw_data", BOOKING_FIELDS))
    return rows.withColumns({
        "booking_date_key": date_key(F.col("booking_date")),
        "flight_date_key": date_key(F.col("flight_date")),
        "days_before_departure": F.datediff("flight_date", "booking_date"),
    }).withColumnsRenamed({"channel": "booking_channel", "status": "booking_status"})


def resolve_bookings(rows: DataFrame, t: Tables, cabins: DataFrame) -> DataFrame:
    """Business keys to surrogate keys: passenger, route, cabin and both airports."""
    lookups = [
        (current_rows(t.passenger), "passenger_id", "passenger_id", "passenger_key", "passenger_key"),
        (t.route, "route_code", "route_code", "route_key", "route_key"),
        (cabins, "cabin_class", "cabin_code", "cabin_class_key", "cabin_class_key"),
        (t.airport, "origin", "iata_code", "airport_key", "origin_airport_key"),
        (t.airport, "destination", "iata_code", "airport_key", "dest_airport_key"),
    ]
    for dim, code, dim_code, value, name in lookups:
        rows = unique_lookup(rows, dim, code, dim_code, value, name)
    return rows.drop("passenger_id", "route_code", "cabin_class", "origin", "destination", "flight_number",
                     "booking_date", "flight_date")


def merge_bookings(
    spark: SparkSession, source: DataFrame, log: str, batch_id: int, order: Sequence[str] = ("ingest_timestamp",),
    keyed: KeyedState | None = None,
) -> None:
    """Upsert resolved bookings: append the inserted and status-changed rows to the log.

    With a ``keyed`` state beside the log, the batch opens the few files that can hold its
    keys; without one it reads the whole log for them.
    """
    rows = with_keys(source, BOOKING_KEY).withColumn("created_at", F.col("ingest_timestamp"))
    with Kept() as keep:
        # reduced before it is used twice: the state needs the batch's keys, the merge its rows
        rows = keep(latest_per_key(rows, BOOKING_KEY, order))
        asked = rows.select(*BOOKING_KEY)
        state = keyed.lookup(asked, batch_id) if keyed else state_of(spark, log, BOOKING_FACT, BOOKING_KEY, asked, batch_id)
        changes = merge_changes(
            state, rows, BOOKING_KEY, "booking_status", "updated_at", F.col("s.ingest_timestamp"), order, BOOKING_DEFAULTS
        )
        write_changes(changes, log, batch_id, keyed, BOOKING_FACT)


def bookings_batch(spark: SparkSession, t: Tables, cabins: DataFrame, log: str) -> BatchFn:
    """Parse, resolve and upsert a batch of raw bookings."""

    def run(batch: DataFrame, batch_id: int) -> None:
        merge_bookings(spark, resolve_bookings(parse_bookings(batch), t, cabins), log, batch_id)

    return run


def stream_bookings(
    spark: SparkSession, raw_path: str, t: Tables, cabins: DataFrame, log: str, checkpoint: str,
    every: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """New bookings every 5 minutes (``every='5 minutes'``) or once over what is there."""
    raw = append_stream(spark, raw_path, "PSS", max_files)
    return start_batches(raw, bookings_batch(spark, t, cabins, log), checkpoint, every)


def parse_flight_updates(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    rows = raw.select("ingest_timestamp", *extra, *payload("raw_data", FLIGHT_FIELDS))
    keyed = rows.withColumn("flight_date_key", date_key(F.col("flight_date"))).drop("flight_date")
    return keyed.withColumnRenamed("status", "flight_status")


FLIGHT_FILL = (
    "actual_departure", "actual_arrival", "departure_delay_min", "arrival_delay_min", "pax_flown", "fuel_consumed_kg",
)


def apply_flight_updates(target: DataFrame, updates: DataFrame, order: Sequence[str]) -> DataFrame:
    """Overwrite the status, fill in new measures, recompute the load factor."""
    load = F.col("pax_flown") * 100.0 / F.nullif(F.col("seat_capacity"), F.lit(0))
    return merge_update_only(
        target, updates, FLIGHT_KEY, ["flight_status"], FLIGHT_FILL, {"load_factor_pct": load},
        "updated_at", F.col("s.ingest_timestamp"), order,
    )


def on_days_of(log_rows: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """Log rows on the days that a batch names.

    The days become constants, so the scan leaves out the partitions of other days; the
    join that follows picks the rows. Up to ``DAYS_LISTED`` days are listed, so that one
    mistyped year does not open the whole log; of more the first and the last are taken.
    """
    days = [r[0] for r in batch.select(day).filter(F.col(day).isNotNull()).distinct().limit(DAYS_LISTED + 1).collect()]
    if len(days) <= DAYS_LISTED:
        return log_rows.filter(F.col(day).isNotNull() & F.col(day).isin(sorted(days)))
    span = batch.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return log_rows.filter(F.col(day).between(span["first"], span["last"]))


def merge_flights(
    spark: SparkSession, updates: DataFrame, log: str, schema: T.StructType, batch_id: int,
    order: Sequence[str] = ("ingest_timestamp",), partition_by: Sequence[str] = (), keyed: KeyedState | None = None,
) -> None:
    """Append new versions of the flights the messages name; unknown flights are dropped.

    Two flights may share a message key, so versions are told apart by the
    flight's own key. With a log partitioned by flight date (``partition_by``) a
    batch reads only the days it names; with a ``keyed`` state (its version key is
    ``flight_event_key``) only the files that can hold the flights it names.
    """
    # parsed once: the days, the named flights and the merge all read it
    rows = latest_per_key(with_keys(updates, FLIGHT_KEY), FLIGHT_KEY, order).persist()
    try:
        named = rows.select(*FLIGHT_KEY)
        if keyed:
            state = keyed.lookup(named, batch_id)
        else:
            past = read_log(spark, log, schema, batch_id)
            if partition_by:
                past = on_days_of(past, named, "flight_date_key")
            touched = past.join(named, FLIGHT_KEY, "left_semi")
            state = latest_per_key(touched, ["flight_event_key"], ["batch_id"]).drop("batch_id")
        write_changes(apply_flight_updates(state, rows, order), log, batch_id, keyed, schema, partition_by)
    finally:
        rows.unpersist()


def flights_batch(
    spark: SparkSession, log: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> BatchFn:
    def run(batch: DataFrame, batch_id: int) -> None:
        merge_flights(spark, parse_flight_updates(batch), log, schema, batch_id, partition_by=partition_by)

    return run


def stream_flights(
    spark: SparkSession, raw_path: str, log: str, schema: T.StructType, checkpoint: str,
    every: str | None = None, max_files: int | None = None, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Flight status messages every 2 minutes or once over what is there."""
    raw = append_stream(spark, raw_path, "OPS", max_files)
    return start_batches(raw, flights_batch(spark, log, schema, partition_by), checkpoint, every)


def enrich_feedback(raw: DataFrame, passenger: DataFrame, stamp: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Raw feedback to fact rows: passenger, score, label, summary, action, priority.

    A plain stream-static join plus row expressions, so it is the same for batch
    and stream. ``stamp`` sets processed_at, so that the batch enrichment does
    not score the row again. ``keep`` names columns of the raw rows to carry along.
    """
    rows = raw.select("ingest_timestamp", *keep, *payload("raw_data", FEEDBACK_FIELDS))
    members = current_rows(passenger).select("passenger_id", "passenger_key")
    scored = rows.join(members, "passenger_id", "left").withColumn("score", sentiment(F.col("feedback_text")))
    score = F.col("score")
    return scored.select(
        *keep, "passenger_key", date_key(F.col("flight_date")).alias("flight_date_key"),
        F.col("channel").alias("feedback_channel"), F.col("ingest_timestamp").alias("feedback_timestamp"),
        "feedback_text", F.col("subject").alias("feedback_subject"), "nps_score", "overall_rating",
        score.alias("sentiment_score"), sentiment_label(score).alias("sentiment_label"),
        summarise(F.col("feedback_text")).alias("ai_summary"),
        action_required(score, F.col("nps_score")).alias("ai_action_required"),
        feedback_priority(score).alias("ai_priority"),
        (F.col("ingest_timestamp") if stamp else F.lit(None).cast("timestamp_ntz")).alias("processed_at"),
    )


def stream_feedback(
    spark: SparkSession, raw_path: str, passenger: DataFrame, sink: str, checkpoint: str,
    every: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """Scored feedback every 10 minutes, appended exactly once by the file sink."""
    rows = enrich_feedback(append_stream(spark, raw_path, "FEEDBACK", max_files), passenger)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


ALERT_LOG = struct(
    "delay_key bigint, alert_type string, severity string, flight_number string, message string, "
    "acknowledged boolean, created_at timestamp_ntz"
)


def delay_alert_rows(delays: DataFrame, flights: DataFrame, at: str) -> DataFrame:
    named = delays.filter(F.col("delay_minutes") > 120).join(
        flights.select("flight_event_key", "flight_number"), "flight_event_key"
    )
    message = F.concat(
        F.lit("Flight "), "flight_number", F.lit(" delayed "), F.col("delay_minutes").cast("string"),
        F.lit(" min due to "), "delay_category",
    )
    return named.select(
        "delay_key", F.lit("CRITICAL_DELAY").alias("alert_type"), F.lit("HIGH").alias("severity"),
        "flight_number", message.alias("message"), F.lit(False).alias("acknowledged"), F.col(at).alias("created_at"),
    )


def delay_alerts_batch(
    spark: SparkSession, flights: DataFrame, log: str, at: str, once: bool = True, keyed: KeyedState | None = None
) -> BatchFn:
    """Alert rows of a batch of delay changes; ``once`` alerts a delay key a single time.

    With a ``keyed`` state (by ``delay_key``) the batch asks it for its own keys instead of
    reading all alerts.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = delay_alert_rows(batch, flights, at)
        if once:
            rows = latest_per_key(rows, ["delay_key"], ["created_at"])
            known = keyed.lookup(rows, batch_id) if keyed else read_log(spark, log, ALERT_LOG, batch_id)
            rows = rows.join(known.select("delay_key"), "delay_key", "left_anti")
        write_changes(rows.select(*ALERT_LOG.fieldNames()), log, batch_id, keyed, ALERT_LOG)

    return run


def stream_delay_alerts(
    spark: SparkSession, changes: DataFrame, flights: DataFrame, log: str, checkpoint: str, at: str,
    every: str | None = None,
) -> StreamingQuery:
    return start_batches(changes, delay_alerts_batch(spark, flights, log, at), checkpoint, every)


def surge_window(
    feedback: DataFrame, ts: str, score: str, late: str = "30 minutes", below: float = -0.6, more_than: int = 10
) -> DataFrame:
    """Sliding hours (every 15 minutes) with more than 10 very negative feedbacks."""
    bad = feedback.filter(F.col(score) < below).withColumn("__at", F.col(ts).cast("timestamp"))
    return (
        bad.withWatermark("__at", late)
        .groupBy(F.window("__at", "1 hour", "15 minutes"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > more_than)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n")
    )


def gold_refresh_batch(
    recompute: Callable[[DataFrame], DataFrame], unit: str, gold_path: str, partition: str
) -> BatchFn:
    """Recompute the units (days, months) a batch touches and replace only their partitions.

    ``unit`` is the column of the batch that names them, ``partition`` that of the
    gold table. Choose a unit whose partition is worth a file: a table of one row
    a day is kept by month. The partition of a unit that comes out empty is deleted.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(F.col(unit).alias(partition)).distinct()
        replace_partitions(recompute(batch.select(unit).distinct()), touched, gold_path, partition)

    return run


def replace_partitions(rows: DataFrame, touched: DataFrame, table_path: str, partition: str) -> None:
    """Make ``rows`` the content of the partitions that ``touched`` names, and delete those without a row.

    Running it again with the same rows changes nothing, so a batch that fails between the
    two steps is put right by its replay. What is collected is at most one value a partition.
    """
    fresh = stored(rows)
    (
        fresh.hint("rebalance", F.col(partition))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table_path)
    )
    spark = rows.sparkSession
    store = spark._jvm.org.apache.hadoop.fs.Path(table_path).getFileSystem(spark._jsc.hadoopConfiguration())
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    gone = touched.join(fresh.select(partition).distinct(), partition, "left_anti").select(F.col(partition).cast("string"))
    for (value,) in gone.filter(F.col(partition).isNotNull()).collect():
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/{folder(partition, value)}"), True)


def gold_refresh(
    changes: DataFrame, recompute: Callable[[DataFrame], DataFrame], unit: str, gold_path: str,
    partition: str, checkpoint: str, every: str | None = None,
) -> StreamingQuery:
    return start_batches(changes, gold_refresh_batch(recompute, unit, gold_path, partition), checkpoint, every)
