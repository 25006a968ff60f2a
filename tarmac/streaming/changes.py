"""A feed of row versions, each passed on once, with late ones listed instead of lost.

Streaming deduplication with a watermark drops what arrives too late without a word. Here the
watermark is kept beside the log: a batch is held against the latest time that earlier batches
have seen, less a delay. Versions older than that go to a log of late rows, versions that were
passed on before are counted as repeated, and the accounts of a batch say how many there were of
each. All is written per batch and rewritten by its replay.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.ranges import stored
from tarmac.schemas import struct
from tarmac.streaming.feeds import BatchFn, read_log, start_log, write_batch
from tarmac.streaming.keyed import KeyedState

ACCOUNTS = struct("messages bigint, late bigint, repeated bigint, passed bigint, latest timestamp_ntz")


class ChangeFeed:
    """The folders of a feed of versions: what was passed on, what came late, and the accounts.

    ``keys`` and ``ts`` tell versions apart; a version without a time stamp or key is late by definition.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], ts: str, late: timedelta) -> None:
        self.spark, self.path, self.schema, self.keys, self.ts, self.late = spark, path, schema, list(keys), ts, late
        own = T.StructType([schema[c] for c in (*keys, ts)])
        self.seen = KeyedState(spark, f"{path}/seen", own, [*keys, ts])

    def start(self) -> None:
        for name, schema in (("log", self.schema), ("late", self.schema), ("accounts", ACCOUNTS)):
            start_log(self.spark, f"{self.path}/{name}", schema)
        self.seen.start()

    def read(self, name: str = "log", before: int | None = None) -> DataFrame:
        schema = ACCOUNTS if name == "accounts" else self.schema
        return read_log(self.spark, f"{self.path}/{name}", schema, before).filter(F.col("batch_id") >= 0)

    def batch(self) -> BatchFn:
        def run(rows: DataFrame, batch_id: int) -> None:
            self.take(rows, batch_id)

        return run

    def take(self, rows: DataFrame, batch_id: int) -> None:
        """Pass on the versions of a batch that are neither late nor repeated."""
        identity, ts = [*self.keys, self.ts], F.col(self.ts)
        rows = stored(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]))
        latest = self.read("accounts", batch_id).agg(F.max("latest").alias("t")).first()["t"]
        known = F.lit(True)
        for c in identity:
            known = known & F.col(c).isNotNull()
        limit = None if latest is None else F.lit((latest - self.late).isoformat(sep=" ")).cast("timestamp_ntz")
        timely = known if limit is None else known & (ts.cast("timestamp_ntz") >= limit)
        write_batch(rows.filter(~timely), f"{self.path}/late", batch_id)
        unique = rows.filter(timely).dropDuplicates(identity)
        fresh = stored(unique.join(self.seen.lookup(unique, batch_id), identity, "left_anti").select(*self.schema.fieldNames()))
        write_batch(fresh, f"{self.path}/log", batch_id)
        self.seen.write(fresh.select(*identity), batch_id)
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~timely).alias("late"), F.max(ts.cast("timestamp_ntz")).alias("t")).first()
        passed = fresh.count()
        newest = max([t for t in (latest, told["t"]) if t is not None], default=None)
        row = [told["n"], told["late"], told["n"] - told["late"] - passed, passed, newest]
        write_batch(self.spark.createDataFrame([row], ACCOUNTS), f"{self.path}/accounts", batch_id)
