"""Past states from checkpoints and a tail: what a read costs does not grow with the age of the log.

Changes are kept by the day of their time stamp. Now and then the whole state at an instant is
written as a checkpoint. The state at ``t`` is the newest checkpoint no later than ``t`` and the
changes after it, whose days alone are opened. A change that arrives late, dated at or before a
checkpoint, makes that checkpoint and later ones wrong: they are deleted before it is added.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.dates import AsOf, as_of_ts
from tarmac.operators.upsert import latest_per_key

DAY, BATCH = "change_day", "batch"


class History:
    """The changes of a table by day, and its checkpoints.

    ``ts`` is the time stamp of a change; of a key's changes at one instant the later batch counts.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], ts: str) -> None:
        self.spark, self.path, self.schema, self.keys, self.ts = spark, path.rstrip("/"), schema, list(keys), ts
        self.rows_schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        self.opened: list[str] = []  # folders that the last read opened

    def _names(self, folder: str, prefix: str) -> list[str]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        store = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []
        return sorted(n.removeprefix(prefix) for n in found if n.startswith(prefix))

    def _delete(self, folder: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def checkpoints(self) -> list[datetime]:
        """The instants of the checkpoints that are whole, oldest first."""
        whole = [n for n in self._names("states", "at=") if self._names(f"states/at={n}", "_SUCCESS")]
        return [datetime.strptime(n, "%Y%m%d-%H%M%S-%f") for n in whole]

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Add a batch of changes; a replay of it writes the same folders again."""
        rows = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        first = rows.agg(F.min(self.ts).alias("t")).first()["t"]
        for at in self.checkpoints():
            if first is not None and at >= first:
                self._delete(f"states/at={at:%Y%m%d-%H%M%S-%f}")
        placed = rows.withColumn(DAY, F.to_date(self.ts)).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        placed = placed.hint("rebalance", F.col(DAY))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY, BATCH).parquet(f"{self.path}/changes")

    def _changes(self, after: datetime | None, until: datetime) -> DataFrame:
        """The changes after one instant and up to another, from the folders of their days."""
        days = [d for d in self._names("changes", f"{DAY}=") if d[:4].isdigit()]  # a change without a time has no state
        days = [d for d in days if (after is None or date.fromisoformat(d) >= after.date()) and date.fromisoformat(d) <= until.date()]
        self.opened = [f"changes/{DAY}={d}" for d in days]
        if not days:
            return self.spark.createDataFrame([], self.rows_schema)
        reader = self.spark.read.schema(self.rows_schema).option("basePath", f"{self.path}/changes")
        rows = reader.parquet(*[f"{self.path}/{f}" for f in self.opened]).select(*self.rows_schema.fieldNames())
        rows = rows.filter(F.col(self.ts) <= as_of_ts(until))
        return rows if after is None else rows.filter(F.col(self.ts) > as_of_ts(after))

    def _instant(self, at: AsOf) -> datetime:
        return self.spark.range(1).select(as_of_ts(at).alias("t")).first()["t"]

    def as_of(self, at: AsOf) -> DataFrame:
        """The newest change of each key no later than ``at``."""
        until = self._instant(at)
        known = [c for c in self.checkpoints() if c <= until]
        rows = self._changes(known[-1] if known else None, until)
        if known:
            folder = f"states/at={known[-1]:%Y%m%d-%H%M%S-%f}"
            self.opened.append(folder)
            rows = rows.union(self.spark.read.schema(self.rows_schema).parquet(f"{self.path}/{folder}"))
        return latest_per_key(rows, self.keys, [self.ts, BATCH]).drop(BATCH)

    def checkpoint(self, at: AsOf) -> None:
        """Write the state at an instant, out of the checkpoint before it and the changes since."""
        until = self._instant(at)
        known = [c for c in self.checkpoints() if c <= until]
        rows = self._changes(known[-1] if known else None, until)
        if known:
            rows = rows.union(self.spark.read.schema(self.rows_schema).parquet(f"{self.path}/states/at={known[-1]:%Y%m%d-%H%M%S-%f}"))
        state = latest_per_key(rows, self.keys, [self.ts, BATCH])
        if not (known and known[-1] == until):
            state.select(*self.rows_schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/states/at={until:%Y%m%d-%H%M%S-%f}")
