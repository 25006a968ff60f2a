"""A keyed state next to a change log: the newest version of every key, found by opening few files.

The state is a set of runs. Every micro-batch adds one run of level 0 with the versions it wrote;
once a level has ``fanout`` runs they are merged into one of the next level, in which only the
newest version of a key is left. A run is split into hash buckets, ``fanout`` times as many on
each level, so files stay of a size while the state grows, and a bucket of a level is part of one
bucket of the level below. A batch asks for its keys: it opens, in each run, the files of their
buckets. There are fewer than ``fanout`` runs on a level and levels as the logarithm of the number
of batches, so what a batch opens depends on its keys and hardly on the age of the log.

Which runs there are after batch n stands in the manifest of n, written last. A replay of n starts
from the manifest before it and writes the same folders again; runs are deleted only when neither
of the last two manifests names them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.upsert import latest_per_key

BUCKET = "__bucket"
BASE_BATCH = -1


@dataclass(frozen=True)
class Run:
    """One run: its folder, level, number of buckets, and the buckets that have rows."""

    name: str
    level: int
    buckets: int
    present: tuple[int, ...]


class KeyedState:
    """The newest versions of a change log, by key.

    ``keys`` are what a batch asks for; ``version_keys`` (by default the same) tell rows apart.
    ``deleted`` names a boolean column: rows whose newest version has it set are not returned,
    and leave the state with the merge into the last level.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
        version_keys: Sequence[str] | None = None, fanout: int = 8, base_buckets: int = 4, max_level: int = 5,
        deleted: str | None = None,
    ) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = schema
        self.rows_schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        self.version_keys = list(version_keys or keys)
        self.fanout, self.base_buckets, self.max_level, self.deleted = fanout, base_buckets, max_level, deleted
        self.opened = 0  # files that the last lookup opened

    # -- files -------------------------------------------------------------------------------

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, folder: str) -> list[str]:
        store, where = self._fs(folder)
        return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []

    def _batches(self) -> list[int]:
        """The batches whose manifest is whole, newest last."""
        found = [int(n.removeprefix("batch=")) for n in self._names(f"{self.path}/manifest") if n.startswith("batch=")]
        return sorted(n for n in found if "_SUCCESS" in self._names(f"{self.path}/manifest/batch={n}"))

    def runs(self, before: int | None = None) -> list[Run]:
        """The runs after the newest batch, or after the newest one below ``before``."""
        known = [n for n in self._batches() if before is None or n < before]
        return self._read(known[-1]) if known else []

    def _read(self, batch_id: int) -> list[Run]:
        text = self.spark.read.text(f"{self.path}/manifest/batch={batch_id}", wholetext=True).first()
        return [Run(r["name"], r["level"], r["buckets"], tuple(r["present"])) for r in json.loads(text["value"])]

    def _commit(self, runs: Sequence[Run], batch_id: int) -> None:
        body = json.dumps([r.__dict__ for r in runs])
        rows = self.spark.createDataFrame([[body]], "value string").coalesce(1)
        rows.write.mode("overwrite").text(f"{self.path}/manifest/batch={batch_id}")

    def _sweep(self) -> None:
        """Delete manifests before the last two, and runs that those two do not name."""
        batches = self._batches()
        named = {r.name for n in batches[-2:] for r in self._read(n)}
        gone = [f"manifest/batch={n}" for n in batches[:-2]]
        gone += [f"runs/{n}" for n in self._names(f"{self.path}/runs") if n not in named]
        for name in gone:
            store, where = self._fs(f"{self.path}/{name}")
            store.delete(where, True)

    # -- rows --------------------------------------------------------------------------------

    def _buckets(self, level: int) -> int:
        return self.base_buckets * self.fanout ** min(level, self.max_level)

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")

    def _write(self, rows: DataFrame, name: str, level: int) -> Run:
        count = self._buckets(level)
        placed = rows.select(*self.rows_schema.fieldNames(), self._bucket(count).alias(BUCKET))
        folder = f"{self.path}/runs/{name}"
        # A bucket is one task and one file: keys are unique, so no bucket is hot.
        placed.repartition(F.col(BUCKET)).sortWithinPartitions(*self.keys).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        present = sorted(int(n.removeprefix(f"{BUCKET}=")) for n in self._names(folder) if n.startswith(f"{BUCKET}="))
        return Run(name, level, count, tuple(present))

    def _files(self, runs: Sequence[Run], wanted: dict[int, set[int]] | None = None) -> DataFrame:
        """The rows of runs, or of those of their buckets that are wanted, by number of buckets."""
        folders = [
            f"{self.path}/runs/{r.name}/{BUCKET}={b}" for r in runs for b in r.present
            if wanted is None or b in wanted[r.buckets]
        ]
        self.opened = len(folders)
        if not folders:
            return self.spark.createDataFrame([], self.rows_schema)
        return self.spark.read.schema(self.rows_schema).parquet(*folders)

    def _alive(self, rows: DataFrame) -> DataFrame:
        newest = latest_per_key(rows, self.version_keys, ["batch_id"])
        return newest if self.deleted is None else newest.filter(~F.coalesce(F.col(self.deleted), F.lit(False)))

    def lookup(self, asked: DataFrame, before: int | None = None) -> DataFrame:
        """The newest versions of just the keys that ``asked`` holds, as of the batch below ``before``.

        At most one bucket number a bucket of the finest level in use is collected.
        """
        runs = self.runs(before)
        asked = asked.select(*self.keys).distinct()
        finest = max((r.buckets for r in runs), default=1)
        hit = {r[0] for r in asked.select(self._bucket(finest)).distinct().collect()} if runs else set()
        wanted = {r.buckets: {b % r.buckets for b in hit} for r in runs}  # counts divide one another
        found = self._files(runs, wanted).join(asked, self.keys, "left_semi")
        return self._alive(found).drop("batch_id")

    def current(self, before: int | None = None) -> DataFrame:
        """The newest version of every key."""
        return self._alive(self._files(self.runs(before))).drop("batch_id")

    def start(self, base: DataFrame | None = None) -> None:
        """Begin with the versions known before the first batch."""
        if base is None:
            self._commit([], BASE_BATCH)
        else:
            level = 0
            while level < self.max_level and base.count() > 100_000 * self._buckets(level):
                level += 1
            self._commit([self._write(self._versioned(base, BASE_BATCH), f"base-{level}", level)], BASE_BATCH)

    def _versioned(self, rows: DataFrame, batch_id: int) -> DataFrame:
        cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        return rows.select(*cast, F.lit(batch_id).cast("bigint").alias("batch_id"))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add the versions that a batch wrote (one for each version key), after merging full levels."""
        newest = [n for n in self._batches() if n > batch_id]
        if newest:
            raise ValueError(f"batch {batch_id} would replace a past batch of {self.path}, whose last is {newest[-1]}")
        runs, level = self.runs(batch_id), 0
        while level <= self.max_level:
            full = [r for r in runs if r.level == level]
            if len(full) >= self.fanout:
                rest = [r for r in runs if r.level != level]
                merged = latest_per_key(self._files(full), self.version_keys, ["batch_id"])
                if self.deleted is not None and not any(r.level > level for r in rest):
                    merged = merged.filter(~F.coalesce(F.col(self.deleted), F.lit(False)))
                target = min(level + 1, self.max_level)
                runs = [*rest, self._write(merged, f"merged-{batch_id}-{target}", target)]
            level += 1
        runs.append(self._write(self._versioned(rows, batch_id), f"batch-{batch_id}", 0))
        self._commit(runs, batch_id)
        self._sweep()
