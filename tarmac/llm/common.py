"""Helpers shared by the text operators: fresh names, row-wise Arrow maps, shipped code."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.session import scratch_path

# A record batch holds at most this many rows, so that long texts do not pile up in a worker.
BATCH_ROWS = 256
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()
_HELD: dict[str, dict[str, bytes]] = {}


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def held(name: str | None) -> dict[str, bytes]:
    """What this Python worker remembers under ``name`` from task to task.

    Workers are reused: whatever another name left there is dropped, so that one operator's
    memory does not stand beside the next one's.
    """
    for other in [n for n in _HELD if n != name]:
        del _HELD[other]
    return {} if name is None else _HELD.setdefault(name, {})


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside sends a Python worker at most ``BATCH_ROWS`` rows at once.

    By its default Spark gathers 10,000 whole texts, once in the executor and once in the worker.
    A lower setting of the caller holds; afterwards the session is as it was.
    """
    before = spark.conf.get(ARROW_ROWS, None)
    if before is None or not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_ROWS)
        else:
            spark.conf.set(ARROW_ROWS, before)


class Scratch:
    """Intermediate tables in the shared scratch folder that are deleted together.

    Drop them only when no DataFrame that reads them is used any more. Many small tables make
    many plans: what they leave is released after each, or the driver holds the broadcast sides
    and plans of all until its heap is full, and executors the shuffle files.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows by way of a written table."""
        path = scratch_path(self.spark, "rows")
        with small_batches(self.spark):
            df.write.parquet(path)
        self.paths.append(path)
        self._release()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the tables written so far."""
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []
        self._release()

    def _release(self) -> None:
        self.spark._jvm.System.gc()  # Spark drops broadcasts and shuffle files of what is no longer referred to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first ``name_<n>`` that clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    n, out = 0, name
    while out.lower() in taken:
        n, out = n + 1, f"{name}_{n}"
    return out


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def annotate(
    df: DataFrame, text: str, keep: Sequence[str], schema: str, make: Callable[[], Callable[[list], list[Sequence]]]
) -> DataFrame:
    """The ``keep`` columns and the columns of ``schema`` computed from the text of each row.

    ``make`` is called once in each task and returns the function from a list of texts
    (None for null) to one sequence per column of ``schema``. Rows are neither moved nor dropped.
    """
    ship(df.sparkSession)
    added = StructType.fromDDL(schema)
    source = df.select(F.col(f"`{text}`").cast("string").alias(fresh(df, "__text")), *[F.col(f"`{c}`") for c in keep])
    kept = StructType(source.schema.fields[1:])
    arrow = [_arrow_type(f) for f in added.fields]
    names = [*keep, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        score = make()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                columns = score(part.column(0).to_pylist())
                arrays = [pa.array(c, type=t) for c, t in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays], names=names)

    return source.mapInArrow(run, StructType([*kept.fields, *added.fields]))


def _arrow_type(field) -> pa.DataType:
    kinds = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
        "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()),
    }
    return kinds[field.dataType.simpleString()]
