"""Query registry: a Spark callable and, where SQL can say it, an oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result types that read the same in any engine.

    Integers as bigint, other numbers as double rounded to 4 places, dates and
    timestamps as text.
    """
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind in ("tinyint", "smallint", "int", "bigint"):
            c = c.cast("bigint")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal") or kind in ("float", "double"):
            c = F.round(F.round(c.cast("double"), 10), 4)  # binary noise first, then the tie
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add
