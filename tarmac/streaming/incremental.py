"""Views of sums kept up to date by signed deltas: the cost follows what changed, not the month it is in.

A view sums, for each unit (a day, a route), what its base rows contribute. A base row (a flight)
has totals of its detail tables (bookings, feedback, delays): row counts and sums, which are also
the weights of the fan-out of several details. Two keyed states are kept: base rows with their
totals, and units with their sums.

A change is a row and a sign: +1 for a new version, -1 for the old one it replaces or for a row
that goes. A batch adds up the signed details of each base row, looks up just those base rows, and
forms the difference between what each contributed before and contributes now (its unit may have
changed as well). Differences are added up by unit and applied to just those units; a unit without
base rows is deleted. Extrema cannot be subtracted: they follow what is added, and where a
retraction takes away a unit's extreme value, that unit alone is gone through again.

Sums are exact for integers and decimals, and for doubles that hold integers below 2^53; other
doubles gather rounding errors with every change.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.ranges import stored
from tarmac.operators.upsert import latest_per_key
from tarmac.streaming.keyed import KeyedState

SIGN = "sign"
PRESENT, ROWS, GONE = "__present", "__rows", "__gone"


@dataclass(frozen=True)
class Detail:
    """A detail table: its additive measures per row (numeric columns or expressions), summed by base key."""

    name: str
    measures: Mapping[str, Column]

    @property
    def rows(self) -> str:
        return f"{self.name}__rows"


@dataclass(frozen=True)
class Definition:
    """What a view shows.

    ``base`` are the columns kept of a base row, ``sums`` what a row contributes to its unit's
    sums, of base columns, detail totals and row counts (null: nothing; how many rows contribute
    is counted beside each sum). ``extrema`` maps a name to (expression, "min" or "max").
    """

    key: str
    unit: str
    base: T.StructType
    details: Sequence[Detail]
    sums: Mapping[str, Column]
    extrema: Mapping[str, tuple[Column, str]] = field(default_factory=dict)


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change from old versions to new ones of the same rows, as rows and signs."""
    return old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))


class IncrementalView:
    """A view's two states and how a batch of changes moves them.

    ``rows_of`` gives the current base rows (with totals) of some units, for extrema that a
    retraction hits; by default they are picked out of the state of base rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, definition: Definition,
        rows_of: Callable[[DataFrame], DataFrame] | None = None, **layout: int,
    ) -> None:
        self.spark, self.d = spark, definition
        totals = [f for d in definition.details for f in (d.rows, *d.measures)]
        self.totals = totals
        wide = T.StructType([*definition.base.fields, T.StructField(PRESENT, T.BooleanType()), *[T.StructField(n, T.DoubleType()) for n in totals]])
        unit_type = definition.base[definition.unit].dataType
        shown = [T.StructField(definition.unit, unit_type), T.StructField(ROWS, T.LongType())]
        for name in definition.sums:
            shown += [T.StructField(name, T.DoubleType()), T.StructField(self._filled(name), T.LongType())]
        shown += [T.StructField(n, T.DoubleType()) for n in definition.extrema]
        shown.append(T.StructField(GONE, T.BooleanType()))
        self.wide = KeyedState(spark, f"{path}/base", wide, [definition.key], **layout)
        self.units = KeyedState(spark, f"{path}/units", T.StructType(shown), [definition.unit], deleted=GONE, **layout)
        self.rows_of = rows_of
        self.touched = 0  # base rows that the last batch looked at

    def start(self) -> None:
        self.wide.start()
        self.units.start()

    @staticmethod
    def _filled(name: str) -> str:
        return f"{name}__filled"

    def _rows_of(self, units: DataFrame, batch_id: int) -> DataFrame:
        return self.wide.current(batch_id + 1).filter(PRESENT).join(units, self.d.unit, "left_semi")

    def _differences(self, base: DataFrame | None, details: Mapping[str, DataFrame]) -> DataFrame:
        """Per base key: the signed totals of its details, and its new base row if that changed."""
        d = self.d
        parts = []
        for detail in d.details:
            if detail.name not in details:
                continue
            sign = F.col(SIGN).cast("double")
            sums = [F.sum(F.coalesce(m.cast("double"), F.lit(0.0)) * sign).alias(n) for n, m in detail.measures.items()]
            rows = details[detail.name].filter(F.col(d.key).isNotNull()).groupBy(d.key)
            parts.append(rows.agg(F.sum(sign).alias(detail.rows), *sums))
        if base is not None:
            # A new version beside the old one counts; an old one alone means that the row is gone.
            newest = latest_per_key(base.select(*d.base.fieldNames(), SIGN), [d.key], [SIGN])
            row = F.struct(*[F.col(c) for c in d.base.fieldNames()])
            parts.append(newest.select(d.key, row.alias("__row"), (F.col(SIGN) > 0).alias("__here")))
        out = parts[0]
        for part in parts[1:]:
            out = out.join(part, d.key, "full_outer")
        for name in self.totals:
            out = out.withColumn(name, F.coalesce(name, F.lit(0.0)) if name in out.columns else F.lit(0.0))
        if base is None:
            out = out.withColumn("__row", F.lit(None).cast(d.base)).withColumn("__here", F.lit(None).cast("boolean"))
        return out

    def _contributed(self, rows: DataFrame, sign: int) -> DataFrame:
        """What base rows add to their unit's sums, or take away."""
        d = self.d
        parts: list[Column] = [F.col(d.unit), F.lit(sign).cast("bigint").alias(ROWS)]
        for name, value in d.sums.items():
            number = value.cast("double")
            parts += [(F.coalesce(number, F.lit(0.0)) * sign).alias(name), F.when(number.isNotNull(), sign).otherwise(0).cast("bigint").alias(self._filled(name))]
        parts += [value.cast("double").alias(n) for n, (value, _) in d.extrema.items()]
        return rows.filter(F.col(PRESENT) & F.col(d.unit).isNotNull()).select(*parts)

    def apply(self, batch_id: int, base: DataFrame | None = None, details: Mapping[str, DataFrame] | None = None) -> None:
        """Take in a batch: signed base rows, and signed rows of the detail tables by name."""
        d, details = self.d, details or {}
        moved = stored(self._differences(base, details))
        old = stored(self.wide.lookup(moved.select(d.key), batch_id))
        self.touched = moved.count()
        before = old.select(d.key, F.struct(*[c for c in old.columns]).alias("o"))
        pairs = moved.join(before, d.key, "left")
        fields = []
        for c in d.base.fieldNames():
            fresh = F.when(F.col("__here"), F.col(f"__row.{c}")).otherwise(F.col(f"o.{c}"))
            fields.append(F.col(d.key) if c == d.key else fresh.alias(c))
        present = F.coalesce(F.col("__here"), F.col(f"o.{PRESENT}"), F.lit(False)).alias(PRESENT)
        totals = [(F.coalesce(F.col(f"o.{n}"), F.lit(0.0)) + F.col(n)).alias(n) for n in self.totals]
        new = stored(pairs.select(*fields, present, *totals))
        both = stored(self._contributed(old, -1).union(self._contributed(new, 1)))
        sums = [F.sum(c).alias(c) for c in (ROWS, *[x for n in d.sums for x in (n, self._filled(n))])]
        added = [self._extreme(n, how, F.when(F.col(ROWS) > 0, F.col(n))).alias(f"{n}__new") for n, (_, how) in d.extrema.items()]
        taken = [self._extreme(n, how, F.when(F.col(ROWS) < 0, F.col(n))).alias(f"{n}__old") for n, (_, how) in d.extrema.items()]
        change = both.groupBy(d.unit).agg(*sums, *added, *taken)
        known = self.units.lookup(change.select(d.unit), batch_id)
        known = known.select(d.unit, F.struct(*known.columns).alias("u"))
        joined = change.join(known, d.unit, "left")
        shown = [F.col(d.unit)]
        for c in (ROWS, *[x for n in d.sums for x in (n, self._filled(n))]):
            shown.append((F.coalesce(F.col(f"u.{c}"), F.lit(0)) + F.col(c)).alias(c))
        hit = F.lit(False)
        for n, (_, how) in d.extrema.items():
            beyond = F.col(f"{n}__old") >= F.col(f"u.{n}") if how == "max" else F.col(f"{n}__old") <= F.col(f"u.{n}")
            hit = hit | F.coalesce(beyond, F.lit(False))
            better = (F.greatest if how == "max" else F.least)(F.col(f"u.{n}"), F.col(f"{n}__new"))
            shown.append(better.alias(n))
        rows = stored(joined.select(*shown, hit.alias("__hit")).withColumn(GONE, F.col(ROWS) <= 0))
        self.wide.write(new, batch_id)
        if d.extrema:
            rows = self._renewed(rows, batch_id)
        self.units.write(rows.drop("__hit"), batch_id)

    @staticmethod
    def _extreme(name: str, how: str, value: Column) -> Column:
        return F.max(value) if how == "max" else F.min(value)

    def _renewed(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Extrema of the units that a retraction has hit, from their base rows."""
        d = self.d
        hit = stored(rows.filter(F.col("__hit") & ~F.col(GONE)).select(d.unit))
        if hit.isEmpty():
            return rows
        own = self.rows_of(hit) if self.rows_of else self._rows_of(hit, batch_id)
        aggregates = [self._extreme(n, how, value.cast("double")).alias(f"{n}__right") for n, (value, how) in d.extrema.items()]
        right = own.groupBy(d.unit).agg(*aggregates).withColumn("__renewed", F.lit(True))
        joined = rows.join(right, d.unit, "left")
        for n in d.extrema:
            joined = joined.withColumn(n, F.when(F.col("__renewed"), F.col(f"{n}__right")).otherwise(F.col(n)))
        return joined.select(*rows.columns)

    def current(self) -> DataFrame:
        """The view: unit, number of base rows, sums (null where no row contributes) and extrema."""
        d, rows = self.d, self.units.current()
        sums = [F.when(F.col(self._filled(n)) > 0, F.col(n)).alias(n) for n in d.sums]
        return rows.select(d.unit, F.col(ROWS).alias("rows"), *sums, *d.extrema)
