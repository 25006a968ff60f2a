"""Several detail tables LEFT JOINed to one base row, then aggregated.

Joining them row by row emits every combination per key: a key with b bookings
and f feedbacks yields b*f rows, each booking counted f times. The result only
depends on per-key sums and row counts, so each detail table is aggregated by key
first and the other tables' row counts enter as weights. The answer equals the
row-by-row join exactly, a hot key costs one row, and the fan-out-safe answer is
the same plan with all weights 1. A detail row whose key no base row has is left out
before the aggregate (``prune``), so that a report over few days does not shuffle
the detail of all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Branch:
    """One detail table: ``measures`` must be additive aggregates (sum, count, count_if)."""

    name: str
    rows: DataFrame
    measures: Mapping[str, Column]
    key: str | None = None


class FanOut:
    def __init__(
        self, base: DataFrame, key: str, branches: Sequence[Branch], literal: bool = True, prune: bool = False
    ):
        self.literal = literal
        self.names = [b.name for b in branches]
        out = base
        for b in branches:
            source = b.key or key
            rows = b.rows.filter(F.col(source).isNotNull())
            if prune:
                wanted = base.select(F.col(key).alias("__wanted"))
                rows = rows.join(wanted, F.col(source) == F.col("__wanted"), "left_semi")
            per_key = (
                rows.groupBy(F.col(source).alias(key))
                .agg(
                    F.count(F.lit(1)).cast("double").alias(f"{b.name}__rows"),
                    *[m.alias(n) for n, m in b.measures.items()],
                )
            )
            out = out.join(per_key, key, "left")
        self.rows = out

    def weight(self, excluding: str | None = None) -> Column:
        """How many joined rows each base row (or row of ``excluding``) stands for."""
        product = F.lit(1.0)
        if self.literal:
            for name in self.names:
                if name != excluding:
                    product = product * F.coalesce(F.col(f"{name}__rows"), F.lit(1.0))
        return product

    def sum(self, column: str, branch: str | None = None) -> Column:
        """SUM over the joined rows of a base column, or of a branch's per-key sum."""
        return F.sum(F.col(column) * self.weight(branch))

    def count(self, column: str, branch: str | None = None) -> Column:
        return F.coalesce(self.sum(column, branch), F.lit(0.0)).cast("decimal(38,0)")

    def count_if(self, condition: Column) -> Column:
        """COUNT(CASE WHEN ...) over a base condition."""
        hits = F.sum(F.when(condition, self.weight()))
        return F.coalesce(hits, F.lit(0.0)).cast("decimal(38,0)")

    def count_rows(self) -> Column:
        return F.sum(self.weight())

    def avg(self, column: str) -> Column:
        """AVG of a base column over the joined rows."""
        filled = F.sum(F.when(F.col(column).isNotNull(), self.weight()))
        return self.sum(column) / F.nullif(filled, F.lit(0.0))

    def avg_of(self, total: str, filled: str, branch: str) -> Column:
        """AVG of a branch measure from its per-key sum and non-null count."""
        return self.sum(total, branch) / F.nullif(self.sum(filled, branch), F.lit(0.0))

    def share_if(self, condition: Column) -> Column:
        """100 * COUNT(CASE WHEN condition) / COUNT(*), null on an empty group."""
        hits = F.coalesce(F.sum(F.when(condition, self.weight())), F.lit(0.0))
        return hits * 100.0 / F.nullif(self.count_rows(), F.lit(0.0))
