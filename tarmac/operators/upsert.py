"""Upserts and updates: (target, source) -> new target, never in place.

Parquet has no MERGE. Each operator is one equi-join whose result the caller
writes to a new folder (or to the partitions it touched), so a lost executor or
a rerun never sees a half-changed table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ranges import next_in_ranges, previous_in_ranges, ranged, running_in_ranges, stored


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key (ties settled by the remaining columns).

    A MAX over a struct combines on the map side, so a key repeated a billion
    times reaches the shuffle as one row per task. Map and VARIANT columns have
    no order and must be projected away first.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return newest.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose merge keys are all present; the rest belongs in quarantine."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def without_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def _pair(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = source.select(*keys, F.struct(*source.columns).alias("s"))
    return t.join(s, list(keys), how)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], status: str, updated: str, now: Column,
    order: Sequence[str], defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Insert unmatched keys; on a match whose status differs, take the new status.

    The source is reduced to its latest row per key first. A null status on
    either side compares as unknown and changes nothing. Columns the source lacks
    are null or take ``defaults``.
    """
    newest = latest_per_key(with_keys(source, keys), keys, order)
    pairs = _pair(target, newest, keys, "full_outer")
    return pairs.select(*_upserted(target, newest, keys, status, updated, now, defaults or {}))


def merge_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], status: str, updated: str, now: Column,
    order: Sequence[str], defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Only the rows ``merge_upsert`` would insert or change: what a change log appends."""
    newest = latest_per_key(with_keys(source, keys), keys, order)
    pairs = _pair(target, newest, keys, "right").filter(
        F.col("t").isNull() | F.coalesce(F.col(f"t.{status}") != F.col(f"s.{status}"), F.lit(False))
    )
    return pairs.select(*_upserted(target, newest, keys, status, updated, now, defaults or {}))


def _upserted(
    target: DataFrame, newest: DataFrame, keys: Sequence[str], status: str, updated: str, now: Column,
    defaults: Mapping[str, object],
) -> list[Column]:
    """Target columns out of a (t, s) pair: insert, status change, or unchanged."""
    insert = F.col("t").isNull()
    changed = F.coalesce(F.col(f"t.{status}") != F.col(f"s.{status}"), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        default = F.lit(defaults.get(c))
        fresh = F.coalesce(F.col(f"s.{c}"), default) if c in newest.columns else default
        if c == updated:
            value = F.when(insert | changed, now).otherwise(F.col(f"t.{c}"))
        elif c == status:
            value = F.when(insert, fresh).when(changed, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            value = F.when(insert, fresh).otherwise(F.col(f"t.{c}"))
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return out


def merge_update_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], overwrite: Sequence[str],
    fill: Sequence[str], derived: Mapping[str, Column], updated: str, now: Column, order: Sequence[str],
) -> DataFrame:
    """Update matched rows: overwrite some columns, COALESCE others, recompute derived ones.

    Source rows without a target are dropped. ``derived`` expressions see the
    already updated columns.
    """
    newest = latest_per_key(with_keys(source, keys), keys, order)
    pairs = _pair(target, newest, keys, "left")
    hit = F.col("s").isNotNull()
    out = []
    for c in target.columns:
        old = F.col(c) if c in keys else F.col(f"t.{c}")
        kind = target.schema[c].dataType
        if c in overwrite:
            value = F.when(hit, F.col(f"s.{c}").cast(kind)).otherwise(old)
        elif c in fill:
            value = F.coalesce(F.col(f"s.{c}").cast(kind), old)
        elif c == updated:
            value = F.when(hit, now).otherwise(old)
        else:
            value = old
        out.append(value.alias(c))
    merged = pairs.select(*out, hit.alias("__hit"))
    for c, expression in derived.items():
        kind = target.schema[c].dataType
        merged = merged.withColumn(c, F.when(F.col("__hit"), expression.cast(kind)).otherwise(F.col(c)))
    return merged.drop("__hit")


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: all assignments see the row as it was."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def batch_enrich(
    df: DataFrame, text: str, processed: str, assignments: Mapping[str, Column], now: Column
) -> DataFrame:
    """Score the rows never processed and stamp them; a second run changes nothing."""
    todo = F.col(text).isNotNull() & F.col(processed).isNull()
    return update_where(df, todo, {**assignments, processed: now})


def derived_update(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    value = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    return df.withColumn(total, value)


def keyed_override(df: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Overwrite the attributes an override row states (null means: leave as is)."""
    named = [c for c in overrides.columns if c != key]
    side = overrides.select(key, *[F.col(c).alias(f"__{c}") for c in named])
    joined = df.join(side, key, "left")
    return joined.select(
        *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in named else F.col(c) for c in df.columns]
    )


def guarded_update(
    df: DataFrame, match: Column, guard: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Conditional update: only while the guard (such as "still available") holds."""
    return update_where(df, match & guard, assignments)


OPEN_END = "9999-12-31 23:59:59"


def scd2_apply(
    dim: DataFrame, changes: DataFrame, key: str, ts: str, tracked: Sequence[str], surrogate: str
) -> DataFrame:
    """Close the open version and add new ones where a tracked attribute changed.

    ``changes`` holds (key, ts, tracked...). New versions inherit the other
    attributes of the open one and take surrogate keys above the largest in use
    (in order of key and time); unknown keys are ignored. Running it twice with
    the same changes adds nothing. Versions are compared on range partitions, so
    a key that repeats endlessly is spread over tasks. Only open versions whose key
    has later changes are compared; all other rows pass straight through.
    """
    history = dim.filter(~F.col("is_current"))
    every = dim.filter(F.col("is_current"))
    arriving = (
        changes.select(key, F.col(ts).alias("effective_from"), *tracked, F.lit(1).cast("bigint").alias("__new"))
        .join(every.select(key, F.col("effective_from").alias("__since")), key)
        .filter(F.col("effective_from") > F.col("__since"))
        .drop("__since")
    )
    arriving = stored(latest_per_key(arriving, [key, "effective_from"], tracked))  # its keys are used four times
    moved = arriving.select(key).distinct()
    current, still = every.join(moved, key, "left_semi"), every.join(moved, key, "left_anti")
    still = still.withColumn("effective_to", F.lit(OPEN_END).cast("timestamp_ntz")).select(*dim.columns)
    opened = current.select(key, "effective_from", *tracked, F.lit(0).cast("bigint").alias("__new"))
    rows = ranged(opened.unionByName(arriving), [key], ["effective_from"])

    state = F.struct(*tracked)
    compared = previous_in_ranges(rows, [key], "effective_from", state, "__before")
    points = compared.filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state)).drop("__before")
    points = stored(points)  # used four times below
    dated = next_in_ranges(points, [key], "effective_from", F.col("effective_from"), "__next")
    numbered = running_in_ranges(dated, [], [key, "effective_from"], "__new", "__seq")

    top = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint").alias("m")).scalar()
    carried = [c for c in dim.columns if c not in {*tracked, "effective_from", "effective_to", "is_current"}]
    full = numbered.join(current.select(*carried), key)
    fresh = F.when(F.col("__new") == 1, top + F.col("__seq")).otherwise(F.col(surrogate))
    versions = full.withColumns({
        surrogate: fresh.cast(dim.schema[surrogate].dataType),
        "effective_to": F.coalesce("__next", F.lit(OPEN_END).cast("timestamp_ntz")),
        "is_current": F.col("__next").isNull(),
    })
    return history.unionByName(still).unionByName(versions.select(*dim.columns))


def scd2_apply_late(
    dim: DataFrame, changes: DataFrame, seen: DataFrame, key: str, ts: str, tracked: Sequence[str], surrogate: str
) -> DataFrame:
    """``scd2_apply`` for changes in any order: late ones split closed intervals, and their neighbours are chained anew.

    ``seen`` are all changes applied before, as ``changes`` has them: a change that repeated the
    state of its time left no version, but counts once a late one comes before it. The versions of
    just the keys that ``changes`` names are made again, from the key's first version and all its
    changes, on range partitions; other rows pass straight through. A version that starts when it
    did before keeps its surrogate key, new ones get keys above the largest in use (in order of key
    and time). Of several changes at one instant the largest state counts; changes no later than a
    key's first version and unknown keys are ignored. Attributes that are not tracked are those of
    the open version. Whatever the order of arrival, the intervals and states are those of the
    changes applied in order of time.
    """
    columns = [key, ts, *tracked]
    named = changes.select(key).distinct()
    own = dim.join(named, key, "left_semi")
    rest = dim.join(named, key, "left_anti").select(*dim.columns)
    first = own.groupBy(key).agg(F.min("effective_from").alias("__first"))
    every = changes.select(*columns).unionByName(seen.select(*columns).join(named, key, "left_semi"))
    every = every.withColumnRenamed(ts, "effective_from").join(first, key).filter(F.col("effective_from") > F.col("__first")).drop("__first")
    every = latest_per_key(every, [key, "effective_from"], tracked)
    origin = own.join(first, key).filter(F.col("effective_from") == F.col("__first")).select(key, "effective_from", *tracked)
    # A version that is there but in no change, as of a dimension that came with a history, is a change as well.
    kept = own.join(first, key).filter(F.col("effective_from") > F.col("__first")).select(key, "effective_from", *tracked)
    kept = kept.join(every.select(key, "effective_from"), [key, "effective_from"], "left_anti")
    rows = ranged(origin.unionByName(every).unionByName(kept), [key], ["effective_from"])

    state = F.struct(*tracked)
    compared = previous_in_ranges(rows, [key], "effective_from", state, "__before")
    points = compared.filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state)).drop("__before")
    known = own.select(key, "effective_from", F.col(surrogate).alias("__known"))
    points = stored(points.join(known, [key, "effective_from"], "left").withColumn("__new", F.col("__known").isNull().cast("bigint")))
    # The join has moved the rows: they are ranged again, with what they now carry.
    again = ranged(points.drop("__part"), [key], ["effective_from"])
    dated = next_in_ranges(again, [key], "effective_from", F.col("effective_from"), "__next")
    numbered = running_in_ranges(dated, [], [key, "effective_from"], "__new", "__seq")

    top = dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint").alias("m")).scalar()
    carried = [c for c in dim.columns if c not in {surrogate, *tracked, "effective_from", "effective_to", "is_current"}]
    full = numbered.join(own.filter("is_current").select(*carried), key)
    versions = full.withColumns({
        surrogate: F.coalesce("__known", top + F.col("__seq")).cast(dim.schema[surrogate].dataType),
        "effective_to": F.coalesce("__next", F.lit(OPEN_END).cast("timestamp_ntz")),
        "is_current": F.col("__next").isNull(),
    })
    return rest.unionByName(versions.select(*dim.columns))
