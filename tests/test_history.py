"""Past states from checkpoints, and versions from changes that arrive in any order."""

import itertools
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tarmac.operators import upsert as U
from tarmac.operators.history import History
from tarmac.operators.snapshot import as_of_snapshot
from tarmac.schemas import struct
from tarmac.session import scratch_path

START, END = datetime(2024, 1, 1), datetime(9999, 12, 31, 23, 59, 59)
LOG = struct("k bigint, at timestamp_ntz, v string")


def test_reads_cost_a_checkpoint_and_the_days_after_it(spark):
    draw = random.Random(5)
    history, rows = History(spark, scratch_path(spark, "history"), LOG, ["k"], "at"), []
    for n in range(4):
        batch = [(draw.randrange(9), START + timedelta(days=10 * n + draw.randrange(10), minutes=draw.randrange(1440)), f"{n}") for _ in range(25)]
        rows += batch
        for _ in range(1 + (n == 1)):  # a replay
            history.append(spark.createDataFrame(batch, LOG), n)
        history.checkpoint(START + timedelta(days=10 * n + 9, hours=12))
    whole = spark.createDataFrame(rows, LOG)

    def right(at):
        want = as_of_snapshot(whole, ["k"], "at", at).collect()
        assert sorted(map(str, history.as_of(at).select(LOG.fieldNames()).collect())) == sorted(map(str, want))

    for days in (-1, 0, 9, 15, 25.7, 39, 60):
        right(START + timedelta(days=days))
        assert len(history.opened) <= 12  # one checkpoint and at most the days since
    assert len(history.checkpoints()) == 4
    late = [(3, START + timedelta(days=21), "late")]  # the checkpoints of day 29 and later do not know it
    rows += late
    history.append(spark.createDataFrame(late, LOG), 4)
    whole = spark.createDataFrame(rows, LOG)
    assert len(history.checkpoints()) == 2
    for days in (20, 21, 22, 50):
        right(START + timedelta(days=days))


DIM = struct("sk bigint, id string, name string, tier string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
CHANGE = struct("id string, at timestamp_ntz, tier string")


def intervals(df):
    return sorted((r.id, r.tier, r.effective_from, r.effective_to, r.is_current, r.name) for r in df.collect())


def test_changes_in_any_order_equal_changes_in_order(spark):
    day = lambda n: START + timedelta(days=n)
    dim = spark.createDataFrame([(1, "p", "Ann", "A", START, END, True), (7, "q", "Bob", "A", START, END, True)], DIM)
    changes = [("p", day(1), "B"), ("p", day(2), "B"), ("p", day(3), "A"), ("q", day(2), "C")]
    in_order = U.scd2_apply(dim, spark.createDataFrame(changes, CHANGE), "id", "at", ["tier"], "sk")
    for order in ([3, 2, 1, 0], [1, 0, 2, 3], [2, 0, 3, 1]):
        now, seen = dim, []
        for i in order:
            one = spark.createDataFrame([changes[i]], CHANGE)
            now = spark.createDataFrame(U.scd2_apply_late(now, one, spark.createDataFrame(seen, CHANGE), "id", "at", ["tier"], "sk").collect(), DIM)
            seen.append(changes[i])
        assert intervals(now) == intervals(in_order)
        assert now.select("sk").distinct().count() == now.count()
        assert {r.sk for r in now.filter(F.col("effective_from") == F.lit(START)).collect()} == {1, 7}  # untouched versions keep theirs


def test_a_late_change_splits_a_closed_interval(spark):
    feb, mar, apr = datetime(2024, 2, 1), datetime(2024, 3, 1), datetime(2024, 4, 1)
    dim = spark.createDataFrame([(1, "p", "Ann", "GOLD", START, apr, False), (2, "p", "Ann", "SILVER", apr, END, True), (3, "x", "Cy", "GOLD", START, END, True)], DIM)
    none = spark.createDataFrame([], CHANGE)
    late = spark.createDataFrame([("p", feb, "TIN"), ("p", mar, "GOLD"), ("p", datetime(2023, 1, 1), "NO"), ("z", feb, "NO")], CHANGE)
    once = U.scd2_apply_late(dim, late, none, "id", "at", ["tier"], "sk")
    assert sorted((r.sk, r.tier, r.effective_from, r.effective_to, r.is_current) for r in once.collect()) == [
        (1, "GOLD", START, feb, False), (2, "SILVER", apr, END, True), (3, "GOLD", START, END, True),
        (4, "TIN", feb, mar, False), (5, "GOLD", mar, apr, False),
    ]
    again = U.scd2_apply_late(once, late, late, "id", "at", ["tier"], "sk")
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_many_orders_by_brute_force(spark):
    draw = random.Random(3)
    dim = spark.createDataFrame([(n, f"p{n}", "N", "A", START, END, True) for n in range(12)], DIM)
    changes = [(f"p{draw.randrange(12)}", START + timedelta(hours=draw.randrange(1, 40)), draw.choice("ABC")) for _ in range(120)]
    parts = [changes[0::3], changes[1::3], changes[2::3]]
    now = dim
    for i, part in enumerate(parts):
        seen = list(itertools.chain(*parts[:i]))
        frames = [spark.createDataFrame(rows, CHANGE) for rows in (part, seen)]
        now = spark.createDataFrame(U.scd2_apply_late(now, *frames, "id", "at", ["tier"], "sk").collect(), DIM)
    want = []
    for n in range(12):
        states = {START: "A"}
        for key, at, tier in sorted(changes):
            if key == f"p{n}":
                states[at] = max(tier, states.get(at, tier))
        points = [(t, s) for t, s in sorted(states.items())]
        points = [p for i, p in enumerate(points) if i == 0 or p[1] != points[i - 1][1]]
        ends = [t for t, _ in points[1:]] + [END]
        want += [(f"p{n}", s, t, e, e == END, "N") for (t, s), e in zip(points, ends, strict=True)]
    assert intervals(now) == sorted(want)
