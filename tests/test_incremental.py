"""A view kept up by deltas equals the same view computed anew, and looks only at what changed."""

import random

from pyspark.sql import functions as F

from tarmac.schemas import struct
from tarmac.session import scratch_path
from tarmac.streaming.incremental import Definition, Detail, IncrementalView

BASE = struct("k bigint, day int, pax double")


def definition():
    weight = F.greatest(F.col("b__rows"), F.lit(1.0)) * F.greatest(F.col("f__rows"), F.lit(1.0))
    amount = F.when(F.col("b__rows") > 0, F.col("amount") * F.greatest(F.col("f__rows"), F.lit(1.0)))
    return Definition(
        "k", "day", BASE, [Detail("b", {"amount": F.col("amount")}), Detail("f", {"score": F.col("score")})],
        {"pax": F.col("pax") * weight, "amount": amount}, {"most": (F.col("pax"), "max"), "least": (F.col("pax"), "min")},
    )


def anew(base, bookings, feedback):
    out = {}
    for k, (day, pax) in base.items():
        if day is None:
            continue
        b, f = [a for kk, a in bookings if kk == k], [s for kk, s in feedback if kk == k]
        unit = out.setdefault(day, [0, None, None, None, None])
        unit[0] += 1
        if pax is not None:
            unit[1] = (unit[1] or 0) + pax * max(len(b), 1) * max(len(f), 1)
            unit[3] = pax if unit[3] is None else max(unit[3], pax)
            unit[4] = pax if unit[4] is None else min(unit[4], pax)
        if b:
            unit[2] = (unit[2] or 0) + sum(b) * max(len(f), 1)
    return {d: tuple(u) for d, u in out.items()}


def test_random_changes(spark):
    draw = random.Random(6)
    view = IncrementalView(spark, scratch_path(spark, "view"), definition(), fanout=2, base_buckets=2)
    view.start()
    base, bookings, feedback = {}, [], []
    for batch in range(5):
        moves, details = [], {"b": [], "f": []}
        for k in draw.sample(range(12), 5):
            if k in base:
                moves.append((k, *base.pop(k), -1))
            if draw.random() < 0.75:
                base[k] = (draw.choice([1, 2, 3, None]), draw.choice([5.0, 6.0, 90.0, None]))
                moves.append((k, *base[k], 1))
        for name, rows in (("b", bookings), ("f", feedback)):
            for row in draw.sample(rows, min(2, len(rows))):
                rows.remove(row)
                details[name].append((*row, -1))
            for _ in range(4):
                rows.append((draw.randrange(14), float(draw.randrange(50))))
                details[name].append((*rows[-1], 1))
        frame = spark.createDataFrame(moves, "k bigint, day int, pax double, sign int")
        parts = {n: spark.createDataFrame(r, f"k bigint, {c} double, sign int") for (n, r), c in zip(details.items(), ("amount", "score"), strict=True)}
        for _ in range(1 + (batch == 2)):  # a replay
            view.apply(batch, frame, parts)
        got = {r.day: (r.rows, r.pax, r.amount, r.most, r.least) for r in view.current().collect()}
        assert got == anew(base, bookings, feedback), batch


def test_an_emptied_unit_and_the_cost_of_a_change(spark):
    view = IncrementalView(spark, scratch_path(spark, "view"), definition())
    view.start()
    many = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 50).cast("int").alias("day"), F.lit(1.0).alias("pax"))
    view.apply(0, many.withColumn("sign", F.lit(1)))
    view.apply(1, many.filter("day = 7").withColumn("sign", F.lit(-1)), {"b": spark.createDataFrame([(3, 2.5, 1)], "k bigint, amount double, sign int")})
    rows = {r.day: r for r in view.current().collect()}
    assert view.touched == 11 and set(rows) == set(range(50)) - {7}
    assert (rows[3].rows, rows[3].pax, rows[3].amount) == (10, 10.0, 2.5) and rows[4].amount is None
