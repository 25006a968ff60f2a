"""Joins, aggregates, ordered operators, upserts, snapshots, quality: against brute force."""

import random
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.functions.dates import as_of_ts
from tarmac.operators import aggregates as A
from tarmac.operators import governance, joins, ordering, quality, snapshot, windows
from tarmac.operators import upsert as U
from tarmac.operators.fanout import Branch, FanOut
from tarmac.operators.ranges import PART, ranged
from tarmac.session import scratch_path


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def facts(spark):
    """Flights with bookings and feedback; one flight holds a third of all rows."""
    rnd = random.Random(5)
    keys = [rnd.randrange(1, 12) if rnd.random() > 0.33 else 0 for _ in range(300)]
    flights = spark.createDataFrame([(k, k % 3, None if k == 4 else k * 10) for k in range(15)], "k long, route int, pax int")
    bookings = spark.createDataFrame([(k, float(rnd.randrange(100)), rnd.choice([None, 1.0, 2.0])) for k in keys], "k long, amount double, extra double")
    feedback = spark.createDataFrame([(rnd.choice([0, 0, 2, 5, 13]), rnd.choice([None, 1, 5])) for _ in range(60)], "k long, rating int")
    return flights, bookings, feedback


@pytest.mark.parametrize("literal", [True, False])
def test_fanout_equals_the_literal_join(facts, literal):
    flights, bookings, feedback = facts
    f = FanOut(flights, "k", [
        Branch("b", bookings, {"amount": F.sum("amount"), "extra": F.sum("extra"), "extras": F.count("extra")}),
        Branch("o", feedback, {"rating": F.sum("rating"), "ratings": F.count("rating"), "fives": F.count_if(F.col("rating") == 5)}),
    ], literal)
    got = f.rows.groupBy("route").agg(
        f.sum("amount", "b").alias("amount"), f.sum("pax").alias("pax"), f.avg("pax").alias("mean_pax"),
        f.avg_of("extra", "extras", "b").alias("extra"), f.avg_of("rating", "ratings", "o").alias("rating"),
        f.count("fives", "o").cast("double").alias("fives"), f.share_if(F.col("pax") > 50).alias("share"),
        f.count_if(F.col("pax") > 50).cast("double").alias("big"),
    )
    if literal:
        joined = flights.join(bookings, "k", "left").join(feedback, "k", "left")
        want = joined.groupBy("route").agg(
            F.sum("amount"), F.sum("pax").cast("double"), F.avg("pax"), F.avg("extra"), F.avg("rating"),
            F.count_if(F.col("rating") == 5).cast("double"), F.count_if(F.col("pax") > 50) * 100.0 / F.count(F.lit(1)),
            F.count_if(F.col("pax") > 50).cast("double"),
        )
    else:
        b, o = flights.join(bookings, "k").groupBy("route"), flights.join(feedback, "k").groupBy("route")
        want = (
            flights.groupBy("route").agg(F.sum("pax").cast("double").alias("p"), F.avg("pax").alias("m"),
                (F.count_if(F.col("pax") > 50) * 100.0 / F.count(F.lit(1))).alias("s"), F.count_if(F.col("pax") > 50).cast("double").alias("n"))
            .join(b.agg(F.sum("amount").alias("a"), F.avg("extra").alias("e")), "route", "left")
            .join(o.agg(F.avg("rating").alias("r"), F.count_if(F.col("rating") == 5).cast("double").alias("f")), "route", "left")
            .select("route", "a", "p", "m", "e", "r", F.coalesce("f", F.lit(0.0)), "s", "n")
        )
    for x, y in zip(rows_of(got), rows_of(want), strict=True):
        assert x == pytest.approx(y)


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_exact_percentiles_match_the_builtin(spark, accuracy):
    """Also with so coarse a sketch that groups are bracketed (5 * accuracy < rows)."""
    rnd = random.Random(3)
    values = [(rnd.choice(["a", "a", "a", "b"]), rnd.choice([None, 7.0, rnd.random() * 100, float(rnd.randrange(5))])) for _ in range(4000)]
    df = spark.createDataFrame([*values, ("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)], "g string, v double")
    points = {"low": 0.0, "p5": 0.05, "mid": 0.5, "p95": 0.95, "top": 1.0}
    got = A.exact_percentiles(df, ["g"], "v", points, accuracy)
    want = df.filter("v IS NOT NULL").groupBy("g").agg(*[F.percentile("v", p) for p in points.values()])
    for x, y in zip(rows_of(got), rows_of(want), strict=True):
        assert x[0] == y[0] and x[1:] == pytest.approx(y[1:])


def test_percentiles_of_small_and_large_groups_take_one_path(spark):
    df = spark.range(130_000).select(F.when(F.col("id") % 13 < 12, "large").otherwise("small").alias("g"), (F.hash("id") % 1_000_003 / 7).alias("v"))
    points = {"p1": 0.01, "mid": 0.5, "p999": 0.999}
    got = A.exact_percentiles(df, ["g"], "v", points)
    want = df.groupBy("g").agg(*[F.percentile("v", p) for p in points.values()])
    for x, y in zip(rows_of(got), rows_of(want), strict=True):
        assert x[0] == y[0] and x[1:] == pytest.approx(y[1:])


def test_null_keys_of_ranges_raise(spark):
    rows = spark.createDataFrame([(1, 1), (None, 2)], "k long, n long")
    with pytest.raises(Exception, match="k must not be null"):
        ranged(rows, ["k"], ["n"])


def test_ranges_follow_the_rows(spark):
    assert ranged(spark.range(1000), [], ["id"], range_rows=100).select(PART).distinct().count() >= 8
    assert ranged(spark.range(1000), [], ["id"]).select(PART).distinct().count() == 1


def test_scratch_needs_a_shared_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default: None, set=lambda *_: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)), "x")
    assert scratch_path(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[4]")), "x")


@pytest.fixture(scope="module")
def activity(spark):
    """One passenger holds most rows."""
    rnd = random.Random(11)
    return spark.createDataFrame(
        [(0 if rnd.random() < 0.6 else rnd.randrange(1, 40), 20240101 + rnd.randrange(28), n, rnd.randrange(50), rnd.choice([None, 5]), 0)
         for n in range(2000)],
        "passenger_key long, activity_date_key int, activity_key long, miles_earned int, miles_redeemed int, miles_expired int",
    ).repartition(6)


def test_running_balance_equals_the_window(activity):
    order = Window.partitionBy("passenger_key").orderBy("activity_date_key", "activity_key").rowsBetween(Window.unboundedPreceding, 0)
    change = F.col("miles_earned") - F.coalesce("miles_redeemed", F.lit(0))
    want = activity.withColumn("balance_after", F.sum(change).over(order)).select("activity_key", "balance_after")
    got = windows.running_balance(activity).select("activity_key", "balance_after")
    assert rows_of(got) == rows_of(want)


def test_row_numbers_and_surrogates(spark, activity):
    numbered = windows.row_number_key(activity, ["activity_date_key", "activity_key"], "n")
    order = Window.orderBy("activity_date_key", "activity_key")
    want = activity.withColumn("n", F.row_number().over(order))
    assert rows_of(numbered.select("activity_key", "n")) == rows_of(want.select("activity_key", "n"))
    existing = spark.createDataFrame([(41,)], "id long")
    keyed = windows.surrogate_key(existing, "id", activity.select("activity_key"), ["activity_key"])
    assert rows_of(keyed.select("activity_key", "id"))[:2] == [(0, 42), (1, 43)]
    assert keyed.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (42, 2041, 2000)
    empty = spark.createDataFrame([], "id long")
    first = windows.surrogate_key(empty, "id", activity.select("activity_key"), ["activity_key"])
    assert first.agg(F.min("id")).first()[0] == 1


def test_unique_lookup(spark):
    df = spark.createDataFrame([("a",), ("x",), (None,)], "code string")
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "iata string, k int")
    assert rows_of(joins.unique_lookup(df, dim, "code", "iata", "k", "key")) == [("a", 1), ("x", None), (None, None)]
    with pytest.raises(Exception, match="several k for b"):
        joins.unique_lookup(spark.createDataFrame([("b",)], "code string"), dim, "code", "iata", "k", "key").collect()


def test_left_join_on_filter_keeps_left_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5), (1, 50), (2, 50)], "k int, v int")
    assert rows_of(joins.left_join_on_filter(left, right, ["k"], F.col("v") < 10)) == [(1, 5), (2, None)]


def test_grid_and_exists(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    assert joins.grid(base, {"t": ["T2", "T5"], "n": range(1, 4)}).count() == 12
    assert joins.exists_probe(base, F.col("k") > 1).first()[0] is True
    assert joins.exists_probe(base, F.col("k") > 2).first()[0] is False


def test_having_global_is_empty_when_false(spark):
    df = spark.range(5)
    assert A.having_global(df, {"n": F.count(F.lit(1))}, F.col("n") > 5).count() == 0
    assert A.having_global(df, {"n": F.count(F.lit(1))}, F.col("n") > 4).first()[0] == 5


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000)
    for portable in (True, False):
        one = ordering.bernoulli_sample(df.repartition(7), "id", 0.2, 3, portable)
        two = ordering.bernoulli_sample(df.coalesce(1), "id", 0.2, 3, portable)
        assert rows_of(one) == rows_of(two) and 850 < one.count() < 1150
    assert ordering.random_sample(df, "id", 10, 3).count() == 10


TARGET = "ref string, person long, status string, amount int, updated timestamp_ntz"
NOW = datetime(2024, 1, 2)


def merged(spark, target, source):
    return U.merge_upsert(target, source, ["ref", "person"], "status", "updated", as_of_ts(NOW), ["seq"])


def test_merge_upsert(spark):
    old = datetime(2024, 1, 1)
    target = spark.createDataFrame(
        [("A", 1, "CONFIRMED", 10, old), ("B", 1, None, 20, old), ("C", 1, "FLOWN", 30, old), ("D", 1, "FLOWN", 40, old)], TARGET)
    source = spark.createDataFrame(
        [("A", 1, "CANCELLED", 99, 1), ("A", 1, "FLOWN", 98, 2), ("B", 1, "FLOWN", 97, 1), ("C", 1, None, 96, 1),
         ("D", 1, "FLOWN", 95, 1), ("E", 1, "CONFIRMED", 50, 1), ("F", None, "CONFIRMED", 60, 1)],
        "ref string, person long, status string, amount int, seq int")
    once = merged(spark, target, source)
    assert rows_of(once) == [
        ("A", 1, "FLOWN", 10, NOW),       # the latest of the batch decides, only the status moves
        ("B", 1, None, 20, old),          # a null status is unknown: no update
        ("C", 1, "FLOWN", 30, old),
        ("D", 1, "FLOWN", 40, old),       # same status: untouched
        ("E", 1, "CONFIRMED", 50, NOW),   # insert; F has no key and is left out
    ]
    assert rows_of(merged(spark, once, source)) == rows_of(once)
    assert rows_of(U.without_keys(source, ["ref", "person"]).select("ref")) == [("F",)]
    changes = U.merge_changes(target, source, ["ref", "person"], "status", "updated", as_of_ts(NOW), ["seq"])
    assert rows_of(changes) == [r for r in rows_of(once) if r[4] == NOW]


def test_merge_update_only(spark):
    target = spark.createDataFrame([(1, "S", 5, 50, 25.0, None), (2, "S", 6, 60, 30.0, None)],
                                   "k int, status string, delay int, seats int, load double, updated timestamp_ntz")
    source = spark.createDataFrame([(1, "L", None, 1), (1, "X", 9, 0), (3, "L", 1, 1)], "k int, status string, delay int, seq int")
    load = F.col("delay") * 100.0 / F.col("seats")
    out = U.merge_update_only(target, source, ["k"], ["status"], ["delay"], {"load": load}, "updated", as_of_ts(NOW), ["seq"])
    assert rows_of(out) == [(1, "L", 5, 50, 10.0, NOW), (2, "S", 6, 60, 30.0, None)]


def test_batch_enrich_is_idempotent(spark):
    df = spark.createDataFrame([(1, "good", None, None), (2, None, None, None), (3, "bad", 0.5, datetime(2023, 1, 1))],
                               "k int, t string, score double, at timestamp_ntz")
    once = U.batch_enrich(df, "t", "at", {"score": F.lit(1.0)}, as_of_ts(NOW))
    assert rows_of(once) == [(1, "good", 1.0, NOW), (2, None, None, None), (3, "bad", 0.5, datetime(2023, 1, 1))]
    assert rows_of(U.batch_enrich(once, "t", "at", {"score": F.lit(9.0)}, as_of_ts("2025-01-01"))) == rows_of(once)


def test_scd2_apply(spark):
    start, end = datetime(2024, 1, 1), datetime(9999, 12, 31, 23, 59, 59)
    dim = spark.createDataFrame(
        [(1, "p1", "Ann", "GOLD", start, end, True), (2, "p2", "Bob", "SILVER", start, end, True),
         (3, "p2", "Bob", "BRONZE", datetime(2023, 1, 1), start, False)],
        "sk long, id string, name string, tier string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    feb, mar, apr = datetime(2024, 2, 1), datetime(2024, 3, 1), datetime(2024, 4, 1)
    changes = spark.createDataFrame(
        [("p1", feb, "GOLD"), ("p1", mar, "DIAMOND"), ("p1", apr, "DIAMOND"), ("p2", datetime(2023, 6, 1), "GOLD"), ("p9", feb, "GOLD")],
        "id string, at timestamp_ntz, tier string")
    once = U.scd2_apply(dim, changes, "id", "at", ["tier"], "sk")
    assert rows_of(once) == [
        (1, "p1", "Ann", "GOLD", start, mar, False), (2, "p2", "Bob", "SILVER", start, end, True),
        (3, "p2", "Bob", "BRONZE", datetime(2023, 1, 1), start, False), (4, "p1", "Ann", "DIAMOND", mar, end, True),
    ]
    assert rows_of(U.scd2_apply(once, changes, "id", "at", ["tier"], "sk")) == rows_of(once)
    open_then = snapshot.scd2_as_of(once, "2024-02-15").select("id", "tier")
    assert rows_of(open_then) == [("p1", "GOLD"), ("p2", "SILVER")]


def test_scd2_hot_key(spark):
    """One key flips its tier 600 times; every flip is kept, in order, on several ranges."""
    start, end = datetime(2020, 1, 1), datetime(9999, 12, 31, 23, 59, 59)
    dim = spark.createDataFrame([(1, "p1", "T0", start, end, True), (2, "p2", "T0", start, end, True)],
                                "sk long, id string, tier string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    changes = spark.range(1, 601).select(
        F.lit("p1").alias("id"), F.timestamp_add("HOUR", F.col("id").cast("int"), as_of_ts(start)).cast("timestamp_ntz").alias("at"),
        F.concat(F.lit("T"), F.floor(F.col("id") / 2) % 2).alias("tier"))
    out = U.scd2_apply(dim, changes, "id", "at", ["tier"], "sk").filter("id = 'p1'")
    rows = sorted(out.collect(), key=lambda r: r.effective_from)
    assert len(rows) == 301 and [r.is_current for r in rows].count(True) == 1
    assert all(a.effective_to == b.effective_from and a.tier != b.tier for a, b in zip(rows, rows[1:]))
    assert [r.sk for r in rows] == [1, *range(3, 303)]


def test_snapshots(spark):
    log = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "a"), (1, datetime(2024, 1, 3), "b"), (2, datetime(2024, 1, 2), "c")],
        "k int, at timestamp_ntz, v string")
    assert rows_of(snapshot.as_of_snapshot(log, ["k"], "at", "2024-01-02 12:00:00").select("k", "v")) == [(1, "a"), (2, "c")]
    assert rows_of(snapshot.as_of_snapshot(log, ["k"], "at", "2030-01-01").select("k", "v")) == [(1, "b"), (2, "c")]
    day_ago = snapshot.seconds_before("2024-01-03 00:00:00", 86400)
    assert rows_of(snapshot.as_of_snapshot(log, ["k"], "at", day_ago).select("k", "v")) == [(1, "a"), (2, "c")]
    restored = snapshot.restore_snapshot(log, ["k"], "at", "2024-01-01", scratch_path(spark, "r"))
    assert rows_of(restored.select("k", "v")) == [(1, "a")]


def test_overrides_and_guard(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    listed = spark.createDataFrame([(2, "z", None)], "k int, s string, n int")
    assert rows_of(U.keyed_override(df, listed, "k")) == [(1, "a", 1), (2, "z", 2)]
    hit = U.guarded_update(df, F.col("k") == 1, F.col("s") == "b", {"s": F.lit("taken")})
    assert rows_of(hit) == rows_of(df)


def test_tags_and_policy(spark):
    people = spark.createDataFrame([(1, "Ann", "ann.lee@x.org", "LHR"), (2, "Bob", None, "JFK")], "k int, first_name string, email string, home string")
    tagged = governance.tag_columns(people, governance.PASSENGER_TAGS)
    with pytest.raises(ValueError, match="does not allow"):
        governance.tag_columns(people, {"email": {"PII_CLASSIFICATION": "SHOE_SIZE"}})
    assert [r[1:4] for r in governance.tag_rows({"p": tagged})] == [("EMAIL", "p", "email"), ("NAME", "p", "first_name")]
    assert rows_of(governance.tag_catalog({"p": tagged}).select("column_name", "filled_values")) == [("email", 1), ("first_name", 2)]
    assert rows_of(governance.policy_apply(tagged, "ANALYST", "home")) == [(1, "A****", "an***@x.org", "LHR")]
    assert governance.policy_apply(tagged, "GUEST", "home").count() == 0
    assert rows_of(governance.policy_apply(tagged, "ADMIN", "home")) == rows_of(people)


def test_quality(spark):
    df = spark.createDataFrame([(1, 5, "LOW"), (1, 11, "ODD"), (2, None, None), (None, 0, "HIGH")], "k int, nps int, p string")
    assert rows_of(quality.key_checks(df, ["k"], ["p"])) == [("duplicate_keys", 1), ("null_k", 1), ("null_p", 1), ("surplus_rows", 1)]
    got = quality.domain_checks(df, {"p": quality.PRIORITY}, {"nps": (0, 10)})
    assert rows_of(got) == [("nps_range", 1), ("p_allowed", 1)]


def test_fan_out_leaves_out_details_before_it_aggregates_them(spark):
    base = spark.createDataFrame([(1, 10), (2, 20), (None, 5)], "k long, v long")
    detail = spark.createDataFrame([(1, 3), (1, 4), (9, 100), (None, 7)], "k long, m long")

    def fan(prune):
        f = FanOut(base, "k", [Branch("one", detail, {"a": F.sum("m")}), Branch("two", detail, {"b": F.sum("m")})], prune=prune)
        return f.rows.agg(f.sum("v").alias("v"), f.sum("a", "one").alias("a"), f.sum("b", "two").alias("b"))

    assert rows_of(fan(True)) == rows_of(fan(False))
    plan = fan(True)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {w: [len(x) - len(x.lstrip(" +-:")) for x in plan if w in x] for w in ("Aggregate [k", "Join LeftSemi")}
    assert len(depth["Join LeftSemi"]) == 2 and min(depth["Join LeftSemi"]) > min(depth["Aggregate [k"])


def test_safe_policy_hides_tags_without_a_mask(spark):
    from tarmac.functions.masks import ADMIN, ANALYST

    people = spark.createDataFrame([(1, "1990-01-01", "x@y.org")], "k int, date_of_birth string, email string")
    marked = people.withMetadata("date_of_birth", {"PII_CLASSIFICATION": "DOB"}).withMetadata("email", {"PII_CLASSIFICATION": "EMAIL"})
    assert governance.policy_apply(marked, ANALYST).first().date_of_birth == "1990-01-01"  # as published
    safe = governance.policy_apply(marked, ANALYST, literal=False, required={"email": "EMAIL"}).first()
    assert safe.date_of_birth is None and safe.email not in (None, "x@y.org") and safe.k == 1
    assert governance.policy_apply(marked, ADMIN, literal=False).first().date_of_birth == "1990-01-01"
    with pytest.raises(ValueError, match="should be tagged EMAIL"):
        governance.policy_apply(people, ANALYST, required={"email": "EMAIL"})
