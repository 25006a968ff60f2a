import itertools
import random
import time

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tarmac.llm import components, nearcopies, simhash
from tarmac.llm.common import ARROW_ROWS, BATCH_ROWS, Scratch


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def planted():
    draw = random.Random(11)
    names = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(25):
        base = draw.choices(names, k=draw.choice([40, 150, 300]))
        rows.append((100 * g + 50, " ".join(base)))
        for c in range(6):
            other = list(base)
            for _ in range(draw.randint(1, max(1, len(base) // 35))):
                other[draw.randrange(len(base))] = draw.choice(names)
            rows.append((100 * g + c, " ".join(other)))
    return [*rows, (7000, "only three words"), (7001, "Only  three words"), (7002, "only four words here"), (8000, ""), (8001, None)]


def least_of_each_group(rows):
    sets = {i: shingles(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(sets, 2):
        if jaccard(sets[a], sets[b]) >= 0.8:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {find(i) for i in sets}


def test_pipeline_removes_planted_near_copies(spark, frame, cluttered):
    rows = planted()
    docs = cluttered(frame(rows))
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(least_of_each_group(rows))
    prints = {i: simhash.fingerprint(t) for i, t in rows}  # copies that op7's two bits do not reach
    far = [(a, b) for a, b in itertools.combinations(rows, 2) if a[0] // 100 == b[0] // 100 and (prints[a[0]] ^ prints[b[0]]).bit_count() > 2]
    assert sum(jaccard(shingles(a[1] or ""), shingles(b[1] or "")) >= 0.8 for a, b in far) > 20


def test_repeated_and_null_ids_and_an_empty_table(frame, spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "A b c d e f"), (None, "x"), (None, "x"), (2, None)]
    assert sorted(map(str, (r.doc_id for r in nearcopies.one_per_group(frame(rows)).collect()))) == ["1", "2", "None"]
    assert nearcopies.one_per_group(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def boilerplate():
    """Unlike texts around shared passages, and one large group of near copies in which few are near the first."""
    draw = random.Random(5)
    names = [f"v{i}" for i in range(4000)]
    passages = [draw.choices(names, k=k) for k in (60, 25, 12)]
    rows = []
    for i in range(400):
        own, shared = draw.choices(names, k=draw.choice([20, 60, 200])), draw.choice(passages)
        at = draw.randrange(len(own))
        rows.append((i, " ".join(own[:at] + shared + own[at:])))
    base = draw.choices(names, k=150)
    for i in range(500):
        other = list(base)
        for _ in range(draw.randint(1, 4)):
            other[draw.randrange(len(base))] = draw.choice(names)
        rows.append((1000 + i, " ".join(other)))
    return rows


def test_common_passages_and_a_large_group_of_near_copies(frame):
    rows = boilerplate()
    kept = [r.doc_id for r in nearcopies.one_per_group(frame(rows)).collect()]
    assert sorted(kept) == sorted(least_of_each_group(rows))
    assert set(range(400)) <= set(kept) and 400 < len(kept) < 600


def test_every_near_pair_shares_a_key_whatever_is_common(frame, spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "COMMON", 2)  # nearly all that is shared is common
    rows = [*((10_000 + i, t) for i, t in boilerplate()[300:480]), *planted()]
    assert {r.doc_id for r in nearcopies.one_per_group(frame(rows)).collect()} == least_of_each_group(rows)


def test_long_texts(frame):
    draw = random.Random(9)
    long = [f"u{draw.randrange(10**6)}" for _ in range(60_000)]
    near = long[:30_000] + ["new"] * 40 + long[30_000:]
    rows = [(5, " ".join(long)), (3, " ".join(near)), (4, " ".join(long[:45_000])), (9, "x " * 50_000)]
    assert sorted(r.doc_id for r in nearcopies.one_per_group(frame(rows)).collect()) == [3, 4, 9]


def test_simhash_finds_what_its_radius_covers_and_the_filter_adds_the_rest(frame, spark, monkeypatch):
    rows = planted()
    seen, step = [], nearcopies.by_simhash
    monkeypatch.setattr(nearcopies, "by_simhash", lambda *a: seen.append(({r.node: r.fps for r in a[0].collect() if r.n >= 4}, out := step(*a))) or out)
    monkeypatch.setattr(nearcopies.Scratch, "drop", lambda self: None)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame(rows), "").collect()}
    (fps, pairs), = seen
    edges = {(r.a, r.b) for r in pairs.collect()}
    root = {n: n for n in fps}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[find(a)] = find(b)
    apart = lambda a, b: [((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(fps[a], fps[b], strict=True)]
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if sum(apart(a, b)) <= 3 * nearcopies.PRINTS - 1]
    assert near and all(find(a) == find(b) for a, b in near)
    assert kept == least_of_each_group(rows) and len({find(n) for n in fps}) > len(kept)  # SimHash alone leaves copies


def test_prints_are_majorities_and_unlike_in_every_part():
    draw = random.Random(4)
    one = nearcopies.shingles(" ".join(f"w{draw.randrange(500)}" for _ in range(300)))
    parts = [int(x) & (1 << 64) - 1 for x in nearcopies.prints(one)]
    assert parts[0] == sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in one) > len(one))
    assert all(15 < (x ^ y).bit_count() < 50 for x, y in itertools.combinations(parts, 2))


def test_workers_get_few_texts_at_once(spark):
    def rows_of(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    scratch = Scratch(spark)
    for own in (None, "0", "100", "5000"):
        if own is not None:
            spark.conf.set(ARROW_ROWS, own)
        sent = [r.n for r in scratch.keep(spark.range(0, 1000, 1, 1).mapInArrow(rows_of, "n long")).collect()]
        assert sum(sent) == 1000 and max(sent) == (100 if own == "100" else BATCH_ROWS)
        assert spark.conf.get(ARROW_ROWS, None) == own
        spark.conf.unset(ARROW_ROWS)
    scratch.drop()


def test_kept_tables_leave_no_broadcasts_with_the_driver(spark):
    held = lambda: spark.sparkContext._jsc.sc().env().memoryManager().storageMemoryUsed()
    scratch = Scratch(spark)
    ids = scratch.keep(spark.range(100_000).select("id", F.xxhash64("id").alias("of")))
    before = held()
    for i in range(20):  # a broadcast side takes 1.5 MB, all of them 30
        scratch.keep(spark.range(1000).join(F.broadcast(ids.filter(F.col("id") > i)), "id"))
    for _ in range(50):  # Spark's cleaner goes its own pace
        if held() - before < 20_000_000:
            break
        time.sleep(0.1)
    assert held() - before < 20_000_000
    scratch.drop()


@pytest.mark.parametrize(
    ("edges", "roots", "most"),
    [
        ([], {}, 0),
        ([(5, 1), (4, 1), (9, 2), (3, 3)], {5: 1, 4: 1, 9: 2}, 0),
        ([(1, 5), (1, 4)], {5: 1, 4: 1}, 0),
        ([(5, 1), (1, 5)], {5: 1}, 1),
        ([(5, 1), (5, 4)], {5: 1, 4: 1}, 1),
        ([(5, 4), (4, 1)], {5: 1, 4: 1}, 1),
        ([(i, i + 1) for i in range(20)], {i: 0 for i in range(1, 21)}, 6),
    ],
)
def test_components_make_no_round_for_stars(spark, monkeypatch, edges, roots, most):
    rounds, step = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda e: rounds.append(1) or step(e))
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == roots and len(found) == len(roots)
    assert len(rounds) <= most
