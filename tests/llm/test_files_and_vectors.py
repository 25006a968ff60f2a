"""WARC archives, byte-level BPE, sharding, nearest neighbours and the pipeline."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import ORACLES, QUERIES, bpe, graphann, sharding, warc
from tarmac.session import scratch_path

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# WARC

PAGES = [
    (5, "http://a", "<p>é" * 100), (3, "http://b", "<p>é" * 100), (9, "http://c", "short"), (8, "http://d", "short"), (1, None, None), (2, "u r\nl", ""),
    (4, "http://e", "x\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 9000), (6, "http://f", "🙂" * 30_000), (7, "http://g", "🙂" * 30_000), (None, "n", "<p>é" * 100),
    (None, "n", "only here, without an id, " * 20), (11, "r", "row " * 9000), (11, "r", "row " * 9000), (12, "r", "row " * 9000),
]


def expected_pages(rows):
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    least = {}
    for i, b in raw:
        if i is not None and len(b) >= 100:
            least[b] = min(i, least.get(b, i))
    out = []
    for i, b in raw:
        first = least.get(b)
        again = first is not None and first != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


@pytest.mark.parametrize("segment", [16_384, 1_000])
def test_pages_survive_the_archives(spark, segment):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit("x"))
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, segment, file_records=7)
    rows = warc.read_archives(spark, path).collect()
    assert Counter(tuple(r) for r in rows) == expected_pages(PAGES)
    kinds = Counter(r.kind for r in warc.read_records(spark, path).collect())
    assert kinds["continuation"] > 0 and kinds["revisit"] == 4


def test_a_missing_segment_raises(spark):
    pages = spark.createDataFrame([(1, "u", "abc" * 5000)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, 1000)
    segments = warc.read_records(spark, path).filter("segment IS NOT NULL")
    assert warc.reassemble(segments).count() == 1
    for lost in ("segment <> 3", "total IS NULL", "segment <> 1"):
        with pytest.raises(Exception, match="segments of"):
            warc.reassemble(segments.filter(lost)).collect()


def test_chunked_framing():
    for data in (b"", b"a", bytes(range(256)) * 100):
        assert warc.unchunked(warc.chunked(data, 7)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"3\r\nab", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_no_pages(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_query_equals_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cursor = con.execute(ORACLES["op5_warc"])
    names = [d[0] for d in cursor.description]
    df = QUERIES["op5_warc"](spark, SF).select(*names)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


# Byte-level BPE

TEXTS = [
    None, "", " ", "▁ ▁a  \t\n 日本語 \U0001f642\U0001f642 \x00\x01 é ÿĀĠ <unk> <s> ­  ", "a" * 3000, "I'll  don't 123 4567 ٣²!!!",
    "<|endoftext|>", "\r\n\r\n  x\t\t", "\U0010ffff퟿", "The quick brown fox. " * 500,
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_inverts(library, monkeypatch):
    own = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for cached, at_once in ((500_000, 100_000), (5, 3)):
        monkeypatch.setattr(bpe, "MATCHES_CACHED", cached)
        monkeypatch.setattr(bpe, "MATCHES_AT_ONCE", at_once)
        for text in TEXTS:
            ids = own.encode(text or "")
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text or "")
            assert own.decode(ids) == (text or "").encode()


def test_every_piece_is_its_own_rank():
    own = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    spelt = [p.decode("latin-1").translate(own.spelling) for p in own.pieces]
    assert own.processor.encode(spelt) == [[n] for n in range(len(spelt))]


def test_bpe_rows(frame, cluttered, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[3])]
    out = bpe.round_trip(cluttered(frame(rows)), ["doc_id"], RANKS, public_tokenizers.PATTERN).collect()
    told = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out)
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert told == want


# Sharding

def plain_descent(key, tree):
    """The shard at the end of a key's path, and how many draws it took."""
    def least(place, weights):
        draws = []
        for child, weight in enumerate(weights):
            if weight > 0:
                u = ((xxhash.xxh64_intdigest(f"{key}:{place}.{child}", seed=42) >> 11) + 0.5) / 2**53
                draws.append((-math.log(u) / weight, child))
        return min(draws)[1], len(draws)

    region, a = least("tree", [sum(w for rack in r for _, w in rack) for r in tree])
    rack, b = least(region, [sum(w for _, w in k) for k in tree[region]])
    leaf, c = least(f"{region}.{rack}", [w for _, w in tree[region][rack]])
    return tree[region][rack][leaf][0], a + b + c


def plain_shard(key, shards):
    tree = sharding.topology(16)
    return plain_descent(key, tree if shards == 16 else sharding.grown(tree, 16))[0]


def placed(spark, tree, n=6000):
    rows = spark.range(n).select(F.col("id").cast("string").alias("k"))
    return [r.s for r in sharding._descend(rows, F.col("k"), tree, "s").orderBy(F.col("k").cast("long")).collect()]


def test_shards_equal_the_plain_descent(frame, cluttered):
    rows = [(i, "é" * (i % 50)) for i in range(600)] + [(700, None), (None, "null id"), (5, "other text"), (5, "other text")]
    out = sharding.shard_by_key(cluttered(frame(rows))).collect()
    assert len(out) == len(rows)
    for r in out:
        key = "null" if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard, r.law) == (plain_shard(key, 16), plain_shard(key, 17), "key")
        assert r.grown_shard in (r.shard, 16)
    told = Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    assert told == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = Counter((r.shard, r.slot) for r in out)
    per_shard = Counter(r.shard for r in out)
    assert set(slots) == {(s, i) for s, n in per_shard.items() for i in range(n)}


def test_slots_are_gapless_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 20)
    docs = spark.createDataFrame([(1, "hot row")] * 300 + [(i, "t") for i in range(2, 400)], "doc_id long, text string").repartition(4)
    out = sharding.shard_by_key(docs).collect()
    per_shard = Counter(r.shard for r in out)
    assert {(r.shard, r.slot) for r in out} == {(s, i) for s, n in per_shard.items() for i in range(n)}


@pytest.mark.parametrize("shards", [1, 3, 4, 8, 16, 17, 21])
def test_growth_moves_rows_into_the_new_shard_alone(spark, shards):
    tree = sharding.topology(shards)
    for new in (shards, shards + 1):
        later = sharding.grown(tree, new)
        now, then = placed(spark, tree, 3000), placed(spark, later, 3000)
        moved = [b for a, b in zip(now, then) if a != b]
        assert set(moved) == {new} and abs(len(moved) / 3000 - 1 / (new + 1)) < 0.05
        tree = later


def test_weights_set_the_shares_and_movement_is_confined_to_their_subtrees(spark):
    tree, heavy = sharding.topology(16), sharding.topology(16, {2: 5.0})  # region 0, rack 0
    now, then = placed(spark, tree), placed(spark, heavy)
    assert abs(then.count(2) / 6000 - 5 / 20) < 0.03
    moved = [(a, b) for a, b in zip(now, then) if a != b]
    # into the region from outside it, into the rack from inside the region, into the shard from inside the rack
    for a, b in moved:
        assert b < 8 if a >= 8 else b < 4 if a >= 4 else b == 2
    assert any(a >= 8 for a, _ in moved) and any(4 <= a < 8 for a, _ in moved) and any(a < 4 for a, _ in moved)
    assert all(b < 8 for _, b in moved)


def test_the_tree_decides_and_a_row_costs_the_children_on_its_path(spark):
    trees = {(4, 2): 2 + 2 + 4, (16, 1): 1 + 1 + 16, (1, 4): 4 + 4 + 1}
    found = []
    for (rack, region), hashes in trees.items():
        tree = sharding.topology(16, rack_shards=rack, region_racks=region)
        found.append(placed(spark, tree, 1000))
        plain = [plain_descent(i, tree) for i in range(1000)]
        assert found[-1] == [s for s, _ in plain] and {n for _, n in plain} == {hashes}
    assert found[0] != found[1] != found[2] != found[0]
    empty = sharding.topology(4, {0: 0.0, 3: 2.0})
    assert set(placed(spark, empty, 500)) == {1, 2, 3}


def test_sharding_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "t")], "doc_id long, text string")
    assert "Python" not in sharding.shard_by_key(docs)._jdf.queryExecution().executedPlan().toString()
    assert sharding.shard_by_key(docs.limit(0)).count() == 0


# Nearest neighbours

def exact(rows, step, k):
    """The nearest ids of every query row but itself, by its id; one list an id where ids are unique."""
    out = {}
    for q, ids in exact_rows(rows, step, k):
        out[q] = ids
    return out


def exact_rows(rows, step, k):
    good = []
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, np.float32(v).astype(float)))
    for at, (q, v) in enumerate(good):
        if q % step == 0:
            scored = [(-float(np.dot(v, w)), i) for n, (i, w) in enumerate(good) if n != at and len(w) == len(v)]
            yield q, [i for _, i in sorted(scored)[:k]]


def recall(found, want):
    return sum(len(set(found.get(q, [])) & set(ids)) for q, ids in want.items()) / max(1, sum(map(len, want.values())))


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_the_whole_table(spark):
    found = lists(QUERIES["op6_neighbours"](spark, SF))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = exact(rows, 20, 20)
    assert set(found) == set(want) and recall(found, want) >= 0.95


def test_shards_blocks_and_unequal_lengths(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8)) * rng.uniform(0.2, 3, (900, 1))
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = lists(graphann.search(df, F.col("vec_id") % 5 == 0, 10, shard_rows=150, block_queries=40))
    assert recall(found, exact(rows, 5, 10)) >= 0.9


def test_copies_ties_and_bad_vectors(spark):
    hot = [1.0, 0.0]
    rows = [(i, hot) for i in range(0, 200)] + [(300, [0.9, 0.1]), (301, [0.0, 0.0]), (302, None), (303, [float("nan"), 1.0]), (304, [float("inf"), 1.0])]
    rows += [(305, [None, 1.0]), (None, [1.0, 1.0]), (306, []), (310, [0.9, 0.1]), (400, [1.0, 2.0, 3.0]), (405, [3.0, 2.0, 1.0]), (500, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).withColumn("node", F.lit(1))
    found = lists(graphann.search(df, F.col("vec_id") % 100 == 0, 5))
    assert found == exact(rows, 100, 5)
    assert found[0] == [1, 2, 3, 4, 5] and found[100] == [0, 1, 2, 3, 4] and found[400] == [405]


def test_every_row_of_a_repeated_id_is_asked_and_found(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [0.9, 0.3]), (1, [0.2, 0.8]), (2, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("x")).withColumn("least", F.lit("y"))
    found = graphann.search(df, F.col("vec_id") % 20 == 0, 4).collect()
    want = Counter((q, r + 1, i) for q, ids in exact_rows(rows, 20, 4) for r, i in enumerate(ids))
    assert Counter((r.query_id, r["rank"], r.vec_id) for r in found) == want


def test_scores_of_doubles_are_not_rounded(spark):
    df = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.4])], "vec_id long, embedding array<double>")
    assert [r.score for r in graphann.search(df, F.col("vec_id") == 0, 3).collect()] == [float(np.dot([0.1, 0.2], [0.3, 0.4]))]


def test_scores_are_double_products_and_few_rows_give_short_lists(spark):
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.4]), (20, [0.5, 0.6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {(r.query_id, r.vec_id): r.score for r in graphann.search(df, F.col("vec_id") % 20 == 0, 20).collect()}
    f = lambda v: np.float32(v).astype(float)
    assert set(out) == {(0, 1), (0, 20), (20, 0), (20, 1)} and out[0, 1] == float(f(rows[0][1]) @ f(rows[1][1]))
    assert graphann.search(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0


# The pipeline

def test_stages_keep_columns_and_their_decisions(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit(1))
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        if name != "packing":
            assert out.columns == columns and out.count() <= before
            before, docs = out.count(), out
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in out.select("doc_id").collect()} == ids
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == ids


def test_pipeline_on_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
