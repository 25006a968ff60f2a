import hashlib
import math
import random

import duckdb
import pytest
from tarmac.llm import mixing
from tarmac.llm.queries import ORACLES, op12_mixing
from tarmac.operators import ranges


def plain_targets(sizes, share=1.5, epochs=2):
    """Sharing and resharing by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > epochs * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def plain_mix(rows):
    sizes, docs = {}, []
    for doc_id, text, source in rows:
        words = (text or "").encode().split()
        sizes[source] = sizes.get(source, 0) + len(words)
        u = (int(hashlib.md5(f"mix:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        docs.append((-math.log(u) / ((len(set(words)) + 1) / (len(words) + 1)), str(doc_id), len(words), doc_id, source))
    target, out = plain_targets(sizes), []
    for source, size in sizes.items():
        budget = math.floor(target[source] + 0.5)
        whole, rest = divmod(budget, size) if size else (0, 0)
        for _, _, n, doc_id, own in sorted(d[:5] for d in docs if d[4] == source):
            part = min(n, max(rest, 0))
            rest -= n
            out.append((doc_id, n, size, round(target[source], 6), whole * n + part, own))
    return out


def corpus(n=400):
    draw = random.Random(4)
    sources = ["hot"] * 30 + [f"s{i}" for i in range(9)] + ["S", "été", None]
    rows = [(i, " ".join(draw.choices(["a", "b", "c", "d\t", "e\n"], k=draw.choice([0, 1, 5, 40, 300]))), draw.choice(sources)) for i in range(n)]
    return [*rows, (7, "again the same id", "hot"), (None, "no id here", "hot"), (900, None, "none"), (901, "", "none"), (902, "x " * 20_000, "long")]


SCHEMA = "doc_id long, text string, source string"


@pytest.mark.parametrize("range_rows", [200_000, 40])
def test_against_plain_sampling(frame, cluttered, monkeypatch, range_rows):
    monkeypatch.setattr(ranges.ranged, "__defaults__", (range_rows,))  # many ranges, also inside a source
    rows = corpus()
    out = mixing.mix(cluttered(frame(rows, SCHEMA))).collect()
    assert sorted(map(str, ((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken, r.source) for r in out))) == sorted(map(str, plain_mix(rows)))


def test_targets_are_met_and_reruns_agree(frame):
    rows = frame(corpus(), SCHEMA)
    out = mixing.mix(rows).collect()
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    assert sum(r.taken for r in out) == pytest.approx(1.5 * sum(r.size for r in out), abs=30)
    assert sorted(map(str, mixing.mix(rows.repartition(7)).collect())) == sorted(map(str, out))


def test_better_documents_are_drawn_more_often(frame):
    rows = [(i, " ".join(f"w{j}" for j in range(40)) if i % 2 else "w " * 40, "one") for i in range(2000)]
    out = mixing.mix(frame(rows, SCHEMA), share=0.3).collect()
    taken = [sum(r.taken for r in out if r.doc_id % 2 == side) for side in (0, 1)]
    assert taken[1] > 5 * taken[0] > 0


def test_a_table_without_rows_or_words(frame, spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [(r.taken, r.target) for r in mixing.mix(frame([(1, None, None), (2, "", "a")], SCHEMA)).collect()] == [(0, 0.0)] * 2


def test_oracle_on_clashing_rows(frame, spark, tmp_path):
    frame(corpus(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    told = duckdb.sql(f"CREATE OR REPLACE TEMP VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'") or duckdb.sql(ORACLES["op12_mixing"])
    columns = ["doc_id", "size", "source_size", "target", "taken", "source"]
    spark_rows = op12_mixing(spark, str(tmp_path)).select(columns).collect()
    assert sorted(map(str, map(tuple, spark_rows))) == sorted(map(str, told.select(*columns).fetchall()))
