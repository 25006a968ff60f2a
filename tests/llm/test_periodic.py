import hashlib
import random
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tarmac.llm import periodic


def plain(words):
    """All runs by trying every period on every stretch."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            part = words[i : e + q]
            smallest = next(p for p in range(1, q + 1) if all(part[k] == part[k + p] for k in range(len(part) - p)))
            if smallest == q and len(part) >= max(6, 4 * q):
                runs.append((i, len(part), q))
            i = e + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    told = [(*r, 1000 * r[1] // r[2]) for r in best] or [(None,) * 4]
    digests = ["".join(f"{s},{k},{q}\n" for s, k, q in runs).encode(), b" ".join(plain_collapse(words, runs))]
    return (doc_id, len(runs), *told[0], *(hashlib.sha256(d).hexdigest() for d in digests))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=120))
def test_runs_of_few_words(words):
    assert periodic.find(words) == plain(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 6), min_size=1, max_size=6), st.integers(1, 7)), max_size=10))
def test_runs_next_to_each_other(parts):
    words = [w for part, times in parts for w in part * times]
    runs = periodic.find(words)
    assert runs == plain(words)
    assert periodic.collapse(words, runs) == plain_collapse(words, runs)


def texts():
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choices("a b c d the of".split(), k=draw.randint(0, 150)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (None, "a b " * 9), (1002, "x " * 500), (1002, "x " * 500), (1003, "uné deux\t\n" * 12)]
    return rows


def test_rows_against_brute_force(frame, cluttered):
    rows = texts()
    out = periodic.summarise(cluttered(frame(rows)), plant=True)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(plain_row(*r)) for r in rows)


def test_runs_and_collapsed_text(frame, spark):
    out = {r.doc_id: r for r in periodic.detect(frame(texts()), ["doc_id"]).collect() if r.doc_id is not None}
    assert [tuple(r) for r in out[1002].runs] == [(0, 500, 1)] and out[1002].collapsed == "x"
    assert out[1003].collapsed == "uné deux" and out[1000].runs == [] and out[1000].collapsed == ""
    assert periodic.summarise(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_sequences_take_no_quadratic_time():
    draw = random.Random(2)
    begun = time.monotonic()
    assert periodic.find(["x"] * 300_000) == [(0, 300_000, 1)]
    assert periodic.find(["x", "y", "z"] * 50_000) == [(0, 150_000, 3)]
    part = [draw.randrange(50) for _ in range(9_000)]
    assert (0, 45_000, 9_000) in periodic.find(part * 5)
    periodic.find(draw.choices("ab", k=60_000))
    assert time.monotonic() - begun < 120
