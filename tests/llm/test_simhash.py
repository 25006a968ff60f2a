import itertools
import random

import xxhash

from tarmac.llm import simhash
from tarmac.llm.components import components


def plain_fingerprint(text):
    words = bytes(text or "", "utf8").lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_the_plain_ones(monkeypatch):
    draw = random.Random(3)
    texts = [None, "", " \t", "A", "a b", "A b C", " x  y z É", *(" ".join(draw.choices(["Ab", "cd", "é", "x y"], k=draw.randint(3, 60))) for _ in range(40))]
    for part in (100_000, 7):
        monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", part)
        assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_every_pair_within_the_radius_agrees_in_some_table():
    masks = [m % (1 << 64) for m in simhash.masks()]
    assert len(masks) == 7
    for i, j in itertools.combinations(range(64), 2):
        assert any(not (m >> i & 1) and not (m >> j & 1) for m in masks)


def test_links_lose_and_add_no_pair(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for flips in (1, 1, 2, 3):
            q = p
            for b in draw.sample(range(64), flips):
                q ^= 1 << b
            prints.add(q)
    prints |= {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (a ^ b).bit_count() <= 2]
    signed = {simhash._signed(p): p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = [(signed[r.a], signed[r.b]) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)  # both within one bit of a value, or linked through the least at it
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    assert roots(prints, edges) == roots(prints, near)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(1, 80)]
    pairs = [(1000 + 2 * i, 1001 + 2 * i) for i in range(20)]
    edges = chain + star + pairs
    nodes = {n for e in edges for n in e}
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: found.get(n, n) for n in nodes} == roots(nodes, edges)


def texts_with_copies():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = draw.choices(words, k=120)
        for c in range(draw.choice([1, 2, 5])):
            other = list(base)
            if c:
                other[draw.randrange(120)] = "changed"
            rows.append((100 * g + c, " ".join(other)))
        rows.append((100 * g + 50, " ".join(base)))
    return rows + [(5000, None), (4999, ""), (4998, "  ")]


def expected(rows):
    prints = {i: plain_fingerprint(t) for i, t in rows}
    edges = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    return prints, roots(list(prints), edges)


def test_groups_equal_brute_force(frame, cluttered):
    rows = texts_with_copies()
    prints, root = expected(rows)
    out = simhash.near_duplicates(cluttered(frame(rows))).collect()
    assert {r.doc_id: r.fingerprint for r in out} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in out} == root
    assert root[5000] == 4998


def test_a_large_group_of_copies_is_one_node(frame):
    out = simhash.near_duplicates(frame([(i, "the same words in every row") for i in range(2000)])).collect()
    assert len(out) == 2000 and {r.component_id for r in out} == {0}


def test_one_of_each_group_stays(frame, cluttered):
    rows = texts_with_copies()
    _, root = expected(rows)
    docs = cluttered(frame(rows + [(0, rows[0][1]), (None, "only null ids here"), (None, "only null ids here")]))
    out = simhash.one_per_group(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(root.values())) and ids.count(None) == 1


def test_null_ids_name_no_group(frame):
    out = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame([(None, "p q r s"), (3, "p q r s"), (None, "other words here now")])).collect()}
    assert out == {(None, 3), (3, 3), (None, None)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0
