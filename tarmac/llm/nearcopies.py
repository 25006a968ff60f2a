"""Near copies by the Jaccard similarity of word shingles, for the corpus pipeline.

Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of 0.8 or
more; groups are the connected components. Texts of one shingle set are one node.

SimHash. A set's fingerprint is the majority of its shingles' hashes, in ``PRINTS`` parts of 64 bits
with hashes of their own. Nodes within 2 bits in some part meet in that part's covering tables
(``simhash.links``) whenever at most 3 * PRINTS - 1 of all bits differ; they are confirmed on the
whole sets like all pairs. No radius bounds a similarity of 0.8, so this alone would lose links:
the nodes that it leaves in different components go through an exact filter.

Keys. In the order of their hashes, each of the first K shingles of two near copies' union is
shared with a probability of 0.8 or more, and a shared one is among the first K of either. If c of
a node's first K shingles are common ones, its rare ones are keys enough, unless c or fewer of the
K are shared: ``allowed`` is the largest c at which that has a probability below ``CHANCE``; of a
set seen as a whole it is known how many are shared at least. A node takes its first 24 shingles,
or 64 or 256 if those hold too many common ones, and else all of them. There the keys are an exact
prefix filter (Chaudhuri, Ganti, Kaushik 2006): its rare shingles and then the rarest of the common
ones, n - ceil(0.8 n) + 1 in all at least. A shingle is common that more than ``COMMON`` nodes have
among their first 64, or, among the nodes that look further, as a key; then these choose again, until
there is none. So a rare key has at most twice as many nodes, what is common is the same for all, and
common shingles are keys only of nodes that consist of little else, such as a large group of near copies.

Pairs. The nodes of a key are compared with one of them first. What remains are nodes of different
components: rare keys are then compared in full; common keys go through further rounds of picks
while these link something, then in full. On a common key a pair must pass the positional bound:
what is shared from there on is at most what either set has left. Every pair is held against two
more exact bounds, its sizes and the parities of its shingles by hash cell (differing cells are no
more than differing shingles), and confirmed on the whole sets. Nothing is capped. Texts of common
shingles alone that are all unlike cost their pairs.

Nulls and edge cases: a null text is empty; texts without words are copies of one another; fewer
than five words are one shingle; ASCII case and white space do not count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm import simhash
from tarmac.llm.common import Scratch, annotate, fresh
from tarmac.llm.components import components

WIDTH = 5  # words of a shingle
SIMILAR = (4, 5)  # a near copy's least Jaccard similarity, as a fraction
SEED = 42
STAGES = (24, 64, 256)  # how many first shingles a node looks at, before it looks at all; all but the last are signed
SIGNED = 64  # first shingles that are kept with a node
CHANCE = 1e-14  # of missing a pair of near copies
COMMON = 16  # a shingle that is a key of more nodes than this is common
PRINTS = 4  # 64-bit parts of a fingerprint
CELLS = 512  # hash cells whose parities bound the difference of two sets
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; none for a text without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space alone
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    many = len(words) - width + 1
    mixed = np.full(many, width, np.uint64)
    for i in range(width):
        mixed += hashes[i : i + many] * FACTORS[i]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # an invertible mix, so that layers are even
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def prefix(n: Column) -> Column:
    """How many first shingles of a set of ``n`` must hold one that any near copy's hold too."""
    up, down = SIMILAR
    return (n - F.ceil(n * up / down) + 1).cast("long")


def allowed(k: int, chance: float = CHANCE) -> int:
    """The most common shingles among a node's first ``k`` at which its rare ones are keys enough."""
    up, down = SIMILAR
    share, below, c = up / down, 0.0, 0
    while (below := below + comb(k, c) * share**c * (1 - share) ** (k - c)) < chance:
        c += 1
    return c - 1


def enough(n: Column, many: Column, count: int) -> Column:
    """Whether a node's rare shingles are keys enough, ``many`` of its first ``count`` being common.

    Of a set that is seen as a whole, all but a quarter at least are shared among either's first.
    """
    up, down = SIMILAR
    whole = many * up < n * (up - (down - up))
    return F.when(n <= count, whole).otherwise(many <= allowed(count))


def parity(hashes: np.ndarray) -> np.ndarray:
    """One bit a hash cell, set if the cell holds an odd number of shingles; as signed 64-bit numbers."""
    odd = np.bincount((hashes & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prints(hashes: np.ndarray) -> np.ndarray:
    """The parts of a set's SimHash fingerprint, as signed 64-bit numbers."""
    parts = []
    for p in range(PRINTS):
        mixed = hashes if p == 0 else (hashes ^ (hashes >> np.uint64(29))) * FACTORS[p]
        mixed = mixed if p == 0 else (mixed ^ (mixed >> np.uint64(32))) * FACTORS[0]
        parts.append(simhash.majority([mixed ^ (mixed >> np.uint64(31))] if p else [mixed], len(hashes)))
    return np.array(parts, np.uint64).view(np.int64)


def _signed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the digest of the shingle set, its size ``n``, its parities, its fingerprint and the first of its shingles."""

    def make() -> Callable[[list], list]:
        import xxhash

        def sign(texts: list) -> list:
            sets = [shingles(t) for t in texts]
            return [
                [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets], [len(s) for s in sets],
                [parity(s) for s in sets], [prints(s) for s in sets], [s[:SIGNED].view(np.int64) for s in sets],
            ]

        return sign

    return annotate(rows, "text", keep, "digest string, n bigint, parity array<bigint>, fps array<bigint>, keys array<bigint>", make)


def _all_shingles(texts: DataFrame) -> DataFrame:
    def make() -> Callable[[list], list]:
        return lambda rows: [[shingles(t).view(np.int64) for t in rows]]

    return annotate(texts, "text", ["node", "n"], "keys array<bigint>", make)


def _left(looking: DataFrame, cells: DataFrame, common: DataFrame, count: int, scratch: Scratch) -> DataFrame:
    """The nodes among ``looking`` whose first ``count`` shingles hold too many common ones."""
    many = cells.join(common, "key", "left_semi").groupBy("node").agg(F.count("*").alias("many"))
    many = looking.select("node", "n").join(many, "node")
    return scratch.keep(many.filter(~enough(F.col("n"), F.col("many"), count)).select("node"))


def members(nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The shared keys: the rare ones (key, node), and the common ones (key, node, n, at).

    ``nodes`` has (node, n, keys) with the first shingles, ``texts`` (node, text); ``at`` is the
    place of a common key in its node's order: rare shingles first, then common ones by number.
    """
    nodes = nodes.filter(F.col("n") >= 4)  # different sets of which one is smaller cannot be near copies
    often = nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("c"))
    common, deep = scratch.keep(often.filter(F.col("c") > COMMON)), None

    def cells(looking: DataFrame, count: int | None) -> DataFrame:
        return looking.select("node", F.explode(F.col("keys") if count is None else F.slice("keys", 1, count)).alias("key"))

    while True:
        looking, left = nodes, []
        for count in STAGES[:-1]:
            left.append(_left(looking, cells(looking, count), common, count, scratch))
            looking = nodes.join(left[-1], "node", "left_semi")
        # What is at hand of these is used up: all their shingles, once for each node.
        named = looking.select("node", "n")
        new = named if deep is None else named.join(deep.select("node"), "node", "left_anti")
        found = scratch.keep(_all_shingles(texts.join(new, "node")))
        deep = found if deep is None else deep.union(found)
        looking = deep.join(left[-1], "node", "left_semi")
        left.append(_left(looking, cells(looking, STAGES[-1]), common, STAGES[-1], scratch))
        last = looking.join(left[-1], "node", "left_semi")
        some = cells(looking.join(left[-1], "node", "left_anti"), STAGES[-1])
        some = some.union(cells(last, None)).join(common, "key", "left_anti")
        # A key that only other nodes have was counted above; so no rare key has more than twice COMMON nodes.
        more = scratch.keep(some.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > COMMON))
        if more.isEmpty():
            break
        common = scratch.keep(common.union(more))
    every = [cells(nodes, STAGES[0]).join(left[0], "node", "left_anti")]
    every.append(cells(nodes.join(left[0], "node", "left_semi"), STAGES[1]).join(left[1], "node", "left_anti"))
    rare = [c.join(common, "key", "left_anti").select("key", "node") for c in every]
    rare = scratch.keep(reduce(DataFrame.union, [*rare, some.select("key", "node")]))
    held = cells(last, None).join(common, "key", "left_anti").groupBy("node").agg(F.count("*").alias("held"))
    held = scratch.keep(last.select("node", "n").join(held, "node", "left").fillna(0, ["held"]))
    order = Window.partitionBy("node").orderBy("c", "key")
    met = cells(last, None).join(common, "key").join(held, "node").withColumn("at", F.row_number().over(order) + F.col("held"))
    chosen = scratch.keep(met.filter(F.col("at") <= prefix(F.col("n"))).select("key", "node", "n", "at"))
    shared = rare.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    return scratch.keep(rare.join(shared, "key", "left_semi")), chosen


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b), a > b, of nodes that are near copies; ``pairs`` may repeat and be in any order."""
    up, down = SIMILAR
    own = Scratch(scratch.spark)
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    facts = lambda side: nodes.select(F.col("node").alias(side), F.struct("n", "parity").alias(f"of_{side}"))
    n, m, x, y = (F.col(c) for c in ("of_a.n", "of_b.n", "of_a.parity", "of_b.parity"))
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(CELLS // 64)), F.lit(0))
    able = (F.least(n, m) * down >= F.greatest(n, m) * up) & (apart * (down + up) <= (n + m) * (down - up))
    pairs = own.keep(pairs.join(facts("a"), "a").join(facts("b"), "b").filter(able).select("a", "b"))

    def make() -> Callable[[list], list]:
        return lambda rows: [[shingles(t).view(np.int64) for t in rows]]

    wanted = own.keep(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    sets = own.keep(annotate(texts.join(wanted, "node", "left_semi"), "text", ["node"], "shingles array<bigint>", make))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    both = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("total"))
    found = scratch.keep(both.filter(F.col("common") * (down + up) >= F.col("total") * up).select("a", "b"))
    own.drop()
    return found


def _merged(roots: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots`` (node, root) joined up by further edges of nodes; only the roots of these are gone through."""
    of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    moved = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moved = moved.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b").distinct()
    above = scratch.keep(components(moved))
    up = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    raised = roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return scratch.keep(raised.union(above))


def _open(rows: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows, with their ``root``, of the keys whose nodes are of more than one component."""
    placed = rows.join(roots, "node", "left").select(*rows.columns, F.coalesce("root", "node").alias("root"))
    unlike = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    return scratch.keep(placed.join(unlike, "key", "left_semi"))


def _positional(rows: DataFrame, other: str) -> Column:
    """Whether two nodes can share enough from a common key on; always, for rows without places."""
    if "at" not in rows.columns:
        return F.lit(True)
    up, down = SIMILAR
    n, at, m, there = F.col("n"), F.col("at"), F.col(f"{other}.n"), F.col(f"{other}.at")
    return (F.least(n - at, m - there) + 1) * (down + up) >= (n + m) * up


def _picks(rows: DataFrame, *salt: Column) -> DataFrame:
    """One pair (a, b) for each row and the node picked of its key, if their roots differ."""
    places = [c for c in ("n", "at") if c in rows.columns]
    pick = F.min(F.struct(F.xxhash64("node", *salt).alias("h"), F.col("node"), F.col("root"), *places)).alias("pick")
    met = rows.join(rows.groupBy("key").agg(pick), "key").filter((F.col("root") != F.col("pick.root")) & _positional(rows, "pick"))
    return met.select(F.col("node").alias("a"), F.col("pick.node").alias("b"))


def _pairs(rows: DataFrame) -> DataFrame:
    """All pairs (a, b) of a key's nodes whose roots differ."""
    places = [c for c in ("n", "at") if c in rows.columns]
    other = rows.select("key", F.struct("node", "root", *places).alias("o"))
    met = rows.join(other, "key").filter((F.col("node") > F.col("o.node")) & (F.col("root") != F.col("o.root")) & _positional(rows, "o"))
    return met.select(F.col("node").alias("a"), F.col("o.node").alias("b"))


def by_simhash(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that join all nodes within 2 bits in a part of their fingerprints ``fps``; links by least nodes.

    Nodes of one part are one fingerprint there, and each is paired with the least of them.
    """
    own = Scratch(scratch.spark)
    parts = own.keep(nodes.filter(F.col("n") >= 4).select("node", F.posexplode("fps").alias("part", "fp")))
    least = own.keep(parts.groupBy("part", "fp").agg(F.min("node").alias("first"), F.max("node").alias("last")))
    same = parts.join(least.filter("first < last"), ["part", "fp"]).select(F.col("node").alias("a"), F.col("first").alias("b"))
    found = simhash.links(least.select("part", "fp"), ["part"])
    of = lambda side: least.select("part", F.col("fp").alias(side), F.col("first").alias(f"node_{side}"))
    far = found.join(of("a"), ["part", "a"]).join(of("b"), ["part", "b"]).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    pairs = scratch.keep(same.filter("a <> b").union(far).distinct())
    own.drop()
    return pairs


def roots_of(nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node that is not the least of its component.

    ``nodes`` has (node, n, parity, fps, keys), ``texts`` (node, text).
    """
    facts = nodes.select("node", "n", "parity")
    confirmed = lambda pairs: _confirmed(pairs, facts, texts, scratch)
    roots = scratch.keep(components(confirmed(by_simhash(nodes, scratch))))
    rare, common = members(nodes.select("node", "n", "keys"), texts, scratch)
    first = _picks(_open(rare, roots, scratch)).union(_picks(_open(common, roots, scratch)))
    roots = _merged(roots, confirmed(first), scratch)
    roots = _merged(roots, confirmed(_pairs(_open(rare, roots, scratch))), scratch)
    turn = 1
    while not (left := _open(common, roots, scratch)).isEmpty():
        found = confirmed(_picks(left, F.col("key"), F.lit(turn)))
        last = found.isEmpty()
        roots = _merged(roots, confirmed(_pairs(left)) if last else found, scratch)
        if last:
            break
        turn += 1
    return roots


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents with one of each group of near copies: that of the least doc_id.

    Of repeated rows with that id one stays; of a group whose ids are all null, one row stays.
    All columns are kept. Intermediate tables are deleted, all but the numbered documents and the picks.
    """
    spark = docs.sparkSession
    scratch, lasting = Scratch(spark), Scratch(spark)
    order = fresh(docs, "__order")
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = lasting.keep(docs.withColumn(order, F.monotonically_increasing_id()))
    slim = rows.select("doc_id", F.col(order).alias("node"), "text")
    signed = scratch.keep(_signed(slim, ["doc_id", "node"]))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "node")).alias("first")
    firsts = scratch.keep(signed.groupBy("digest").agg(first).select(F.col("first.node").alias("node"), "first"))
    nodes = scratch.keep(signed.select("node", "n", "parity", "fps", "keys").join(firsts.select("node"), "node", "left_semi"))
    roots = roots_of(nodes, slim.select("node", "text"), scratch)
    placed = firsts.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    kept = lasting.keep(placed.select(F.col("first.node").alias("__kept")))
    scratch.drop()
    return rows.join(kept, rows[order] == kept["__kept"], "left_semi").select(*own)
