"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

A fingerprint's bit i is given a non-zero label of ``radius + 1`` bits. For every non-zero
vector v of that length one table keeps the bits whose label has odd inner product with v. The
labels of any ``radius`` differing bits span less than the whole space, so some v is orthogonal
to all of them and its table keeps none of the differing bits: every pair within the radius
agrees there. With radius 2 there are 7 tables of about 36 bits.

Fingerprints that meet another in some table are candidates. They are confirmed without forming
pairs: two fingerprints are within 2 bits if and only if some value is within 1 bit of both, so
each candidate is sent to the 65 values within 1 bit of it. At most 65 different fingerprints
can meet at a value, whatever the data, and all that meet are linked to their least one.

Nulls and edge cases: a null text is empty; a text without words has the fingerprint zero, which
links like any other; fewer than three words are one shingle; repeated rows share a fingerprint
and are never expanded into pairs; rows with a null doc_id are linked too but name no group, so
a group of such rows alone has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import annotate, fresh
from tarmac.llm.components import components
from tarmac.operators.ranges import stored

BITS, RADIUS = 64, 2
SEED = 42
SHINGLES_AT_ONCE = 100_000


def fingerprint(text: str | None) -> int:
    """The majority bits of the shingle hashes; 0 for a text without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space alone
    if not words:
        return 0
    if len(words) < 3:
        words = [b" ".join(words)]
        width = 1
    else:
        width = 3
    n = len(words) - width + 1

    def hashes() -> Iterator[np.ndarray]:
        for at in range(0, n, SHINGLES_AT_ONCE):
            stop = min(n, at + SHINGLES_AT_ONCE)
            yield np.array([digest(b" ".join(s), SEED) for s in zip(*(words[at + i : stop + i] for i in range(width)))], dtype="<u8")

    return majority(hashes(), n)


def majority(hashes: Iterable[np.ndarray], n: int) -> int:
    """The bits that are set in over half of ``n`` 64-bit hashes, which come in arrays."""
    counts = np.zeros(BITS, np.int64)
    for some in hashes:
        counts += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, keep: Sequence[str], name: str, text: str = "text") -> DataFrame:
    """``keep`` and the fingerprint of every row as the signed 64-bit column ``name``."""

    def make() -> Callable[[list], list]:
        return lambda texts: [[_signed(fingerprint(t)) for t in texts]]

    return annotate(docs, text, keep, f"`{name}` bigint", make)


def masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The bit masks of the covering family, as signed 64-bit numbers."""
    top = 1 << (radius + 1)
    labels = [1 + i % (top - 1) for i in range(bits)]
    return [_signed(sum(1 << i for i, m in enumerate(labels) if (m & v).bit_count() % 2)) for v in range(1, top)]


def links(prints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Edges (a, b), a > b, that join all distinct fingerprints ``fp`` within 2 bits of each other.

    With ``by`` only fingerprints that agree in these columns are compared, and edges carry them.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks())])
    cells = prints.select(*by, "fp", F.explode(tables).alias("c")).groupBy(*by, "c.t", "c.key")
    shared = cells.agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo < hi").select(*by, "t", "key")
    keyed = prints.select(*by, "fp", F.explode(tables).alias("c")).select(*by, "fp", "c.t", "c.key")
    candidates = keyed.join(shared, [*by, "t", "key"], "left_semi").select(*by, "fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS)])
    met = candidates.select(*by, "fp", F.explode(near).alias("at")).groupBy(*by, "at").agg(F.collect_set("fp").alias("all"))
    stars = met.filter(F.size("all") > 1).select(*by, F.array_min("all").alias("b"), F.explode("all").alias("a"))
    return stars.filter("a <> b").select(*by, "a", "b").distinct()


def groups(prints: DataFrame, ids: str = "doc_id", name: str = "fp") -> DataFrame:
    """The rows of ``prints`` with ``component_id``, the least id reachable over links of 2 or fewer bits.

    ``prints`` should be a stored table: it is read several times. Exact copies share one
    fingerprint and are linked as one node.
    """
    rows = prints.select(F.col(ids).alias("id"), F.col(name).alias("fp"))
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(nodes.select("fp")))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed)
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(named, prints[name] == named["__fp"]).drop("__fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = stored(fingerprints(docs, ["doc_id"], "fp"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups(prints).select("doc_id", text.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents with one of each near-duplicate group: that of the least doc_id.

    Of repeated rows with that id one stays; of a group whose ids are all null, one row stays.
    All columns are kept.
    """
    order = fresh(docs, "__order")
    rows = stored(docs.withColumn(order, F.monotonically_increasing_id()))
    prints = stored(fingerprints(rows, ["doc_id", order], "fp"))
    grouped = groups(prints.select(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", order).alias("doc_id"), "fp"))
    kept = grouped.groupBy("component_id").agg(F.count("*")).select(F.col(f"component_id.{order}").alias("__kept"))
    return rows.join(kept, rows[order] == kept["__kept"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
