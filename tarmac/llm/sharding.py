"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row goes down the tree level by level. At a node each child draws -ln(u) / weight, with u from a
hash of the row's id and the child's name and with the summed weight of the child's subtree; the
least draw is followed and the others' subtrees are not opened, so a row costs one hash for each
child on its path: 2 regions, 2 racks and 4 shards are 8 hashes for 16 shards.

Where a weight changes, the draws of that shard and of the nodes above it change and no others:
rows move into or out of those nodes only, and what stays in another subtree stays where it is. A
shard more opens a region of its own (``grown``), which changes no weight that was there, so rows
move into the new shard and nowhere else. A shard put into an existing rack also draws rows into
its older neighbours, as that rack and region then weigh more.

Only DataFrame functions are used. Nulls and edge cases: a null text has no bytes (size 1) and
the crc32 of the empty text; a null doc_id is drawn by the text of null, "null"; equal ids go
to one shard; repeated rows get different slots; an empty table gives no rows; children of weight
0 take no row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import fresh
from tarmac.operators.ranges import stored

RACK_SHARDS, REGION_RACKS = 4, 2
RUN_ROWS = 50_000  # mean number of rows that are numbered in one window
LAW = "key"

# A tree: region -> rack -> shard -> weight.
Tree = Sequence[Sequence[Sequence[tuple[int, float]]]]


def topology(shards: int, weights: Mapping[int, float] | None = None, rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS) -> Tree:
    """Shards 0 to ``shards`` - 1 in racks of ``rack_shards`` and regions of ``region_racks`` racks."""
    leaves = [(s, float((weights or {}).get(s, 1.0))) for s in range(shards)]
    racks = [leaves[i : i + rack_shards] for i in range(0, shards, rack_shards)]
    return [racks[i : i + region_racks] for i in range(0, len(racks), region_racks)]


def unit(hashed: Column) -> Column:
    """A number above 0 and below 1 from the upper 53 bits of a hash."""
    return (F.shiftrightunsigned(hashed, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    return [*tree, [[(shard, weight)]]]


def _least(key: Column, place: Column, weights: Column) -> Column:
    """Which child of the node named by ``place`` a key follows: that of the least draw."""

    def draw(weight: Column, child: Column) -> Column:
        name = F.concat(key, F.lit(":"), place, F.lit("."), child.cast("string"))
        return F.when(weight > 0, F.struct((-F.log(unit(F.xxhash64(name))) / weight).alias("draw"), child.alias("child")))

    return F.array_min(F.transform(weights, draw))["child"]


def _descend(rows: DataFrame, key: Column, tree: Tree, name: str) -> DataFrame:
    """The rows with the shard at the end of their path, as column ``name``."""
    nested = lambda values, deep: F.array(*[nested(v, deep - 1) for v in values]) if deep else F.lit(values)
    racks = [[sum(w for _, w in rack) for rack in region] for region in tree]
    place, region, rack = (fresh(rows, f"__{n}") for n in ("at", "region", "rack"))
    rows = rows.withColumn(region, _least(key, F.lit("tree"), nested([float(sum(r)) for r in racks], 1)))
    within = nested([[float(w) for w in r] for r in racks], 2)
    rows = rows.withColumn(rack, _least(key, F.col(region).cast("string"), within[F.col(region)]))
    path = F.concat_ws(".", F.col(region).cast("string"), F.col(rack).cast("string"))
    within = nested([[[float(w) for _, w in k] for k in r] for r in tree], 3)
    rows = rows.withColumn(place, _least(key, path, within[F.col(region)][F.col(rack)]))
    numbers = nested([[[s for s, _ in k] for k in r] for r in tree], 3)
    return rows.withColumn(name, numbers[F.col(region)][F.col(rack)][F.col(place)].cast("int")).drop(region, rack, place)


def assign(docs: DataFrame, tree: Tree, later: Tree, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``slot`` counts from 0 without gaps in each shard, in the order of a hash of the row's id
    and its place in the stored table. Slots are counted in runs of that hash: the rows of a run
    are numbered in one window, and the runs' sizes, one small row each, are summed up before
    it. Rows of one id have places of their own, so a repeated id is spread over the runs.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(doc_id).alias("doc_id"), key.alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    placed = _descend(_descend(placed, F.col("key"), tree, "shard"), F.col("key"), later, "grown_shard")
    rows = stored(placed.drop("key"))
    runs = max(1, math.ceil(rows.count() / RUN_ROWS))
    rows = rows.withColumn("u", unit(F.xxhash64("doc_id", "place"))).withColumn("run", F.floor(F.col("u") * runs))
    sizes = rows.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    opening = sizes.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("opening"))
    within = Window.partitionBy("shard", "run").orderBy("u", "place")
    numbered = rows.withColumn("n", F.row_number().over(within) - 1)
    slot = (F.col("n") + F.col("opening")).cast("long").alias("slot")
    return numbered.join(opening, ["shard", "run"]).select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", slot, "grown_shard")


def shard_by_key(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every row's place among ``shards`` equal shards, and where it would be with one more."""
    tree = topology(shards)
    return assign(docs, tree, grown(tree, shards))
