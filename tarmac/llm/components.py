"""Connected components of an edge table, by alternating large and small stars.

Each round is joins and minima by node; nothing is gathered by group or on the driver but whether
a node is left that hangs on two others or is hung on while it hangs itself. If there is none, the
edges are stars around the least nodes; one sum by node shows it, so no further round is made to
see that nothing changes. A node of very many edges is a hot join key, which adaptive execution
splits. Rounds are written tables, so a lost executor costs a rerun of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ranges import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether the edges, a > b, are stars: a node is an ``a`` once at most, and no ``b`` then."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    by_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return by_node.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b) that is not its component's least node."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while not _stars(now):
        now = stored(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
