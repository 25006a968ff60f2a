"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard.

Inner product becomes distance by one more coordinate that gives every vector of a shard the
same length. A shard's graph is grown in batches: a beam search from the entry proposes
neighbours, relaxed distance pruning (an edge goes when a kept neighbour is nearer to its end,
by a factor) keeps diverse ones, reverse edges are added and pruned alike. A query's beam search
visits every shard; what the shards find is scored in double precision and merged.

Equal vectors are one node, named by its least vec_id and joined by the first ``k + 1`` of its
members (no list of k needs more, so the limit loses nothing); equal queries are searched once.
Every row is indexed; memory is bounded by a shard's and a query block's rows.

Nulls and edge cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, as queries or candidates, nor do rows with a null vec_id; of several vectors with
one vec_id the least counts; vectors of different lengths are searched apart; ties go to the
smaller vec_id; with fewer than k candidates a list has all of them; an empty table gives none.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import ship
from tarmac.operators.ranges import stored

SHARD_ROWS = 10_000  # mean number of vectors in a shard
BLOCK_QUERIES = 4_096  # mean number of queries that meet a shard in one task
DEGREE, SLACK = 32, 48  # kept neighbours, and how many a node may gather before it is pruned
RELAXED = 1.44  # squared factor of the distance pruning
BUILD_BEAM, SEARCH_BEAM = 64, 128
EXPANDED = 4  # nodes of a beam that are expanded in one step
BATCH = 256


class Graph:
    """Vectors with their neighbour lists (-1 pads a list); node 0 is the entry."""

    def __init__(self, points: np.ndarray, edges: np.ndarray) -> None:
        self.points, self.edges = points, edges
        self.squares = np.einsum("nd,nd->n", points, points)

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and squared distances (less the query's square) of each query's beam, nearest first."""
        b, n = len(queries), len(self.points)
        ids, dist = np.full((b, width), -1, np.int32), np.full((b, width), np.inf, np.float32)
        done = np.ones((b, width), bool)
        ids[:, 0], done[:, 0] = 0, False
        dist[:, 0] = self.squares[0] - 2 * (queries @ self.points[0])
        stamp = np.zeros((b, n), np.int32)
        stamp[:, 0] = 1
        active, step = np.arange(b), 1
        while len(active):
            own = ids[active]
            order = np.argsort(done[active], axis=1, kind="stable")[:, :EXPANDED]
            rows = np.arange(len(active))[:, None]
            open_ = ~done[active[:, None], order]
            nodes = own[rows, order]
            near = np.where(open_[:, :, None], self.edges[nodes], -1).reshape(len(active), -1)
            done[active[:, None], order] = True
            r, c = np.nonzero(near >= 0)
            new = near[r, c]
            at = active[r]
            unseen = stamp[at, new] == 0
            r, c, new, at = r[unseen], c[unseen], new[unseen], at[unseen]
            mark = (step + 1 + c).astype(np.int32)
            stamp[at, new] = mark
            first = stamp[at, new] == mark  # a node met twice in this step counts once
            r, c, new, at = r[first], c[first], new[first], at[first]
            found = np.full(near.shape, np.inf, np.float32)
            found[r, c] = self.squares[new] - 2 * np.einsum("md,md->m", queries[at], self.points[new])
            all_dist = np.concatenate([dist[active], found], axis=1)
            all_ids = np.concatenate([own, near], axis=1)
            all_done = np.concatenate([done[active], np.isinf(found)], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
            ids[active], dist[active], done[active] = all_ids[rows, best], all_dist[rows, best], all_done[rows, best]
            step += near.shape[1] + 1
            active = active[~done[active].all(axis=1)]
        return np.where(np.isinf(dist), -1, ids), dist

    def prune(self, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """At most DEGREE diverse neighbours of each node, out of its candidates (-1 pads)."""
        near = np.where(near == nodes[:, None], -1, near)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        points = self.points[near]
        dist = ((points - self.points[nodes][:, None]) ** 2).sum(axis=2)
        dist[near < 0] = np.inf
        rows = np.arange(len(nodes))[:, None]
        order = np.argsort(dist, axis=1, kind="stable")
        near, dist, points = near[rows, order], dist[rows, order], points[rows, order]
        squares = self.squares[near]
        pairs = squares[:, :, None] + squares[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        alive, out = near >= 0, np.full((len(nodes), DEGREE), -1, np.int32)
        flat = rows[:, 0]
        for k in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[flat, pick]
            if not some.any():
                break
            out[some, k] = near[flat, pick][some]
            alive &= RELAXED * pairs[flat, pick] > dist
            alive[flat, pick] = False
        return out

    def link_back(self, nodes: np.ndarray) -> None:
        """Add the reverse of the nodes' edges; what outgrows SLACK is pruned."""
        a, slot = np.nonzero(self.edges[nodes] >= 0)
        to, source = self.edges[nodes[a], slot], nodes[a]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, begin, count = np.unique(to, return_index=True, return_counts=True)
        extra = np.full((len(targets), count.max()), -1, np.int32)
        place = np.arange(len(to)) - np.repeat(begin, count)
        extra[np.repeat(np.arange(len(targets)), count), place] = source
        known = (extra[:, :, None] == self.edges[targets][:, None, :]).any(axis=2)
        extra[known] = -1
        merged = np.concatenate([self.edges[targets], extra], axis=1)
        merged = merged[np.arange(len(targets))[:, None], np.argsort(merged < 0, axis=1, kind="stable")]
        size = (merged >= 0).sum(axis=1)
        fits = size <= SLACK
        self.edges[targets[fits]] = merged[fits, :SLACK]
        over = np.flatnonzero(~fits)
        for at in range(0, len(over), BATCH):
            part = over[at : at + BATCH]
            self.edges[targets[part]] = -1
            self.edges[targets[part], :DEGREE] = self.prune(targets[part], merged[part, : size[part].max()])


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """The vectors with one more coordinate that gives all of them the length of the longest."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max() - squares, 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, edges): the graph over ``lengthened(vectors)[order]``, whose node 0 is near the middle."""
    points = lengthened(vectors)
    order = np.random.default_rng(3).permutation(len(points))
    middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.concatenate([[middle], order[order != middle]])
    graph = Graph(points[order], np.full((len(points), SLACK), -1, np.int32))
    at = 1
    while at < len(points):
        nodes = np.arange(at, min(len(points), at + min(at, BATCH)))
        near, _ = graph.beam(graph.points[nodes], BUILD_BEAM)
        graph.edges[nodes, :DEGREE] = graph.prune(nodes, near)
        graph.link_back(nodes)
        at += len(nodes)
    return order, graph.edges


def _whole(values: Column) -> Column:
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(values, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def search(rows: DataFrame, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows found for each row where ``is_query``."""
    spark = rows.sparkSession
    ship(spark)
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    kind = "float" if kind == "float" else "double"  # scores are of the original vectors
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    valid = valid.filter(F.col("vec_id").isNotNull() & _whole(F.col("embedding")))
    # A row has a key of its own, as several may have one vec_id; the stored table fixes it.
    valid = stored(valid.withColumn("row", F.monotonically_increasing_id()))
    order = Window.partitionBy("embedding").orderBy("vec_id", "row")
    ranked = valid.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    first = Window.partitionBy("embedding").orderBy("vec_id", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = stored(ranked.withColumn("node", F.first("row").over(first)))
    nodes = members.filter("n = 1").select("node", F.col("vec_id").alias("least"), "embedding", F.size("embedding").alias("dim"))
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    index = stored(_index(nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int"))))

    asked = valid.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "embedding")
    asked = stored(asked.join(nodes, "embedding").select("query_id", "query_row", F.col("node").alias("of")))
    named = asked.select("of").distinct()
    blocks = max(1, math.ceil(named.count() / block_queries))
    questions = nodes.join(named, nodes["node"] == named["of"], "left_semi").withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.lit(blocks)).cast("int"))
    found = stored(_visit(index, questions, shards, blocks, k + 1))

    # The best k + 1 nodes, then the best k + 1 of their members, then each query's own k.
    best = Window.partitionBy("of").orderBy(F.desc("score"), "least", "node")
    top = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("of", "node", "score")
    listed = top.join(members.select("node", "vec_id", "row"), "node")
    best = Window.partitionBy("of").orderBy(F.desc("score"), "vec_id", "row")
    listed = listed.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("of", "vec_id", "row", "score")
    answers = asked.join(listed, "of").filter("row <> query_row")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    answers = answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _index(nodes: DataFrame) -> DataFrame:
    """One row per shard: its node ids, vectors and graph."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        vectors = _matrix(group.column("embedding"))
        order, edges = build(vectors)
        file = io.BytesIO()
        names = {c: group.column(c).to_numpy()[order] for c in ("node", "least")}
        np.savez(file, vectors=vectors[order], edges=edges, **names)
        return pa.table({"dim": group.column("dim")[:1], "shard": group.column("shard")[:1], "graph": pa.array([file.getvalue()], pa.binary())})

    return nodes.groupBy("dim", "shard").applyInArrow(run, "dim int, shard int, graph binary")


def _visit(index: DataFrame, questions: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """The ``k`` best nodes of every shard for every question, scored in double precision."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"of": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "least": np.zeros(0, np.int64), "score": np.zeros(0)}
        if len(left) and len(right):
            held = np.load(io.BytesIO(left.column("graph")[0].as_py()))
            vectors, names, least = held["vectors"], held["node"], held["least"]
            graph = Graph(lengthened(vectors), held["edges"])
            of, asked = right.column("node").to_numpy(), _matrix(right.column("embedding"))
            for at in range(0, len(of), BATCH):
                part = asked[at : at + BATCH]
                ids, _ = graph.beam(np.concatenate([part.astype(np.float32), np.zeros((len(part), 1), np.float32)], axis=1), max(SEARCH_BEAM, k))
                score = np.einsum("bld,bd->bl", vectors[ids].astype(np.float64), part.astype(np.float64))
                score[ids < 0] = -np.inf
                order = np.lexsort((names[ids], least[ids], -score), axis=1)[:, :k]
                rows = np.arange(len(part))[:, None]
                keep = ids[rows, order] >= 0
                parts = {"of": np.repeat(of[at : at + BATCH], keep.sum(axis=1)), "node": names[ids[rows, order]][keep], "least": least[ids[rows, order]][keep], "score": score[rows, order][keep]}
                out = {c: np.concatenate([v, parts[c]]) for c, v in out.items()}
        return pa.table(out)

    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = questions.select("dim", "block", "node", "embedding", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    keys = ["dim", "shard", "block"]
    return graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "of long, node long, least long, score double")
