"""Connected components of an edge table by alternating large-star and small-star, and of a small one in a single task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm.shared import discard, stash

#: Steps after which a graph that still changes is reported as an error; stars halve the depth in each.
MOST_STEPS = 60
#: Edges that one file of a step holds, about.
EDGES_OF_A_FILE = 200_000
#: Edges at most that one task joins by itself: a step of stars costs more than that, mostly to start its tasks.
EDGES_OF_A_TASK = 200_000


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step. edges: (u, v) with u > v. Large: each node's larger neighbours get its least neighbour (or itself).

    Small: its smaller neighbours and itself do. The least is an aggregation with partial sums, and the way back a join
    on the node that Spark can split where a node has very many edges.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether edges are not yet stars: a node has two centres, or is a centre and has one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges (u, v) of a task by union-find; the root of a tree is its least node."""
    up: dict[int, int] = {}

    def root(n: int) -> int:
        while (m := up.setdefault(n, n)) != n:
            up[n] = n = up[m]
        return n

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    for i in range(0, len(nodes), 10_000):
        part = nodes[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(map(root, part), pa.int64())], names=["node", "component"])


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) longs, in any order, repeated or not, no nulls. Returns (node, component) for the nodes of links.

    component is the least node reachable. A pair of equal ends adds nothing; no links give no rows. More than
    EDGES_OF_A_TASK edges are joined by steps of stars; each step is written in as many files as its number of edges asks
    for, and steps never add edges.
    """
    edges = stash(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), "edges")
    if edges.count() <= EDGES_OF_A_TASK:
        return stash(edges.coalesce(1).mapInArrow(_together, "node long, component long"), "components")
    before, edges = edges, stash(edges.distinct(), "edges")
    discard(before)
    files = 1 + edges.count() // EDGES_OF_A_FILE
    for _ in range(MOST_STEPS):
        if not _unfinished(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, edges = edges, stash(_stars(_stars(edges, large=True), large=False).coalesce(files), "edges")
        discard(before)
    raise RuntimeError(f"components still change after {MOST_STEPS} steps")
