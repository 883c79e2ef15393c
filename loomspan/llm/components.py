"""Connected components of a graph given as an edge table, without the driver or a single task seeing all of it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Edges that one task contracts on its own.
TASK_EDGES = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's edges (u, v): every node with its least neighbour by any path."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(root)]
    pairs = [p for p in pairs if p[0] != p[1]]
    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges with u > v."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("least"))
        joined = edges.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
    return out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that isn't its component's least node."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    edges = staged(edges, "links")
    tasks = 1 + edges.count() // task_edges
    edges = staged(edges.repartition(tasks, "v").mapInArrow(_contract, "u long, v long"), "contracted")
    while tasks > 1:
        before = edges
        edges = staged(_star(_star(edges, True), False), "stars")
        # At the fixed point both steps leave the edges as they are.
        sums = [d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for d in (before, edges)]
        if sums[0] == sums[1]:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
