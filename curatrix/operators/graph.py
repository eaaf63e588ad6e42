"""Connected components of an edge table by contraction.

In each round every node takes the least node, by a hash that changes from round to round,
within two steps of it, and nodes that take the same one become one. Merged nodes are
connected, and edges between different ones stay, so components do not change, while the
graph shrinks by a constant factor at least: the rounds are logarithmic in the edges, also
for a chain, and all rounds together cost a few times the first. What has shrunk to
``SMALL`` edges is finished in one task, by union and find.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import checkpointed, shipped

#: Edges that one task takes; their bound, not the input's.
SMALL = 500_000


def components(edges: DataFrame, u: str = "u", v: str = "v", small: int = SMALL) -> DataFrame:
    """node (long), component (one of its nodes) of every node that has an edge to another. Null ends, loops and repeated edges add nothing."""
    shipped(edges.sparkSession)
    left = checkpointed(_pairs(edges, F.col(u).cast("long"), F.col(v).cast("long")))
    rounds: list[DataFrame] = []
    while left.count() > small:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        both = left.select(F.col("u").alias("x"), F.col("v").alias("y")).union(left.select("v", "u"))
        near = checkpointed(both.groupBy("x").agg(F.min(rank("y")).alias("m")).select("x", F.least("m", rank("x")).alias("m")))
        nearer = both.join(near.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("m").alias("m"))
        named = checkpointed(nearer.select(F.col("x").alias("node"), F.col("m.n").alias("component")))
        rounds.append(named)
        ends = left.join(named.withColumnsRenamed({"node": "u", "component": "a"}), "u").join(named.withColumnsRenamed({"node": "v", "component": "b"}), "v")
        left = checkpointed(_pairs(ends, F.col("a"), F.col("b")))
    out = left.coalesce(1).mapInArrow(_finish, "node long, component long")
    if rounds:
        out = checkpointed(out)
    while rounds:
        later = out.select(F.col("node").alias("component"), F.col("component").alias("last"))
        out = rounds.pop().join(later, "component", "left").select("node", F.coalesce("last", "component").alias("component"))
    return out


def _finish(batches):
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent[root(a)] = root(b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"])


def _pairs(edges: DataFrame, a: Column, b: Column) -> DataFrame:
    return edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
