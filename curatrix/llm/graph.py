"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges and labels stay in tables. A node with very many neighbours is no special case: its
smallest neighbour is taken before the shuffle, and the join back may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, u: str = "u", v: str = "v", files: int | None = None) -> DataFrame:
    """node, component (the smallest node it is connected with, itself included), for the nodes of edges between different nodes.

    Each round is written as ``files`` files at most. Edges with a null end, loops and repeated edges add nothing.
    """
    a, b = F.col(u), F.col(v)
    held = written(edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges", files)
    state = _state(held)
    while state[0]:
        both = held.select(F.col("u").alias("x"), F.col("v").alias("y")).union(held.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = written(down.union(least).distinct(), "edges", files)
        now = _state(held)
        if now == state:
            break
        state = now
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(held.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
