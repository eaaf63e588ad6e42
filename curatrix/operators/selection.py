"""Ranked, quota and sampled selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed


def score_order(score: str = "score", tier: str = "tier", key: str = "paper_id") -> list[Column]:
    return [F.col(score).desc(), F.col(tier) != "positive", F.col(key)]


def quota_topk(df: DataFrame, group: Sequence[str], quota: int | Column, order: Sequence[Column], tier: str = "tier", share: float = 0.7, most: int | None = None) -> DataFrame:
    """Per group at most ``quota`` rows: positives up to their share, negatives up to the rest, then positives and then negatives fill up.

    Adds ``selected_rank`` (1 is the best of the kept, positives of their share first, then negatives, then the fill).
    ``most`` is the largest quota (it is known of an int, and needed of a column): no row of a higher rank within its tier can be kept, so that many
    of each task at most are shuffled, and a group's windows stay small however many rows it has. Rows without a tier are negatives' side.
    """
    q, most = (F.lit(quota), quota) if isinstance(quota, int) else (quota, most)
    if most is None:
        raise ValueError("a quota by column needs most, the largest of them")
    positive = F.coalesce(F.col(tier) == "positive", F.lit(False))
    counts = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]).agg(F.count_if(positive).alias("_np"), F.count_if(~positive).alias("_nn"))
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group, positive).orderBy(*order)))
    ranked = ranked.filter(F.col("_rn") <= F.lit(most))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    ranked = ranked.join(counts, same, "inner").drop(*[f"_g{i}" for i in range(len(group))])
    pos = F.least(F.col("_np"), F.greatest(F.lit(1), F.floor(q * share)))
    neg = F.least(F.col("_nn"), F.greatest(F.lit(0), q - pos))
    part = F.when(positive & (F.col("_rn") <= pos), 0).when(~positive & (F.col("_rn") <= neg), 1).when(positive, 2).otherwise(3)
    placed = ranked.withColumn("_part", part).withColumn("selected_rank", F.row_number().over(Window.partitionBy(*group).orderBy("_part", "_rn")))
    return placed.filter(F.col("selected_rank") <= q).drop("_rn", "_np", "_nn", "_part")


def limit_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def priority_rank(key: Column, priorities: Sequence[str]) -> Column:
    """A key's place among the priorities; unknown keys come after all."""
    found = F.array_position(F.array(*[F.lit(p) for p in priorities]), key)
    return F.when(found > 0, found - 1).otherwise(len(priorities)).cast("int")


def venue_key(venue: Column) -> Column:
    """``VENUE YEAR`` as ``venue:year``."""
    return F.concat_ws(":", F.lower(F.substring_index(venue, " ", 1)), F.substring_index(venue, " ", -1))


def hash_order(seed: int, key: Column) -> Column:
    """A key of a stable shuffle, the same on any engine with SHA-256."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def sample(df: DataFrame, seed: int, n: int, key: str) -> DataFrame:
    """``n`` rows by hash order (all if n is 0 or less): a sample without replacement."""
    if n <= 0:
        return df
    return df.orderBy(hash_order(seed, F.col(key)), key).limit(n)


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Row numbers from 1 over the whole table without one task that sorts it all.

    Rows are range partitioned and numbered within partitions; partition counts are summed.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    parts = checkpointed(parts)  # both uses below must see the same partitions
    counts = parts.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return parts.join(F.broadcast(starts.select("_p", "_first", "_before")), "_p").withColumn(name, F.col("_i") - F.col("_first") + F.col("_before") + 1).drop("_p", "_i", "_first", "_before")


def batched(df: DataFrame, key: str, size: int = 50) -> DataFrame:
    """Adds position (from 1), batch (from 0) and request_id ``key:position``."""
    out = numbered(df, [key], "position")
    return out.withColumn("batch", F.floor((F.col("position") - 1) / size)).withColumn("request_id", F.concat_ws(":", F.col(key).cast("string"), F.col("position").cast("string")))


def take_until(df: DataFrame, accepted: Column, gap: int, order: Sequence[str | Column]) -> DataFrame:
    """Accepted rows in order until there are ``gap`` of them."""
    return df.filter(accepted).orderBy(*order).limit(max(0, gap))


def next_with_wraparound(df: DataFrame, key: str, order: str) -> DataFrame:
    """Each row's successor in order; the last one's is the first, and a single row has none."""
    n = numbered(df, [order], "_pos")
    total = n.agg(F.max("_pos").alias("_total"))
    step = n.select(F.col(key).alias("next_id"), F.col("_pos").alias("_next"))
    held = n.join(F.broadcast(total)).withColumn("_next", F.when(F.col("_pos") == F.col("_total"), 1).otherwise(F.col("_pos") + 1))
    out = held.join(step, "_next", "left")
    return out.withColumn("next_id", F.when(F.col("_total") > 1, F.col("next_id"))).drop("_pos", "_next", "_total")
