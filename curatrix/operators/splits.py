"""Stable splits by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def hash_ratio(key: Column, seed: int = rules.SPLIT_SEED) -> Column:
    """The first 48 bits of SHA-256 of ``seed:key`` over their largest value."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(0xFFFFFFFFFFFF))


def choose_split(key: Column, seed: int = rules.SPLIT_SEED, bounds: tuple[float, float] = rules.SPLIT_BOUNDS) -> Column:
    r = hash_ratio(key, seed)
    return F.when(r < bounds[0], rules.SPLITS[0]).when(r < bounds[1], rules.SPLITS[1]).otherwise(rules.SPLITS[2])


def assign(records: DataFrame, merged: DataFrame, manifest: DataFrame, key: str = "paper_id") -> DataFrame:
    """key, split, is_new: assignments never move, new merged ids that have a record get theirs."""
    new = merged.select(key).distinct().join(records.select(key), key, "left_semi").join(manifest.select(key), key, "left_anti")
    return manifest.select(key, "split", F.lit(False).alias("is_new")).union(new.select(key, choose_split(F.col(key)), F.lit(True)))


def manifest_rows(manifest: DataFrame, key: str = "paper_id") -> DataFrame:
    """One split an id; of several the last in split order."""
    place = F.array_position(F.array(*[F.lit(s) for s in rules.SPLITS]), F.col("split"))
    return manifest.groupBy(key).agg(F.max_by("split", place).alias("split"))


def split_counts(assigned: DataFrame) -> DataFrame:
    """split, n for every split, zeros included."""
    totals = assigned.agg(*[F.count_if(F.col("split") == s).alias(s) for s in rules.SPLITS])
    return totals.select(F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in rules.SPLITS])).alias("x")).select("x.*")
