"""A persistent index of ids and fingerprints that new rows must not have.

The index is a bucketed Parquet table of keys, with a Bloom filter in each row group.
Checking many rows shuffles their keys into the index's buckets; the index itself is only
scanned. Checking a batch's few keys names them in a filter, which prunes buckets by hash
and row groups by Bloom filter. Additions are appended, so checking costs no rebuild.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of an index, and keys that one batch check may name.
BUCKETS, BATCH = 64, 10_000


def keys(key: str = "paper_id", fp: str = "fingerprint") -> Column:
    """A row's keys: its id's and its fingerprint's; nulls have none."""
    return F.array_compact(F.array(F.concat(F.lit("i:"), F.col(key)), F.concat(F.lit("f:"), F.col(fp))))


class BlockedIndex:
    """The index in the folder ``path``; it is made by the first ``add``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name = f"blocked_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"

    def table(self) -> DataFrame:
        """key of every blocked id (``i:``) and fingerprint (``f:``)."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (key STRING) USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, key: str = "paper_id", fp: str = "fingerprint") -> None:
        """Block the ids and fingerprints of rows; those that are in the index already are not added again."""
        held = self.table()
        new = rows.select(F.explode(keys(key, fp)).alias("key")).distinct().join(held, "key", "left_anti")
        new.repartition(self.buckets, "key").write.mode("append").option("parquet.bloom.filter.enabled#key", "true").option("path", self.path).bucketBy(self.buckets, "key").format("parquet").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def label(self, cands: DataFrame, ordinal: str, key: str = "paper_id", fp: str = "fingerprint") -> DataFrame:
        """``cands`` with ``reason``: blocked_id, blocked_fingerprint or null. ``ordinal`` is unique. Both keys are looked up in one join, and the index is not shuffled."""
        asked = cands.select(F.col(ordinal).alias("_o"), F.explode(keys(key, fp)).alias("key"))
        hit = asked.join(self.table().hint("merge"), "key", "left_semi").groupBy("_o").agg(F.bool_or(F.startswith("key", F.lit("i:"))).alias("_by_id"))
        out = cands.join(hit, F.col(ordinal) == F.col("_o"), "left")
        reason = F.when(F.col("_by_id"), "blocked_id").when(F.col("_o").isNotNull(), "blocked_fingerprint")
        return out.withColumn("reason", reason).select(*cands.columns, "reason")

    def blocked(self, batch: DataFrame, key: str = "paper_id", fp: str = "fingerprint") -> list[str]:
        """The keys of a batch of bounded size that are blocked, or that two of its rows have."""
        found = batch.select(F.explode(keys(key, fp)).alias("key")).groupBy("key").count().limit(BATCH + 1).collect()
        if len(found) > BATCH:
            raise ValueError(f"a batch has {BATCH} keys at most; use label")
        names = [r.key for r in found]
        held = self.table().filter(F.col("key").isin(names)).distinct().collect() if names else []
        return sorted({r.key for r in found if r["count"] > 1} | {r.key for r in held})
