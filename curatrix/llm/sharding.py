"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable Parquet shards. ``compact`` takes runs of
shards of a similar size (a tier: sizes within a factor of ``fanout``) and rewrites each
run as files of about the target size. Which shards make up the table is said by a
manifest, one immutable JSON file a version, which is committed by one rename that
fails if that version exists. A reader sees a version whole or not at all; a writer that
dies leaves files that no manifest names, and ``vacuum`` removes them.

Rows never pass the driver, and a merge needs no shuffle: Spark's file scan packs a
run's shards into splits of the target size, and each split is written as one file.
Whatever the sources' or keys' sizes, splits are cut by bytes, so a hot key does not
matter here.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CommitConflict(RuntimeError):
    """Another writer has committed this version first; read again and retry."""


@dataclass(frozen=True)
class Shard:
    path: str
    n_bytes: int


class ShardStore:
    """A table of shards under ``root`` (any path that Hadoop's file systems open).

    Nulls, empty and long texts, and repeated rows are stored as they are: the store
    never looks into rows. An empty arrival adds a version without shards; a table
    without shards reads as no rows of ``schema``. Column names are those of the first
    arrival; later ones must have the same schema.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4):
        self.spark, self.root, self.target_bytes, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # manifests

    def versions(self) -> list[int]:
        at = self._path(f"{self.root}/manifests")
        if not self._files.exists(at):
            return []
        names = [x.getPath().getName() for x in self._files.listStatus(at)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if not found:
            return {"version": 0, "schema": None, "shards": []}
        stream = self._files.open(self._path(self._manifest_path(found[-1] if version is None else version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:012d}.json"

    def _commit(self, version: int, schema: dict | None, shards: list[Shard]) -> None:
        """Write beside, then rename onto the version's name, which must be free: the one atomic step.

        That is atomic where renaming refuses to overwrite, as in HDFS and local folders. An
        object store needs a committer with a conditional put in its place.
        """
        beside = self._path(f"{self.root}/manifests/_{uuid.uuid4().hex}")
        stream = self._files.create(beside, False)
        stream.write(bytearray(json.dumps({"version": version, "schema": schema, "shards": [[s.path, s.n_bytes] for s in shards]}).encode()))
        stream.close()
        final = self._path(self._manifest_path(version))
        if self._files.exists(final) or not self._files.rename(beside, final):
            self._files.delete(beside, False)
            raise CommitConflict(f"version {version} exists")

    # writing

    def _written(self, folder: str) -> list[Shard]:
        found, it = [], self._files.listFiles(self._path(f"{self.root}/data/{folder}"), True)
        while it.hasNext():
            x = it.next()
            if x.getPath().getName().endswith(".parquet") and x.getLen():
                found.append(Shard(x.getPath().toString().split("/data/")[-1], x.getLen()))
        return sorted(found, key=lambda s: s.path)

    def append(self, arrival: DataFrame) -> int:
        """Add one arrival as shards, as its partitions come; returns the new version."""
        return self.append_each(arrival, None)

    def append_each(self, arrivals: DataFrame, by: str | None) -> int:
        """Add many arrivals in one pass; ``by`` is a column that tells them apart and is not stored."""
        held, folder = self.manifest(), uuid.uuid4().hex
        schema = json.loads((arrivals.drop(by) if by is not None else arrivals).schema.json())
        if held["schema"] and _fields(held["schema"]) != _fields(schema):
            raise ValueError(f"the arrival's columns are {_fields(schema)}, the table's {_fields(held['schema'])}")
        writer = arrivals.write.option("compression", "zstd")
        if by is not None:
            writer = writer.partitionBy(by)
        writer.parquet(f"{self.root}/data/{folder}")
        new = self._written(folder)
        self._commit(held["version"] + 1, held["schema"] or schema, [*(Shard(*s) for s in held["shards"]), *new])
        return held["version"] + 1

    def tier(self, n_bytes: int) -> int:
        return int(math.log(max(1, n_bytes), self.fanout))

    def runs(self, held: dict | None = None) -> list[list[Shard]]:
        """Shards to merge of a manifest (None: the last), by tier: tiers below the target that have ``fanout`` shards or more."""
        tiers: dict[int, list[Shard]] = {}
        for s in (Shard(*x) for x in (held or self.manifest())["shards"]):
            if s.n_bytes < self.target_bytes // 2:
                tiers.setdefault(self.tier(s.n_bytes), []).append(s)
        return [x for _, x in sorted(tiers.items()) if len(x) >= self.fanout]

    def compact(self) -> int:
        """Merge runs, each by itself, until no tier has enough shards to merge; one commit a round. Returns the last version.

        A round works on one manifest: if another writer commits meanwhile, this one's
        commit fails (``CommitConflict``) and changes nothing.
        A tier whose run makes more than half as many files as it took is left alone from then on.
        """
        packer = self.spark.newSession()  # its own settings: the caller's stay
        packer.conf.set("spark.sql.files.maxPartitionBytes", str(self.target_bytes))
        packer.conf.set("spark.sql.files.openCostInBytes", "0")
        packer.conf.set("spark.sql.files.minPartitionNum", "1")
        settled: set[int] = set()
        while True:
            held, new = self.manifest(), []
            runs = [run for run in self.runs(held) if self.tier(run[0].n_bytes) not in settled]
            if not runs:
                return held["version"]
            for run in runs:
                folder = uuid.uuid4().hex
                rows = packer.read.schema(self._schema(held)).parquet(*[f"{self.root}/data/{s.path}" for s in run])
                rows.write.option("compression", "zstd").parquet(f"{self.root}/data/{folder}")
                made = self._written(folder)
                new += made
                if len(made) * 2 > len(run):
                    settled.add(self.tier(run[0].n_bytes))
            gone = {s.path for run in runs for s in run}
            stay = [Shard(*s) for s in held["shards"] if s[0] not in gone]
            self._commit(held["version"] + 1, held["schema"], [*stay, *new])

    def vacuum(self, grace_seconds: float = 24 * 3600) -> int:
        """Delete data files that the last manifest does not name; returns how many. Older versions can then no longer be read.

        Files younger than the grace stay: they may be another writer's that has not
        committed yet. It must be longer than any write takes; 0 is for a store with no
        other writer.
        """
        at, n, until = self._path(f"{self.root}/data"), 0, time.time() * 1000 - grace_seconds * 1000
        live = {s[0] for s in self.manifest()["shards"]}
        if not self._files.exists(at):
            return 0
        it, dead = self._files.listFiles(at, True), []
        while it.hasNext():
            x = it.next()
            p = x.getPath()
            if p.getName().endswith(".parquet") and x.getModificationTime() <= until and p.toString().split("/data/")[-1] not in live:
                dead.append(p)
        for p in dead:
            n += bool(self._files.delete(p, False))
        return n

    # reading

    @staticmethod
    def _schema(held: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(held["schema"]) if held["schema"] else StructType([])

    def read(self, version: int | None = None) -> DataFrame:
        held = self.manifest(version)
        schema = self._schema(held)
        if not held["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{s[0]}" for s in held["shards"]])


def _fields(schema: dict) -> list[tuple[str, str]]:
    return [(f["name"], json.dumps(f["type"], sort_keys=True)) for f in schema["fields"]]


def arrivals(df: DataFrame, n: int, key: str, name: str) -> DataFrame:
    """``df`` dealt into so many arrivals by the key's hash, as column ``name``."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(n)).cast("int"))
