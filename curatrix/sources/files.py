"""Scans and sinks of JSON files, by Hadoop paths: nothing is opened on a local disk."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .. import schemas
from ..functions import text as t


class SourceError(ValueError):
    """A source is missing or has the wrong shape."""


class SinkError(ValueError):
    """Rows that must not be written."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _fs(spark, path)
    return files.exists(at)


def partitions(spark: SparkSession, path: str, name: str, kind=int) -> list:
    """The values of ``name`` among the folders ``name=value`` of a path, in order."""
    files, at = _fs(spark, path)
    names = [x.getPath().getName() for x in files.listStatus(at)] if files.exists(at) else []
    return sorted(kind(x.partition("=")[2]) for x in names if x.startswith(f"{name}="))


def delete(spark: SparkSession, path: str) -> None:
    files, at = _fs(spark, path)
    files.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _fs(spark, path)
    if not files.exists(at):
        raise SourceError(f"{path} does not exist")
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside and rename over the old file in one step: readers see the old file or the new one."""
    beside = _written_beside(spark, path, text)
    options = spark._jvm.org.apache.hadoop.fs.Options
    modes = spark.sparkContext._gateway.new_array(options.Rename, 1)
    modes[0] = options.Rename.OVERWRITE
    _, at = _fs(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, at, modes)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; SinkError if another writer was first."""
    beside = _written_beside(spark, path, text)
    files, at = _fs(spark, path)
    if files.exists(at) or not files.rename(beside, at):
        files.delete(beside, False)
        raise SinkError(f"{path} exists")


def _written_beside(spark: SparkSession, path: str, text: str):
    files, beside = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    return beside


def read_json(spark: SparkSession, path: str):
    """A small JSON document, on the driver."""
    return json.loads(read_text(spark, path))


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def scan_conference(spark: SparkSession, root: str, venues: list[tuple[str, int]]) -> DataFrame:
    """Raw rows of ``<root>/<venue>/<venue><year>.json`` (each a JSON array) with venue, year and source_path; only named files are opened.

    A JSON array can't be split: each file is one task, which parses it as a whole. Large
    corpora belong in JSON lines, or in many files.
    """
    paths = {f"{root.rstrip('/')}/{v}/{v}{y}.json": (v.upper(), y) for v, y in venues}
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise SourceError(f"missing: {', '.join(missing)}")
    raw = spark.read.schema(schemas.RAW).option("multiLine", True).option("mode", "FAILFAST").json(list(paths)).select("*", F.col("_metadata.file_path").alias("source_path"))
    name = F.regexp_extract(F.substring_index("source_path", "/", -1), r"^(.*?)(\d+)\.json$", 1)
    year = F.regexp_extract(F.substring_index("source_path", "/", -1), r"(\d+)\.json$", 1)
    return raw.withColumn("venue", F.upper(name)).withColumn("year", year.cast("int"))


def scan_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines; a missing file is an empty table, blank lines are skipped, a line that is no object fails the scan."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, line of every line of text files, blank ones too; a missing path, or none, is an empty table.

    Files may be read in pieces: lines are counted a piece, and only the counts are summed.
    """
    found = [p for p in ([path] if isinstance(path, str) else path) if exists(spark, p)]
    if not found:
        return spark.createDataFrame([], "value string, file string, line long")
    lines = spark.read.text(found).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("id"))
    pieces = lines.groupBy("file", "piece").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("file", "piece", "first", before.alias("before"))
    return lines.join(pieces, ["file", "piece"]).select("value", "file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"))


def scan_patches(spark: SparkSession, path: str) -> DataFrame:
    """Translation patches with an id, the last row of each id: by time, then file and line. Lines that are no JSON are an error."""
    lines = scan_lines(spark, path).filter(t.strip(F.col("value")) != "")
    parsed = lines.select(F.from_json("value", schemas.PATCHES, {"mode": "FAILFAST"}).alias("x"), "file", "line")
    rows = parsed.select("x.*", F.struct(F.coalesce("x.translated_at", F.lit("")), "file", "line").alias("_at"))
    bad = rows.filter(F.coalesce(t.strip(F.col("paper_id")), F.lit("")) == "")
    if bad.head(1):
        raise SourceError(f"{path}: a patch has no paper_id")
    cols = [F.coalesce(c, F.lit("")).alias(c) for c in schemas.PATCHES.fieldNames()]
    return rows.groupBy("paper_id").agg(F.max_by(F.struct(*cols), "_at").alias("x")).select("x.*")


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """split, paper_id: distinct stripped ids of each split; no rows if there is no manifest."""
    if not exists(spark, path):
        return spark.createDataFrame([], "split string, paper_id string")
    m = spark.read.schema("splits map<string,array<string>>").option("multiLine", True).json(path)
    rows = m.select(F.explode("splits").alias("split", "ids")).select("split", F.explode("ids").alias("paper_id"))
    return rows.select("split", t.strip(F.col("paper_id")).alias("paper_id")).filter("paper_id != ''").distinct()


def scan_import(spark: SparkSession, path: str) -> tuple[str, DataFrame, DataFrame]:
    """(source_batch, records, AI annotations) of an import payload."""
    shape = StructType().add("source_batch", "string").add("records", ArrayType(schemas.RECORDS)).add("annotations_ai", ArrayType(schemas.ANNOTATIONS))
    p = spark.read.schema(shape).option("multiLine", True).json(path)
    head = p.select("source_batch", F.col("records").isNull().alias("no_records"), F.col("annotations_ai").isNull().alias("no_annotations")).first()
    if head is None or head.no_records or head.no_annotations:
        raise SourceError("records and annotations_ai must be arrays")
    return head.source_batch or "", p.select(F.explode("records").alias("r")).select("r.*"), p.select(F.explode("annotations_ai").alias("a")).select("a.*")


# sinks


def require_unique(df: DataFrame, key: str) -> None:
    if found := df.groupBy(key).count().filter("count > 1").select(key).orderBy(key).head(5):
        raise SinkError(f"repeated {key}: {', '.join(str(r[0]) for r in found)}")


def write_jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    """JSON lines, nulls kept; ``one_file`` only for tables meant for people."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_records(records: DataFrame, path: str, keep_final: bool = False) -> None:
    """Sorted by id, unique ids only, final columns dropped unless asked for."""
    require_unique(records, "paper_id")
    out = records if keep_final else records.drop(*[c for c in records.columns if c.startswith("final_")])
    write_jsonl(out.orderBy("paper_id"), path)


def write_audit(calls: DataFrame, path: str, kind: str, run: str, batch: int = 0) -> None:
    """One line a model call of ``calls`` (paper_id, and ``calls`` as ``models.run_model`` returns them) in the audit log.

    Each batch of a run has a folder of its own, so none waits for another, and a batch
    that is logged again replaces itself.
    """
    lines = calls.select("paper_id", F.explode("calls").alias("c")).select(F.lit(kind).alias("event_type"), "paper_id", "c.*")
    lines.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/run={run}/batch={batch}")


def append_sorted(rows: DataFrame, path: str) -> None:
    """Add rows, sorted by id, to a folder of JSON lines."""
    rows.orderBy("paper_id").write.mode("append").option("ignoreNullFields", "false").json(path)


def write_sorted(rows: DataFrame, path: str) -> None:
    write_jsonl(rows.orderBy("paper_id"), path)


def write_raw(objects: DataFrame, path: str) -> None:
    """JSON objects (an id, and ``value``) as lines, sorted by id, unique ids only."""
    key = objects.columns[0]
    require_unique(objects, key)
    objects.orderBy(key).select("value").write.mode("overwrite").text(path)


def upsert(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Base rows, but new rows take their ids' place."""
    return base.join(new.select(key), key, "left_anti").unionByName(new)


#: Buckets of a table whose rows are upserted.
BUCKETS = 64


def bucket_of(key: str, n: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


class SnapshotRoot:
    """A benchmark's tables as snapshots: the tables of a commit are written to a new folder, then one new version file names them.

    Tables and documents that a commit does not give stay where they are and are named
    again, not copied. A table is one folder, or, once rows were upserted into it, a folder
    for each of ``BUCKETS`` hashes of its key: an upsert writes only the buckets that it
    touches, and names the others again. A version file must not exist before, so of two
    writers that say they began at one version the later one fails (SinkError), and a
    failed writer leaves the last version whole. Old versions are the backups.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        files, at = _fs(self.spark, f"{self.root}/versions")
        names = [x.getPath().getName() for x in files.listStatus(at)] if files.exists(at) else []
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json") and not x.startswith("."))

    def version(self) -> int:
        """The last version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def _held(self, version: int | None = None) -> tuple[int, dict[str, str | list[str | None]]]:
        """The last version (0: none), and each name's path below the root, or its buckets' paths."""
        n = self.version() if version is None else version
        return n, {} if not n else read_json(self.spark, f"{self.root}/versions/{n:012d}.json")

    def paths(self, table: str, version: int | None = None) -> list[str]:
        """Where a table is; nowhere if there is none, or no row in it."""
        at = self._held(version)[1].get(table, [])
        return [f"{self.root}/{p}" for p in ([at] if isinstance(at, str) else at) if p]

    def named(self, table: str, version: int | None = None) -> bool:
        """Whether a version has the table, be it empty."""
        return table in self._held(version)[1]

    def path(self, name: str, version: int | None = None) -> str:
        """Where a document is, or a table that is one folder."""
        at = self._held(version)[1].get(name, f"none/{name}")
        if not isinstance(at, str):
            raise SourceError(f"{name} is in buckets: see paths")
        return f"{self.root}/{at}"

    def _json(self, paths: list[str], schema: StructType) -> DataFrame:
        found = [p for p in paths if exists(self.spark, p)]
        return self.spark.read.schema(schema).option("mode", "FAILFAST").json(found) if found else self.spark.createDataFrame([], schema)

    def read(self, table: str, schema: StructType, version: int | None = None) -> DataFrame:
        return self._json(self.paths(table, version), schema)

    def read_document(self, name: str, version: int | None = None) -> dict:
        path = self.path(name, version)
        return read_json(self.spark, path) if exists(self.spark, path) else {}

    def _touched(self, table: str, rows: DataFrame, key: str, version: int) -> tuple[list[int], list[str]]:
        """The buckets that rows fall in (all, if the table is not in buckets yet), and where their rows are now."""
        at = self._held(version)[1].get(table, [])
        if isinstance(at, str):
            return list(range(BUCKETS)), [f"{self.root}/{at}"]
        hit = sorted(r.b for r in rows.select(bucket_of(key).alias("b")).distinct().collect())  # BUCKETS rows at most
        return hit, [f"{self.root}/{at[b]}" for b in hit if at and at[b]]

    def replaced(self, table: str, rows: DataFrame, key: str, version: int) -> DataFrame:
        """The rows of a version's table whose place an upsert of ``rows`` takes; only the buckets that it touches are read."""
        return self._json(self._touched(table, rows, key, version)[1], rows.schema).join(rows.select(key), key, "left_semi").select(*rows.columns)

    def commit(self, tables: dict[str, DataFrame], documents: dict[str, object] | None = None, began: int | None = None, upserts: dict[str, DataFrame] | None = None, key: str = "paper_id") -> int:
        """Write the given tables and documents and name them, and all others, in a new version, which is returned.

        A table may be given as (key, value), where the value is a whole JSON object.
        ``upserts`` are rows that take the place of those with their keys in their tables,
        whose schemas they have. ``began`` is the version whose tables the new ones were made
        from (None: this one). If another writer has committed since, nothing is committed:
        SinkError.
        """
        version, names = self._held(began)
        if version != self.version():
            raise SinkError(f"{self.root} has changed since version {version}")
        folder = f"snapshot-{uuid.uuid4().hex}"
        for name, df in tables.items():
            write = write_raw if df.columns == [key, "value"] else write_records if name == "records" else write_sorted
            write(df, f"{self.root}/{folder}/{name}")
        for name, value in (documents or {}).items():
            write_json(self.spark, f"{self.root}/{folder}/{name}", value)
        names = names | {name: f"{folder}/{name}" for name in (*tables, *(documents or {}))}
        for name, rows in (upserts or {}).items():
            names[name] = self._upserted(f"{folder}/{name}", name, rows, key, version)
        create_text(self.spark, f"{self.root}/versions/{version + 1:012d}.json", json.dumps(names))
        return version + 1

    def _upserted(self, folder: str, table: str, rows: DataFrame, key: str, version: int) -> list[str | None]:
        require_unique(rows, key)
        hit, old = self._touched(table, rows, key, version)
        held = self._held(version)[1].get(table, [])
        after = list(held) if held and not isinstance(held, str) else [None] * BUCKETS
        whole = upsert(self._json(old, rows.schema), rows, key).withColumn("_bucket", bucket_of(key))
        whole.repartition("_bucket").sortWithinPartitions("_bucket", key).write.option("ignoreNullFields", "false").partitionBy("_bucket").json(f"{self.root}/{folder}")
        made = set(partitions(self.spark, f"{self.root}/{folder}", "_bucket"))
        for b in hit:
            after[b] = f"{folder}/_bucket={b}" if b in made else None
        return after
