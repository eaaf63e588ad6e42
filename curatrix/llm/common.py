"""What the operators of this package share: the shared folder and written tables."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a scanned table for which a file of results is written.
FILE_BYTES = 32 << 20
#: White space that separates words: blank, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def release_memory() -> None:
    """Give freed memory back: Python workers live on after a task, beside the next ones."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def tidy(task):
    """A function of an Arrow table that leaves no freed memory behind."""

    def run(table):
        try:
            return task(table)
        finally:
            release_memory()

    return run


def tidy_pair(task):
    """The same for a function of two Arrow tables."""

    def run(left, right):
        try:
            return task(left, right)
        finally:
            release_memory()

    return run


def tidy_stream(task):
    """The same for a function of a stream of batches."""

    def run(batches):
        yield from task(batches)
        release_memory()

    return run


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did, if they can see that folder; a cluster has it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (*paths, root) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Where a session in one local process names none (as in tests), a temporary folder is
    set; a cluster has to name one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="curatrix-"))
        named = context.getCheckpointDir()
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(files.makeQualified(jpath))
    return path


def files_for(df: DataFrame, n_bytes: int = FILE_BYTES) -> int:
    """In how many files to write what comes of the table that ``df`` scans: one for ``n_bytes`` of it, but two a core at least.

    Thousands of small files, one for each small partition, cost more than their rows.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(2 * cores, min(int(str(size)) // n_bytes, 1_000_000))


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: cuts the lineage,
    and survives the loss of any executor. ``files`` is how many it has at most."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
