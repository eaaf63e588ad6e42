"""The folder that the driver and all executors share."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder is set only where a session in one local process names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curatrix-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path there, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(files.makeQualified(at))
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shipped(spark: SparkSession) -> SparkSession:
    """Give executors this package's modules, once a session: what runs there imports them by name."""
    context = spark.sparkContext
    if not getattr(context, "_curatrix_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
        path = os.path.join(tempfile.mkdtemp(prefix="curatrix-"), "curatrix.zip")  # the driver serves it to executors
        with open(path, "wb") as out:
            out.write(held.getvalue())
        context.addPyFile(path)
        context._curatrix_shipped = True
    return spark
