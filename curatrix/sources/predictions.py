"""Predictions as a table: a data source that posts batches of requests and reads the answers.

``written_requests`` lays rows down as files that hold whole batches; each file is a
partition of the source, whose reader posts one batch after another, asks again where a
request fails, and returns a row a request with its prediction or its error. A task that
runs again asks its file's batches again, and only one of its results is kept.

    spark.dataSource.register(PredictionSource)
    spark.read.format("predictions").options(base_url=..., requests=..., timeout=10, attempts=2).load()
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import SourceError
from .shared import shipped

#: Paper fields that a request holds.
PAPER = ("paper_id", "title", "abstract", "abstract_zh", "authors", "venue", "year", "source", "source_path", "keywords")
SCHEMA = (
    "request_id string, primary_research_object string, preference_labels array<string>, negative_tier string, evidence_spans map<string,array<string>>, notes string, "
    "algorithm_version string, success boolean, error_kind string, error string, attempts int, duration_ms long"
)


class Batches(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PredictionReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.base_url, self.requests = options.get("base_url"), options.get("requests")
        if not self.base_url or not self.requests:
            raise SourceError("the options base_url and requests are needed")
        self.timeout, self.attempts, self.pause = float(options.get("timeout", 10)), int(options.get("attempts", 1)), float(options.get("pause", 0.5))
        self.fail_fast = str(options.get("fail_fast", "false")).lower() == "true"
        if self.timeout <= 0 or self.attempts < 1:
            raise SourceError("timeout has to be over 0 and attempts 1 or more")

    def partitions(self) -> list[Batches]:
        from pyarrow import fs

        files, at = fs.FileSystem.from_uri(self.requests)
        found = files.get_file_info(fs.FileSelector(at))
        return [Batches(x.path) for x in sorted(found, key=lambda x: x.path) if x.base_name.endswith(".parquet")]

    def read(self, partition: Batches) -> Iterator[tuple]:
        from pyarrow import fs

        from ..operators import models

        files, _ = fs.FileSystem.from_uri(self.requests)
        predict = models.http_predictor(self.base_url, self.timeout)()
        with files.open_input_file(partition.path) as held:
            for number, rows in _by_batch(pq.ParquetFile(held)):
                yield from self._batch(number, rows, predict)

    def _batch(self, number: int, rows: list[dict], predict) -> Iterator[tuple]:
        from ..operators import models

        keys, found, kind, error, n, began = [r["request_id"] for r in rows], {}, None, None, 0, time.monotonic()
        for n in range(1, self.attempts + 1):
            try:
                found, kind, error = models.answers_by_key(predict(rows), keys), None, None
                break
            except ValueError as e:  # the service does not keep to the protocol: asking again is no use
                kind, error = "protocol", str(e) or type(e).__name__
                break
            except (RuntimeError, OSError) as e:
                kind, error = "request", str(e) or type(e).__name__
                time.sleep(self.pause * (n < self.attempts))
        if error and self.fail_fast:
            raise RuntimeError(f"batch {number}: {error}")
        spent = int(1000 * (time.monotonic() - began))
        for key in keys:
            x = found.get(key, {})
            spans = x.get("evidence_spans")
            yield (key, x.get("primary_research_object"), x.get("preference_labels"), x.get("negative_tier"), spans if isinstance(spans, dict) else None, x.get("notes"), x.get("algorithm_version"), error is None, kind, error, n, spent)


def _by_batch(held: pq.ParquetFile) -> Iterator[tuple[int, list[dict]]]:
    """The batches of a file, each in the order of its rows; a file is read a row group at a time."""
    number, rows = None, []
    for part in held.iter_batches(batch_size=1_000):
        for row in part.to_pylist():
            batch = row.pop("batch")
            row.pop("position")
            if batch != number and rows:
                yield number, rows
                rows = []
            number = batch
            rows.append(row)
    if rows:
        yield number, rows


class PredictionSource(DataSource):
    """Options: base_url, requests (a folder of ``written_requests``), timeout in seconds, attempts, pause between them, fail_fast."""

    @classmethod
    def name(cls) -> str:
        return "predictions"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PredictionReader:
        return PredictionReader(self.options)


def written_requests(asked: DataFrame, path: str, files: int) -> str:
    """Rows with request_id, position, batch and paper fields, written as at most ``files`` files of whole batches in order; returns the folder's URI."""
    rows = asked.select("request_id", "position", F.col("batch").cast("long").alias("batch"), *PAPER)
    rows.repartition(files, "batch").sortWithinPartitions("batch", "position").write.parquet(path)
    at = asked.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(asked.sparkSession._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()


def predictions(spark: SparkSession, requests: str, base_url: str, timeout: float = 10.0, attempts: int = 1, fail_fast: bool = False) -> DataFrame:
    shipped(spark).dataSource.register(PredictionSource)
    return spark.read.format("predictions").options(base_url=base_url, requests=requests, timeout=timeout, attempts=attempts, fail_fast=str(fail_fast).lower()).load()
