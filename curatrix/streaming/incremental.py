"""Structured Streaming forms of what is incremental: annotation with skip-existing, split assignment, audit roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import rules
from ..operators import models, splits


def annotate_stream(records: DataFrame, out_path: str, factory: Callable, output: str, key: str = "paper_id") -> DataStreamWriter:
    """Annotate each micro-batch's new ids and append. A batch that is replayed finds its rows there and skips them.

    For sinks that outlive their checkpoints: it reads the ids of the sink in each batch. ``annotate_changes`` does not.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates([key])
        done = models.run_model(todo, factory, output).schema
        held = spark.read.schema(done).parquet(out_path).select(key) if _exists(spark, out_path) else spark.createDataFrame([], done)
        models.run_model(models.missing_only(todo, held, key), factory, output).write.mode("append").parquet(out_path)

    return records.writeStream.foreachBatch(step)


def changed_rows(rows: DataFrame, key: str, content: Column, order: Column) -> DataFrame:
    """``rows`` of a stream that are new, or whose ``content`` is not what their key had last, as one row a key and batch: the last by ``order``.

    The state is a digest a key, in the state store: a batch that is replayed after a
    failure begins from the state that its checkpoint names, and gives the same rows. Rows
    with a null key are passed over.
    """
    keyed = rows.filter(F.col(key).isNotNull()).withColumns({"_digest": F.sha2(F.to_json(F.struct(content.alias("c")), {"ignoreNullFields": "false"}), 256), "_order": order})
    names, schema = rows.columns, keyed.drop("_order").schema

    def step(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = None
        for part in parts:
            top = part.sort_values(["_order", "_digest"], kind="stable").iloc[[-1]]
            if last is None or (last["_order"].iloc[0], last["_digest"].iloc[0]) <= (top["_order"].iloc[0], top["_digest"].iloc[0]):
                last = top
        if last is not None and (not state.exists or state.get[0] != last["_digest"].iloc[0]):
            state.update((last["_digest"].iloc[0],))
            yield last[schema.fieldNames()]

    # the projection also makes of the operator's rows what a shuffle can write
    return keyed.groupBy(key).applyInPandasWithState(step, schema, "digest string", "append", GroupStateTimeout.NoTimeout).select(*names)


def annotate_changes(records: DataFrame, factory: Callable, output: str, key: str = "paper_id", content: Sequence[str] = ("title", "abstract"), order: str = "updated_at", **how) -> DataFrame:
    """New records, and those whose content has changed, with the model's output: a stream for an appending file sink.

    What was annotated is known from keyed state, so the sink is never read; the state's and
    the sink's checkpoints together write a row once, whatever runs again. ``latest`` reads
    the annotations that hold.
    """
    held = [c for c in content if c in records.columns]
    return models.run_model(changed_rows(records, key, F.struct(*held), F.col(order)), factory, output, **how)


def latest(written: DataFrame, key: str = "paper_id", order: str = "updated_at") -> DataFrame:
    """The last row of each key of what a stream has appended: an upsert by key, taken when it is read."""
    row = F.struct(*written.columns)
    return written.groupBy(key).agg(F.max_by(row, F.col(order)).alias("_row")).select("_row.*")


def assign_stream(merged: DataFrame, key: str = "paper_id", seed: int = rules.SPLIT_SEED) -> DataFrame:
    """Splits need no state: the hash decides, so assignments never move."""
    return merged.select(key, splits.choose_split(F.col(key), seed).alias("split"))


def audit_windows(log: DataFrame, ts: str = "ts", kind: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Calls and their total by window and kind; rows later than the watermark are dropped."""
    return log.withWatermark(ts, late).groupBy(F.window(ts, window), kind).agg(F.count("*").alias("calls"), F.sum("value").alias("total"))


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
