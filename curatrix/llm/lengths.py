"""Token counts as an exact length histogram.

Documents are counted by their encoded length; sums from the long end then answer, for
every context limit, how many documents and tokens lie above it and what is left if
all texts are cut there. The histogram has a row for each length that occurs, so
beyond the encoding itself everything grows with the longest text, not the corpus.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy_stream
from .tokens import tokenizer_of

#: Lengths a block of the two-level sums.
BLOCK = 1024


def length_histogram(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """length, n_docs: counted within each task first, so at most one row a length and task is shuffled.

    A null or empty text has length 0. An empty table gives no rows.
    """

    def count(batches):
        tok, found = tokenizer_of(tokenizer), Counter()
        for batch in batches:
            for n in tok.counts(batch.column(0)):
                lengths, docs = np.unique(n, return_counts=True)
                found.update(dict(zip(lengths.tolist(), docs.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["length", "n"])

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(tidy_stream(count), "length long, n long").groupBy("length").agg(F.sum("n").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds, for each length L: docs and tokens in texts of at least L, tokens if all are cut at L, and the rank of L.

    Columns: length, n_docs, docs_at_least, tokens_at_least, tokens_if_cut (sum of
    min(length, L)), docs_up_to and total_docs (the quantile of L is their ratio),
    total_tokens. Summed in two levels: within blocks of lengths, then over the blocks,
    of which there is one for each ``BLOCK`` lengths.
    """
    h = histogram.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks_ = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = blocks_.select(
        "block",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_above"),
        F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = h.withColumn("d_in", F.sum("n_docs").over(within)).withColumn("t_in", F.sum("tokens").over(within)).join(above, "block")
    s = s.withColumn("docs_at_least", F.col("d_in") + F.col("d_above")).withColumn("tokens_at_least", F.col("t_in") + F.col("t_above"))
    return s.select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("tokens_if_cut"),
        (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        "total_docs", "total_tokens",
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_over, tokens_if_cut for any limits, from the sums: the first length above a limit answers it.

    ``sums`` has a row a length and ``limits`` is a stated list; texts of the limit's
    own length are not over it.
    """
    total = F.max("total_tokens")
    over = [
        F.struct(
            F.lit(x).cast("long").alias("limit"),
            F.coalesce(F.max(F.when(F.col("length") > x, F.col("docs_at_least"))), F.lit(0)).alias("docs_over"),
            (total - F.coalesce(F.max(F.when(F.col("length") > x, F.col("tokens_at_least") - x * F.col("docs_at_least"))), F.lit(0))).alias("tokens_if_cut"),
        )
        for x in limits
    ]
    return sums.agg(F.array(*over).alias("x")).select(F.explode("x").alias("x")).select("x.*")
