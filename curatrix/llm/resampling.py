"""Target-distribution importance resampling over hashed n-grams.

Features are all runs of 1 to ``n_max`` consecutive words, hashed into buckets; a bucket's
gain is 1000 times the log ratio of its smoothed shares in the target's and in the corpus'
texts. A document's weight is the mean gain of its features; Gumbel noise from a hash of
its id makes the highest scores a sample without replacement, weighted by exp(weight).

Method. A slice of a partition's texts becomes one sequence of word ids, whose suffixes are
sorted by their first ``n_max`` words (prefix doubling). Suffixes that begin with the same
n-gram are adjacent: runs in which the common prefix with the one before is n words or
more. Each run's n-gram is hashed once, and its bucket is put back at all its occurrences.

Scale. Tasks send one count a bucket, so the model has ``n_buckets`` numbers whatever the
corpus. Ranks come from the histogram of the integer scores (log ratios bound them, so it
has some 100,000 rows at most) and from a range partitioned table of the scores above the
cut, in which ids that repeat very often may be split.

Null and empty texts have no words, no features and weight 0. Rows with a null doc_id
count in the statistics, but have no score and are never drawn. Rows that repeat a doc_id
have the same noise and each a rank of its own. Other columns are not read, whatever their
names. Without documents, or without target texts, nothing fails: all gains then come from
the smoothing alone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reachable, tidy_stream, written
from .hashing import LOWER, raw, separators, slices, word_hashes

#: ASCII but digits and letters.
SEPARATORS = separators([b for b in range(128) if not chr(b).isalnum()])
#: Bytes of text sorted at once; a longer text is sorted by itself.
STEP = 4_000_000


def suffix_runs(ids: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``ids`` by the first ``depth`` words at least, and each suffix's common prefix with the one before (at most ``depth`` words).

    ``left`` is how many words a text has from each place on; suffixes end there.
    """
    n, rank, done = len(ids), ids.astype(np.int64) + 1, 1
    while done < depth:
        second = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > done)
        second[inside] = rank[inside + done]
        rank = np.unique(rank * (n + 2) + second, return_inverse=True)[1] + 1
        done *= 2
    order = np.argsort(rank, kind="stable")
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        same = np.ones(n - 1, bool)
        for k in range(depth):
            same &= (left[a] > k) & (left[b] > k)
            same[same] = ids[a[same] + k] == ids[b[same] + k]
            common[1:] += same
    return order, common


def ngram_buckets(column: pa.Array, n_max: int, n_buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 1 to ``n_max``, the bucket of the n-gram that starts at each word of the column's values (-1: none does); and each value's number of words."""
    data, offsets = raw(column)
    words, counts, start, end = word_hashes(data, offsets, SEPARATORS)
    if not len(words):
        return [np.zeros(0, np.int64) for _ in range(n_max)], counts
    ids = np.unique(words, return_inverse=True)[1]
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(ids))
    order, common = suffix_runs(ids, left, n_max)
    text, out = LOWER[data].tobytes(), []
    for n in range(1, n_max + 1):
        run = np.cumsum(common < n) - 1
        whole = left[order] >= n
        at, run = order[whole], run[whole]
        first = np.flatnonzero(np.append(True, run[1:] != run[:-1])[: len(run)])
        hashed = np.array([zlib.crc32(b" ".join(text[start[i + k] : end[i + k]] for k in range(n))) % n_buckets for i in at[first]], np.int64)
        buckets = np.full(len(ids), -1, np.int64)
        if len(at):
            buckets[at] = np.repeat(hashed, np.diff(np.append(first, len(at))))
        out.append(buckets)
    return out, counts


def bucket_counts(texts: DataFrame, text: str = "text", n_max: int = 1, n_buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall in each bucket. Only these ``n_buckets`` numbers reach the driver."""

    def count(batches):
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for a, b in slices(raw(batch.column(0))[1], STEP):
                for found in ngram_buckets(batch.column(0).slice(a, b - a), n_max, n_buckets)[0]:
                    total += np.bincount(found[found >= 0], minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    reachable(texts.sparkSession)
    out = np.zeros(n_buckets, np.int64)
    for r in texts.select(F.col(f"`{text}`")).mapInArrow(tidy_stream(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: 1000 times the log of target share by corpus share, one added to each count, floored."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", n_max: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain of the features, 0 without any) for every row."""

    def score(batches):
        for batch in batches:
            for a, b in slices(raw(batch.column(1))[1], STEP):
                found, counts = ngram_buckets(batch.column(1).slice(a, b - a), n_max, len(gain))
                ends = np.cumsum(counts)
                total, n = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
                for buckets in found:
                    for sums, each in ((total, np.where(buckets >= 0, gain[buckets], 0)), (n, buckets >= 0)):
                        upto = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
                        sums += upto[ends] - upto[ends - counts]
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy_stream(score), f"doc_id {kind}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", n_max: int = 1, n_buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``; rank is null where a document is not drawn.

    Of the N documents of ``min_words`` words or more, floor(percent * N / 100) are drawn,
    those of the highest scores; ties go to the smaller doc_id.
    """
    spark = reachable(docs.sparkSession)
    gain = gains(bucket_counts(docs, text, n_max, n_buckets), bucket_counts(target, target_text, n_max, n_buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = written(weights(docs, gain, doc_id, text, n_max).withColumn("score", F.col("weight") + noise), "scores")
    able = scored.filter((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull())
    histogram = able.groupBy("score").agg(F.count("*").alias("n")).collect()
    quota, cut, above = percent * sum(r.n for r in histogram) // 100, None, 0
    for score, n in sorted(histogram, reverse=True):
        if above >= quota:
            break
        cut, above = score, above + n
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*columns, none)
    top = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull() & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("_salt")]
    # rows that share an id are spread by a salt; the place in a partition is the low part of the row's number
    ordered = scored.filter(top).withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(ordered.select(*columns, F.monotonically_increasing_id().alias("_i")), "ranked")
    part, place = F.shiftright("_i", 33), F.col("_i").bitwiseAND((1 << 33) - 1)
    counts, starts = sorted(numbered.groupBy(part.alias("part")).count().collect()), []
    before = 0
    for p, n in counts:
        starts.append((p, before))
        before += n
    starts = spark.createDataFrame(starts, "_part long, _before long")  # one row a partition
    rank = F.col("_before") + place + 1
    ranked = numbered.join(F.broadcast(starts), part == F.col("_part")).select(*columns, F.when(rank <= quota, rank).alias("rank"))
    return ranked.unionByName(scored.filter(~F.coalesce(top, F.lit(False))).select(*columns, none))


def drawn(docs: DataFrame, ranks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``ranks`` (of ``resample``) draws; all rows that share a drawn id."""
    ids = ranks.filter("rank IS NOT NULL").select(F.col("doc_id").alias(doc_id))
    return docs.join(ids, doc_id, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
