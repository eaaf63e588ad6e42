"""Fingerprints, blocked sets and greedy dedupe."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import graph
from ..functions import rules, text as t
from ..sources.shared import checkpointed, shipped


def normalize(c: Column, chars: str = rules.TRIM_CHARS) -> Column:
    """Lower case, stripped, white space collapsed, then punctuation trimmed at the edges."""
    return F.btrim(t.collapse(t.strip(F.lower(c))), F.lit(chars))


def fingerprint(title: Column, abstract: Column) -> Column:
    """SHA-256 of the normalised pair: what is shuffled is 64 characters, whatever the texts' length."""
    return F.sha2(F.concat(F.coalesce(normalize(title), F.lit("")), F.lit("::"), F.coalesce(normalize(abstract), F.lit(""))), 256)


def normalized_title(c: Column) -> Column:
    """The title key: case-folded, stripped, white space collapsed."""
    return t.collapse(t.strip(t.casefold(c)))


def blocked_ids(*tables: DataFrame, key: str = "paper_id") -> DataFrame:
    out = tables[0].select(key)
    for other in tables[1:]:
        out = out.union(other.select(key))
    return out.distinct()


def label_blocked(cands: DataFrame, existing: DataFrame, key: str = "paper_id", fp: str = "fingerprint") -> DataFrame:
    """Adds ``reason``: blocked_id, blocked_fingerprint, or null."""
    ids = existing.select(key).distinct().withColumn("_by_id", F.lit(True))
    prints = existing.select(fp).distinct().withColumn("_by_fp", F.lit(True))
    out = cands.join(ids, key, "left").join(prints, fp, "left")
    reason = F.when(F.col("_by_id"), "blocked_id").when(F.col("_by_fp"), "blocked_fingerprint")
    return out.withColumn("reason", reason).drop("_by_id", "_by_fp")


#: Rounds in which rows that come first in both their groups are kept at once; what they leave open is walked.
ROUNDS = 2


def greedy(rows: DataFrame, ordinal: str, key: str = "paper_id", fp: str = "fingerprint") -> DataFrame:
    """``rows`` with ``reason``: null for what a walk in order would keep, else duplicate_id or duplicate_fingerprint.

    Only kept rows bar later ones. Of rows that share both keys only the first can be kept.
    Rows that come first in both their groups are kept, and what shares a key with them
    goes; that settles groups of any size about one key. What is still open are chains of
    rows that hang on each other: components of the graph of ids and fingerprints, each
    walked in order in its task, which holds the keys that it has kept. Ordinals must be
    unique and not null. A null id or fingerprint is nobody else's.
    """
    if rows.filter(F.col(ordinal).isNull()).head(1):
        raise ValueError(f"{ordinal} must not be null")
    some = rows.filter(F.col(key).isNotNull() | F.col(fp).isNotNull())
    undecided = checkpointed(some.groupBy(key, fp).agg(F.min(ordinal).alias(ordinal)).select(ordinal, key, fp))
    kept = []
    for _ in range(ROUNDS):
        first = undecided.transform(_with_least, key, ordinal, "_id_first").transform(_with_least, fp, ordinal, "_fp_first")
        now = checkpointed(first.filter(f"{ordinal} = _id_first AND {ordinal} = _fp_first").select(ordinal, key, fp))
        kept.append(now)
        undecided = undecided.join(now.select(ordinal), ordinal, "left_anti").join(now.select(key), key, "left_anti").join(now.select(fp), fp, "left_anti")
        undecided = checkpointed(undecided.select(ordinal, key, fp))
        if not undecided.head(1):
            break
    else:
        kept.append(checkpointed(_walked(undecided, ordinal, key, fp)))
    kept = functools.reduce(DataFrame.union, kept)
    # a kept row bars later ones; ids are looked at first
    by_id = kept.filter(F.col(key).isNotNull()).select(key, F.col(ordinal).alias("_id_at"))
    by_fp = kept.filter(F.col(fp).isNotNull()).select(fp, F.col(ordinal).alias("_fp_at"))
    out = rows.join(by_id, key, "left").join(by_fp, fp, "left")
    reason = F.when(F.col("_id_at") < F.col(ordinal), "duplicate_id").when(F.col("_fp_at") < F.col(ordinal), "duplicate_fingerprint")
    return out.withColumn("reason", reason).drop("_id_at", "_fp_at").select(*rows.columns, "reason")


def _walked(rows: DataFrame, ordinal: str, key: str, fp: str) -> DataFrame:
    """The rows that a walk of each component in order keeps."""
    shipped(rows.sparkSession)
    # nodes are hashes: keys that share one only make a component larger
    nodes = rows.withColumn("_u", F.when(F.col(key).isNotNull(), F.xxhash64(F.lit("id"), F.col(key)))).withColumn("_v", F.when(F.col(fp).isNotNull(), F.xxhash64(F.lit("fp"), F.col(fp))))
    found = graph.components(nodes, "_u", "_v")
    whole = nodes.withColumn("node", F.coalesce("_u", "_v")).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ordered = whole.select("component", ordinal, key, fp).repartition("component").sortWithinPartitions("component", ordinal)
    return ordered.mapInArrow(_walk, rows.schema)


def _walk(batches):
    component, ids, prints = None, set(), set()
    for batch in batches:
        keep = []
        for i, (c, one, two) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True)):
            if c != component:
                component, ids, prints = c, set(), set()
            if (one is None or one not in ids) and (two is None or two not in prints):
                ids.add(one)
                prints.add(two)
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(keep, pa.int64())) for k in (1, 2, 3)], names=batch.schema.names[1:])


def _with_least(df: DataFrame, by: str, ordinal: str, name: str) -> DataFrame:
    """Each row's smallest ordinal of its group, taken before the shuffle and joined back; a null is a group of its own row."""
    least = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.min(ordinal).alias(name))
    return df.join(least, by, "left").withColumn(name, F.coalesce(F.col(name), F.col(ordinal)))


def check_new(rows: DataFrame, existing: DataFrame, key: str = "paper_id", title: str = "title", abstract: str = "abstract") -> None:
    """ValueError where a row's id or fingerprint is another row's or an existing one's. ``rows`` is a batch of bounded size: existing rows are only filtered by it."""
    printed = lambda df: df.select(F.col(key), fingerprint(F.col(title), F.col(abstract)).alias("_fp"))
    new, old = checkpointed(printed(rows)), printed(existing)
    twice = new.groupBy(key).count().filter("count > 1").select(key).union(duplicates(new, F.col("_fp"), key).select("first_id"))
    ids, prints = F.broadcast(new.select(F.col(key).alias("_k"))), F.broadcast(new.select(F.col("_fp").alias("_f")))
    held = old.join(ids, F.col(key) == F.col("_k"), "left_semi").select(key).union(old.join(prints, F.col("_fp") == F.col("_f"), "left_semi").select(key))
    if bad := twice.union(held).head(5):
        raise ValueError(f"ids or texts of rows to add exist: {', '.join(str(r[0]) for r in bad)}")


def duplicates(df: DataFrame, by: Column, key: str) -> DataFrame:
    """by, n, first_id of values that several rows have."""
    return df.groupBy(by.alias("value")).agg(F.count("*").alias("n"), F.min(key).alias("first_id")).filter("n > 1")


def title_duplicates(df: DataFrame, title: Column, key: str) -> DataFrame:
    return df.groupBy(normalized_title(title).alias("title")).agg(F.countDistinct(key).alias("n")).filter("n > 1")


def title_collisions(new: DataFrame, old: DataFrame, title: str, key: str) -> DataFrame:
    """New rows whose normalised title an old row with another id has."""
    o = old.select(normalized_title(F.col(title)).alias("_t"), F.col(key).alias("_old")).groupBy("_t").agg(F.min("_old").alias("_lo"), F.max("_old").alias("_hi"))
    n = new.withColumn("_t", normalized_title(F.col(title)))
    return n.join(o, "_t").filter((F.col("_lo") != F.col(key)) | (F.col("_hi") != F.col(key))).drop("_t", "_lo", "_hi")
