"""Distributions and facets in long form: section, key, n. Everything is counted in one pass of partial sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distribution(df: DataFrame, sections: Mapping[str, Column]) -> DataFrame:
    """section, key, n: rows by each section's value; an array counts each of its values, nulls are left out; section total is all rows."""
    kinds = df.select(*[c.alias(k) for k, c in sections.items()]).schema
    entries = [F.array(F.struct(F.lit("total").alias("section"), F.lit("").alias("key")))]
    for name, value in sections.items():
        values = value if kinds[name].dataType.typeName() == "array" else F.array(value.cast("string"))
        entries.append(F.transform(F.filter(values, lambda x: x.isNotNull()), named("section", name, "key")))
    return df.select(F.explode(F.concat(*entries)).alias("x")).groupBy("x.section", "x.key").agg(F.count("*").alias("n"))


def named(field: str, name: str, value: str):
    return lambda x: F.struct(F.lit(name).alias(field), x.cast("string").alias(value))


def label_counts(df: DataFrame, labels: Column, tier: Column, domain: Sequence[str]) -> DataFrame:
    """label, positives, negatives for every label of the domain."""
    totals = df.agg(*[x for i, d in enumerate(domain) for x in (
        F.count_if(F.array_contains(labels, d) & (tier == "positive")).alias(f"p{i}"), F.count_if(F.array_contains(labels, d) & (tier == "negative")).alias(f"n{i}"),
    )])
    rows = [F.struct(F.lit(d).alias("label"), F.col(f"p{i}").alias("positives"), F.col(f"n{i}").alias("negatives")) for i, d in enumerate(domain)]
    return totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def release(records: DataFrame, key: str, venue: Column, kind: Column, labels: Column, tier: Column, status: Column, domain: Sequence[str]) -> DataFrame:
    """section, key, n of a release: total, venues, objects, unresolved (status isn't final), duplicate_ids, and each label's rows (positive) and its rows of a negative tier (negative)."""
    counted = distribution(records, {"venue": venue, "object": kind, "unresolved": F.when(F.coalesce(status, F.lit("")) != "final", "")})
    twice = records.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_ids").alias("section"), "key", "n")
    sums = records.agg(*[x for i, d in enumerate(domain) for x in (F.count_if(F.array_contains(labels, d)).alias(f"p{i}"), F.count_if(F.array_contains(labels, d) & (tier == "negative")).alias(f"n{i}"))])
    entry = lambda section, d, c: F.struct(F.lit(section).alias("section"), F.lit(d).alias("key"), F.col(c).alias("n"))
    rows = [x for i, d in enumerate(domain) for x in (entry("positive", d, f"p{i}"), entry("negative", d, f"n{i}"))]
    return counted.union(twice).union(sums.select(F.explode(F.array(*rows)).alias("x")).select("x.*"))


def positive_ratio(df: DataFrame, layer: Column, tier: Column) -> DataFrame:
    """layer, positives, total, ratio (unrounded; 0 if there are no rows)."""
    out = df.groupBy(layer.alias("layer")).agg(F.count_if(tier == "positive").alias("positives"), F.count("*").alias("total"))
    return out.withColumn("ratio", F.when(F.col("total") == 0, 0.0).otherwise(F.col("positives") / F.col("total")))


def gap(counts: DataFrame, target: int) -> DataFrame:
    """Adds target and gap, which isn't below 0, to rows with ``current``."""
    return counts.withColumn("target", F.lit(target).cast("long")).withColumn("gap", F.greatest(F.lit(0).cast("long"), F.col("target") - F.col("current")))


def facet(df: DataFrame, name: str, value: str, domain: Sequence[str], keep: Column) -> DataFrame:
    """facet, value, n over the rows that the other filters keep; zero for values without rows."""
    totals = df.filter(keep).agg(*[F.count_if(F.col(value) == d).alias(f"c{i}") for i, d in enumerate(domain)])
    rows = [F.struct(F.lit(name).alias("facet"), F.lit(d).alias("value"), F.col(f"c{i}").alias("n")) for i, d in enumerate(domain)]
    return totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def facets(df: DataFrame, filters: Mapping[str, Column], values: Mapping[str, Column], domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """facet, value, n of any number of facets in one pass: each facet's rows are those that all filters but its own keep.

    A row has a bitmap of the filters that it fails; it counts for a facet if it fails no
    other filter than the one of that name. ``values`` are strings or arrays of them (a row
    counts once for each value); the values of ``domains`` are there with 0, others if they occur.
    """
    bits = {name: 1 << i for i, name in enumerate(filters)}
    failed = F.lit(0).cast("long")
    for name, keep in filters.items():
        failed = failed.bitwiseOR(F.when(F.coalesce(keep, F.lit(False)), 0).otherwise(bits[name]).cast("long"))
    kinds = dict(df.select(*[c.alias(name) for name, c in values.items()]).dtypes)
    entries = []
    for name, c in values.items():
        held = F.array_distinct(c) if kinds[name].startswith("array") else F.array(c.cast("string"))
        counts = F.col("_failed").bitwiseAND(~bits.get(name, 0)) == 0
        entry = F.transform(held, named("facet", name, "value"))
        entries.append(F.when(counts & held.isNotNull(), entry).otherwise(F.array().cast("array<struct<facet:string,value:string>>")))
    each = df.withColumn("_failed", failed).select(F.explode(F.concat(*entries)).alias("x")).select("x.facet", "x.value", F.lit(1).alias("w")).filter("value IS NOT NULL")
    known = df.sparkSession.createDataFrame([(name, v, 0) for name, domain in domains.items() for v in domain], "facet string, value string, w int")
    return each.union(known).groupBy("facet", "value").agg(F.sum("w").alias("n"))


def python_round(x: float, digits: int = 4) -> float:
    """Reports round on the driver, half to even on the exact binary value."""
    return round(x, digits)
