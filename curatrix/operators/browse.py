"""Browsing: status of records, filters, facets and what comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .reports import named

STATUSES = ("pending", "completed", "negative", "conflict")


def browse(records: DataFrame, ai: DataFrame, human: DataFrame, conflicts: DataFrame, splits: DataFrame, key: str = "paper_id", tier: str = "candidate_negative_tier") -> DataFrame:
    """Records with status, split and has_ai. Open conflicts come first, then negatives nobody has looked at, then what a human has done.

    The right sides must have one row an id.
    """
    mark = lambda df, name: df.select(key, F.lit(True).alias(name))
    out = records.join(mark(ai, "_ai"), key, "left").join(mark(human, "_human"), key, "left").join(mark(conflicts, "_conflict"), key, "left").join(splits.select(key, "split"), key, "left")
    status = F.when(F.col("_conflict"), "conflict").when((F.col(tier) == "negative") & F.col("_human").isNull(), "negative").when(F.col("_human"), "completed").otherwise("pending")
    return out.withColumn("status", status).withColumn("split", F.coalesce("split", F.lit("unassigned"))).withColumn("has_ai", F.col("_ai").isNotNull()).drop("_ai", "_human", "_conflict")


#: What is shown for stored values (fixed values).
CAPTIONS = {
    "status": {"all": "全部", "negative": "待抽检", "pending": "待复标", "completed": "已完成", "conflict": "有冲突"},
    "split": {"dev": "开发集", "dev_validation": "开发验证集", "test": "测试集", "": "未分配", "unassigned": "未分配"},
    "tier": {"positive": "正样本", "negative": "负样本"},
}


def caption(kind: str, value: Column) -> Column:
    """The caption of a value; a split without one is shown as it is, other unknown values are null."""
    held = F.create_map(*[F.lit(x) for pair in CAPTIONS[kind].items() for x in pair])
    found = F.try_element_at(held, F.coalesce(value, F.lit("")))
    return F.coalesce(found, value) if kind == "split" else found


def display(source: Column, translated: Column) -> Column:
    """The translation, or the source where there is none."""
    return F.when(F.coalesce(translated, F.lit("")) != "", translated).otherwise(source)


def shown(rows: DataFrame) -> DataFrame:
    """Browsed rows with what a page shows: title, abstract, labels and object (a seed annotation's before the candidate's) and captions."""
    return rows.select(
        "*", display(F.col("title"), F.col("title_zh")).alias("display_title"), display(F.col("abstract"), F.col("abstract_zh")).alias("display_abstract"),
        F.coalesce("seed_labels", "candidate_preference_labels").alias("display_labels"), F.coalesce("seed_object", "primary_research_object").alias("display_object"),
        *[caption(k, F.col(c)).alias(f"{k}_caption") for k, c in (("status", "status"), ("split", "split"), ("tier", "candidate_negative_tier"))],
    )


def kept_by(filters: dict[str, str | None], ignore: str | None = None) -> Column:
    """The filters' predicate, but for the one that a facet ignores; ``all`` and None filter nothing."""
    out = F.lit(True)
    for name, value in filters.items():
        if value not in (None, "all") and name != ignore:
            out = out & (F.array_contains(F.col(name), value) if name.endswith("labels") else F.col(name) == value)
    return out


def pending(records: DataFrame, *done: DataFrame, key: str = "paper_id") -> DataFrame:
    out = records
    for d in done:
        out = out.join(d.select(key), key, "left_anti")
    return out


def needs_translation(source: Column, target: Column) -> Column:
    return (t.strip(F.coalesce(source, F.lit(""))) != "") & (t.strip(F.coalesce(target, F.lit(""))) == "")


def needs_backfill(source: Column, target: Column, placeholder: Column) -> Column:
    return needs_translation(source, target) | ((t.strip(F.coalesce(source, F.lit(""))) != "") & (target == placeholder))


def facet_values(df: DataFrame, **columns: Column) -> DataFrame:
    """facet, value: the distinct values of each column, arrays by element."""
    rows = []
    kinds = df.select(*[c.alias(k) for k, c in columns.items()]).schema
    for name, c in columns.items():
        values = c if kinds[name].dataType.typeName() == "array" else F.array(c)
        rows.append(F.transform(values, named("facet", name, "value")))
    return df.select(F.explode(F.concat(*rows)).alias("x")).select("x.facet", "x.value").filter("value IS NOT NULL").distinct()
