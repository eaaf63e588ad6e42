"""Import of records against what exists, and the clean-up of legacy rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text as t
from . import dedupe
from .validation import fk_violations


#: Keys of the legacy protocol that go.
LEGACY_KEYS = ("target_preference_labels", "final_target_preference_labels")


class ImportRejected(ValueError):
    """The payload breaks a guard; nothing was written."""


def row_hash(columns: Sequence[str]) -> Column:
    """One value for a row: maps count as their sorted entries, nulls as themselves."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def diff(new: DataFrame, old: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """New rows with status: added, updated or unchanged."""
    held = old.select(F.col(key), row_hash(compare).alias("_old"))
    out = new.withColumn("_new", row_hash(compare)).join(held, key, "left")
    status = F.when(F.col("_old").isNull(), "added").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("updated")
    return out.withColumn("status", status).drop("_new", "_old")


def guard(records: DataFrame, annotations: DataFrame, existing: DataFrame) -> None:
    """Repeated ids, repeated titles, titles that exist with another id, annotations without a record."""
    found = {
        "repeated ids": dedupe.duplicates(records, F.col("paper_id"), "paper_id"),
        "repeated titles": dedupe.title_duplicates(records, F.col("title"), "paper_id"),
        "existing titles": dedupe.title_collisions(records.select("paper_id", "title"), existing.select("paper_id", "title"), "title", "paper_id"),
        "annotations without a record": fk_violations(annotations, records, "paper_id"),
        "repeated annotations": dedupe.duplicates(annotations, F.col("paper_id"), "paper_id"),
    }
    bad = [f"{name}: {[r[0] for r in rows]}" for name, df in found.items() if (rows := df.head(5))]
    if bad:
        raise ImportRejected("; ".join(bad))


def cleaned_tier(tier: Column) -> Column:
    return F.when(tier.isin(*rules.LEGACY_NEGATIVE_TIERS), "negative").otherwise(tier)


def clean_objects(lines: DataFrame, renamed: Mapping[str, Mapping[str, str]], drop: Sequence[str] = LEGACY_KEYS, emptied: Mapping[str, str] | None = None) -> DataFrame:
    """line, problem, cleaned: JSON objects of any fields (``value``, ``file``, ``line``) with legacy keys gone and legacy values mapped.

    ``renamed`` maps a field's values; a value that is none of the mapped ones and none of
    what they are mapped to is a problem. Where a field of ``emptied`` has become negative,
    the list that it names is emptied. Fields that nobody names stay as they are, whatever
    they hold. Lines that are blank are left out; ``problem`` is null where there is none.
    """
    parsed = lines.filter(t.strip(F.col("value")) != "").withColumn("_v", F.try_parse_json("value"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    fields = F.when(is_object, F.try_variant_get("_v", "$", "map<string,variant>"))
    out = parsed.withColumn("_fields", F.map_filter(fields, lambda k, _: ~k.isin(*drop)))
    problem = F.when(F.col("_v").isNull(), "not JSON").when(~is_object, "not an object")
    for name, values in renamed.items():
        text = F.trim(F.try_variant_get(F.col("_fields")[name], "$", "string"))
        to = F.coalesce(F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[text], text)
        known = F.coalesce(to.isin(*set(values.values())), F.lit(False))
        problem = problem.when(F.map_contains_key("_fields", F.lit(name)) & ~known, F.concat(F.lit(f"{name}: "), F.coalesce(text, F.lit("null"))))
        now = F.parse_json(F.concat(F.lit('"'), to, F.lit('"')))
        out = out.withColumn("_fields", F.when(F.map_contains_key("_fields", F.lit(name)) & known, _with_value("_fields", name, now)).otherwise(F.col("_fields")))
    for name, listed in (emptied or {}).items():
        negative = (F.try_variant_get(F.col("_fields")[name], "$", "string") == "negative") & F.map_contains_key("_fields", F.lit(listed))
        out = out.withColumn("_fields", F.when(negative, _with_value("_fields", listed, F.parse_json(F.lit("[]")))).otherwise(F.col("_fields")))
    return out.select("file", "line", problem.alias("problem"), F.to_json("_fields").alias("cleaned"))


def _with_value(fields: str, name: str, value: Column) -> Column:
    return F.transform_values(fields, lambda k, v: F.when(k == name, value).otherwise(v))


def with_other_fields(rows: DataFrame, raw: DataFrame, known: Sequence[str], key: str = "paper_id") -> DataFrame:
    """key, value: ``rows`` as JSON objects, with the fields of ``raw`` (key, value: an object) that are not ``known`` put back."""
    other = raw.select(key, F.map_filter(F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>"), lambda k, _: ~k.isin(*known)).alias("_other"))
    own = F.try_variant_get(F.parse_json(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})), "$", "map<string,variant>")
    rest = F.map_filter(F.col("_other"), lambda k, _: ~k.isin(*rows.columns))
    return rows.select(key, own.alias("_own")).join(other, key, "left").select(key, F.to_json(F.when(F.col("_other").isNull(), F.col("_own")).otherwise(F.map_concat("_own", rest))).alias("value"))


def cleaned_annotation(a: Column) -> Column:
    """An annotation struct with its legacy tier mapped, and no labels if it is negative; null stays null."""
    tier = cleaned_tier(a["negative_tier"])
    out = a.withField("negative_tier", tier).withField("preference_labels", F.when(tier == "negative", F.array().cast("array<string>")).otherwise(a["preference_labels"]))
    return F.when(a.isNotNull(), out)


def legacy_clean(df: DataFrame, tier: str, labels: str, drop: Sequence[str] = ("target_preference_labels",)) -> DataFrame:
    """Legacy tiers become negative, labels of negatives are cleared, legacy columns go."""
    out = df.drop(*drop).withColumn(tier, cleaned_tier(F.col(tier)))
    return out.withColumn(labels, F.when(F.col(tier) == "negative", F.array().cast("array<string>")).otherwise(F.col(labels)))
