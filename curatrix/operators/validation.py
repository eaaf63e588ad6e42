"""Data-quality rules. Each check gives issue rows; nothing raises, and all rows are looked at in one pass a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules, text as t


def issue(when: Column, path: str, message: str | Column) -> Column:
    return F.when(when, F.struct(F.lit(path).alias("path"), (F.lit(message) if isinstance(message, str) else message).alias("message")))


def issues(df: DataFrame, key: str, checks: Sequence[Column]) -> DataFrame:
    """key, path, message: one row for each check that fails on a row."""
    return df.select(F.col(key), F.explode(F.array_compact(F.array(*checks))).alias("i")).select(key, "i.path", "i.message")


def json_issues(df: DataFrame, key: str, raw: Column) -> DataFrame:
    """Lines that are no JSON, or no object."""
    v = F.try_parse_json(raw)
    return issues(df.withColumn("_v", v), key, [
        issue(F.col("_v").isNull(), "$", "not JSON"),
        issue(F.col("_v").isNotNull() & ~F.schema_of_variant(F.col("_v")).startswith("OBJECT"), "$", "not an object"),
    ])


def field_issues(df: DataFrame, key: str, raw: Column, fields: Sequence[str]) -> DataFrame:
    """Missing and extra fields of JSON objects; lists are sorted."""
    keys, want = F.json_object_keys(raw), F.array(*[F.lit(f) for f in sorted(fields)])
    rows = df.withColumn("_m", F.array_sort(F.array_except(want, keys))).withColumn("_x", F.array_sort(F.array_except(keys, want)))
    return issues(rows, key, [
        issue(F.size("_m") > 0, "$", F.concat(F.lit("missing: "), F.array_join("_m", ", "))), issue(F.size("_x") > 0, "$", F.concat(F.lit("extra: "), F.array_join("_x", ", "))),
    ])


def has_type(value: Column, kind: str, domain: Sequence[str] | None = None) -> Column:
    """Whether a variant value has a wire type. A boolean is no integer."""
    shape = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    text_list = shape.isin("ARRAY<STRING>", "ARRAY<VOID>")
    if kind == "integer":
        return shape == "BIGINT"
    if kind == "object":
        return shape.startswith("OBJECT")
    if kind == "string[]":
        return text_list
    if kind == "string":
        return shape == "STRING"
    if kind == "enum":
        return (shape == "STRING") & F.coalesce(F.try_variant_get(value, "$", "string").isin(*(domain or ())), F.lit(False))
    if kind == "enum[]":
        return text_list & F.coalesce(F.forall(F.try_variant_get(value, "$", "array<string>"), lambda x: x.isin(*(domain or ()))), F.lit(False))
    return F.lit(False)


def type_issues(df: DataFrame, key: str, raw: Column, fields: Mapping[str, str], enums: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Values of declared fields whose JSON type, or domain, isn't the declared one; missing fields are another check's."""
    rows = df.withColumn("_v", F.try_parse_json(raw))
    checks = []
    for name, kind in fields.items():
        value = F.try_variant_get(F.col("_v"), f"$.{name}", "variant")
        checks.append(issue(value.isNotNull() & ~has_type(value, kind, (enums or {}).get(name)), name, f"not {kind}"))
    return issues(rows, key, checks)


def line_issues(lines: DataFrame, fields: Mapping[str, str], enums: Mapping[str, Sequence[str]] | None = None, spans: str | None = None) -> DataFrame:
    """file, line, path, message of raw JSON lines: no JSON, no object, missing or extra fields, wrong types, bad evidence keys; blank lines are no rows. One pass."""
    raw, v = F.col("value"), F.col("_v")
    rows = lines.filter(t.strip(raw) != "").withColumn("_v", F.try_parse_json(raw)).withColumn("_o", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    keys, want = F.when(F.col("_o"), F.json_object_keys(raw)), F.array(*[F.lit(f) for f in sorted(fields)])
    rows = rows.withColumn("_m", F.array_sort(F.array_except(want, keys))).withColumn("_x", F.array_sort(F.array_except(keys, want)))
    checks = [
        issue(v.isNull(), "$", "not JSON"), issue(v.isNotNull() & ~F.col("_o"), "$", "not an object"),
        issue(F.size("_m") > 0, "$", F.concat(F.lit("missing: "), F.array_join("_m", ", "))), issue(F.size("_x") > 0, "$", F.concat(F.lit("extra: "), F.array_join("_x", ", "))),
    ]
    for name, kind in fields.items():
        value = F.when(F.col("_o"), F.try_variant_get(v, f"$.{name}", "variant"))
        checks.append(issue(value.isNotNull() & ~has_type(value, kind, (enums or {}).get(name)), name, f"not {kind}"))
    if spans:
        held = F.from_json(F.get_json_object(raw, f"$.{spans}"), "map<string,array<string>>")
        known = (*rules.PREFERENCE_LABELS, *rules.EVIDENCE_EXTRA_KEYS)
        checks.append(issue(~F.forall(F.map_keys(held), _within(known)), spans, "unknown key"))
        checks.append(issue(F.exists(F.map_values(held), lambda q: q.isNull() | F.exists(q, lambda x: x.isNull() | (t.strip(x) == ""))), spans, "blank quote"))
    found = rows.select("file", "line", F.explode(F.array_compact(F.array(*checks))).alias("i"))
    return found.select("file", "line", "i.path", "i.message")


def parsed_lines(lines: DataFrame, schema) -> DataFrame:
    """The rows of lines that parse; others are ``line_issues``'."""
    return lines.filter(t.strip(F.col("value")) != "").select(F.from_json("value", schema).alias("x")).filter("x IS NOT NULL").select("x.*")


def conflict_issues(conflicts: DataFrame) -> DataFrame:
    """The invariants of conflicts: an id, fields, both annotations, each of this id and valid in itself."""
    sides = {k: conflicts.filter(F.col(k).isNotNull()).select(F.col("paper_id").alias("_id"), f"{k}.*") for k in ("codex_annotation", "human_annotation", "resolved_annotation")}
    c = F.col
    own = issues(conflicts, "paper_id", [
        issue(F.coalesce(t.strip(c("paper_id")), F.lit("")) == "", "paper_id", "blank"), issue(F.coalesce(F.size("conflicting_fields"), F.lit(0)) <= 0, "conflicting_fields", "empty"),
        *[issue(c(k).isNull(), k, "missing") for k in ("codex_annotation", "human_annotation")],
        *[issue(c(f"{k}.paper_id") != c("paper_id"), k, "of another id") for k in sides],
    ])
    for name, rows in sides.items():
        found = annotation_issues(rows.drop("paper_id").withColumnRenamed("_id", "paper_id"))
        own = own.union(found.select("paper_id", F.concat(F.lit(f"{name}."), "path"), "message"))
    return own


def _within(domain: Sequence[str]):
    return lambda x: x.isin(*domain)


def enum_issues(df: DataFrame, key: str, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    checks = []
    for name, domain in domains.items():
        many = df.schema[name].dataType.typeName() == "array"
        ok = F.forall(F.col(name), _within(domain)) if many else F.col(name).isin(*domain)
        checks.append(issue(~F.coalesce(ok, F.lit(False)), name, "out of the domain"))
    return issues(df, key, checks)


def evidence_issues(df: DataFrame, key: str, spans: str, domain: Sequence[str]) -> DataFrame:
    s = F.col(spans)
    return issues(df, key, [
        issue(~F.forall(F.map_keys(s), lambda k: k.isin(*domain)), spans, "unknown key"),
        issue(F.exists(F.map_values(s), lambda v: v.isNull() | F.exists(v, lambda x: x.isNull() | (t.strip(x) == ""))), spans, "blank quote"),
    ])


def translation_issues(df: DataFrame, key: str, pairs: Sequence[tuple[str, str]], long_pair: tuple[str, str] | None = None) -> DataFrame:
    """Blank targets of set sources, refusals, and targets too short for a long source."""
    checks = [issue((t.strip(F.col(s)) != "") & (t.strip(F.coalesce(F.col(z), F.lit(""))) == ""), z, "required_pair") for s, z in pairs]
    checks += [issue(t.any_of(F.col(z), rules.REFUSALS), z, "refusal") for _, z in pairs]
    if long_pair:
        checks.append(issue(too_short(*map(F.col, long_pair)), long_pair[1], "short"))
    return issues(df, key, checks)


def too_short(source: Column, target: Column) -> Column:
    a, b = F.length(t.strip(source)), F.length(t.strip(target))
    return (b > 0) & (a >= rules.LONG_SOURCE) & (b < rules.SHORT_TRANSLATION) & (b / a < rules.SHORT_RATIO)


def record_issues(records: DataFrame) -> DataFrame:
    """The invariants of records."""
    c = F.col
    blank = [issue(F.coalesce(t.strip(c(k)), F.lit("")) == "", k, "blank") for k in ("paper_id", "title", "venue", "source", "source_path")]
    return issues(records, "paper_id", [
        *blank,
        issue(~F.coalesce(c("primary_research_object").isin(*rules.RESEARCH_OBJECTS), F.lit(False)), "primary_research_object", "out of the domain"),
        issue(~F.coalesce(F.forall("candidate_preference_labels", lambda x: x.isin(*rules.PREFERENCE_LABELS)), F.lit(False)), "candidate_preference_labels", "out of the domain"),
        issue(~F.coalesce(t.strip(c("candidate_negative_tier")).isin(*rules.TIERS), F.lit(False)), "candidate_negative_tier", "out of the domain"),
    ])


def annotation_issues(annotations: DataFrame, one_label: bool = False) -> DataFrame:
    """The invariants of annotations; ``one_label`` adds that a positive needs exactly one label."""
    c = F.col
    checks = [
        *[issue(F.coalesce(t.strip(c(k)), F.lit("")) == "", k, "blank") for k in ("paper_id", "labeler_id")],
        issue(~F.coalesce(c("primary_research_object").isin(*rules.RESEARCH_OBJECTS), F.lit(False)), "primary_research_object", "out of the domain"),
        issue(F.size("preference_labels") > 1, "preference_labels", "more than one"),
        issue(~F.coalesce(F.forall("preference_labels", lambda x: x.isin(*rules.PREFERENCE_LABELS)), F.lit(False)), "preference_labels", "out of the domain"),
        issue(~F.coalesce(t.strip(c("negative_tier")).isin(*rules.TIERS), F.lit(False)), "negative_tier", "out of the domain"),
        issue(~F.coalesce(c("review_status").isin(*rules.REVIEW_STATUSES), F.lit(False)), "review_status", "out of the domain"),
    ]
    if one_label:
        checks.append(issue((c("negative_tier") == "positive") & (F.size("preference_labels") != 1), "preference_labels", "positive_requires_one_label"))
    return issues(annotations, "paper_id", checks)


def cleaned_annotations(df: DataFrame) -> DataFrame:
    """What an annotation's constructor does: strips, dedupes, and clears the labels of negatives."""
    tier = t.strip(F.col("negative_tier"))
    spans = F.transform_values(F.coalesce("evidence_spans", F.from_json(F.lit("{}"), "map<string,array<string>>")), lambda k, v: t.clean_list(v))
    put = {
        "paper_id": t.strip(F.col("paper_id")), "labeler_id": t.strip(F.col("labeler_id")), "negative_tier": tier, "evidence_spans": spans,
        "preference_labels": F.when(tier == "negative", F.array().cast("array<string>")).otherwise(t.clean_list(F.col("preference_labels"))),
    }
    return df.select(*[put.get(c, F.coalesce(F.col(c), F.lit(""))).alias(c) for c in schemas.ANNOTATIONS.fieldNames()])


def fk_violations(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return rows.select(key).distinct().join(parents.select(key), key, "left_anti")
