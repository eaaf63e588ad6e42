"""Merge of two annotators' labels, conflicts and arbitration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

FIELDS = ("primary_research_object", "preference_labels", "negative_tier")


class MergeError(ValueError):
    """An annotated id has no record, or only one annotation."""


def conflicting_fields(ai: str, human: str) -> Column:
    a, h = F.col(ai), F.col(human)
    return F.array_compact(F.array(
        F.when(a["primary_research_object"] != h["primary_research_object"], F.lit(FIELDS[0])),
        F.when(F.array_sort(a["preference_labels"]) != F.array_sort(h["preference_labels"]), F.lit(FIELDS[1])),
        F.when(a["negative_tier"] != h["negative_tier"], F.lit(FIELDS[2])),
    ))


def _as_struct(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col("paper_id"), F.struct(*[F.col(c) for c in df.columns]).alias(name))


def routed(records: DataFrame, ai: DataFrame, human: DataFrame, arbitrations: DataFrame | None = None) -> DataFrame:
    """paper_id, record, ai, human, arbiter, fields, route, problem: one row an annotated id.

    Routes: direct (a negative candidate or AI tier: the human's labels hold), agree,
    conflict_open, conflict_resolved. ``problem`` names what is missing, or is null.
    """
    pair = _as_struct(ai, "ai").join(_as_struct(human, "human"), "paper_id", "full")
    pair = pair.join(_as_struct(records, "record"), "paper_id", "left")
    if arbitrations is not None:
        pair = pair.join(_as_struct(arbitrations, "arbiter"), "paper_id", "left")
    else:
        pair = pair.withColumn("arbiter", F.lit(None).cast(pair.schema["human"].dataType))
    problem = F.when(F.col("record").isNull(), "no_record").when(F.col("ai").isNull() | F.col("human").isNull(), "one_annotation")
    direct = (F.col("record")["candidate_negative_tier"] == "negative") | (F.col("ai")["negative_tier"] == "negative")
    out = pair.withColumn("problem", problem).withColumn("fields", conflicting_fields("ai", "human"))
    route = F.when(F.col("problem").isNotNull(), None).when(direct, "direct").when(F.size("fields") == 0, "agree").when(F.col("arbiter").isNull(), "conflict_open").otherwise("conflict_resolved")
    return out.withColumn("route", route)


def merge(
    records: DataFrame, ai: DataFrame, human: DataFrame, arbitrations: DataFrame | None = None, strict: bool = True, written: Callable[[DataFrame], DataFrame] = lambda df: df
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records with final columns, merged annotations, conflicts). ``strict`` raises ``MergeError`` on any problem.

    Annotations meet only what decides of their records; records, with their texts, are
    joined once, at the end. ``written`` may keep the routes, from which all three are made.
    """
    rows = written(routed(records.select("paper_id", "candidate_negative_tier"), ai, human, arbitrations).drop("record"))
    if strict and (bad := rows.filter("problem IS NOT NULL").select("paper_id", "problem").head(5)):
        raise MergeError("; ".join(f"{r.paper_id}: {r.problem}" for r in bad))
    good = rows.filter("problem IS NULL")
    human_, ai_, arb = F.col("human"), F.col("ai"), F.col("arbiter")
    both = F.array_distinct(F.array(ai_["labeler_id"], human_["labeler_id"]))
    merged_human = human_.withField("labeler_id", F.lit("merged")).withField("review_status", F.lit("final"))
    chosen = F.when(F.col("route") == "conflict_resolved", arb).otherwise(human_)
    overlay = good.select(
        F.col("paper_id").alias("_id"), chosen.alias("c"), F.when(F.col("route") == "conflict_open", "conflict").otherwise("final").alias("_status"),
        F.when(F.col("route") == "conflict_resolved", F.array_distinct(F.concat(both, F.array(arb["labeler_id"])))).otherwise(both).alias("_labelers"),
    )
    plain = [c for c in records.columns if not c.startswith("final_")]
    c = F.col("c")
    final = records.select(*plain).join(overlay, F.col("paper_id") == F.col("_id"), "left").select(
        *[F.coalesce(t.blank_to_null(c["notes"]), F.col("notes")).alias("notes") if x == "notes" else F.col(x) for x in plain],
        c["primary_research_object"].alias("final_primary_research_object"),
        F.when(c["negative_tier"] == "negative", F.array().cast("array<string>")).otherwise(c["preference_labels"]).alias("final_preference_labels"),
        c["negative_tier"].alias("final_negative_tier"), F.col("_labelers").alias("final_labeler_ids"), F.col("_status").alias("final_review_status"),
        c["evidence_spans"].alias("final_evidence_spans"),
    )
    merged = good.filter(F.col("route") != "conflict_open").select(F.when(F.col("route") == "conflict_resolved", arb).otherwise(merged_human).alias("m")).select("m.*")
    conflicts = good.filter(F.col("route").startswith("conflict")).select(
        "paper_id", F.col("fields").alias("conflicting_fields"), ai_.alias("codex_annotation"), human_.alias("human_annotation"), arb.alias("resolved_annotation")
    )
    return final, merged, conflicts


def resolved(final: str, candidate: str) -> Column:
    """The final value unless it is blank, else the candidate's."""
    return F.coalesce(t.blank_to_null(F.col(final)), F.col(candidate))


def by_precedence(key: str, **tables: DataFrame) -> DataFrame:
    """key, seed_source: the first of the named tables that has the id."""
    out = None
    for rank, (name, df) in enumerate(tables.items()):
        one = df.select(F.col(key), F.lit(rank).alias("_r"), F.lit(name).alias("_n"))
        out = one if out is None else out.union(one)
    return out.groupBy(key).agg(F.min_by("_n", "_r").alias("seed_source"))


#: What an arbiter can choose.
CHOICES = ("codex", "human", "custom")


def choice_of() -> Column:
    """Which side a resolved conflict took: codex or human where the payload is the same, else custom; null while it is open."""
    plain = ("primary_research_object", "preference_labels", "negative_tier", "notes")
    payload = lambda c: F.struct(*[F.col(c)[k].alias(k) for k in plain], F.to_json(F.array_sort(F.map_entries(F.col(c)["evidence_spans"]))).alias("spans"))
    same = lambda c: payload("resolved_annotation").eqNullSafe(payload(c))
    side = F.when(same("codex_annotation"), "codex").when(same("human_annotation"), "human").otherwise("custom")
    return F.when(F.col("resolved_annotation").isNotNull(), side)


def arbitrate(conflicts: DataFrame, choices: DataFrame) -> DataFrame:
    """Annotations by an arbiter: ``choices`` has paper_id, choice (codex, human, custom) and custom (an annotation)."""
    won = conflicts.join(choices, "paper_id").select(
        F.when(F.col("choice") == "codex", F.col("codex_annotation")).when(F.col("choice") == "human", F.col("human_annotation")).otherwise(F.col("custom")).alias("w")
    )
    return won.select(F.col("w").withField("labeler_id", F.lit("arbiter")).withField("review_status", F.lit("final")).alias("w")).select("w.*")
