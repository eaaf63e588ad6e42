"""Scores and labels by contained terms: projections over one haystack column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text as t
from ..functions.automaton import Found, Terms


def terms_of(*given) -> Terms:
    """All terms of score rules, label terms and object rules, looked for at once."""
    lists: list[Sequence[str]] = []
    for x in given:
        if isinstance(x, rules.TermScore):
            lists += [x.strong, x.context, x.exclude, *(terms for terms, _ in x.bonuses)]
        elif isinstance(x, rules.GroupScore):
            lists += [x.phrases, x.exclude, *(t for g in x.groups for t in (g.terms, g.gate)), *(t for every, some, _ in x.together for t in (every, some))]
        elif isinstance(x, Mapping):
            lists += list(x.values())
        else:
            lists += [words.split() for _, words in x]
    return Terms(*lists)


#: Every term of the library's own rules.
TERMS = terms_of(rules.ACCELERATION, rules.SCHEDULING, rules.LABEL_TERMS, rules.OBJECT_RULES)


def haystack(with_keywords: bool = True) -> Column:
    """The lower-cased searchable text of a paper row."""
    lists = ["keywords", "tags"] if with_keywords else ["tags"]
    return F.lower(F.concat_ws(" ", "title", "abstract", "primary_area", "topic", *[F.array_join(c, " ") for c in lists]))


def term_score(h: Column | Found, rule: rules.TermScore = rules.ACCELERATION) -> Column:
    strong, context, exclude = rule.weights
    score = t.hits(h, rule.strong) * strong + t.hits(h, rule.context) * context + t.hits(h, rule.exclude) * exclude
    for terms, points in rule.bonuses:
        score = score + t.any_of(h, terms).cast("int") * points
    return score


def matched_terms(h: Column | Found, rule: rules.TermScore = rules.ACCELERATION) -> Column:
    return t.matched(h, (*rule.strong, *rule.context))


def _counts(h: Column | Found, g: rules.Group) -> Column:
    found = t.any_of(h, g.terms)
    return found & (t.hits(h, g.gate) >= g.at_least) if g.at_least else found


def group_score(h: Column | Found, rule: rules.GroupScore = rules.SCHEDULING) -> Column:
    score = t.hits(h, rule.exclude) * rule.exclude_weight + t.hits(h, rule.phrases) * rule.phrase_weight
    for g in rule.groups:
        score = score + F.when(_counts(h, g), t.hits(h, g.terms) + g.weight).otherwise(0)
    for every, some, points in rule.together:
        score = score + (t.all_of(h, every) & t.any_of(h, some)).cast("int") * points
    return score


def matched_groups(h: Column | Found, rule: rules.GroupScore = rules.SCHEDULING) -> Column:
    names = F.array_compact(F.array(*[F.when(_counts(h, g), F.lit(g.name)) for g in rule.groups])) if rule.groups else F.array().cast("array<string>")
    return F.array_distinct(F.concat(t.matched(h, rule.phrases), names))


def label_scores(h: Column | Found, terms: Mapping[str, Sequence[str]] = rules.LABEL_TERMS, extra: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Two points a contained term of each label, and a label's extra column."""
    return {label: t.hits(h, words) * 2 + ((extra or {}).get(label, F.lit(0))) for label, words in terms.items()}


def best_label(scores: Mapping[str, Column]) -> Column:
    """The label of the highest score, the first of equals; the empty string if none is above 0."""
    best = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    out = F.when(best <= 0, F.lit(""))
    for label, score in scores.items():
        out = out.when(score == best, F.lit(label))
    return out


def research_object(h: Column | Found, object_rules=rules.OBJECT_RULES, default: str = rules.DEFAULT_OBJECT) -> Column:
    """The rule with most contained words, the first of equals."""
    scores = {label: t.hits(h, words.split()) for label, words in object_rules}
    found = best_label(scores)
    return F.when(found == "", F.lit(default)).otherwise(found)


def classify(papers: DataFrame) -> DataFrame:
    """Candidates with their object, label, tier and scores."""
    with_bits = papers.withColumn("_h", TERMS.bits(haystack())).withColumn("_b", TERMS.bits(haystack(with_keywords=False)))
    hay = TERMS.on("_h")
    scored = with_bits.select(
        "*", term_score(hay).alias("score"), matched_terms(hay).alias("matched_terms"), group_score(hay).alias("scheduling_score"),
        matched_groups(hay).alias("matched_groups"), research_object(TERMS.on("_b")).alias("primary_research_object"),
    )
    label = best_label(label_scores(hay, extra={rules.SCHEDULING_LABEL: F.col("scheduling_score")}))
    scored = scored.withColumn("_label", label)
    return scored.select(
        *papers.columns, "score", "matched_terms", "scheduling_score", "matched_groups", "primary_research_object",
        F.when(F.col("_label") != "", F.array("_label")).otherwise(F.array().cast("array<string>")).alias("candidate_preference_labels"),
        F.when(F.col("_label") != "", "positive").otherwise("negative").alias("candidate_negative_tier"),
    )


#: The note texts below are fixed values: stored notes are searched by them.
def general_note(score: Column, terms: Column) -> Column:
    return F.concat(F.lit("自动关键词筛选得分="), score.cast("string"), F.lit("；命中="), F.array_join(F.slice(terms, 1, 8), ", "))


def scheduling_note(score: Column, groups: Column) -> Column:
    return F.concat(F.lit("调度专项得分="), score.cast("string"), F.lit("；命中组="), F.array_join(groups, ", "))


def join_notes(*parts: Column) -> Column:
    return F.concat_ws("；", *[t.blank_to_null(p) for p in parts])


def batch_note(notes: Column, batch: str, score: Column) -> Column:
    return join_notes(notes, F.lit(f"augment_batch={batch}"), F.concat(F.lit("augment_score="), score.cast("string")))


def evidence(abstract: Column, labels: Column, tier: Column) -> Column:
    """label -> [first sentence], and the key negative for a negative tier; empty without a sentence."""
    sentence = t.first_sentence(abstract)
    keys = F.concat(labels, F.when(tier == "negative", F.array(F.lit("negative"))).otherwise(F.array().cast("array<string>")))
    entries = F.transform(keys, lambda k: F.struct(k, F.array(sentence)))
    return F.when(sentence == "", F.from_json(F.lit("{}"), "map<string,array<string>>")).otherwise(F.map_from_entries(entries))


def candidates(classified: DataFrame, note: Column) -> DataFrame:
    """Candidate rows in the records schema."""
    keep = F.when(F.size("keywords") > 0, F.col("keywords")).otherwise(F.col("tags"))
    return classified.select(
        "paper_id", "title", F.lit("").alias("title_zh"), "abstract", F.lit("").alias("abstract_zh"), "authors", "venue", "year", "source", "source_path",
        "primary_research_object", "candidate_preference_labels", "candidate_negative_tier", t.clean_list(keep).alias("keywords"), note.alias("notes"), "score",
    )


def build_records(cands: DataFrame) -> DataFrame:
    """Records whose final annotation is the candidate's."""
    labels, tier = F.col("candidate_preference_labels"), F.col("candidate_negative_tier")
    return cands.select(
        "*", F.col("primary_research_object").alias("final_primary_research_object"),
        F.when(tier == "negative", F.array().cast("array<string>")).otherwise(labels).alias("final_preference_labels"), tier.alias("final_negative_tier"),
        F.array(F.lit("candidate_seed"), F.lit("human_reviewer")).alias("final_labeler_ids"), F.lit("final").alias("final_review_status"),
        evidence(F.col("abstract"), labels, tier).alias("final_evidence_spans"),
    )
