"""Explicit schemas of the stored tables, and the wire contract derived from them."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

from .functions import rules

_TEXT, _LIST, _SPANS = StringType(), ArrayType(StringType()), MapType(StringType(), ArrayType(StringType()))


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


RECORDS = _struct(
    paper_id=_TEXT, title=_TEXT, title_zh=_TEXT, abstract=_TEXT, abstract_zh=_TEXT, authors=_LIST, venue=_TEXT, year=IntegerType(), source=_TEXT, source_path=_TEXT,
    primary_research_object=_TEXT, candidate_preference_labels=_LIST, candidate_negative_tier=_TEXT, keywords=_LIST, notes=_TEXT,
)
FINAL = _struct(final_primary_research_object=_TEXT, final_preference_labels=_LIST, final_negative_tier=_TEXT, final_labeler_ids=_LIST, final_review_status=_TEXT, final_evidence_spans=_SPANS)
ANNOTATIONS = _struct(
    paper_id=_TEXT, labeler_id=_TEXT, primary_research_object=_TEXT, preference_labels=_LIST, negative_tier=_TEXT, evidence_spans=_SPANS, notes=_TEXT, review_status=_TEXT
)
CONFLICTS = _struct(paper_id=_TEXT, conflicting_fields=_LIST, codex_annotation=ANNOTATIONS, human_annotation=ANNOTATIONS, resolved_annotation=ANNOTATIONS)
PATCHES = _struct(paper_id=_TEXT, title=_TEXT, title_zh=_TEXT, abstract_zh=_TEXT, model=_TEXT, translated_at=_TEXT)
SPLITS = _struct(split=_TEXT, paper_id=_TEXT)
RAW = _struct(**{k: _TEXT for k in (
    "id title abstract tldr status keywords primary_area topic author author_site aff pdf proceeding project site oa github code openreview".split()
)})

#: Fields that hold values of a closed domain.
ENUMS = {
    "primary_research_object": rules.RESEARCH_OBJECTS, "candidate_preference_labels": rules.PREFERENCE_LABELS, "preference_labels": rules.PREFERENCE_LABELS,
    "candidate_negative_tier": rules.TIERS, "negative_tier": rules.TIERS, "review_status": rules.REVIEW_STATUSES,
}
FILES = {"records": "records.jsonl", "annotations_ai": "annotations-ai.jsonl", "annotations_human": "annotations-human.jsonl", "merged": "merged.jsonl", "conflicts": "conflicts.jsonl", "stats": "stats.json"}


def wire_type(field: StructField) -> str:
    """The contract's name of a field's type."""
    many = isinstance(field.dataType, ArrayType)
    if field.name in ENUMS:
        return "enum[]" if many else "enum"
    if many:
        return "string[]"
    return {"StringType": "string", "IntegerType": "integer", "MapType": "object"}[type(field.dataType).__name__]


def schema_payload(name: str = "labelled-papers", version: str = "2026-04-01", description: str = "") -> dict:
    """The content of ``schema.json``; a root that has its own name and description passes them."""
    return {
        "name": name,
        "version": version,
        "description": description,
        "files": dict(FILES),
        "record_fields": {f.name: wire_type(f) for f in RECORDS},
        "annotation_fields": {f.name: wire_type(f) for f in ANNOTATIONS},
        "annotation_constraints": {"preference_labels_cardinality": "0..1", "positive_requires_exactly_one_preference_label": True},
        "negative_tiers": list(rules.TIERS),
        "preference_labels": list(rules.PREFERENCE_LABELS),
    }
