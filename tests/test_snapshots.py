"""Upserts by bucket and statistics that follow them."""

import random

import pytest

from curatrix import schemas
from curatrix.functions import rules
from curatrix.plans import workflows as w
from curatrix.sources import files
from curatrix.sources.files import SnapshotRoot
from test_resuming import annotations, records


def test_an_upsert_writes_its_buckets(spark, tmp_path):
    root = SnapshotRoot(spark, str(tmp_path / "root"))
    ids = [f"p{i:03d}" for i in range(200)]
    root.commit({"records": records(spark, ids)})
    first = root.commit({}, upserts={"records": records(spark, ["p000"], notes="new")})  # from one folder to buckets
    assert len(root.paths("records")) > 1 and root.read("records", schemas.RECORDS).count() == 200
    before = set(root.paths("records"))
    root.commit({}, upserts={"records": records(spark, ["p001"], notes="newer")}, began=first)
    after = set(root.paths("records"))
    assert len(after - before) == len(before - after) == 1  # one bucket written, the others named again
    got = {r.paper_id: r.notes for r in root.read("records", schemas.RECORDS).collect()}
    assert len(got) == 200 and got["p000"] == "new" and got["p001"] == "newer" and got["p002"] == "x"
    assert {r.paper_id: r.notes for r in root.read("records", schemas.RECORDS, version=first).collect()}["p001"] == "x"
    last = root.commit({}, upserts={"records": records(spark, ["q1", "q2"])})
    assert root.read("records", schemas.RECORDS).count() == 202 and root.replaced("records", records(spark, ["p000", "zz"]), "paper_id", last).count() == 1
    with pytest.raises(files.SinkError, match="repeated"):
        root.commit({}, upserts={"records": records(spark, ["a", "a"])})
    with pytest.raises(files.SinkError, match="has changed"):
        root.commit({}, upserts={"records": records(spark, ["a"])}, began=first)
    with pytest.raises(files.SourceError, match="buckets"):
        root.path("records")
    root.commit({}, upserts={"annotations_ai": annotations(spark, ["p1"])})  # a table that was not there
    assert root.read("annotations_ai", schemas.ANNOTATIONS).count() == 1
    assert w.validate(root)["file_counts"]["records"] == 202


def test_statistics_follow_upserts(spark, tmp_path):
    """Random upserts into all layers: the document kept is the one that a recount makes."""
    r, root = random.Random(4), SnapshotRoot(spark, str(tmp_path / "root"))
    ids = [f"p{i}" for i in range(25)]
    tiers = lambda n: [r.choice(rules.TIERS) for _ in range(n)]

    def record_rows(some):
        base = records(spark, some).collect()
        rows = [x.asDict() | {"primary_research_object": r.choice(rules.RESEARCH_OBJECTS[:3]), "candidate_negative_tier": t} for x, t in zip(base, tiers(len(some)), strict=True)]
        return spark.createDataFrame([tuple(x[f] for f in schemas.RECORDS.fieldNames()) for x in rows], schemas.RECORDS)

    def annotation_rows(some):
        return spark.createDataFrame([(i, "x", "LLM", r.sample(rules.PREFERENCE_LABELS, r.randrange(3)), t, {}, "", "final") for i, t in zip(some, tiers(len(some)), strict=True)], schemas.ANNOTATIONS)

    for n in range(6):
        t = w.load(root)
        changes = {name: (record_rows if name == w.REC else annotation_rows)(r.sample(ids, r.randrange(1, 9))) for name in r.sample([w.REC, w.AI, w.HUMAN, w.MERGED], 2)}
        w.commit_rows(root, t, changes)
        if n % 2:
            assert root.read_document("stats.json") == w.stats(w.load(root))
    assert root.read_document("stats.json")["total_records"] > 0
