"""Workflows on a small benchmark root."""

import json

import pytest

from pyspark.sql import functions as F

from curatrix import schemas
from curatrix.functions import rules
from curatrix.operators import importer
from curatrix.plans import workflows as w
from curatrix.sources import files
from curatrix.sources.files import SnapshotRoot
from curatrix.streaming import incremental

VENUES = {("iclr", 2025): 2, ("icml", 2025): 1}


@pytest.fixture()
def source(tmp_path):
    rows = {
        "iclr/iclr2025": [
            {"id": "i1", "title": "KV Cache Compression for LLM Inference", "abstract": "We compress the kv cache. It serves.", "status": "Poster", "keywords": "kv cache; llm", "author": "A;B"},
            {"id": "i2", "title": "Image Segmentation of Cats", "tldr": "Cats are cut out.", "status": "Spotlight", "keywords": ["vision", "cats"], "author_site": "C, D"},
            {"id": "i3", "title": "Withdrawn", "abstract": "No.", "status": "Withdrawn"},
        ],
        "icml/icml2025": [{"title": "Continuous Batching for Language Model Serving", "abstract": "Request scheduling in LLM serving with low latency.", "status": "Oral", "keywords": "serving;batching"}],
    }
    for name, value in rows.items():
        p = tmp_path / "src" / f"{name}.json"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(json.dumps(value))
    return str(tmp_path / "src")


@pytest.fixture()
def root(spark, tmp_path):
    return SnapshotRoot(spark, str(tmp_path / "root"))


def _factory():
    """Made in a function, so that it goes to workers by value."""

    def factory():
        return model

    def model(row):
        positive = "serving" in row.get("abstract", "").lower()
        return {"primary_research_object": "LLM", "preference_labels": ["系统与调度优化"] if positive else [], "negative_tier": "positive" if positive else "negative", "evidence_spans": {}, "notes": "", "translation": "译文", "abstract_zh": "译文"}

    return factory


factory = _factory()


def test_scan_and_normalize(spark, source):
    from curatrix.operators import ingest

    got = {r.paper_id: r for r in ingest.accepted_papers(files.scan_conference(spark, source, list(VENUES))).collect()}
    assert set(got) == {"i1", "i2", "continuous-batching-for-language-model-serving"}
    assert got["i1"].authors == ["A", "B"] and got["i2"].authors == ["C", "D"] and got["i2"].keywords == ["vision", "cats"] and got["i2"].abstract == "Cats are cut out."
    assert got["i1"].venue == "ICLR 2025" and got["i1"].year == 2025
    with pytest.raises(files.SourceError):
        files.scan_conference(spark, source, [("nips", 2025)])


def test_rebuild_annotate_merge_split_evaluate(root, source):
    root_ = root
    w.rebuild(root_, source, {("iclr", 2025): 2, ("icml", 2025): 1})
    t = w.load(root_)
    ids = {r.paper_id for r in t["records"].collect()}
    assert "continuous-batching-for-language-model-serving" in ids
    assert root_.read_document("stats.json")["total_records"] == len(ids)
    assert w.annotate(root_, factory, "model", rebuild_all=True).count() == 0
    w.refresh_merge(root_)
    first = w.assign_splits(root_)
    assert first["assigned"] == first["eligible"] and w.assign_splits(root_)["assigned"] == 0
    w.export_manifest(root_, f"{root_.root}/manifest.json")
    listed = {tuple(r) for r in files.scan_manifest(root_.spark, f"{root_.root}/manifest.json").collect()}
    assert listed == {tuple(r) for r in root_.read("splits", schemas.SPLITS).collect()} and len(listed) == first["eligible"]
    report = w.evaluate(root_, factory)
    assert report["counts"]["total"] == w.load(root_)["merged"].count() and report["errors"] == 0
    w.write_evaluation(root_, report, f"{root_.root}/report")
    assert files.read_json(root_.spark, f"{root_.root}/report/report.json")["counts"] == report["counts"]
    patches = w.backfill(root_, factory, "abstract", "abstract_zh")
    assert patches.count() == len(ids) and {r.abstract_zh for r in w.load(root_)["records"].collect()} == {"译文"}
    got = w.validate(root_)
    assert not got["ok"] and {i["message"] for i in got["issues"]} == {"required_pair"}


def test_rebalance_and_augment(spark, root, source):
    rec = spark.createDataFrame([("old", "Old", "", "text", "", [], "V 1", 2025, "s", "p", "LLM", [], "positive", [], "")], schemas.RECORDS)
    ann = spark.createDataFrame([("old", "ai", "LLM", [rules.SCHEDULING_LABEL], "positive", {}, "", "pending")], schemas.ANNOTATIONS)
    root.commit({"records": rec, "annotations_ai": ann})
    got = w.augment(root, source, factory, "b1", venues=(("icml", 2025), ("iclr", 2025)), target=1, minimum=6)
    assert got["stop_reason"] == "target_positive_count_reached" and got["added"] == 1
    assert "augment_batch=b1" in w.load(root)["records"].filter("paper_id != 'old'").first().notes
    kept = root.read_document("blocked.json")
    assert kept["version"] == root.version()  # the index follows the commit
    got = w.rebalance(root, source, [("iclr", 2025)], factory, target=0.5, batch=1)
    assert got["stop_reason"] in ("target_ratio_reached", "candidate_pool_exhausted") and got["added"]
    t = w.load(root)
    assert root.read_document("stats.json") == w.stats(t) and root.read_document("blocked.json") == {"path": kept["path"], "version": t.version}
    index = w.blocked_index(root, t)
    assert {r.key[2:] for r in index.table().filter("key LIKE 'i:%'").collect()} == {r.paper_id for r in t["records"].collect()}
    rows = t["records"].limit(1)
    with pytest.raises(ValueError, match="exist"):
        w.add_rows(root, t, index, rows.withColumn("paper_id", F.lit("other")), t["annotations_ai"].limit(0))  # the same text
    root.commit({"conflicts": spark.createDataFrame([], schemas.CONFLICTS)})
    assert w.blocked_index(root, w.load(root)).path != index.path  # of an older version


def payload(tmp_path, records, annotations):
    p = tmp_path / "in.json"
    p.write_text(json.dumps({"source_batch": "b", "records": records, "annotations_ai": annotations}, ensure_ascii=False))
    return str(p)


def a_record(pid, title, **kw):
    return {f.name: [] if f.dataType.typeName() == "array" else 2025 if f.name == "year" else "x" for f in schemas.RECORDS} | {"paper_id": pid, "title": title, "primary_research_object": "LLM", "candidate_negative_tier": "negative"} | kw


def an_annotation(pid):
    return {"paper_id": pid, "labeler_id": "ai", "primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative", "evidence_spans": {}, "notes": "", "review_status": "pending"}


def test_import(root, tmp_path):
    path = payload(tmp_path, [a_record("a", "One"), a_record("b", "Two")], [an_annotation("a")])
    assert w.import_payload(root, path, dry_run=True)["records"] == {"added": 2}
    assert w.load(root)["records"].count() == 0
    w.import_payload(root, path)
    assert w.import_payload(root, path)["records"] == {"unchanged": 2}
    assert w.import_payload(root, payload(tmp_path, [a_record("a", "One", notes="new")], []))["records"] == {"updated": 1}
    for bad in (([a_record("c", "One")], []), ([a_record("c", "Q"), a_record("c", "R")], []), ([a_record("c", "Q"), a_record("d", " q ")], []), ([], [an_annotation("zz")]), ([a_record("c", "Q", primary_research_object="?")], [])):
        with pytest.raises(importer.ImportRejected):
            w.import_payload(root, payload(tmp_path, *bad))


def test_legacy_cleanup(spark, root):
    rec = spark.createDataFrame([(p, p, "", "a", "", [], "v", 2025, "s", "p", "LLM", ["模型压缩"], tier, [], "") for p, tier in (("p1", "hard"), ("p2", "positive"))], schemas.RECORDS)
    ann = lambda who: spark.createDataFrame([("p1", who, "LLM", ["模型压缩"], "in_domain", {}, "", "pending"), ("p2", who, "LLM", ["模型压缩"], "positive", {}, "", "pending")], schemas.ANNOTATIONS)
    root.commit({"records": rec, "annotations_ai": ann("ai"), "annotations_human": ann("human")})
    with pytest.raises(files.SourceError, match="merged, conflicts"):
        w.cleanup_legacy(root)
    old = json.loads(rec.filter("paper_id = 'p1'").toJSON().first()) | {"target_preference_labels": ["x"], "own": {"deep": [1, None, 2.5]}, "score": 7}
    with open(f"{root.path('annotations_human')}/more.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(an_annotation("p3") | {"negative_tier": "easy", "preference_labels": ["模型压缩"], "seen_by": "me"}) + "\n")
    with open(f"{root.path('records')}/more.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(old | {"paper_id": "p3"}, ensure_ascii=False) + "\n" + json.dumps(old | {"paper_id": "p4", "candidate_negative_tier": "odd"}) + "\n")
    root.commit({"merged": ann("m").limit(0), "conflicts": spark.createDataFrame([], schemas.CONFLICTS)})
    with pytest.raises(importer.ImportRejected, match="records:more.json:2: candidate_negative_tier: odd"):
        w.cleanup_legacy(root)
    with open(f"{root.path('records')}/more.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(old | {"paper_id": "p3"}, ensure_ascii=False) + "\n")
    counts = w.cleanup_legacy(root)
    assert (counts["records"], counts["annotations_human"], counts["merged"]) == (3, 3, 2)
    raw = {r["paper_id"]: r for r in map(json.loads, (x.value for x in spark.read.text(root.path("records")).collect()))}
    assert raw["p3"]["own"] == {"deep": [1, None, 2.5]} and raw["p3"]["score"] == 7 and "target_preference_labels" not in raw["p3"] and raw["p3"]["candidate_negative_tier"] == "negative" and raw["p3"]["candidate_preference_labels"] == []
    human = {r["paper_id"]: r for r in map(json.loads, (x.value for x in spark.read.text(root.path("annotations_human")).collect()))}
    assert human["p3"]["seen_by"] == "me" and human["p3"]["negative_tier"] == "negative"
    assert root.read_document("stats.json") == w.stats(w.load(root))
    got = {r.paper_id: (r.negative_tier, r.preference_labels) for r in w.load(root)["merged"].collect()}
    assert got == {"p1": ("negative", []), "p2": ("positive", ["模型压缩"])}


def test_sinks(spark, tmp_path):
    rec = spark.createDataFrame([("b",), ("a",)], "paper_id string")
    files.write_records(rec, str(tmp_path / "r"))
    assert sorted(r.paper_id for r in files.scan_jsonl(spark, str(tmp_path / "r"), rec.schema).collect()) == ["a", "b"]
    with pytest.raises(files.SinkError):
        files.write_records(rec.union(rec), str(tmp_path / "r2"))
    assert files.scan_jsonl(spark, str(tmp_path / "none"), rec.schema).count() == 0
    (tmp_path / "m.json").write_text('{"splits": {"dev": [" a ", "a", ""], "test": ["b"]}}')
    assert {tuple(r) for r in files.scan_manifest(spark, str(tmp_path / "m.json")).collect()} == {("dev", "a"), ("test", "b")}


def _counting(marks):
    def factory():
        import os

        def model(row):
            open(os.path.join(marks, f"{row['paper_id']}.{os.urandom(4).hex()}"), "w").close()
            return {"label": (row["title"] or "none").upper()}

        return model

    return factory


def test_keyed_stream(spark, tmp_path):
    """New and changed rows once each, over restarts and a replayed batch; the sink is not read."""
    src, out, marks = tmp_path / "in", str(tmp_path / "out"), tmp_path / "marks"
    src.mkdir()
    marks.mkdir()
    schema = "paper_id string, title string, updated_at long"

    def run(name, rows, checkpoint=str(tmp_path / "ck")):
        if rows:
            (src / f"{name}.json").write_text("".join(json.dumps(dict(zip(("paper_id", "title", "updated_at"), r, strict=True))) + "\n" for r in rows))
        stream = spark.readStream.schema(schema).json(str(src))
        q = incremental.annotate_changes(stream, _counting(str(marks)), "label string").drop("calls").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
        return sorted((r.paper_id, r.label) for r in spark.read.parquet(out).collect())

    assert run("1", [("a", "x", 1), ("b", "y", 1), ("a", "z", 2), (None, "n", 1)]) == [("a", "Z"), ("b", "Y")]
    assert run("2", [("a", "z", 3), ("b", "w", 3), ("c", None, 3)]) == [("a", "Z"), ("b", "W"), ("b", "Y"), ("c", "NONE")]
    assert len(run("2", [])) == 4
    for name in ("1", ".1.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()  # the last batch is replayed, as after a crash before its commit
    assert len(run("3", [])) == 4
    got = {r.paper_id: r.label for r in incremental.latest(spark.read.parquet(out)).collect()}
    assert got == {"a": "Z", "b": "W", "c": "NONE"}
    asked = [p.name[0] for p in marks.iterdir()]
    assert asked.count("a") == 1  # content that came again was not asked for


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "serving"), ("b", "other")], "paper_id string, abstract string").write.parquet(src)
    stream = spark.readStream.schema("paper_id string, abstract string").parquet(src)
    for _ in range(2):
        q = incremental.annotate_stream(stream, out, factory, "negative_tier string").option("checkpointLocation", str(tmp_path / f"ck{_}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert {(r.paper_id, r.negative_tier) for r in spark.read.parquet(out).collect()} == {("a", "positive"), ("b", "negative")}
    assert spark.read.parquet(out).count() == 2
    assert incremental.assign_stream(spark.read.parquet(src)).count() == 2
    assert incremental.audit_windows(spark.createDataFrame([], "ts timestamp, event_type string, value double")).count() == 0
