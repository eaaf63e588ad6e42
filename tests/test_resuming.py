"""Resumable runs, commits of several writers, raw-line validation, batch predictors, settings."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from curatrix import schemas
from curatrix.functions import rules, text as t
from curatrix.operators import browse, models, reports, validation
from curatrix.plans import config, workflows as w
from curatrix.sources import files
from curatrix.sources.files import SnapshotRoot


@pytest.fixture()
def root(spark, tmp_path):
    return SnapshotRoot(spark, str(tmp_path / "root"))


def records(spark, ids, **kw):
    row = lambda i: {**{f.name: [] if f.dataType.typeName() == "array" else 2025 if f.name == "year" else "x" for f in schemas.RECORDS}, "paper_id": i, "title": f"title {i}", "title_zh": "", "abstract": f"abstract {i}", "abstract_zh": "", "primary_research_object": "LLM", "candidate_negative_tier": "positive", **kw}
    return spark.createDataFrame([tuple(row(i)[f] for f in schemas.RECORDS.fieldNames()) for i in ids], schemas.RECORDS)


def annotations(spark, ids, who="ai", tier="negative"):
    return spark.createDataFrame([(i, who, "LLM", [], tier, {}, "", "pending") for i in ids], schemas.ANNOTATIONS)


def test_casefold(spark):
    letters = [chr(c) for c in range(1, 0x1FFFF) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    got = spark.createDataFrame([(x,) for x in [*letters, "Straße", "STRASSE ΟΔΟΣ", "ﬁn ı I"]], "x string").select("x", t.casefold(F.col("x")).alias("y")).collect()
    assert [r.x for r in got if r.y != r.x.casefold()] == []


def test_two_writers_and_unchanged_tables(spark, root):
    root.commit({"records": records(spark, ["a"]), "annotations_ai": annotations(spark, ["a"])})
    path = root.path("annotations_ai")
    began = root.versions()[-1]
    root.commit({"records": records(spark, ["a", "b"])}, began=began)
    assert root.path("annotations_ai") == path  # named again, not copied
    with pytest.raises(files.SinkError):
        root.commit({"records": records(spark, ["z"])}, began=began)
    assert {r.paper_id for r in w.load(root)["records"].collect()} == {"a", "b"}
    assert {r.paper_id for r in root.read("records", schemas.RECORDS, version=began).collect()} == {"a"}


def test_write_text_replaces_in_one_step(spark, tmp_path):
    path = str(tmp_path / "x" / "CURRENT")
    for word in ("one", "two"):
        files.write_text(spark, path, word)
        assert files.read_text(spark, path) == word
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["CURRENT"]


def test_validate_names_lines(spark, root):
    root.commit({"records": records(spark, ["a"], title_zh="译", abstract_zh="译")}, {"schema.json": schemas.schema_payload(), "stats.json": {"n": 1}})
    messages = lambda: {(i["path"].split(":")[0].split(".")[0], i["message"]) for i in w.validate(root)["issues"]}
    assert messages() == {(x, "the file is missing") for x in ("annotations_ai", "annotations_human", "merged", "conflicts")}
    none = annotations(spark, [])
    root.commit({"annotations_ai": none, "annotations_human": none, "merged": none, "conflicts": spark.createDataFrame([], schemas.CONFLICTS)})
    assert w.validate(root)["ok"]
    good = json.loads(records(spark, ["b"], title_zh="译", abstract_zh="译").toJSON().first())
    bad = ["{", "", "[]", json.dumps(good), json.dumps({k: v for k, v in good.items() if k != "notes"} | {"paper_id": "c", "title": "other", "more": 1}), json.dumps(good | {"paper_id": "d", "title": "third", "year": "2025"}), json.dumps(good | {"paper_id": "e"})]
    folder = root.path("records")
    with open(f"{folder}/zz.json", "w", encoding="utf-8") as f:
        f.write("\n".join(bad) + "\n")
    found = w.validate(root)
    named = {(i["path"], i["message"]) for i in found["issues"]}
    assert {("records:zz.json:1.$", "not JSON"), ("records:zz.json:3.$", "not an object"), ("records:zz.json:5.$", "missing: notes"), ("records:zz.json:5.$", "extra: more"), ("records:zz.json:6.year", "not integer")} <= named
    assert any(m == "repeated fingerprint" for _, m in named) and found["file_counts"]["records"] == 7
    assert w.validate(root, listed=1, keep=f"{root.root}/found")["n_issues"] == found["n_issues"] == spark.read.parquet(f"{root.root}/found").count()


def test_conflicts_are_validated(spark):
    one = ("a", "codex", "LLM", [], "negative", {}, "", "pending")
    rows = [("a", ["preference_labels"], one, one, None), ("b", [], one, None, None)]
    got = {(r.paper_id, r.path, r.message) for r in validation.conflict_issues(spark.createDataFrame(rows, schemas.CONFLICTS)).collect()}
    assert got == {("b", "conflicting_fields", "empty"), ("b", "human_annotation", "missing"), ("b", "codex_annotation", "of another id")}


def _translator(fail):
    def factory():
        def model(row):
            if row["paper_id"] in fail:
                raise ValueError("no")
            return {"translation": "译文 " + row["paper_id"]}

        return model

    return factory


def test_patches_resume(spark, root, tmp_path):
    root.commit({"records": records(spark, ["a", "b", "c", "d"])})
    at = str(tmp_path / "patches")
    first = w.translate(root, _translator({"c"}), "title", "title_zh", at, limit=3, batch=2)
    assert {r.paper_id for r in first.collect()} == {"a", "b"}
    assert all(r.title_zh == "" for r in w.load(root)["records"].collect())
    again = w.translate(root, _translator(set()), "title", "title_zh", at, batch=2, apply=True)
    assert {r.paper_id for r in again.collect()} == {"c", "d"}
    assert {r.paper_id: r.title_zh for r in w.load(root)["records"].collect()} == {"a": "", "b": "", "c": "译文 c", "d": "译文 d"}
    assert {r.paper_id for r in files.scan_patches(spark, at).collect()} == {"a", "b", "c", "d"}
    assert w.translate(root, _translator(set()), "title", "title_zh", at).count() == 0
    log = spark.read.json(f"{root.root}/audit").filter("event_type = 'translate_title'")
    want = [("a", 0, True), ("b", 0, True), ("c", 0, False), ("c", 0, True), ("c", 1, False), ("c", 2, False), ("d", 0, True)]
    assert sorted((r.paper_id, r.attempt, r.success) for r in log.collect()) == want


def _labeler(marks, broken):
    def factory():
        import os

        def model(row):
            if row["paper_id"] == broken:
                raise KeyError("the worker dies")
            open(os.path.join(marks, row["paper_id"] + f".{os.getpid()}.{row['attempt']}.{os.urandom(3).hex()}"), "w").close()
            return {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative", "evidence_spans": {}, "notes": ""}

        return model

    return factory


def test_annotation_goes_on_after_a_failure(spark, root, tmp_path):
    root.commit({"records": records(spark, list("abcdef"))})
    marks = tmp_path / "marks"
    marks.mkdir()
    with pytest.raises(Exception):  # noqa: B017
        w.annotate(root, _labeler(str(marks), "e"), "ai", batch=2)
    assert w.load(root)["annotations_ai"].count() == 0
    done = sorted(p.name[0] for p in marks.iterdir())
    assert {"a", "b", "c", "d"} <= set(done)
    assert w.annotate(root, _labeler(str(marks), None), "ai", batch=2).count() == 0
    assert w.load(root)["annotations_ai"].count() == 6
    asked = [p.name[0] for p in marks.iterdir()]
    assert all(asked.count(x) == 1 for x in "abcd")  # kept from the first run
    log = spark.read.json(f"{root.root}/audit")
    assert sorted(r.paper_id for r in log.collect()) == list("abcdef") and log.select("request_id").distinct().count() == 6  # once a call that was kept


def test_the_later_of_two_writers_fails(spark, root):
    """Whoever began at an older version loses nothing of the other's: its commit fails, and its kept calls serve the next run."""
    root.commit({"records": records(spark, ["a", "b"])})

    def meanwhile(*args, **kw):
        out = run_kept(*args, **kw)
        root.commit({"annotations_human": annotations(spark, ["a"], "human")})
        return out

    run_kept, w.run_kept = w.run_kept, meanwhile
    try:
        with pytest.raises(files.SinkError, match="has changed"):
            w.annotate(root, _labeler_of("negative"), "ai")
    finally:
        w.run_kept = run_kept
    t = w.load(root)
    assert t["annotations_ai"].count() == 0 and t["annotations_human"].count() == 1
    w.annotate(root, _labeler_of(None), "ai")  # would fail if it asked
    t = w.load(root)
    assert t["annotations_ai"].count() == 2 and t["annotations_human"].count() == 1


def _labeler_of(tier):
    def factory():
        def model(row):
            if tier is None:
                raise KeyError("asked")
            return {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": tier, "evidence_spans": {}, "notes": ""}

        return model

    return factory


def test_calls_are_in_flight_together_and_in_order(spark):
    """Five calls at a time from one task, rows in their order, and no more than that."""
    ids = [f"{i:03d}" for i in range(40)]
    rows = spark.createDataFrame([(i,) for i in ids], "paper_id string").coalesce(1)

    def factory():
        import threading
        import time

        lock, now, most = threading.Lock(), [0], [0]

        def model(row):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.02 + 0.002 * (int(row["paper_id"]) % 7))
            with lock:
                now[0] -= 1
            return {"most": most[0]}

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = models.run_model(rows, factory, "most int").select("paper_id", "most").collect()
        wide = models.run_model(rows, factory, "most int", concurrency=10).select(F.spark_partition_id().alias("p"), "most").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.paper_id for r in got] == ids and max(r.most for r in got) == 5
    assert len({r.p for r in wide}) == 2 and max(r.most for r in wide) == 5


def test_audit_entries(spark):
    """An entry a call: prompt, answer, usage, error."""
    rows = spark.createDataFrame([("a", "T", {"k": ["v"]}), ("b", "bad", None)], "paper_id string, title string, m map<string,array<string>>")

    def factory():
        good = json.dumps({"primary_research_object": "Vision", "preference_labels": [], "negative_tier": "negative"})
        return models.annotator(lambda prompt: models.Answer("no JSON" if "bad" in prompt else good, provider="p", model="m", prompt_tokens=3, total_tokens=5))()

    got = {r.paper_id: r for r in models.run_model(rows, factory, "primary_research_object string").collect()}
    assert got["a"].primary_research_object == "计算机视觉" and got["a"].m == {"k": ["v"]} and len(got["a"].calls) == 1
    c = got["a"].calls[0]
    assert (c.success, c.error, c.provider, c.model, c.prompt_tokens, c.completion_tokens, c.total_tokens, c.attempt) == (True, None, "p", "m", 3, None, 5, 0) and "T" in c.prompt and c.response_chars == len(c.response)
    assert [(x.attempt, x.success, x.response) for x in got["b"].calls] == [(0, False, "no JSON"), (1, False, "no JSON")] and got["b"].attempts == 2 and got["b"].calls[0].error


def test_arbitration(spark, root):
    labels = rules.PREFERENCE_LABELS
    one = lambda who, i, k: (i, who, "LLM", [labels[k]], "positive", {"general": [who]}, "", "pending")
    ids = ["a", "b", "c", "d"]
    root.commit({
        "records": records(spark, ids), "annotations_ai": spark.createDataFrame([one("ai", i, 0) for i in ids], schemas.ANNOTATIONS),
        "annotations_human": spark.createDataFrame([one("hu", i, 1) for i in ids], schemas.ANNOTATIONS),
    })
    w.refresh_merge(root)
    choose = lambda *rows: spark.createDataFrame(list(rows), schemas.CONFLICTS["codex_annotation"].dataType.simpleString().join(["paper_id string, choice string, custom ", ""]))
    for bad in ([("z", "codex", None)], [("a", "both", None)], [("a", "custom", None)], [("a", "codex", None), ("a", "human", None)]):
        with pytest.raises(ValueError):
            w.arbitrate(root, choose(*bad))
    assert w.arbitrate(root, choose(("a", "codex", None), ("b", "human", None), ("c", "custom", one("me", "c", 2)))) == {"conflicts": 4, "open": 1, "codex": 1, "human": 1, "custom": 1}
    got = {r.paper_id: r.preference_labels for r in w.load(root)["merged"].collect()}
    assert got == {"a": [labels[0]], "b": [labels[1]], "c": [labels[2]]}


def test_choices_by_alias_and_refusals():
    answer = lambda **kw: json.dumps({"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "positive"} | kw)
    for said, want in (("Vision", "计算机视觉"), ("search engine", "检索 / 推荐 / 搜索"), ("VLM system paper", "多模态 / VLM"), ("reinforcement agents", "强化学习 / 序列决策"), ("a dataset", "评测 / Benchmark / 数据集"), ("LLM 推理", "LLM")):
        assert models.parse_annotation(answer(primary_research_object=said))["primary_research_object"] == want
    a, b = rules.PREFERENCE_LABELS[:2]
    assert models.parse_annotation(answer(preference_labels=[a, f"{a}（主）", "?", " "]))["preference_labels"] == [a]
    assert models.parse_annotation(answer(preference_labels=[a, b], negative_tier="it is negative"))["preference_labels"] == []
    for bad in ({"preference_labels": [a, b]}, {"preference_labels": a}, {"primary_research_object": "cooking"}, {"negative_tier": "maybe"}):
        with pytest.raises(ValueError):
            models.parse_annotation(answer(**bad))
    spans = models.parse_annotation(answer(evidence_spans=[{"label": a, "text": " x "}, {"label": "odd", "text": "y"}, {"label": a, "text": "x"}, {"text": ""}, 3]))["evidence_spans"]
    assert spans == {a: ["x"], "general": ["y"]} and models.parse_annotation(answer(evidence_spans={"negative": ["n", "n "], b: "z"}))["evidence_spans"] == {"negative": ["n"], b: ["z"]}


def test_rows_to_add_are_checked(spark):
    from curatrix.operators import dedupe

    old = records(spark, ["a", "b"])
    dedupe.check_new(records(spark, ["c", "d"]), old)
    for bad in (records(spark, ["a"]), records(spark, ["c"]).union(records(spark, ["c"])), records(spark, ["c"], title="Same").union(records(spark, ["d"], title="same ", abstract="abstract c")), records(spark, ["c"], title="title a", abstract="abstract a")):
        with pytest.raises(ValueError, match="exist"):
            dedupe.check_new(bad, old)


@pytest.fixture()
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            ids = [r["request_id"] for r in body["requests"]]
            if any(i.startswith("p3:") for i in ids):
                self.send_error(500, "broken")
                return
            answers = [{"request_id": i, "prediction": {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative", "evidence_spans": {}, "notes": ""}, "model_info": {"algorithm_version": "1"}} for i in ids]
            if any(i.startswith("p5:") for i in ids):
                answers[0]["truth"] = 1
            out = json.dumps({"responses": answers}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_batches_over_http(spark, root, server):
    ids = [f"p{i}" for i in range(7)]
    root.commit({"records": records(spark, ids), "merged": annotations(spark, ids, "merged")})
    got = w.evaluate_by_batches(root, models.http_predictor(server), batch=2)
    assert (got["errors"], got["request_errors"], got["protocol_errors"], got["counts"]["total"]) == (4, 2, 2, 3)
    with pytest.raises(Exception, match="broken"):
        w.evaluate_by_batches(root, models.http_predictor(server), batch=2, fail_fast=True)
    assert w.evaluate_by_batches(root, models.http_predictor("http://127.0.0.1:9"), batch=4) == {"errors": 7, "request_errors": 7}


def test_prompts_escalate_and_back_ends_are_named():
    asked = []

    def ask(text):
        asked.append(text)
        if len(asked) < 2:
            return "cannot say"
        return json.dumps({"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative"})

    model = models.annotator(ask)()
    with pytest.raises(ValueError):
        model({"attempt": 0, "title": "T", "abstract": "a\nb"})
    assert model({"attempt": 1, "title": "T", "abstract": "a\nb"})["negative_tier"] == "negative"
    assert asked[0].startswith(models.ANNOTATE_ASKS[0]) and asked[1].startswith(models.ANNOTATE_ASKS[1]) and "a b" in asked[1]
    translate = models.translator(lambda text: "译文")()
    assert translate({"attempt": 0, "source_text": " "}) == {"translation": ""} and translate({"attempt": 2, "source_text": "x"}) == {"translation": "译文"}

    def broken(text):
        raise RuntimeError("down")

    with pytest.raises(models.Unretried):
        models.translator(broken)()({"attempt": 0, "source_text": "x"})
    models.register("mine")(lambda **settings: models.annotator(ask))
    assert models.backend("mine", key="k")() is not None
    with pytest.raises(ValueError, match="unknown"):
        models.backend("other")


def test_release_captions_and_settings(spark, root, tmp_path):
    root.commit({"records": records(spark, ["a", "b"]), "merged": annotations(spark, ["a"], "merged")})
    got = w.release_report(root)
    assert got["total_records"] == 2 and got["unresolved"] == 1 and not got["ok"] and got["objects"] == {"LLM": 2}
    counted = reports.release(spark.createDataFrame([("a", "v"), ("a", "v")], "id string, v string"), "id", F.col("v"), F.lit("o"), F.array(F.lit("l")), F.lit("negative"), F.lit("final"), ("l",))
    assert {tuple(r) for r in counted.collect()} == {("total", "", 2), ("venue", "v", 2), ("object", "o", 2), ("duplicate_ids", "a", 2), ("positive", "l", 2), ("negative", "l", 2)}
    one = spark.createDataFrame([("test", None)], "split string, status string")
    assert one.select(browse.caption("split", F.col("split")), browse.caption("split", F.lit("own")), browse.caption("status", F.lit("conflict"))).first()[:] == ("测试集", "own", "有冲突")
    p = tmp_path / "private.yaml"
    p.write_text("# keys\napi_key: 'a: b'\nconcurrency: 7 # some\n")
    held = config.read_settings(spark, str(p))
    assert held == {"api_key": "a: b", "concurrency": "7"} and config.resolve("concurrency", None, {}, held) == 7 and config.read_settings(spark, str(tmp_path / "none")) == {}
    assert rules.PREFERENCE_LABELS
