"""The command line: evaluation over HTTP, settings and selections, parameters of the model commands; facets in one pass."""

import http.server
import json
import sys
import threading
import types

import pytest
from pyspark.sql import functions as F

from curatrix import schemas
from curatrix.operators import models, reports
from curatrix.plans import cli, workflows as w
from curatrix.sources import files, predictions
from curatrix.sources.files import SnapshotRoot
from test_resuming import annotations, records


@pytest.fixture()
def root(spark, tmp_path):
    root = SnapshotRoot(spark, str(tmp_path / "root"))
    ids = [f"p{i}" for i in range(7)]
    root.commit({"records": records(spark, ids), "merged": annotations(spark, ids, "merged")})
    return root


class Service:
    """A prediction service on a local port; ``answer`` maps (ids, number of calls for them) to a status and a body."""

    def __init__(self, answer):
        self.calls, lock = [], threading.Lock()

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(handler):  # noqa: N805
                body = json.loads(handler.rfile.read(int(handler.headers["Content-Length"])))
                ids = tuple(r["request_id"] for r in body["requests"])
                with lock:
                    self.calls.append((handler.path, ids, body))
                    n = sum(c[1] == ids for c in self.calls)
                status, out = answer(ids, n)
                handler.send_response(status)
                handler.end_headers()
                handler.wfile.write(out if isinstance(out, bytes) else json.dumps(out).encode())

            def log_message(handler, *args):  # noqa: N805
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


def good(ids, n=1):
    return 200, {"responses": [{"request_id": i, "prediction": {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative", "evidence_spans": {"general": ["x"]}, "notes": ""}, "model_info": {"algorithm_version": "1"}} for i in ids]}


@pytest.fixture()
def service():
    made = []

    def make(answer=good):
        made.append(Service(answer))
        return made[-1]

    yield make
    for s in made:
        s.server.shutdown()


def run(capsys, *args):
    code = cli.main(list(args))
    return code, json.loads(capsys.readouterr().out)


def test_evaluate_over_http(root, service, capsys, tmp_path):
    s, out = service(), str(tmp_path / "out")
    code, got = run(capsys, "evaluate", "--root", root.root, "--base-url", s.url, "--batch-size", "3", "--timeout-seconds", "5", "--output-dir", out)
    assert code == 0 and got["ok"] and got["report"]["counts"]["total"] == 7 and (got["report"]["request_errors"], got["report"]["protocol_errors"]) == (0, 0)
    assert [len(ids) for _, ids, _ in s.calls] == [3, 3, 1] and {p for p, _, _ in s.calls} == {"/v1/evaluation/annotate"}
    assert [i for _, ids, _ in s.calls for i in ids] == [f"benchmark:p{i}:{i + 1}" for i in range(7)]
    paper = s.calls[0][2]["requests"][0]["paper"]
    assert set(paper) == set(predictions.PAPER) and paper["title"] == "title p0"
    assert files.read_json(root.spark, f"{out}/report.json")["counts"]["total"] == 7 and "Rows: 7" in files.read_text(root.spark, f"{out}/summary.md") and files.exists(root.spark, f"{out}/stdout.txt")
    code, got = run(capsys, "evaluate", "--root", root.root, "--base-url", s.url, "--limit", "2", "--sample-seed", "7")
    assert code == 0 and got["report"]["counts"]["total"] == 2


def test_evaluate_counts_failed_batches(root, service, capsys):
    def answer(ids, n):
        if "benchmark:p0:1" in ids:
            return 500, {}
        if "benchmark:p2:3" in ids:
            return 200, b"no JSON"
        if "benchmark:p4:5" in ids:
            return good(ids[:1])
        return good(ids)

    s = service(answer)
    code, got = run(capsys, "evaluate", "--root", root.root, "--base-url", s.url, "--batch-size", "2")
    assert code == 1 and not got["ok"] and (got["report"]["request_errors"], got["report"]["protocol_errors"], got["report"]["counts"]["total"]) == (2, 4, 1)
    with pytest.raises(Exception, match="batch 0"):
        cli.main(["evaluate", "--root", root.root, "--base-url", s.url, "--batch-size", "2", "--fail-fast"])
    with pytest.raises(ValueError, match="batch"):
        w.evaluate_over_http(root, s.url, batch=0)


def test_source_asks_again(spark, root, service):
    """A request that fails is asked again, an answer that breaks the protocol is not; every batch is a call of its own."""
    s = service(lambda ids, n: (503, {}) if n < 3 else good(ids))
    asked, _ = w._asked(w.load(root), 0, 1, 2)
    requests = predictions.written_requests(asked, f"{root.root}/requests", 2)
    got = predictions.predictions(spark, requests, s.url, attempts=3).collect()
    assert len(got) == 7 and all(r.success and r.attempts == 3 and r.evidence_spans == {"general": ["x"]} for r in got) and len(s.calls) == 12
    bad = service(lambda ids, n: (200, {"responses": 1}))
    got = predictions.predictions(spark, requests, bad.url, attempts=3).collect()
    assert {(r.error_kind, r.attempts) for r in got} == {("protocol", 1)} and len(bad.calls) == 4
    assert predictions.predictions(spark, requests, bad.url).rdd.getNumPartitions() == len([1 for _ in (root.spark.read.parquet(requests).inputFiles())])
    with pytest.raises(Exception, match="base_url"):
        spark.read.format("predictions").load().collect()


def test_records_have_to_be_there(spark, root, service):
    root.commit({"merged": annotations(spark, ["p0", "lost"], "merged")})
    with pytest.raises(ValueError, match="lost"):
        w.evaluate_over_http(root, service().url)


def test_back_ends_by_argument_environment_selection(root, capsys, tmp_path, monkeypatch):
    seen = []

    def plugin(name):
        def make(**settings):
            seen.append((name, settings))

            def factory():
                return lambda row: {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative", "evidence_spans": {}, "notes": ""}

            return factory

        return make

    module = types.ModuleType("my_back_ends")
    monkeypatch.setitem(sys.modules, "my_back_ends", module)
    for name in ("one", "two", "three"):
        monkeypatch.setitem(models.BACKENDS, name, plugin(name))
    selection, settings = str(tmp_path / "backend.json"), tmp_path / "private.yaml"
    settings.write_text("api_key: secret\nmodel: m1\nconcurrency: 2\n")
    monkeypatch.setenv("CURATRIX_BACKEND", "one")
    code, got = run(capsys, "select-backend", "--root", root.root, "--selection", selection, "--seed", "4")
    assert code == 0 and (got["selected_backend"], got["seed"], got["source"]) == ("one", 4, "cli")
    common = ["annotate", "--root", root.root, "--plugin", "my_back_ends", "--selection", selection, "--settings", str(settings), "--rebuild-all"]
    assert run(capsys, *common, "--backend", "three")[0] == 0 and seen[-1] == ("three", {"api_key": "secret", "model": "m1"})
    monkeypatch.setenv("CURATRIX_BACKEND", "two")
    monkeypatch.setenv("CURATRIX_MODEL", "m2")
    args = cli.parser().parse_args(common)
    cli.model_of(args, root.spark)
    assert seen[-1] == ("two", {"api_key": "secret", "model": "m2"})
    monkeypatch.delenv("CURATRIX_BACKEND")
    cli.model_of(args, root.spark)
    assert seen[-1][0] == "one"
    with pytest.raises(ValueError, match="unknown back end"):
        cli.model_of(cli.parser().parse_args(["annotate", "--root", "r"]), root.spark)
    assert w.load(root)["annotations_ai"].count() == 7


def test_arbitrate_command(spark, root, capsys, tmp_path):
    p = tmp_path / "choices.json"
    p.write_text('{"paper_id": "p0", "choice": "codex"}\n')
    with pytest.raises(ValueError, match="p0: no conflict"):
        cli.main(["arbitrate", "--root", root.root, "--input", str(p)])
    code, got = run(capsys, "release", "--root", root.root, "--keep", str(tmp_path / "repeated"))
    assert (code, got["n_duplicate_ids"], got["duplicate_ids"]) == (0, 0, []) and spark.read.parquet(str(tmp_path / "repeated")).count() == 0


def test_parameters_reach_the_workflows(root, capsys, monkeypatch):
    seen = {}
    monkeypatch.setitem(sys.modules, "my_models", types.SimpleNamespace(factory="F"))
    for name in ("rebalance", "augment"):
        monkeypatch.setattr(w, name, lambda *a, name=name, **kw: seen.setdefault(name, (a[1:], kw)) and {"ok": True})
    common = ["--root", root.root, "--source", "src", "--model", "my_models:factory", "--workers", "3", "--venue", "ICLR:2026"]
    assert run(capsys, "rebalance", *common, "--target", "0.4", "--batch-size", "20", "--seed", "9", "--max-new-records", "5")[0] == 0
    assert run(capsys, "augment", *common, "--target", "70", "--max-reviewed", "12", "--minimum-score", "6", "--batch-tag", "b")[0] == 0
    assert seen["rebalance"] == (("src", [("iclr", 2026)], "F", "ai"), {"target": 0.4, "batch": 20, "seed": 9, "max_new": 5, "concurrency": 3})
    assert seen["augment"] == (("src", "F", "b", [("iclr", 2026)]), {"target": 70, "minimum": 6, "max_reviewed": 12, "labeler": "ai", "concurrency": 3})


def test_facets_in_one_aggregate(spark):
    rows = [("a", "x", ["l", "m", "l"]), ("b", "x", ["l"]), ("a", "y", []), (None, "x", None), ("a", None, ["m"]), ("a", "x", ["l", None])]
    df = spark.createDataFrame(rows, "s string, t string, labels array<string>")
    filters = {"s": lambda r: r[0] == "a", "t": lambda r: r[1] == "x", "labels": lambda r: r[2] is not None and "l" in r[2]}
    got = reports.facets(df, {"s": F.col("s") == "a", "t": F.col("t") == "x", "labels": F.array_contains("labels", "l")}, {"s": F.col("s"), "t": F.col("t"), "labels": F.col("labels"), "all": F.lit("n")}, {"s": ("a", "zz"), "t": ("q",)})
    want = {("s", "a"): 0, ("s", "zz"): 0, ("t", "q"): 0}
    for r in rows:
        for name, values in (("s", [r[0]]), ("t", [r[1]]), ("labels", set(r[2] or ())), ("all", ["n"])):
            if all(f(r) for k, f in filters.items() if k != name):
                for v in values:
                    if v is not None:
                        want[name, v] = want.get((name, v), 0) + 1
    assert {(r.facet, r.value): r.n for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Join" not in plan
    assert schemas.RECORDS.fieldNames()


def test_local_ci(spark, root, tmp_path, capsys):
    """Tests run in a process of their own, and only behind the schema gate; their return code is the command's."""
    tests = tmp_path / "own_tests"
    tests.mkdir()
    (tests / "test_it.py").write_text("def test_it():\n    assert 1 == 1\n")
    got = w.local_ci(root, str(tests))
    assert not got["ok"] and got["steps"]["unit_tests"]["returncode"] is None and "skipped" in got["steps"]["unit_tests"]["stderr"]
    none = annotations(spark, [])
    root.commit(
        {"records": records(spark, ["a"], title_zh="译", abstract_zh="译"), "annotations_ai": none, "annotations_human": none, "merged": none, "conflicts": spark.createDataFrame([], schemas.CONFLICTS)},
        {"schema.json": schemas.schema_payload(), "stats.json": {"n": 1}},
    )
    code, got = run(capsys, "ci", "--root", root.root, "--tests", str(tests))
    assert code == 0 and got["ok"] and "1 passed" in got["steps"]["unit_tests"]["stdout"]
    (tests / "test_it.py").write_text("def test_it():\n    assert 1 == 2\n")
    code, got = run(capsys, "ci", "--root", root.root, "--tests", str(tests))
    assert code == 1 and got["steps"]["unit_tests"]["returncode"] == 1
