"""Settings and where they come from."""

import http.server
import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curatrix.functions import forms
from curatrix.operators import clients, models
from curatrix.plans import config, workflows as w
from curatrix.sources import files
from curatrix.sources.files import SnapshotRoot


def test_order_of_sources():
    env = {"CURATRIX_CONCURRENCY": "7"}
    assert config.resolve("concurrency", 3, env, {"concurrency": 9}) == 3
    assert config.resolve("concurrency", None, env, {"concurrency": 9}) == 7
    assert config.resolve("concurrency", None, {}, {"concurrency": 9}) == 9
    assert config.resolve("concurrency", None, {}, {}) == 5
    assert config.resolve("other", None, {}, {}) is None


def test_selection_round_trip(spark, tmp_path):
    path = str(tmp_path / "backend.json")
    assert config.read_selection(spark, path) == {}
    config.write_selection(spark, path, "b", "cli", datetime(2026, 1, 2), seed=4)
    assert config.read_selection(spark, path) == {"selected_backend": "b", "updated_at": "2026-01-02T00:00:00", "source": "cli", "seed": 4}
    assert config.batch_id("x", datetime(2026, 1, 2)) == "20260102-x"


def test_forms(spark):
    from urllib.parse import parse_qs, urlencode

    texts = ["", "plain", "a b&c=d", "é中文~*-_.", "100% +", "\n\t"]
    got = spark.createDataFrame([(x, y) for x in texts for y in texts], "x string, y string").select("x", "y", forms.encode_form({"a b": F.col("x"), "c": F.col("y")}).alias("f")).collect()
    assert all(r.f == urlencode({"a b": r.x, "c": r.y}) for r in got)
    read = ["", "a=1&b=2&a=3", "a=&b", "=x&a=b=c", "a%20b=%C3%A9+x&&", "q=100%"]
    got = spark.createDataFrame([(x,) for x in read], "f string").select("f", forms.parse_form(F.col("f")).alias("m")).collect()
    assert all(r.m == parse_qs(r.f) for r in got)


def test_sections_of_settings(spark, tmp_path):
    p = tmp_path / "private.yaml"
    p.write_text("# mine\nconcurrency: 3\nchat:  # a service\n  api_key: 'k: 1'\n\n  model: m # best\nother:\n  model: o\nlast: x\n")
    assert config.read_settings(spark, str(p)) == {"concurrency": "3", "chat": {"api_key": "k: 1", "model": "m"}, "other": {"model": "o"}, "last": "x"}
    p.write_text("  a: b\n")
    with pytest.raises(files.SourceError, match=":1 is not"):
        config.read_settings(spark, str(p))


@pytest.fixture()
def chat_service():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            prompt = body["messages"][-1]["content"]
            if "down" in prompt:
                self.send_error(503, "busy")
                return
            self.send_response(200)
            self.end_headers()
            answer = json.dumps({"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative"})
            usage = {"prompt_tokens": len(prompt), "completion_tokens": 2, "total_tokens": len(prompt) + 2}
            if "odd" in prompt:
                self.wfile.write(b"[]")
            elif body["stream"]:
                for piece in (answer[:10], None, answer[10:]):
                    self.wfile.write(b"data: " + json.dumps({"choices": [{"delta": {"content": piece}}]}).encode() + b"\n\n")
                self.wfile.write(b"data: " + json.dumps({"choices": [], "usage": usage}).encode() + b"\n\ndata: [DONE]\n\n")
            else:
                said = answer if self.headers["Authorization"] == "Bearer k" and body["model"] == "m" else "who?"
                self.wfile.write(json.dumps({"choices": [{"message": {"content": said}}], "usage": usage}).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v3"
    server.shutdown()


def test_chat_client(spark, chat_service):
    for stream in (False, True):
        answer = clients.chat_client(chat_service, "m", "k", stream=stream, system="You label.")("hello")
        assert json.loads(answer.text)["negative_tier"] == "negative" and (answer.prompt_tokens, answer.total_tokens, answer.model) == (5, 7, "m")
    ask = clients.chat_client(chat_service, "m", "k")
    with pytest.raises(models.RequestError, match="503"):
        ask("down")
    with pytest.raises(models.ProtocolError):
        ask("odd")
    with pytest.raises(models.RequestError):
        clients.chat_client("http://127.0.0.1:9", "m")("x")
    rows = spark.createDataFrame([("a", "T"), ("b", "down")], "paper_id string, title string")
    got = {r.paper_id: r for r in models.run_model(rows, models.backend("chat", base_url=chat_service, model="m", api_key="k"), "negative_tier string").collect()}
    assert got["a"].negative_tier == "negative" and got["a"].calls[0].total_tokens == got["a"].calls[0].prompt_tokens + 2 and got["a"].calls[0].prompt.endswith("Title: T")
    assert not got["b"].success and len(got["b"].calls) == 2 and "503" in got["b"].error


def test_dashboard(spark, tmp_path):
    from test_resuming import annotations, records

    root = SnapshotRoot(spark, str(tmp_path / "root"))
    root.commit({"records": records(spark, ["a", "b"]), "merged": annotations(spark, ["a", "zz"], "merged")})
    got = w.dashboard(root)
    assert (got["total_candidates"], got["total_merged_annotations"], got["total_conflicts"], got["pending_split_assignment_count"]) == (2, 2, 0, 1) and got["summary"] == w.stats(w.load(root))
    w.assign_splits(root)
    root.commit({}, {"stats.json": {"kept": 1}})
    got = w.dashboard(root)
    assert got["summary"] == {"kept": 1} and got["pending_split_assignment_count"] == 0 and sum(got["split_counts"].values()) == 1
