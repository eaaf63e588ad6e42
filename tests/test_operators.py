"""Operators on cases that the test tables do not have."""

import json
import random

import pytest
from pyspark.sql import functions as F

from curatrix import schemas
from curatrix.functions import rules, text as t
from curatrix.operators import blocked, dedupe, graph, ingest, merge, metrics, models, scoring, selection, splits, validation
from curatrix.plans import cli


def one(spark, value, c):
    return spark.createDataFrame([(value,)], "v string").select(c(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("value, c, want", [
    ("  　a b\t\n", t.strip, "a b"),
    (" Hello,   World! ", dedupe.normalize, "hello,   world".replace("   ", " ")),
    ("《Ab》。", dedupe.normalize, "ab"),
    ("a；b|c; ;d", t.split_multi, ["a", "b", "c", "d"]),
    ("a, b ,c", t.split_multi, ["a", "b", "c"]),
    ('["x, y", "z"]', t.split_multi, ["x, y", "z"]),
    ("Attention: Is All (You) Need?", t.slugify, "attention-is-all-you-need"),
    ("!!", t.slugify, "paper"),
    ("First one. Second", t.first_sentence, "First one"),
    ("a=1； augment_batch= b7 ;c", lambda c: t.key_value(c, "augment_batch"), "b7"),
    ("augment_batch=", lambda c: t.key_value(c, "augment_batch"), None),
    ("", ingest.is_accepted, True), ("Withdrawn poster", ingest.is_accepted, False), ("Oral", ingest.is_accepted, True), ("other", ingest.is_accepted, False), (None, ingest.is_accepted, True),
])
def test_text(spark, value, c, want):
    assert one(spark, value, c) == want


def test_dedupe_ci_keeps_first_spelling(spark):
    df = spark.createDataFrame([(["Ab", "aB", "c", "C", "d"],)], "v array<string>")
    assert df.select(t.dedupe_ci(F.col("v"))).first()[0] == ["Ab", "c", "d"]


PAPER = "title string, abstract string, primary_area string, topic string, keywords array<string>, tags array<string>"


def test_worked_example(spark):
    h = "continuous batching for language model serving improves latency of a large language model runtime with serving systems"
    df = spark.createDataFrame([(h,)], "h string").select(scoring.group_score(F.col("h")).alias("s"), scoring.matched_groups(F.col("h")).alias("g"), scoring.term_score(F.col("h")).alias("t"), scoring.research_object(F.col("h")).alias("o"))
    r = df.first()
    assert (r.s, r.g, r.t, r.o) == (8, ["llm_serving"], 22, "LLM")


def test_a_word_alone_makes_a_positive(spark):
    rows = [("x", "inference of things", "", "", [], [])]
    got = scoring.classify(spark.createDataFrame(rows, PAPER)).first()
    assert got.candidate_preference_labels == [rules.SCHEDULING_LABEL] and got.candidate_negative_tier == "positive"


def test_gates(spark):
    score = lambda h: spark.createDataFrame([(h,)], "h string").select(scoring.group_score(F.col("h"))).first()[0]
    assert score("heterogeneous gpus") == 0
    assert score("heterogeneous gpus prefill decode") == 7
    assert score("expert routing") == 2
    assert score("expert routing straggler") == 8


def sequential(rows):
    ids, fps, out = set(), set(), {}
    for o, i, f in rows:
        if i in ids:
            out[o] = "duplicate_id"
        elif f in fps:
            out[o] = "duplicate_fingerprint"
        else:
            out[o] = None
            ids.add(i)
            fps.add(f)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_is_the_walk(spark, seed):
    r = random.Random(seed)
    rows = [(1, "1", "f1"), (2, "2", "f1"), (3, "2", "f2")] if not seed else [(i, f"i{r.randrange(9)}", f"f{r.randrange(9)}") for i in range(30)]
    got = dedupe.greedy(spark.createDataFrame(rows, "ordinal long, paper_id string, fingerprint string"), "ordinal")
    assert {x.ordinal: x.reason for x in got.collect()} == sequential(rows)


def annotation(pid, who, label=None, tier="positive"):
    return (pid, who, "LLM", [label] if label else [], tier, {}, "", "pending")


def record(pid, tier="positive"):
    return (pid, "t", "", "a", "", [], "v", 2025, "s", "p", "LLM", [], tier, [], "old")


def test_merge_routes(spark):
    a, b = rules.PREFERENCE_LABELS[:2]
    rec = spark.createDataFrame([record("agree"), record("open"), record("arb"), record("neg", "negative"), record("none")], schemas.RECORDS)
    ai = spark.createDataFrame([annotation("agree", "ai", a), annotation("open", "ai", a), annotation("arb", "ai", a), annotation("neg", "ai", None, "negative")], schemas.ANNOTATIONS)
    hu = spark.createDataFrame([annotation("agree", "hu", a), annotation("open", "hu", b), annotation("arb", "hu", b), annotation("neg", "hu", b)], schemas.ANNOTATIONS)
    arb = spark.createDataFrame([annotation("arb", "arbiter", b)], schemas.ANNOTATIONS)
    records, merged, conflicts = merge.merge(rec, ai, hu, arb)
    got = {r.paper_id: (r.final_review_status, r.final_labeler_ids, r.notes) for r in records.collect()}
    assert got == {"agree": ("final", ["ai", "hu"], "old"), "neg": ("final", ["ai", "hu"], "old"), "open": ("conflict", ["ai", "hu"], "old"), "arb": ("final", ["ai", "hu", "arbiter"], "old"), "none": (None, None, "old")}
    assert {r.paper_id: r.labeler_id for r in merged.collect()} == {"agree": "merged", "neg": "merged", "arb": "arbiter"}
    assert {r.paper_id: (r.conflicting_fields, r.resolved_annotation is None) for r in conflicts.collect()} == {"open": (["preference_labels"], True), "arb": (["preference_labels"], False)}


def test_merge_refuses_half_pairs(spark):
    rec = spark.createDataFrame([record("a")], schemas.RECORDS)
    ai = spark.createDataFrame([annotation("a", "ai")], schemas.ANNOTATIONS)
    with pytest.raises(merge.MergeError):
        merge.merge(rec, ai, spark.createDataFrame([], schemas.ANNOTATIONS))


def test_split_golden(spark):
    assert spark.range(1).select(splits.hash_ratio(F.lit("0GvEaa9prl"))).first()[0] == 0.11666748367838806


def test_last_split_wins(spark):
    m = spark.createDataFrame([("dev", "a"), ("test", "a"), ("dev", "b")], "split string, paper_id string")
    assert {r.paper_id: r.split for r in splits.manifest_rows(m).collect()} == {"a": "test", "b": "dev"}


@pytest.mark.parametrize("np, nn, quota, want", [(10, 10, 10, (7, 3)), (2, 10, 10, (2, 8)), (10, 1, 10, (9, 1)), (3, 0, 1, (1, 0)), (0, 5, 3, (0, 3))])
def test_quota(spark, np, nn, quota, want):
    rows = [("v", f"p{i}", "positive", i) for i in range(np)] + [("v", f"n{i}", "negative", 100 + i) for i in range(nn)]
    df = spark.createDataFrame(rows, "venue string, paper_id string, tier string, score long")
    got = [r.tier for r in selection.quota_topk(df, ["venue"], quota, selection.score_order()).collect()]
    assert (got.count("positive"), got.count("negative")) == want


def test_numbered_and_next(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"))
    assert [(r.n, r.k) for r in selection.numbered(df, ["k"], "n").orderBy("n").collect()] == [(i + 1, i) for i in range(1000)]
    got = {r.k: r.next_id for r in selection.next_with_wraparound(spark.createDataFrame([(1,), (5,), (9,)], "k long"), "k", "k").collect()}
    assert got == {1: 5, 5: 9, 9: 1}
    assert selection.next_with_wraparound(spark.createDataFrame([(1,)], "k long"), "k", "k").first().next_id is None


def test_rounding_is_on_the_driver():
    from curatrix.operators.reports import python_round

    assert [python_round(x) for x in (1 / 32, 1 / 160, 3 / 20000)] == [0.0312, 0.0063, 0.0001]


def test_evaluation_report(spark):
    a, b = rules.PREFERENCE_LABELS[:2]
    shape = "struct<primary_research_object:string,preference_labels:array<string>,negative_tier:string>"
    row = lambda o, labels, tier: (o, labels, tier)
    rows = [
        (row("LLM", [a], "positive"), row("LLM", [a], "positive")), (row("多模态 / VLM", [b], "positive"), row("LLM", [], "negative")),
        (row("Diffusion / 生成模型", [b], "positive"), row("Diffusion / 生成模型", [b], "positive")), (row("LLM", [], "negative"), row("LLM", [], "negative")),
    ]
    report = metrics.evaluation_report(spark.createDataFrame(rows, f"truth {shape}, prediction {shape}"))
    p = report["positive_negative"]["labels"]["positive"]
    assert (report["positive_negative"]["accuracy"], p["tp"], p["fp"], p["fn"], p["tn"]) == (0.75, 2, 0, 1, 1)
    assert report["labels"]["total"] == 3 and report["labels"]["correct"] == 2
    assert report["objects"]["labels"]["Diffusion"]["f1"] == 1.0 and report["objects"]["labels"]["VLM"]["recall"] == 0.0
    assert metrics.evaluation_report(spark.createDataFrame([], f"truth {shape}, prediction {shape}"))["counts"] == {"total": 0}


def test_types_of_raw_json(spark):
    rows = [(1, '{"year": 2025}'), (2, '{"year": "2025"}'), (3, '{"year": true}'), (4, '{"year": 1.5}'), (5, "{}"), (6, "[1]"), (7, "nope")]
    df = spark.createDataFrame(rows, "k long, raw string")
    assert {r.k for r in validation.type_issues(df, "k", F.col("raw"), {"year": "integer"}).collect()} == {2, 3, 4}
    assert {r.k: r.message for r in validation.json_issues(df, "k", F.col("raw")).collect()} == {6: "not an object", 7: "not JSON"}


def test_constructor_semantics(spark):
    got = validation.cleaned_annotations(spark.createDataFrame([(" p ", "l", "LLM", ["a", "a "], " negative", {"general": [" q ", "q", ""]}, None, "pending")], schemas.ANNOTATIONS)).first()
    assert (got.paper_id, got.preference_labels, got.negative_tier, got.evidence_spans, got.notes) == ("p", [], "negative", {"general": ["q"]}, "")


def test_models_retry_and_report(spark):
    def factory():
        def model(row):
            if row["k"] == 1 and row["attempt"] == 0 or row["k"] == 2:
                raise ValueError("bad")
            return {"y": row["k"] * 10}

        return model

    got = {r.k: (r.y, r.success, r.error, r.attempts) for r in models.run_model(spark.createDataFrame([(0,), (1,), (2,)], "k long"), factory, "y long").collect()}
    assert got == {0: (0, True, None, 1), 1: (10, True, None, 2), 2: (None, False, "bad", 2)}
    with pytest.raises(ValueError):
        models.check_concurrency(11)


def test_answers():
    ok = {"primary_research_object": "llm", "preference_labels": ["模型压缩", "??"], "negative_tier": "positive", "evidence_spans": {"general": ["a", "a"], "zzz": ["b"]}}
    stream = "\n".join(['{"item": {"type": "reasoning", "text": "x"}}', json.dumps({"item": {"type": "agent_message", "text": json.dumps(ok, ensure_ascii=False)}}, ensure_ascii=False)])
    got = models.parse_annotation(stream)
    assert (got["primary_research_object"], got["preference_labels"], got["evidence_spans"]) == ("LLM", ["模型压缩"], {"general": ["a", "b"]})
    assert models.match_choice("", rules.TIERS) == "positive"
    with pytest.raises(ValueError):
        models.parse_annotation('{"a": 1}')
    with pytest.raises(ValueError):
        models.check_translation("x" * 500, "短")
    assert models.check_translation("x", " 好 ") == "好"


def test_predictions(spark):
    base = {"request_id": "p:1", "prediction": {"primary_research_object": "LLM", "preference_labels": [], "negative_tier": "negative"}, "model_info": {"algorithm_version": "v1"}}
    leak = base | {"truth": 1}
    rows = [(json.dumps(base),), (json.dumps(leak),), (json.dumps(base | {"model_info": {}}),), (json.dumps({"request_id": "x"}),)]
    got = [r.problem for r in models.parse_predictions(spark.createDataFrame(rows, "response string").coalesce(1)).collect()]
    assert got == [None, "names truth", "no algorithm version", "no prediction"]


def test_schema_payload_and_venue_argument():
    payload = schemas.schema_payload()
    assert payload["record_fields"]["year"] == "integer" and payload["record_fields"]["candidate_preference_labels"] == "enum[]" and payload["annotation_fields"]["evidence_spans"] == "object"
    assert cli.venue("ICLR:2026") == ("iclr", 2026)
    with pytest.raises(Exception):
        cli.venue("iclr")


def walk(rows):
    """paper_id, fingerprint rows in order: the reason of each."""
    ids, prints, out = set(), set(), {}
    for n, (i, f) in enumerate(rows):
        out[n] = "duplicate_id" if i is not None and i in ids else "duplicate_fingerprint" if f is not None and f in prints else None
        if out[n] is None:
            ids.add(i)
            prints.add(f)
    return out


def greedy_of(spark, rows):
    df = spark.createDataFrame([(n, i, f) for n, (i, f) in enumerate(rows)], "n long, paper_id string, fingerprint string").repartition(3)
    return {r.n: r.reason for r in dedupe.greedy(df, "n").collect()}


def test_greedy_with_nulls_and_hot_keys(spark):
    r = random.Random(3)
    for n, k in ((60, 8), (200, 60), (200, 150)):
        rows = [(r.choice([None, *map(str, range(k))]), r.choice([None, *map(str, range(k))])) for _ in range(n)]
        assert greedy_of(spark, rows) == walk(rows)
    hot = [("same", str(i)) for i in range(100)] + [(str(i), "print") for i in range(100)]
    assert greedy_of(spark, hot) == walk(hot)
    assert greedy_of(spark, [(None, None)] * 3) == {0: None, 1: None, 2: None}
    with pytest.raises(ValueError, match="null"):
        dedupe.greedy(spark.createDataFrame([(None, "a", "b")], "n long, paper_id string, fingerprint string"), "n")


def test_greedy_chain_takes_few_jobs(spark):
    """Each row of the chain hangs on the one before; the rounds are logarithmic in its length."""
    chain = [(str((i + 1) // 2), str(i // 2)) for i in range(20_000)]
    tracker, began = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("greedy-chain", "")
    began = greedy_of(spark, chain)
    jobs = len(tracker.getJobIdsForGroup("greedy-chain"))
    spark.sparkContext.setJobGroup("other", "")
    assert began == walk(chain) and jobs < 120


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(500)] + [(2000, k) for k in range(2001, 2300)] + [(5, None), (None, 6), (7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    for small in (graph.SMALL, 40):  # in one task, and contracted first
        got = {x.node: x.component for x in graph.components(df, small=small).collect()}
        check_components(edges, got)
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def check_components(edges, got):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if None not in (a, b) and a != b:
            parent[root(a)] = root(b)
    assert set(got) == set(parent)
    groups = lambda f: sorted(sorted(x for x in parent if f(x) == k) for k in {f(x) for x in parent})
    assert groups(got.get) == groups(root)


def test_blocked_index(spark, tmp_path):
    """Checked in one join without a shuffle of the index; batches by their keys; additions are appended."""
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("o"), F.when(F.col("id") % 50 != 0, F.col("id").cast("string")).alias("paper_id"), F.concat(F.lit("f"), F.col("id") + 1000).alias("fingerprint"))
    index = blocked.BlockedIndex(spark, str(tmp_path / "index"), 4)
    assert index.label(rows(0, 3), "o").filter("reason IS NOT NULL").count() == 0 and index.blocked(rows(0, 3)) == []
    index.add(rows(0, 100))
    index.add(rows(90, 110))
    assert index.table().count() == 2 * 110 - 3
    more = rows(95, 115).union(spark.createDataFrame([(500, "new", "f1001"), (501, None, None)], "o long, paper_id string, fingerprint string"))
    got = index.label(more, "o")
    assert {r.o: r.reason for r in got.collect()} == {i: "blocked_fingerprint" if i == 100 else "blocked_id" if i < 110 else None for i in range(95, 115)} | {500: "blocked_fingerprint", 501: None}
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet spark_catalog") - 400 : plan.index("FileScan parquet spark_catalog")]
    assert "Bucketed: true" in plan and "Exchange" not in scan
    assert index.blocked(more.filter("o >= 109")) == ["f:f1001", "f:f1109", "i:109"]
    assert index.blocked(spark.createDataFrame([("x", "y"), ("x", "z")], "paper_id string, fingerprint string")) == ["i:x"]
    spark.sql(f"DROP TABLE {index.name}")  # another session finds the files
    assert blocked.BlockedIndex(spark, index.path, 4).table().count() == 217
