"""External models as table functions: injected callables, retries, error and audit columns.

A model is ``Callable[[dict], dict]`` made by a factory on the worker, once a task; it is
called from several threads. Results are written before anything else looks at them, and
skip-existing is an anti-join, so a task that runs again repeats calls but not rows. Every
call leaves one audit entry in its row, so the log is written from what was kept: once a
call, whatever ran again.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources.shared import shipped

MIN_CONCURRENCY, MAX_CONCURRENCY = 1, 10
Model = Callable[[dict], dict]
#: Calls in flight from one task, where nothing else is said.
WINDOW = 5
#: One entry a call.
CALL = (
    "request_id string, logged_at timestamp, attempt int, provider string, model string, prompt string, response string, success boolean, error string, duration_ms long, "
    "response_chars long, prompt_tokens long, completion_tokens long, total_tokens long"
)
_AUDIT = f"success boolean, error string, attempts int, duration_ms long, calls array<struct<{CALL}>>"
_NOTED = ("provider", "model", "prompt", "response", "prompt_tokens", "completion_tokens", "total_tokens")
_call: ContextVar[dict | None] = ContextVar("call", default=None)
#: Factories of model factories by name; settings go to them as keywords.
BACKENDS: dict[str, Callable[..., Callable[[], Model]]] = {}


def register(name: str):
    """Decorator: a function of settings that returns a model factory becomes the back end ``name``."""

    def add(make):
        BACKENDS[name] = make
        return make

    return add


def backend(name: str, **settings) -> Callable[[], Model]:
    if name not in BACKENDS:
        raise ValueError(f"unknown back end {name!r}; known: {', '.join(sorted(BACKENDS))}")
    return BACKENDS[name](**settings)


class RequestError(RuntimeError):
    """A call failed."""


class ProtocolError(ValueError):
    """An answer has the wrong shape."""


def check_concurrency(n: int) -> int:
    if not MIN_CONCURRENCY <= n <= MAX_CONCURRENCY:
        raise ValueError(f"concurrency must be {MIN_CONCURRENCY} to {MAX_CONCURRENCY}")
    return n


@dataclass
class Answer:
    """What a model's client may return in place of a text: its usage goes to the audit log."""

    text: str
    provider: str | None = None
    model: str | None = None
    prompt_tokens: int | None = None
    completion_tokens: int | None = None
    total_tokens: int | None = None


def note(**facts) -> None:
    """Called by a model while it runs: adds provider, model, prompt, response or token counts to its call's audit entry."""
    entry = _call.get()
    if entry is not None:
        entry |= {k: facts[k] for k in _NOTED if k in facts}


def asked(ask: Callable[[str], str | Answer], prompt: str) -> str:
    """The text of an answer; prompt, answer and usage are noted."""
    note(prompt=prompt)
    answer = ask(prompt)
    if isinstance(answer, Answer):
        note(**{k: v for k, v in vars(answer).items() if k != "text"})
        answer = answer.text
    note(response=answer)
    return answer


def _called(model: Model, row: dict, attempts: int) -> tuple[dict, str | None, list[dict]]:
    """The model's output for a row, the last error, and an entry a call."""
    out, error, calls = {}, None, []
    for n in range(attempts):
        entry: dict = {"request_id": str(uuid.uuid4()), "logged_at": datetime.now(timezone.utc), "attempt": n, **dict.fromkeys(_NOTED)}
        calls.append(entry)
        token, began, over = _call.set(entry), time.monotonic(), False
        try:
            out, error, over = model(row | {"attempt": n}), None, True
        except (ValueError, RuntimeError) as e:
            error = str(e) or type(e).__name__
        except Unretried as e:
            error, over = str(e), True
        finally:
            _call.reset(token)
        response = entry["response"]
        entry |= {"success": error is None, "error": error, "duration_ms": int(1000 * (time.monotonic() - began)), "response_chars": None if response is None else len(response)}
        if over:
            break
    return out, error, calls


def run_model(rows: DataFrame, factory: Callable[[], Model], output: str, attempts: int = 2, concurrency: int = 5, partitions: int | None = None) -> DataFrame:
    """``rows`` with the columns of ``output`` (a DDL of fields that the model returns) and success, error, attempts, duration_ms and calls (an audit entry each).

    The model gets the row as a dict, with ``attempt`` from 0; ValueError and
    RuntimeError are retried, and after the last attempt the row has its error and null
    outputs. ``concurrency`` bounds how many calls run at a time in all tasks together, as
    the models' owners ask: tasks have ``WINDOW`` calls in flight, the next one starting
    when any ends, and rows come out in their order. Where there is no such bound,
    ``partitions`` deals the rows into more tasks, each with ``concurrency`` calls in flight.
    """
    check_concurrency(concurrency)
    spark = shipped(rows.sparkSession)
    fields = spark.createDataFrame([], output).schema
    names = fields.fieldNames()
    window = concurrency if partitions else min(concurrency, WINDOW)
    tasks = partitions or concurrency // window
    added = spark.createDataFrame([], f"{', '.join(_ddl(fields.simpleString()[len('struct<') : -1]))}, {_AUDIT}").schema
    schema, arrow = type(added)(rows.schema.fields + added.fields), _arrow_schema(added)

    def finished(batch: pa.RecordBatch, futures: list[Future]) -> pa.RecordBatch:
        found = []
        for f in futures:
            out, error, calls = f.result()
            held = {k: out.get(k) if error is None else None for k in names}
            found.append(held | {"success": error is None, "error": error, "attempts": len(calls), "duration_ms": sum(c["duration_ms"] for c in calls), "calls": calls})
        extra = pa.RecordBatch.from_pylist(found, schema=arrow)
        return pa.RecordBatch.from_arrays([*batch.columns, *extra.columns], names=[*batch.schema.names, *extra.schema.names])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, free, held = factory(), threading.Semaphore(window), deque()
        with ThreadPoolExecutor(window) as pool:
            for batch in batches:
                futures: list[Future] = []
                held.append((batch, futures))
                for row in batch.to_pylist(maps_as_pydicts="strict"):
                    free.acquire()
                    future = pool.submit(_called, model, row, attempts)
                    future.add_done_callback(lambda _: free.release())
                    futures.append(future)
                while len(held) > 1 and (len(held) > 2 or all(f.done() for f in held[0][1])):
                    yield finished(*held.popleft())
            while held:
                yield finished(*held.popleft())

    return rows.repartition(tasks).mapInArrow(call, schema)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _ddl(simple: str) -> list[str]:
    """Fields of a struct's simple string as DDL."""
    out, depth, part = [], 0, ""
    for ch in simple + ",":
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            name, _, kind = part.partition(":")
            out.append(f"`{name}` {kind}")
            part = ""
        else:
            part += ch
    return out


def run_batches(rows: DataFrame, factory: Callable[[], Callable[[list[dict]], list[dict]]], output: str, batch: str = "batch", key: str = "request_id", fail_fast: bool = False) -> DataFrame:
    """key, the columns of ``output``, success, error_kind (request or protocol), error, one row a row; each group of ``batch`` is one call.

    A call gets its rows as dicts in the order of ``key`` and returns an answer for each,
    by key. If it fails, or misses one, its whole batch has the error; with ``fail_fast``
    the job fails.
    """
    fields = rows.sparkSession.createDataFrame([], output).schema
    names = fields.fieldNames()

    def call(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key)
        keys, kind, error, found = part[key].tolist(), None, None, {}
        try:
            found = answers_by_key(factory()(part.drop(columns=[batch]).to_dict("records")), keys, key)
        except ValueError as e:
            kind, error = "protocol", str(e) or type(e).__name__
        except (RuntimeError, OSError) as e:
            kind, error = "request", str(e) or type(e).__name__
        if error and fail_fast:
            raise RuntimeError(f"batch {part[batch].iloc[0]}: {error}")
        return pd.DataFrame([[k, *(None if error else found[k].get(n) for n in names), error is None, kind, error] for k in keys], columns=[key, *names, "success", "error_kind", "error"])

    kinds = dict(rows.dtypes)
    ddl = ", ".join(_ddl(fields.simpleString()[len("struct<") : -1]))
    return rows.groupBy(batch).applyInPandas(call, f"`{key}` {kinds[key]}, {ddl}, success boolean, error_kind string, error string")


def answers_by_key(answers: list[dict], keys: Sequence, key: str = "request_id") -> dict:
    """The answers by key; ProtocolError if there is not just one for each."""
    found = {x.get(key): x for x in answers}
    if len(answers) != len(keys) or set(found) != set(keys):
        raise ProtocolError("answers do not match the requests")
    return found


def http_predictor(base_url: str, timeout: float = 10.0, path: str = "/v1/evaluation/annotate") -> Callable[[], Callable[[list[dict]], list[dict]]]:
    """A factory for ``run_batches``: posts {"requests": [{request_id, paper}]} and reads {"responses": [{request_id, prediction, model_info}]}."""

    def factory():
        from urllib import error, request

        def predict(rows: list[dict]) -> list[dict]:
            body = {"requests": [{"request_id": r["request_id"], "paper": {k: v for k, v in r.items() if k != "request_id"}} for r in rows]}
            post = request.Request(base_url.rstrip("/") + path, json.dumps(body, ensure_ascii=False, default=list).encode(), {"Content-Type": "application/json; charset=utf-8"}, method="POST")
            try:
                with request.urlopen(post, timeout=timeout) as answer:
                    text = answer.read().decode()
            except error.URLError as e:
                raise RequestError(f"{getattr(e, 'code', '')} {e.reason}".strip()) from e
            except UnicodeDecodeError as e:
                raise ProtocolError("the answer is not UTF-8") from e
            return [checked_prediction(x) for x in checked_responses(text)]

        return predict

    return factory


def checked_responses(text: str) -> list[dict]:
    try:
        found = json.loads(text)
    except ValueError as e:
        raise ProtocolError("the answer is not JSON") from e
    if not isinstance(found, dict) or not isinstance(found.get("responses"), list):
        raise ProtocolError("the answer has no list of responses")
    return found["responses"]


def checked_prediction(x) -> dict:
    """One response as a flat row; ProtocolError where fields are missing, or it names the truth."""
    held = x.get("prediction") if isinstance(x, dict) else None
    if not isinstance(held, dict) or not x.get("request_id"):
        raise ProtocolError("a response lacks request_id or prediction")
    if not (x.get("model_info") or {}).get("algorithm_version"):
        raise ProtocolError("a response has no algorithm version")
    if set(FORBIDDEN_KEYS) & {*x, *held}:
        raise ProtocolError("a response names truth")
    return {"request_id": x["request_id"], "algorithm_version": x["model_info"]["algorithm_version"]} | held


#: What is asked on each attempt, the later ones more firmly.
ANNOTATE_ASKS = ("Label this paper. Answer with one JSON object only.", "Label this paper. You must decide: choose the nearest value for each field, and neither ask back nor leave the object empty. Answer with one JSON object only.")
#: How to label, in this library's words.
GUIDE = (
    "Fields: primary_research_object, preference_labels, negative_tier, evidence_spans, notes.",
    "First name the kind of model or system that the work improves, not the means by which it does so.",
    "Then decide whether one of the preference labels is the method that the authors propose and test; gains that merely come along do not count.",
    "A paper that does so is positive and has exactly that one label; any other is negative and has none.",
    "Evidence is quoted from title or abstract under the label that it supports; what suggests a negative is quoted under negative.",
    "The suggested values are weak hints: without evidence in the text they do not hold.",
)
TRANSLATE_ASKS = (
    "Translate the abstract into Chinese. Answer with the translation only.",
    "Translate the whole abstract into Chinese, sentence by sentence. Leave nothing out. Answer with the translation only.",
    "Translate every sentence of the abstract into Chinese, in full, whatever its length. Do not sum up or decline. Answer with the translation only.",
)


def _line(*parts) -> str:
    return " ".join(x for x in (" ".join(str(p or "").split()) for p in parts) if x)


def annotation_prompt(row: Mapping, attempt: int = 0, asks: Sequence[str] = ANNOTATE_ASKS) -> str:
    """One line: what is asked, the guide, the domains, the record, and what was suggested for it."""
    domain = f"primary_research_object: {', '.join(rules.RESEARCH_OBJECTS)}. preference_labels: {', '.join(rules.PREFERENCE_LABELS)}. negative_tier: {', '.join(rules.TIERS)}."
    listed = lambda x: ", ".join(map(str, x)) if isinstance(x, (list, tuple)) else x
    named = (("Title", "title"), ("Abstract", "abstract"), ("Keywords", "keywords"), ("Venue", "venue"), ("Suggested object", "suggested_object"), ("Suggested labels", "suggested_labels"), ("Suggested tier", "suggested_tier"))
    fields = [f"{name}: {listed(row[key])}" for name, key in named if row.get(key)]
    return _line(asks[min(attempt, len(asks) - 1)], *GUIDE, domain, *fields)


def annotator(ask: Callable[[str], str | Answer], asks: Sequence[str] = ANNOTATE_ASKS) -> Callable[[], Model]:
    """A factory for ``run_model`` around ``ask``: the prompt of the attempt, then the row; the answer is parsed."""

    def model(row: dict) -> dict:
        return parse_annotation(asked(ask, annotation_prompt(row, row["attempt"], asks)))

    return lambda: model


def translator(ask: Callable[[str], str | Answer], asks: Sequence[str] = TRANSLATE_ASKS, field: str = "translation") -> Callable[[], Model]:
    """A factory for ``run_model``: blank sources need no call; only unusable answers are asked for again, so failed calls end the row's attempts."""

    def model(row: dict) -> dict:
        source = row.get("source_text") or ""
        if not source.strip():
            return {field: ""}
        try:
            answer = asked(ask, _line(asks[min(row["attempt"], len(asks) - 1)], source))
        except RuntimeError as e:
            raise Unretried(str(e) or type(e).__name__) from e
        return {field: check_translation(source, answer)}

    return lambda: model


class Unretried(Exception):
    """An error that is the row's result at once."""


def missing_only(rows: DataFrame, done: DataFrame, key: str = "paper_id") -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


# parsing of answers


def last_message(text: str) -> str:
    """The text of the last agent message of an event stream, or the last line that is a JSON object, or the text."""
    found = None
    lines = [x for x in text.splitlines() if x.strip()]
    for line in lines:
        try:
            item = json.loads(line).get("item", {})
        except (ValueError, AttributeError):
            continue
        if isinstance(item, dict) and item.get("type") == "agent_message":
            found = item.get("text", "")
    if found is not None:
        return found
    return next((x for x in reversed(lines) if x.lstrip().startswith("{")), text)


def match_choice(value: str, domain: Sequence[str], aliases: Mapping[str, str] | None = None) -> str | None:
    """Exact, then contained either way (so a blank is the first of the domain), then by the first alias that its lower case contains."""
    v = value.strip()
    if v in domain:
        return v
    found = next((d for d in domain if d in v or v in d), None)
    return found or next((d for token, d in (aliases or {}).items() if token in v.lower()), None)


def _tier(value: str) -> str:
    found = next((x for x in rules.TIERS if x in value), None)
    if found is None:
        raise ValueError(f"no such negative_tier: {value}")
    return found


def _labels(value) -> list[str]:
    """The one label of a list, or none: values that match no label are passed over, two labels are refused."""
    if not isinstance(value, list):
        raise ValueError("preference_labels is no list")
    found = list(dict.fromkeys(m for x in value if str(x).strip() and (m := match_choice(str(x), rules.PREFERENCE_LABELS))))
    if len(found) > 1:
        raise ValueError("only one preference label is allowed")
    return found


def _spans(value) -> dict[str, list[str]]:
    """Quotes by label, of a map of lists or a list of {label, text}; a key that matches no label is general."""
    spans: dict[str, list[str]] = {}
    if isinstance(value, dict):
        items = [(k, v if isinstance(v, list) else [v]) for k, v in value.items()]
    else:
        items = [(x.get("label", "general"), [x["text"]]) for x in value if isinstance(x, dict) and str(x.get("text") or "").strip()] if isinstance(value, list) else []
    for key, texts in items:
        key = str(key).strip()
        name = key if key in rules.EVIDENCE_EXTRA_KEYS else match_choice(key, rules.PREFERENCE_LABELS) or rules.EVIDENCE_EXTRA_KEYS[0]
        held = spans.setdefault(name, [])
        held += [x for x in dict.fromkeys(str(x).strip() for x in texts) if x and x not in held]
    return spans


def parse_annotation(text: str) -> dict:
    """An annotation's fields from a model's answer; ValueError where fields are missing or unknown, or several labels are named."""
    payload = json.loads(last_message(text))
    required = {"primary_research_object", "preference_labels", "negative_tier"}
    if not isinstance(payload, dict) or not required <= payload.keys():
        raise ValueError("answer lacks required fields")
    kind = match_choice(str(payload["primary_research_object"]), rules.RESEARCH_OBJECTS, rules.OBJECT_ALIASES)
    if kind is None:
        raise ValueError(f"no such research object: {payload['primary_research_object']}")
    tier = _tier(str(payload["negative_tier"]))
    raw = payload["preference_labels"]
    labels = [] if tier == "negative" and isinstance(raw, list) else _labels(raw)
    return {"primary_research_object": kind, "preference_labels": labels, "negative_tier": tier, "evidence_spans": _spans(payload.get("evidence_spans")), "notes": str(payload.get("notes") or "")}


_CJK = re.compile(r"[一-鿿]")


def check_translation(source: str, target: str) -> str:
    """A translation that can be kept, stripped; ValueError otherwise."""
    out = target.strip()
    if not source.strip():
        return ""
    if out.startswith("```") or not _CJK.search(out) or any(x in out for x in rules.REFUSALS):
        raise ValueError("no usable translation")
    n = len(source.strip())
    if n >= rules.LONG_SOURCE and (len(out) < rules.SHORT_TRANSLATION or len(out) / n < rules.SHORT_RATIO):
        raise ValueError("translation is too short")
    return out


FORBIDDEN_KEYS = ("final_primary_research_object", "final_preference_labels", "final_negative_tier", "truth")


def parse_predictions(answers: DataFrame, raw: str = "response", forbidden: Sequence[str] = FORBIDDEN_KEYS) -> DataFrame:
    """request_id, prediction fields, algorithm_version and problem of JSON responses; a response that names truth is a leak."""
    shape = "request_id string, prediction struct<primary_research_object:string,preference_labels:array<string>,negative_tier:string,evidence_spans:map<string,array<string>>,notes:string>, model_info struct<algorithm_version:string>"
    p = answers.select("*", F.from_json(raw, shape).alias("_p"), F.json_object_keys(raw).alias("_k"), F.json_object_keys(F.get_json_object(raw, "$.prediction")).alias("_pk"))
    leak = F.arrays_overlap(F.concat(F.coalesce("_k", F.array().cast("array<string>")), F.coalesce("_pk", F.array().cast("array<string>"))), F.array(*[F.lit(k) for k in forbidden]))
    problem = (
        F.when(F.col("_p.request_id").isNull() | (F.col("_p.request_id") == ""), "no request_id").when(F.col("_p.prediction").isNull(), "no prediction")
        .when(F.coalesce(F.col("_p.model_info.algorithm_version"), F.lit("")) == "", "no algorithm version").when(leak, "names truth")
    )
    return p.select("_p.request_id", "_p.prediction.*", F.col("_p.model_info.algorithm_version").alias("algorithm_version"), problem.alias("problem"))


def align(truths: DataFrame, predictions: DataFrame, key: str = "request_id") -> DataFrame:
    """truth and prediction structs joined by request id, not by position."""
    t = truths.select(key, F.struct(*[c for c in truths.columns if c != key]).alias("truth"))
    p = predictions.select(key, F.struct(*[c for c in predictions.columns if c != key]).alias("prediction"))
    return t.join(p, key)


def audit_rollup(log: DataFrame, by: Column, failed: Column, duration: Column) -> DataFrame:
    return log.groupBy(by.alias("kind")).agg(F.count("*").alias("calls"), F.count_if(failed).alias("failures"), F.sum(duration).alias("total_duration"), F.max(duration).alias("longest"))
