"""Command line: ``python -m curatrix.plans.cli COMMAND --root ROOT ...``.

A model is named ``--model module:factory``, or is the back end that ``--backend``, the
environment (``CURATRIX_BACKEND``), the stored selection or the default names, in this
order; modules named by ``--plugin`` register back ends when they are imported. A back
end's settings (api_key, base_url, model) come from the environment or the settings file.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

COMMANDS = ("rebuild", "annotate", "merge", "arbitrate", "backfill", "split", "evaluate", "rebalance", "augment", "import", "validate", "cleanup", "dashboard", "translate", "release", "ci", "select-backend")
#: Errors that are printed; the table named by ``--keep`` has all of them.
LISTED = 100


def venue(text: str) -> tuple[str, int]:
    """``venue:year``."""
    name, sep, year = text.partition(":")
    if not sep or not name.strip() or not year.strip().isdigit():
        raise argparse.ArgumentTypeError(f"{text!r} is not venue:year")
    return name.strip().lower(), int(year)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="curatrix")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--root", required=True)
    p.add_argument("--source")
    p.add_argument("--input", help="an import payload, choices of an arbiter (JSON lines), or a folder of patches")
    p.add_argument("--keep", help="a table for all errors, issues or repeated ids")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--tests", default="tests", help="the folder of tests that ci runs")
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--venue", type=venue, action="append")
    p.add_argument("--target", type=float)
    p.add_argument("--seed", "--sample-seed", type=int)
    p.add_argument("--batch-tag", action="append")
    p.add_argument("--from-column", default="abstract")
    p.add_argument("--to-column", default="abstract_zh")
    m = p.add_argument_group("models")
    m.add_argument("--model", help="module:factory")
    m.add_argument("--backend")
    m.add_argument("--plugin", action="append", default=[], help="a module that registers back ends")
    m.add_argument("--settings", help="the private settings file")
    m.add_argument("--selection", help="the stored back end selection")
    m.add_argument("--labeler", default="ai")
    m.add_argument("--workers", "--concurrency", type=int, dest="concurrency")
    m.add_argument("--checkpoint-interval", type=int, default=1000, help="rows that are kept at a time")
    m.add_argument("--attempts", type=int)
    m.add_argument("--rebuild-all", action="store_true")
    r = p.add_argument_group("rebalance and augment")
    r.add_argument("--max-new-records", type=int)
    r.add_argument("--max-reviewed", type=int)
    r.add_argument("--minimum-score", type=int)
    e = p.add_argument_group("evaluate")
    e.add_argument("--base-url", help="the prediction service")
    e.add_argument("--timeout-seconds", type=float)
    e.add_argument("--batch-size", type=int)
    e.add_argument("--fail-fast", action="store_true")
    e.add_argument("--output-dir")
    return p


def model_of(a: argparse.Namespace, spark):
    """The model factory that the arguments, the environment, the selection or the default name."""
    from ..operators import clients, models  # noqa: F401 (clients are registered)
    from . import config

    for name in a.plugin:
        importlib.import_module(name)
    if a.model:
        module, _, name = a.model.partition(":")
        return getattr(importlib.import_module(module), name)
    chosen = config.read_selection(spark, a.selection) if a.selection else {}
    held = config.read_settings(spark, a.settings) if a.settings else {}
    name = config.resolve("backend", a.backend, held={"backend": chosen.get("selected_backend")})
    own = held.get(name)  # the back end's section comes before the file's own lines
    held |= own if isinstance(own, dict) else {}
    settings = {k: config.resolve(k, held=held) for k in ("api_key", "base_url", "model")}
    return models.backend(name, **{k: v for k, v in settings.items() if v is not None})


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from .. import schemas
    from ..functions import rules
    from ..sources import files
    from ..sources.files import SnapshotRoot
    from . import config
    from . import workflows as w

    spark = SparkSession.builder.appName("curatrix").getOrCreate()
    root = SnapshotRoot(spark, a.root)
    held = config.read_settings(spark, a.settings) if a.settings else {}
    concurrency = config.resolve("concurrency", a.concurrency, held=held)
    named = lambda **kw: {k: v for k, v in kw.items() if v is not None}

    def annotate():
        errors = w.annotate(root, model_of(a, spark), a.labeler, a.rebuild_all, concurrency, a.checkpoint_interval)
        if a.keep:
            errors.write.mode("overwrite").parquet(a.keep)
        return {"errors": errors.count(), "listed": [r.asDict() for r in errors.orderBy("paper_id").limit(LISTED).collect()]}

    def evaluate():
        size = config.resolve("batch_size", a.batch_size, held=held)
        if a.base_url:
            timeout = float(config.resolve("timeout_seconds", a.timeout_seconds, held=held))
            return w.evaluate_over_http(root, a.base_url, a.limit, 42 if a.seed is None else a.seed, size, timeout, a.attempts or 1, a.fail_fast, out=a.output_dir)
        report = w.evaluate(root, model_of(a, spark), a.limit, 42 if a.seed is None else a.seed, size)
        if a.output_dir:
            w.write_evaluation(root, report, a.output_dir)
        return {"ok": not report["errors"], "report": report}

    def rebuild():
        chosen = model_of(a, spark) if a.model or a.backend else None
        return {"version": w.rebuild(root, a.source, dict.fromkeys(a.venue, max(rules.VENUE_QUOTAS.values())) if a.venue else None, chosen)}

    def choices():
        shape = f"paper_id string, choice string, custom {schemas.ANNOTATIONS.simpleString()}"
        return w.arbitrate(root, spark.read.schema(shape).option("mode", "FAILFAST").json(a.input))

    def select():
        return config.write_selection(spark, a.selection or f"{a.root}/backend.json", config.resolve("backend", a.backend), "cli", **named(sample_size=a.limit or None, seed=a.seed, report_path=a.input))

    run = {
        "rebuild": rebuild,
        "annotate": annotate,
        "merge": lambda: {"version": w.refresh_merge(root)},
        "arbitrate": choices,
        "backfill": lambda: {"patches": w.backfill(root, model_of(a, spark), a.from_column, a.to_column, a.limit or None, a.batch_tag, not a.dry_run, concurrency).count()},
        "split": lambda: w.assign_splits(root, **named(seed=a.seed)),
        "evaluate": evaluate,
        "rebalance": lambda: w.rebalance(root, a.source, a.venue or [("iclr", 2026), ("nips", 2025)], model_of(a, spark), a.labeler, **named(target=a.target, batch=a.batch_size, seed=a.seed, max_new=a.max_new_records, concurrency=concurrency)),
        "augment": lambda: w.augment(
            root, a.source, model_of(a, spark), (a.batch_tag or ["batch"])[0], a.venue or rules.AUGMENT_VENUES,
            **named(target=None if a.target is None else int(a.target), minimum=a.minimum_score, chunk=a.batch_size, max_reviewed=a.max_reviewed, labeler=a.labeler, concurrency=concurrency),
        ),
        "import": lambda: w.import_payload(root, a.input, a.dry_run),
        "validate": lambda: w.validate(root, LISTED, a.keep),
        "cleanup": lambda: w.cleanup_legacy(root),
        "translate": lambda: {"patches": w.translate(root, model_of(a, spark), a.from_column, a.to_column, a.input, a.labeler, not a.dry_run, a.limit or None, a.checkpoint_interval, concurrency, a.attempts or 3).count()},
        "dashboard": lambda: w.dashboard(root),
        "release": lambda: w.release_report(root, LISTED, a.keep),
        "ci": lambda: w.local_ci(root, a.tests),
        "select-backend": select,
    }
    try:
        out = run[a.command]()
    except (files.SourceError, files.SinkError) as e:
        out = {"ok": False, "error": str(e)}
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return int(out.get("ok") is False or bool(out.get("errors")))


if __name__ == "__main__":
    sys.exit(main())
