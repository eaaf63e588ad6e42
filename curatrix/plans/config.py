"""Settings of model back ends, on the driver: an argument comes before the environment, then a file, then the default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..sources import files

DEFAULTS = {"backend": "default", "concurrency": 5, "timeout_seconds": 10, "batch_size": 50}


def resolve(name: str, argument=None, env: Mapping[str, str] | None = None, held: Mapping | None = None, defaults: Mapping = DEFAULTS):
    """One setting; environment names are ``CURATRIX_`` and the name in capitals, and take the default's type."""
    env = os.environ if env is None else env
    found = argument if argument is not None else env.get(f"CURATRIX_{name.upper()}") or (held or {}).get(name) or defaults.get(name)
    kind = type(defaults.get(name))
    return kind(found) if found is not None and kind is not type(None) else found


def read_settings(spark: SparkSession, path: str) -> dict:
    """A private settings file: ``key: value`` lines, and sections of such lines indented below ``key:`` (that part of YAML, with comments, quotes and blank lines); empty if there is none."""
    if not files.exists(spark, path):
        return {}
    found: dict = {}
    section = None
    for number, line in enumerate(files.read_text(spark, path).splitlines(), 1):
        bare = line.strip()
        if not bare or bare.startswith("#") or bare == "---":
            continue
        key, sep, value = bare.partition(":")
        inside = line[:1].isspace()
        if not sep or (inside and section is None):
            raise files.SourceError(f"{path}:{number} is not key: value")
        value = value.strip()
        value = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else "" if value.startswith("#") else value.partition(" #")[0].strip()
        if inside:
            found[section][key.strip()] = value
        elif value:
            found[key.strip()], section = value, None
        else:
            section = key.strip()
            found[section] = {}
    return found


def read_selection(spark: SparkSession, path: str) -> dict:
    """The stored back end selection; empty if there is none."""
    return files.read_json(spark, path) if files.exists(spark, path) else {}


def write_selection(spark: SparkSession, path: str, backend: str, source: str, now: datetime | None = None, **more) -> dict:
    out = {"selected_backend": backend, "updated_at": (now or datetime.now(timezone.utc)).isoformat(), "source": source} | more
    files.write_json(spark, path, out)
    return out


def batch_id(tag: str, now: datetime | None = None) -> str:
    """``yyyymmdd-tag``."""
    return f"{(now or datetime.now()):%Y%m%d}-{tag}"
