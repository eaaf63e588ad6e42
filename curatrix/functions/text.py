"""Text helpers as column expressions (white space is Unicode's, plus the four ASCII separators)."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .automaton import Found

WS = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, WS, " ")


@functools.cache
def _fold_exceptions() -> tuple[str, str]:
    """Letters that lower case of upper case folds otherwise than Unicode's case folding does, found by that rule."""
    held = {"ς": "σ"}
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            c = chr(code)
            low, folded = c.upper().lower(), c.casefold()
            if len(low) == len(folded) == 1 and low != folded and c != "ı":
                held[low] = folded
    return "".join(held), "".join(held.values())


def casefold(c: Column) -> Column:
    """Unicode case folding: like lower case, but ß is ss, ligatures fall apart, and final sigma is sigma."""
    (low, folds), dotless, kept, moved = _fold_exceptions(), "ı", "\ue000", "\ue001"
    upper = F.translate(F.upper(F.translate(c, dotless, kept)), kept, moved)  # between the two, or the optimizer takes upper away
    return F.replace(F.translate(F.lower(upper), low + moved, folds + dotless), F.lit("ß"), F.lit("ss"))


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", strip(c))


def first_non_blank(*columns: Column) -> Column:
    """The first column that isn't blank, stripped; else the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in columns], F.lit(""))


def slugify(c: Column, fallback: str = "paper") -> Column:
    s = F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def clean_list(c: Column) -> Column:
    """Stripped, without blanks, first occurrences of each value."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), strip), lambda x: x != ""))


def dedupe_ci(c: Column) -> Column:
    """First spelling of each value, whatever its case."""
    low = F.transform(c, lambda x: F.lower(x))
    return F.filter(c, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def split_multi(c: Column) -> Column:
    """Values of a field that is either text with separators or the JSON text of a list."""
    as_list = F.from_json(c, "array<string>")
    plain = F.translate(c, "；|", ";;")
    parts = F.when(F.contains(plain, F.lit(";")), F.split(plain, ";")).otherwise(F.split(plain, ","))
    values = F.when(F.startswith(F.ltrim(c), F.lit("[")) & as_list.isNotNull(), as_list).otherwise(parts)
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip), lambda x: x != "")


def first_sentence(c: Column) -> Column:
    return strip(F.substring_index(strip(c), ".", 1))


def key_value(c: Column, key: str) -> Column:
    """The value of ``key=value`` among parts separated by ; or its wide form; null if blank."""
    found = strip(F.regexp_extract(c, rf"(?:^|[;；])\s*{key}=([^;；]*)", 1))
    return F.when(found != "", found)


def _terms(terms: Sequence[str]) -> Column:
    """The terms as one constant array: a plan holds a node a list, not a node a term."""
    return F.split(F.lit("\x1f".join(terms)), "\x1f")


def hits(haystack: Column | Found, terms: Sequence[str]) -> Column:
    """How many of the terms the text contains; repeated terms count each time.

    The haystack of this and the next functions is a text, in which each term is looked
    for, or what an automaton has found in it already.
    """
    if isinstance(haystack, Found):
        return haystack.hits(terms)
    return F.size(F.filter(_terms(terms), lambda t: F.contains(haystack, t))) if terms else F.lit(0)


def any_of(haystack: Column | Found, terms: Sequence[str]) -> Column:
    if isinstance(haystack, Found):
        return haystack.any_of(terms)
    return F.exists(_terms(terms), lambda t: F.contains(haystack, t)) if terms else F.lit(False)


def all_of(haystack: Column | Found, terms: Sequence[str]) -> Column:
    if isinstance(haystack, Found):
        return haystack.all_of(terms)
    return F.forall(_terms(terms), lambda t: F.contains(haystack, t)) if terms else F.lit(True)


def matched(haystack: Column | Found, terms: Sequence[str]) -> Column:
    """The terms that the text contains, in their order, each once."""
    if isinstance(haystack, Found):
        return haystack.matched(terms)
    return F.filter(_terms(list(dict.fromkeys(terms))), lambda t: F.contains(haystack, t)) if terms else F.array().cast("array<string>")
