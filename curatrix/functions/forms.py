"""URL-encoded forms as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(c: Column) -> Column:
    """Percent-encoded UTF-8, blanks as +; letters, digits and ``_.-~`` stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unquoted(c: Column) -> Column:
    """The text of a percent-encoded one; what is wrongly encoded stays as it is."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def encode_form(fields: Mapping[str, Column]) -> Column:
    """``name=value`` pairs joined by &, in the order given; a null value's pair is left out."""
    return F.concat_ws("&", *[F.concat(quoted(F.lit(name)), F.lit("="), quoted(value)) for name, value in fields.items()])


def parse_form(c: Column) -> Column:
    """map<string, array<string>>: each name's values in their order. Pairs without = or without a value are left out; null is no pairs."""
    pairs = F.transform(
        F.filter(F.split(F.coalesce(c, F.lit("")), "&"), lambda p: F.instr(p, "=") > 0),
        lambda p: F.struct(unquoted(F.substring_index(p, "=", 1)).alias("k"), unquoted(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v")),
    )
    held = F.filter(pairs, lambda x: x["v"] != "")
    names = F.array_distinct(F.transform(held, lambda x: x["k"]))
    return F.map_from_entries(F.transform(names, lambda k: F.struct(k, F.transform(F.filter(held, lambda x: x["k"] == k), lambda x: x["v"]))))
