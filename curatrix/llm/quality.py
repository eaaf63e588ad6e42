"""Quality rules: a table of thresholds, compiled into one projection.

Only built-in expressions are used: everything about a document is computed in its own
row, so there is no shuffle, and a hot source or a very long document costs what its
own length costs. The repeated-window count sorts the window hashes of the row, which
keeps it at n log n for texts that are one word ten thousand times over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: What parts words.
BLANKS = " \t\n\x0b\x0c\r"

#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "a an and are as at be but by for from has have he in is it its not of on or she that the their they this to was were which will with you "
    "aber als auch auf aus bei bin das dem den der des die durch ein eine einer er es für hat ich ihr im ist mit nach nicht noch nur oder sein sich sie sind um und von war wie wir zu zum zur über "
    "au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qui que sa se ses son sont sur un une vous "
    "al con como del el ella ellos esta este ha las lo los más me mi muy no nos para pero por si sin sobre su sus te tu una y ya"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if ``metric`` is below ``low`` or above ``high``; shorter documents than ``min_words`` pass."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The production table. Metrics are the keys of ``metrics()``.
RULES = (
    Rule("mean_word_chars", "mean_word_chars", low=2.0, high=20.0),
    Rule("symbol_ratio", "symbol_ratio", high=0.05),
    Rule("exclamation_ratio", "exclamation_ratio", high=0.5, min_words=20),
    Rule("upper_ratio", "upper_ratio", high=0.6, min_words=20),
    Rule("letter_word_ratio", "letter_word_ratio", low=0.35),
    Rule("stop_word_ratio", "stop_word_ratio", low=0.01, min_words=100),
    Rule("dup_line_ratio", "dup_line_ratio", high=0.5, min_words=20),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _window_hash(words: Column, i: Column, window: int) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(window)])


def repeated_words(words: Column, window: int = 5) -> Column:
    """Words that lie in windows of so many words found twice or more in the row's text.

    A text of nothing but different windows, the usual one, costs one array of hashes;
    only others have their windows sorted with their places.
    """
    n = F.size(words)
    places = F.sequence(F.lit(0), n - window)

    def starts(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    marks = F.transform(places, lambda i: F.struct(_window_hash(words, i, window).alias("h"), i.alias("i")))
    count = _let(F.sort_array(marks), lambda s: _let(starts(s), covered))
    different = F.size(F.array_distinct(F.transform(places, lambda i: _window_hash(words, i, window)))) == F.size(places)
    return F.when((n <= window) | different, F.lit(0).cast("long")).otherwise(count)


def metrics() -> dict[str, Column]:
    """Ratios of the rule table over the columns of ``measure``; null (rule passed) where there is nothing to divide by."""
    return {
        "mean_word_chars": F.try_divide(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": F.try_divide(F.col("n_symbols"), F.col("word_chars")),
        "exclamation_ratio": F.try_divide(F.col("n_exclamations"), F.col("n_words")),
        "upper_ratio": F.try_divide(F.col("n_upper"), F.col("n_letters")),
        "letter_word_ratio": F.try_divide(F.col("n_letter_words"), F.col("n_words")),
        "stop_word_ratio": F.try_divide(F.col("n_stop_words"), F.col("n_words")),
        "dup_line_ratio": F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
    }


def failed(rule: Rule) -> Column:
    value = metrics()[rule.metric]
    low = value < F.lit(rule.low) if rule.low is not None else F.lit(False)
    high = value > F.lit(rule.high) if rule.high is not None else F.lit(False)
    return F.coalesce((F.col("n_words") >= rule.min_words) & (low | high), F.lit(False))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", prefix: str = "q_") -> DataFrame:
    """``docs`` with one struct column ``{prefix}quality``: the counts, the failed rules and the verdict.

    All of the input's columns stay, whatever their names: the new column takes the
    first free name of ``{prefix}quality``, ``{prefix}quality_``, ... and is the last.
    A null text has no words. Texts without words, and an empty table, are no special
    case: the counts are 0 and ``base_failed`` is true. Repeated rows are judged row
    by row.
    """
    name = f"{prefix}quality"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    judged = _judge(docs, rules, text)
    counts = [c for c in judged.columns if c != "row"]
    return judged.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.struct(*counts).alias(name))


def _judge(docs: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame:
    """row (the input's columns), the counts, base_failed, failed_rules, kept."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), t.alias("t"))
    bare = F.btrim("t", F.lit(BLANKS))
    inner = inner.withColumn("w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)))
    inner = inner.withColumn("l", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = inner.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_exclamations"),
        F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long").alias("n_letter_words"),  # from a word's first letter to its end
        F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    judged = counted.withColumn("base_failed", base).withColumn("failed_rules", broken)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def kept_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass, with the input's columns.

    Explode keeps what the filter needs in one place: as a predicate, the optimizer would
    carry all of the projection into it again for each use.
    """
    kept = _judge(docs, rules, text).select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
