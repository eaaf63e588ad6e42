"""Evaluation of predictions against truths. Counts and unrounded ratios; reports round on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .reports import python_round


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def label_class(labels: Column) -> Column:
    return F.coalesce(F.try_element_at(labels, F.lit(1)), F.lit(rules.NEGATIVE_CLASS))


def object_bucket(value: Column) -> Column:
    """The evaluation bucket of a research object; null for values out of the domain."""
    out = F.when(F.lit(False), F.lit(""))
    for name, bucket in rules.OBJECT_BUCKETS.items():
        out = out.when(value == name, F.lit(bucket))
    return out.when(value.isin(*rules.RESEARCH_OBJECTS), F.lit(rules.OTHER_BUCKET))


def one_vs_rest(df: DataFrame, domain: Sequence[str], truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """label, tp, fp, fn, tn, predicted, support, total, precision, recall, f1 for each label, in one pass."""
    t, p = F.col(truth), F.col(prediction)
    totals = df.agg(
        F.count("*").alias("total"),
        *[x for i, d in enumerate(domain) for x in (
            F.count_if((t == d) & (p == d)).alias(f"tp{i}"), F.count_if((t != d) & (p == d)).alias(f"fp{i}"), F.count_if((t == d) & (p != d)).alias(f"fn{i}"),
        )],
    )
    rows = [F.struct(F.lit(d).alias("label"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"), "total") for i, d in enumerate(domain)]
    m = totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    return with_ratios(m.withColumn("tn", F.col("total") - F.col("tp") - F.col("fp") - F.col("fn")))


def with_ratios(m: DataFrame) -> DataFrame:
    m = m.withColumn("predicted", F.col("tp") + F.col("fp")).withColumn("support", F.col("tp") + F.col("fn"))
    m = m.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return m.withColumn("f1", f1).select("label", "tp", "fp", "fn", "tn", "predicted", "support", "total", "precision", "recall", "f1")


def set_metrics(truths: DataFrame, predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of (label, id) sets: true_positives, n_predicted, n_truths, precision, recall. Rows of both must be distinct."""
    keys = [*by, "id"]
    both = truths.select(*keys, F.lit(1).alias("_t")).join(predictions.select(*keys, F.lit(1).alias("_p")), keys, "full")
    out = both.groupBy(*by).agg(
        F.count_if(F.col("_t").isNotNull() & F.col("_p").isNotNull()).alias("true_positives"), F.count("_p").alias("n_predicted"), F.count("_t").alias("n_truths")
    )
    return out.withColumn("precision", ratio(F.col("true_positives"), F.col("n_predicted"))).withColumn("recall", ratio(F.col("true_positives"), F.col("n_truths")))


def overall(df: DataFrame, domain: Sequence[str], truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """metric, value: accuracy, macro precision, recall and f1 over the domain, and micro (correct and supported over supported)."""
    m = one_vs_rest(df, domain, truth, prediction)
    macro = m.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("tp").alias("tp"), F.sum("support").alias("supported"))
    acc = df.agg(F.count_if(F.col(truth) == F.col(prediction)).alias("correct"), F.count("*").alias("n"))
    one = macro.join(F.broadcast(acc))  # one row each
    named = {
        "accuracy": ratio(F.col("correct"), F.col("n")), "macro_precision": F.col("precision"), "macro_recall": F.col("recall"), "macro_f1": F.col("f1"), "micro": ratio(F.col("tp"), F.col("supported")),
    }
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in named.items()])).alias("x")).select("x.*")


def summary(rows: list[dict], correct: int, total: int) -> dict:
    """The report of one section from its label rows: values are rounded first, then averaged, then rounded."""
    rounded = [{k: python_round(v) if isinstance(v, float) else v for k, v in r.items()} for r in rows]
    mean = lambda k: python_round(sum(r[k] for r in rounded) / len(rounded)) if rounded else 0.0
    supported = sum(r["support"] for r in rows)
    micro = python_round(sum(r["tp"] for r in rows) / supported) if supported else 0.0
    return {
        "accuracy": python_round(correct / total) if total else 0.0, "correct": correct, "incorrect": total - correct, "total": total,
        "macro": {k: mean(k) for k in ("precision", "recall", "f1")}, "micro": {"precision": micro, "recall": micro, "f1": micro}, "labels": {r["label"]: r for r in rounded},
    }


def evaluation_report(aligned: DataFrame) -> dict:
    """The report of aligned rows: truth and prediction structs (an annotation each); empty sections without rows."""
    if not aligned.head(1):
        return {"counts": {"total": 0}, "positive_negative": {}, "labels": {}, "objects": {}}
    t, p = F.col("truth"), F.col("prediction")
    flat = aligned.select(
        t["negative_tier"].alias("tt"), p["negative_tier"].alias("pt"), label_class(t["preference_labels"]).alias("tl"), label_class(p["preference_labels"]).alias("pl"),
        object_bucket(t["primary_research_object"]).alias("to"), object_bucket(p["primary_research_object"]).alias("po"),
    )
    positive = flat.filter(F.col("tt") == "positive")

    def section(df, a, b, domain):
        counts = df.agg(F.count_if(F.col(a) == F.col(b)), F.count("*")).first()
        return summary([r.asDict() for r in one_vs_rest(df, domain, a, b).collect()], *counts)

    return {
        "counts": {"total": flat.count()},
        "positive_negative": section(flat, "tt", "pt", ("positive",)),
        "labels": section(positive, "tl", "pl", rules.PREFERENCE_LABELS),
        "objects": section(positive, "to", "po", ("LLM", "VLM", "Diffusion", rules.OTHER_BUCKET)),
    }


def batch_errors(df: DataFrame, batch: Column, outcome: Column) -> DataFrame:
    """outcome, n: a batch with a failed row counts whole as failed."""
    per = df.groupBy(batch.alias("_b")).agg(F.count("*").alias("_n"), F.bool_or(outcome).alias("_bad"))
    return per.groupBy(F.when(F.col("_bad"), "failed").otherwise("ok").alias("outcome")).agg(F.sum("_n").alias("n"))
