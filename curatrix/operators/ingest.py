"""Raw conference rows to normalised papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text as t


def is_accepted(status: Column, reject=rules.REJECT_STATUS, accept=rules.ACCEPT_STATUS) -> Column:
    """Blank is accepted; then a reject word decides, then an accept word; anything else is not accepted."""
    s = F.lower(t.strip(F.coalesce(status, F.lit(""))))
    return F.when(s == "", True).when(t.any_of(s, reject), False).otherwise(t.any_of(s, accept))


def normalize(raw: DataFrame) -> DataFrame:
    """Papers of raw rows (``schemas.RAW`` and venue, year, source_path)."""
    c = {k: F.coalesce(F.col(k), F.lit("")) for k in raw.columns if k != "year"}
    venue = F.concat_ws(" ", F.col("venue"), F.col("year").cast("string"))
    authors = t.split_multi(c["author"])
    site = F.filter(F.transform(F.split(c["author_site"], ","), t.strip), lambda x: x != "")
    keywords = t.split_multi(c["keywords"])
    topic, area, title = t.first_non_blank(c["topic"]), t.first_non_blank(c["primary_area"]), t.first_non_blank(c["title"])
    return raw.select(
        F.coalesce(t.blank_to_null(c["id"]), t.slugify(title)).alias("paper_id"),
        F.coalesce(t.blank_to_null(title), F.concat(venue, F.lit(" 未命名论文"))).alias("title"),
        t.first_non_blank(c["abstract"], c["tldr"]).alias("abstract"),
        F.lit("conference").alias("source"),
        venue.alias("venue"),
        F.when(F.size(authors) > 0, authors).otherwise(site).alias("authors"),
        t.dedupe_ci(F.concat(keywords, t.split_multi(topic), t.split_multi(area))).alias("tags"),
        F.array_join(t.dedupe_ci(t.split_multi(c["aff"])), " | ").alias("organization"),
        F.col("year").cast("string").alias("published_at"),
        F.col("year").cast("int").alias("year"),
        F.coalesce(t.blank_to_null(c["status"]), F.lit("accepted")).alias("acceptance_status"),
        area.alias("primary_area"),
        topic.alias("topic"),
        keywords.alias("keywords"),
        t.first_non_blank(c["pdf"], c["proceeding"]).alias("pdf_url"),
        t.first_non_blank(c["project"], c["site"], c["oa"]).alias("project_url"),
        t.first_non_blank(c["github"], c["code"]).alias("code_url"),
        t.first_non_blank(c["openreview"]).alias("openreview_url"),
        F.col("source_path"),
    )


def accepted_papers(raw: DataFrame) -> DataFrame:
    return normalize(raw.filter(is_accepted(F.col("status"))))
