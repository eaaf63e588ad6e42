"""The library's operators as queries over the test tables, each with its SQL.

Documents stand for papers: doc_id is the id, the first line the title, the text the
abstract, the source the venue. Term lists are of words that the invented prose has.
"""

from __future__ import annotations

from collections.abc import Callable


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .. import schemas
from ..functions import forms, rules, text as t
from ..operators import blocked, browse, dedupe, importer, ingest, merge, metrics, models, reports, scoring, selection, splits, validation
from ..sources import files
from ..sources.shared import new_path
from . import workflows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name. Ints go out as longs."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(Tables(spark, sf_dir))
            return df.select(*[F.col(x.name).cast("long").alias(x.name) if isinstance(x.dataType, IntegerType) else F.col(x.name) for x in df.schema])

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def papers(self) -> DataFrame:
        d, title = self.documents, F.substring_index("text", "\n", 1)
        return d.select(
            F.col("doc_id").cast("string").alias("paper_id"), "doc_id", title.alias("title"), F.col("text").alias("abstract"), F.col("lang").alias("primary_area"), F.col("source").alias("topic"),
            F.array("lang").alias("keywords"), F.array("source").alias("tags"), F.col("source").alias("venue"), "lang", "source",
        )

    @property
    def scored(self) -> DataFrame:
        """Papers with the terms that their haystacks contain, and their score."""
        return self.papers.withColumn("found", FOUND.bits(scoring.haystack())).withColumn("score", scoring.term_score(FOUND.on("found"), TERMS))

    @property
    def ai(self) -> DataFrame:
        return self._annotation("ai", F.col("quality") == 1)

    @property
    def human(self) -> DataFrame:
        return self._annotation("human", (F.col("quality") == 1) & (F.col("toxic") == 0))

    def _annotation(self, who: str, positive: Column) -> DataFrame:
        tier = F.when(positive, "positive").otherwise("negative")
        return self.labels.select(
            F.col("doc_id").alias("paper_id"), F.lit(who).alias("labeler_id"), F.lit("LLM").alias("primary_research_object"),
            F.when(positive, F.array(F.lit("clean"))).otherwise(F.array().cast("array<string>")).alias("preference_labels"), tier.alias("negative_tier"),
            F.create_map(F.lit("general"), F.array(F.lit(who))).alias("evidence_spans"), F.lit("").alias("notes"), F.lit("pending").alias("review_status"),
        )

    @property
    def labelled_records(self) -> DataFrame:
        tier = F.when(F.col("quality") == 1, "positive").otherwise("negative")
        d = self.documents.join(self.labels, "doc_id", "left")
        return d.select(
            F.col("doc_id").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.lit("LLM").alias("primary_research_object"),
            F.array().cast("array<string>").alias("candidate_preference_labels"), tier.alias("candidate_negative_tier"), F.lit("").alias("notes"), "lang", "source",
        )


# The term lists and how they look in SQL

TERMS = rules.TermScore(strong=("tion", "der", "que"), context=("and", "with", "la", "ent"), exclude=("data", "llm"), bonuses=((("the", "les"), 2), (("sch", "ou"), 2)))
LABELS = {"alpha": ("tion", "the", "and", "ing"), "beta": ("der", "ein", "ich", "sch"), "gamma": ("que", "la", "eau", "oi")}
OBJECTS = (("english", "the of the and with"), ("german", "der ein und sch"), ("romance", "que la les de"))
GROUPS = rules.GroupScore(
    phrases=("of the", "que la"),
    groups=(rules.Group("any", ("tion", "ent"), 4, ("the", "la"), 1), rules.Group("both", ("der", "und"), 5, ("der", "ein"), 2), rules.Group("two", ("que", "es"), 5, ("la", "de", "eau", "tion"), 2), rules.Group("open", ("sh", "wh"), 3)),
    exclude=("data",),
    together=((("the",), ("and", "with"), 2), ((), ("que", "der"), 2)),
)
#: All of them, looked for at once.
FOUND = scoring.terms_of(TERMS, LABELS, OBJECTS, GROUPS, {"words": (" the ", " que ", " le ")})


def _n(terms) -> str:
    return "(" + " + ".join(f"contains(h, '{x}')::BIGINT" for x in terms) + ")" if terms else "0"


def _any(terms) -> str:
    return "(" + " OR ".join(f"contains(h, '{x}')" for x in terms) + ")"


def _all(terms) -> str:
    return "(" + " AND ".join(f"contains(h, '{x}')" for x in terms) + ")" if terms else "true"


_P = """p AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text, lang, source,
  lower(concat_ws(' ', split_part(text, chr(10), 1), text, lang, source, lang, source)) AS h FROM documents)"""
_SCORE = f"({_n(TERMS.strong)} * 3 + {_n(TERMS.context)} * 1 + {_n(TERMS.exclude)} * -3 + " + " + ".join(f"{_any(x)}::BIGINT * {k}" for x, k in TERMS.bonuses) + ")"
_GATE = {g.name: f"({_n(g.terms)} > 0" + (f" AND {_n(g.gate)} >= {g.at_least})" if g.at_least else ")") for g in GROUPS.groups}
_GROUP_SCORE = (
    f"({_n(GROUPS.exclude)} * -3 + {_n(GROUPS.phrases)} * 6 + "
    + " + ".join(f"CASE WHEN {_GATE[g.name]} THEN {_n(g.terms)} + {g.weight} ELSE 0 END" for g in GROUPS.groups)
    + " + "
    + " + ".join(f"({_all(a)} AND {_any(b)})::BIGINT * {k}" for a, b, k in GROUPS.together)
    + ")"
)
_LABEL = {k: f"({_n(v)} * 2)" for k, v in LABELS.items()}


def _argmax(scores: dict[str, str], none: str) -> str:
    best = f"greatest({', '.join(scores.values())})"
    return f"CASE WHEN {best} <= 0 THEN '{none}' " + " ".join(f"WHEN {v} = {best} THEN '{k}'" for k, v in scores.items()) + " END"


_OBJECT = _argmax({k: _n(v.split()) for k, v in OBJECTS}, "other")
_BEST = _argmax(_LABEL, "")
_TRIM = rules.TRIM_CHARS.replace("'", "''")
_norm = lambda x: f"trim(regexp_replace(trim(lower({x}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s+', ' ', 'g'), '{_TRIM}')"
# case folding, as far as these tables need it: lower case, and ß is ss
_title = lambda x: f"regexp_replace(trim(replace(lower({x}), 'ß', 'ss'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s+', ' ', 'g')"
_FP = f"sha256({_norm('split_part(text, chr(10), 1)')} || '::' || {_norm('text')})"
_RATIO = "(('0x' || sha256('42:' || doc_id)[1:12])::UBIGINT::DOUBLE / 281474976710655.0)"
_SPLIT = f"CASE WHEN {_RATIO} < 0.7 THEN 'dev' WHEN {_RATIO} < 0.85 THEN 'dev_validation' ELSE 'test' END"


# scans and sinks


@query("SELECT doc_id::VARCHAR AS paper_id, split_part(text, chr(10), 1) AS title, source AS venue, n_chars, trim(split_part(trim(text, ' ' || chr(10)), '.', 1), ' ' || chr(10)) AS first_sentence FROM documents")
def q_scan_normalize(x):
    return x.documents.select(F.col("doc_id").cast("string").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("source").alias("venue"), "n_chars", t.first_sentence(F.col("text")).alias("first_sentence"))


@query("SELECT doc_id, text FROM documents")
def q_scan_jsonl(x):
    path = new_path(x.spark, "jsonl")
    files.write_jsonl(x.documents.select("doc_id", "text"), path)
    return files.scan_jsonl(x.spark, path, x.documents.select("doc_id", "text").schema)


@query("SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS equal_rows FROM documents")
def q_roundtrip(x):
    rows = x.documents.select("doc_id", F.create_map("lang", F.array("source", "text")).alias("spans"), F.struct("lang", F.lit(None).cast("string").alias("none")).alias("s"), F.array("lang", "source").alias("tags"))
    path = new_path(x.spark, "roundtrip")
    files.write_jsonl(rows, path)
    hashed = lambda df: df.select("doc_id", importer.row_hash(["doc_id", "spans", "s", "tags"]).alias("row"))
    again = hashed(files.scan_jsonl(x.spark, path, rows.schema)).withColumnRenamed("row", "again")
    return hashed(rows).join(again, "doc_id", "left").agg(F.count("*").alias("n"), F.count_if(F.col("row") == F.col("again")).alias("equal_rows"))


@query("SELECT doc_id, CASE WHEN source = 'src1' THEN upper(lang) ELSE lang END AS lang FROM documents UNION ALL SELECT -1 - doc_id, lang FROM documents WHERE lang = 'fr'")
def q_upsert(x):
    d = x.documents
    new = d.filter("source = 'src1'").select("doc_id", F.upper("lang").alias("lang")).union(d.filter("lang = 'fr'").select(-1 - F.col("doc_id"), "lang"))
    return files.upsert(d.select("doc_id", "lang"), new, "doc_id")


@query("SELECT event_type, count(*)::BIGINT AS n FROM events WHERE NOT (event_type LIKE '%error%') AND (event_type LIKE '%click%' OR event_type LIKE '%view%') GROUP BY event_type")
def q_accept_filter(x):
    return x.events.filter(ingest.is_accepted(F.col("event_type"), ("error",), ("click", "view"))).groupBy("event_type").agg(F.count("*").alias("n"))


# scores and labels


@query(f"WITH {_P}, s AS (SELECT doc_id, {_SCORE} AS score FROM p) SELECT doc_id, score FROM s WHERE score >= 8")
def q_score_terms(x):
    return x.scored.filter("score >= 8").select("doc_id", "score")


@query(f"WITH {_P} SELECT doc_id, {', '.join(f'{v} AS {k}' for k, v in _LABEL.items())} FROM p")
def q_label_scores(x):
    scores = scoring.label_scores(FOUND.on("found"), LABELS)
    return x.scored.select("doc_id", *[v.alias(k) for k, v in scores.items()])


@query(f"WITH {_P} SELECT doc_id, {_BEST} AS label FROM p")
def q_label_argmax(x):
    return x.scored.select("doc_id", scoring.best_label(scoring.label_scores(FOUND.on("found"), LABELS)).alias("label"))


@query(f"""WITH {_P} SELECT doc_id, {_GROUP_SCORE} AS score, concat_ws('|', {', '.join(f"CASE WHEN contains(h, '{w}') THEN '{w}' END" for w in GROUPS.phrases)}, {', '.join(f"CASE WHEN {v} THEN '{k}' END" for k, v in _GATE.items())}) AS groups FROM p""")
def q_group_scores(x):
    return x.scored.select("doc_id", scoring.group_score(FOUND.on("found"), GROUPS).alias("score"), F.array_join(scoring.matched_groups(FOUND.on("found"), GROUPS), "|").alias("groups"))


@query(f"WITH {_P} SELECT doc_id, {_OBJECT} AS object FROM p")
def q_research_object(x):
    return x.scored.select("doc_id", scoring.research_object(FOUND.on("found"), OBJECTS, "other").alias("object"))


def _classified(x) -> DataFrame:
    s = x.scored.select("*", scoring.best_label(scoring.label_scores(FOUND.on("found"), LABELS)).alias("label"), scoring.research_object(FOUND.on("found"), OBJECTS, "other").alias("object"))
    note = scoring.general_note(F.col("score"), scoring.matched_terms(FOUND.on("found"), TERMS))
    return s.withColumn("tier", F.when((F.col("label") != "") & (F.col("score") >= 8), "positive").otherwise("negative")).withColumn("notes", note)


_TERM_LIST = ", ".join(f"CASE WHEN contains(h, '{w}') THEN '{w}' END" for w in dict.fromkeys((*TERMS.strong, *TERMS.context)))
_CLASS = f"""{_P}, s AS (SELECT *, {_SCORE} AS score, {_BEST} AS label, {_OBJECT} AS object FROM p),
 k AS (SELECT *, CASE WHEN label <> '' AND score >= 8 THEN 'positive' ELSE 'negative' END AS tier, '自动关键词筛选得分=' || score || '；命中=' || concat_ws(', ', {_TERM_LIST}) AS notes FROM s)"""


@query(f"WITH {_CLASS} SELECT doc_id, score, label, object, tier, notes FROM k")
def q_classify(x):
    return _classified(x).select("doc_id", "score", "label", "object", "tier", "notes")


_SENTENCE = "trim(split_part(trim(text, ' ' || chr(10)), '.', 1), ' ' || chr(10))"


@query(f"WITH {_CLASS}, e AS (SELECT doc_id, unnest(CASE WHEN tier = 'negative' THEN CASE WHEN label = '' THEN ['negative'] ELSE [label, 'negative'] END ELSE [label] END) AS label, {_SENTENCE} AS sentence FROM k) SELECT * FROM e WHERE sentence <> ''")
def q_evidence(x):
    labels = F.when(F.col("label") != "", F.array("label")).otherwise(F.array().cast("array<string>"))
    return _classified(x).select("doc_id", F.explode(scoring.evidence(F.col("abstract"), labels, F.col("tier"))).alias("label", "quotes")).select("doc_id", "label", F.get("quotes", 0).alias("sentence"))


@query(f"WITH {_CLASS} SELECT doc_id, notes || '；augment_batch=20260101-x；augment_score=' || score AS notes FROM k")
def q_notes(x):
    return _classified(x).select("doc_id", scoring.batch_note(F.col("notes"), "20260101-x", F.col("score")).alias("notes"))


@query(f"WITH {_CLASS} SELECT doc_id, object AS final_object, CASE WHEN tier = 'negative' THEN '' ELSE label END AS final_labels, tier AS final_tier, 'candidate_seed|human_reviewer' AS labelers, 'final' AS status FROM k")
def q_build_records(x):
    c = _classified(x).select(
        "doc_id", F.col("object").alias("primary_research_object"), F.array("label").alias("candidate_preference_labels"), F.col("tier").alias("candidate_negative_tier"), "abstract"
    )
    return scoring.build_records(c).select(
        "doc_id", F.col("final_primary_research_object").alias("final_object"), F.array_join("final_preference_labels", "|").alias("final_labels"), F.col("final_negative_tier").alias("final_tier"),
        F.array_join("final_labeler_ids", "|").alias("labelers"), F.col("final_review_status").alias("status"),
    )


# selections


@query(f"""WITH {_P}, s AS (SELECT doc_id, source, {_SCORE} AS score, CASE WHEN {_SCORE} >= 12 THEN 'positive' ELSE 'negative' END AS tier FROM p),
 r AS (SELECT *, row_number() OVER (PARTITION BY source, tier ORDER BY score DESC, doc_id) AS rn, count(*) FILTER (tier = 'positive') OVER (PARTITION BY source) AS np, count(*) FILTER (tier = 'negative') OVER (PARTITION BY source) AS nn FROM s),
 q AS (SELECT *, least(np, 7) AS pq, least(nn, 10 - least(np, 7)) AS nq FROM r),
 k AS (SELECT *, CASE WHEN tier = 'positive' AND rn <= pq THEN 0 WHEN tier = 'negative' AND rn <= nq THEN 1 WHEN tier = 'positive' THEN 2 ELSE 3 END AS part FROM q),
 z AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY part, rn) AS rank FROM k)
SELECT source, doc_id, rank::BIGINT AS rank, tier FROM z WHERE rank <= 10""")
def q_quota_topk(x):
    s = x.scored.withColumn("tier", F.when(F.col("score") >= 12, "positive").otherwise("negative"))
    return selection.quota_topk(s, ["source"], 10, selection.score_order(key="doc_id")).select("source", "doc_id", F.col("selected_rank").alias("rank"), "tier")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 5")
def q_limit_per_group(x):
    return selection.limit_per_group(x.documents.select("source", "doc_id"), ["source"], 5, ["doc_id"])


@query(f"""WITH {_P}, s AS (SELECT doc_id, {_SCORE} AS score, CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src7' THEN 2 ELSE 3 END AS venue_rank FROM p)
SELECT doc_id, venue_rank::BIGINT AS venue_rank, row_number() OVER (ORDER BY venue_rank, score DESC, doc_id) AS position FROM s""")
def q_venue_rank(x):
    ranked = x.scored.select("doc_id", "score", selection.priority_rank(F.col("source"), ["src3", "src1", "src7"]).alias("venue_rank"))
    return selection.numbered(ranked, ["venue_rank", F.col("score").desc(), "doc_id"], "position").select("doc_id", "venue_rank", "position")


@query("SELECT doc_id FROM (SELECT doc_id, sha256('7:' || doc_id) AS k FROM documents ORDER BY k, doc_id LIMIT 100)")
def q_sample_hash(x):
    return selection.sample(x.documents.select("doc_id"), 7, 100, "doc_id")


@query("SELECT doc_id, position, (position - 1) // 50 AS batch, doc_id || ':' || position AS request_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS position FROM documents)")
def q_batching(x):
    return selection.batched(x.documents.select("doc_id"), "doc_id").select("doc_id", "position", "batch", "request_id")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM labels WHERE quality = 1 AND toxic = 0) WHERE n <= 81")
def q_gap_take(x):
    return selection.take_until(x.labels, (F.col("quality") == 1) & (F.col("toxic") == 0), 81, ["doc_id"]).select("doc_id")


@query("WITH p AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id, coalesce(lead(doc_id) OVER (ORDER BY doc_id), CASE WHEN count(*) OVER () > 1 THEN min(doc_id) OVER () END) AS next_id FROM p")
def q_next_pending(x):
    return selection.next_with_wraparound(browse.pending(x.documents.select("doc_id"), x.labels, key="doc_id"), "doc_id", "doc_id").select("doc_id", "next_id")


# fingerprints and sets


@query(f"SELECT doc_id, {_FP} AS fingerprint FROM documents")
def q_fingerprint(x):
    return x.papers.select("doc_id", dedupe.fingerprint(F.col("title"), F.col("abstract")).alias("fingerprint"))


_OLD = "source IN ('src0', 'src1', 'src2', 'src3', 'src4')"


@query(f"SELECT count(*)::BIGINT AS n FROM (SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE {_OLD})")
def q_blocked_union(x):
    return dedupe.blocked_ids(x.labels, x.documents.filter(_OLD), key="doc_id").agg(F.count("*").alias("n"))


def _decontaminated(x) -> DataFrame:
    p = x.papers.withColumn("fingerprint", dedupe.fingerprint(F.col("title"), F.col("abstract"))).select("doc_id", "source", "fingerprint")
    return dedupe.label_blocked(p.filter(f"NOT {_OLD}"), p.filter(_OLD), "doc_id")


_DECON = f"""f AS (SELECT doc_id, source, {_FP} AS fp FROM documents), o AS (SELECT * FROM f WHERE {_OLD}),
 c AS (SELECT doc_id, fp, CASE WHEN doc_id IN (SELECT doc_id FROM o) THEN 'blocked_id' WHEN fp IN (SELECT fp FROM o) THEN 'blocked_fingerprint' END AS reason FROM f WHERE NOT {_OLD})"""


@query(f"WITH {_DECON} SELECT doc_id, reason FROM c")
def q_decontaminate(x):
    return _decontaminated(x).select("doc_id", "reason")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_antijoin_existing(x):
    return models.missing_only(x.documents.select("doc_id"), x.labels, "doc_id")


_GREEDY = f"{_DECON}, g AS (SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY fp ORDER BY doc_id) > 1 THEN 'duplicate_fingerprint' END AS reason FROM c WHERE reason IS NULL)"


def _survivors(x) -> DataFrame:
    rows = _decontaminated(x).filter("reason IS NULL").drop("reason").withColumn("ordinal", F.col("doc_id"))
    return dedupe.greedy(rows, "ordinal", "doc_id")


@query(f"WITH {_GREEDY} SELECT doc_id, reason FROM g")
def q_dedupe_greedy(x):
    return _survivors(x).select("doc_id", "reason")


@query(f"WITH {_GREEDY} SELECT g.doc_id FROM g JOIN labels l ON g.doc_id = l.doc_id WHERE reason IS NULL AND quality = 0")
def q_pool(x):
    return _survivors(x).filter("reason IS NULL").join(x.labels.filter("quality = 0"), "doc_id").select("doc_id")


@query(f"""WITH {_P}, s AS (SELECT doc_id FROM p WHERE {_SCORE} >= 12) SELECT 'intersect' AS op, (SELECT count(*) FROM (SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM s))::BIGINT AS n
 UNION ALL SELECT 'except', (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM s))""")
def q_set_ops(x):
    ids, high = x.labels.select("doc_id"), x.scored.filter("score >= 12").select("doc_id")
    count = lambda name, df: df.agg(F.lit(name).alias("op"), F.count("*").alias("n"))
    return count("intersect", ids.intersect(high)).union(count("except", ids.subtract(high)))


# merge


_MERGE = """m AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS ai, CASE WHEN quality = 1 AND toxic = 0 THEN 'positive' ELSE 'negative' END AS human FROM labels),
 r AS (SELECT *, CASE WHEN ai = 'negative' THEN 'direct' WHEN ai = human THEN 'agree' ELSE 'conflict_open' END AS route FROM m)"""


@query(f"WITH {_MERGE} SELECT doc_id, human AS final_tier, CASE WHEN route = 'conflict_open' THEN 'conflict' ELSE 'final' END AS status, 'ai|human' AS labelers FROM r UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_merge(x):
    records, _, _ = merge.merge(x.labelled_records, x.ai, x.human, strict=False)
    return records.select(F.col("paper_id").alias("doc_id"), F.col("final_negative_tier").alias("final_tier"), F.col("final_review_status").alias("status"), F.array_join("final_labeler_ids", "|").alias("labelers"))


@query(f"WITH {_MERGE} SELECT route, count(*)::BIGINT AS n FROM r GROUP BY route")
def q_merge_status_counts(x):
    return merge.routed(x.labelled_records, x.ai, x.human).groupBy("route").agg(F.count("*").alias("n"))


@query(f"WITH {_MERGE} SELECT r.doc_id, 'preference_labels|negative_tier' AS fields, split_part(text, chr(10), 1) AS title FROM r JOIN documents d ON r.doc_id = d.doc_id WHERE route = 'conflict_open'")
def q_conflicts(x):
    _, _, conflicts = merge.merge(x.labelled_records, x.ai, x.human, strict=False)
    held = conflicts.filter("resolved_annotation IS NULL").join(x.labelled_records.select("paper_id", "title"), "paper_id")
    return held.select(F.col("paper_id").alias("doc_id"), F.array_join("conflicting_fields", "|").alias("fields"), "title")


@query(f"WITH {_MERGE} SELECT d.doc_id, CASE WHEN r.route <> 'conflict_open' THEN 'merged' WHEN r.doc_id % 2 = 0 THEN 'human' ELSE 'ai' END AS seed_source FROM documents d JOIN r ON d.doc_id = r.doc_id")
def q_seed_precedence(x):
    _, merged, _ = merge.merge(x.labelled_records, x.ai, x.human, strict=False)
    return merge.by_precedence("paper_id", merged=merged, human=x.human.filter("paper_id % 2 = 0"), ai=x.ai).withColumnRenamed("paper_id", "doc_id")


# splits


@query(f"SELECT doc_id, {_SPLIT} AS split FROM documents")
def q_split_hash(x):
    return x.documents.select("doc_id", splits.choose_split(F.col("doc_id")).alias("split"))


@query(f"SELECT doc_id, 'test' AS split, false AS is_new FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, {_SPLIT}, true FROM labels WHERE doc_id % 2 <> 0")
def q_split_assign(x):
    manifest = x.documents.filter("doc_id % 2 = 0").select("doc_id", F.lit("test").alias("split"))
    return splits.assign(x.documents, x.labels, manifest, "doc_id")


@query(f"SELECT s.split, count(d.split)::BIGINT AS n FROM (VALUES ('dev'), ('dev_validation'), ('test')) s(split) LEFT JOIN (SELECT {_SPLIT} AS split FROM documents) d ON s.split = d.split GROUP BY s.split")
def q_split_counts(x):
    return splits.split_counts(x.documents.select(splits.choose_split(F.col("doc_id")).alias("split")))


# reports


@query("""WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'total' AS section, '' AS key, count(*)::BIGINT AS n FROM j UNION ALL SELECT 'lang', lang, count(*) FROM j GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM j GROUP BY source
UNION ALL SELECT 'quality', quality::VARCHAR, count(*) FROM j WHERE quality IS NOT NULL GROUP BY quality UNION ALL SELECT 'toxic', toxic::VARCHAR, count(*) FROM j WHERE toxic IS NOT NULL GROUP BY toxic""")
def q_distribution(x):
    j = x.documents.select("doc_id", "lang", "source").join(x.labels, "doc_id", "left")
    return reports.distribution(j, {k: F.col(k) for k in ("lang", "source", "quality", "toxic")})


@query("""SELECT layer, count(*) FILTER (tier = 'positive')::BIGINT AS positives, count(*)::BIGINT AS total, count(*) FILTER (tier = 'positive') / count(*)::DOUBLE AS ratio FROM (
 SELECT 'ai' AS layer, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS tier FROM labels UNION ALL SELECT 'human', CASE WHEN quality = 1 AND toxic = 0 THEN 'positive' ELSE 'negative' END FROM labels) GROUP BY layer""")
def q_positive_ratio(x):
    return reports.positive_ratio(x.ai.union(x.human), F.col("labeler_id"), F.col("negative_tier"))


_TRUTH = "(SELECT CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS t, CASE WHEN toxic = 0 THEN 'positive' ELSE 'negative' END AS p FROM labels)"
_div = lambda a, b: f"CASE WHEN {b} = 0 THEN 0.0 ELSE {a} / {b}::DOUBLE END"


def _one_vs_rest(source: str, domain) -> str:
    values = ", ".join(f"('{d}')" for d in domain)
    return f"""WITH x AS (SELECT * FROM {source}), c AS (SELECT label, count(*) FILTER (t = label AND p = label)::BIGINT AS tp, count(*) FILTER (t <> label AND p = label)::BIGINT AS fp,
 count(*) FILTER (t = label AND p <> label)::BIGINT AS fn, count(*) FILTER (t <> label AND p <> label)::BIGINT AS tn, count(*)::BIGINT AS total FROM x, (VALUES {values}) v(label) GROUP BY label),
 r AS (SELECT *, tp + fp AS predicted, tp + fn AS support, {_div('tp', '(tp + fp)')} AS precision, {_div('tp', '(tp + fn)')} AS recall FROM c)
SELECT label, tp, fp, fn, tn, predicted, support, total, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r"""


def _aligned(x) -> DataFrame:
    name = lambda c: F.when(c, "positive").otherwise("negative")
    return x.labels.select("doc_id", name(F.col("quality") == 1).alias("truth"), name(F.col("toxic") == 0).alias("prediction"))


@query(_one_vs_rest(_TRUTH, ("positive", "negative")))
def q_eval_binary(x):
    return metrics.one_vs_rest(_aligned(x), ("positive", "negative"))


_LABEL2 = {k: f"({_n(v[1:])} * 2)" for k, v in LABELS.items()}


def _two_labels(x) -> DataFrame:
    short = {k: v[1:] for k, v in LABELS.items()}
    s = x.scored.filter("score >= 8")
    return s.select("doc_id", "lang", scoring.best_label(scoring.label_scores(FOUND.on("found"), LABELS)).alias("truth"), scoring.best_label(scoring.label_scores(FOUND.on("found"), short)).alias("prediction"))


_TWO = f"(WITH {_P} SELECT doc_id, lang, {_BEST} AS t, {_argmax(_LABEL2, '')} AS p FROM p WHERE {_SCORE} >= 8)"


@query(_one_vs_rest(_TWO, LABELS))
def q_eval_label(x):
    return metrics.one_vs_rest(_two_labels(x), list(LABELS))


def _buckets(x) -> DataFrame:
    bucket = lambda c: F.when(c.isin("en", "fr"), c).otherwise("other")
    guess = F.when(t.any_of(FOUND.on("found"), (" the ",)), "en").when(t.any_of(FOUND.on("found"), (" que ", " le ")), "fr").otherwise("de")
    return x.scored.select(bucket(F.col("lang")).alias("truth"), bucket(guess).alias("prediction"))


@query(_one_vs_rest(f"(WITH {_P} SELECT CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'other' END AS t, CASE WHEN contains(h, ' the ') THEN 'en' WHEN contains(h, ' que ') OR contains(h, ' le ') THEN 'fr' ELSE 'other' END AS p FROM p)", ("en", "fr", "other")))
def q_eval_object(x):
    return metrics.one_vs_rest(_buckets(x), ("en", "fr", "other"))


_SETS = f"""t AS (SELECT lang, t AS label, doc_id FROM x WHERE t <> ''), p AS (SELECT lang, p AS label, doc_id FROM x WHERE p <> ''),
 b AS (SELECT coalesce(t.lang, p.lang) AS lang, coalesce(t.label, p.label) AS label, t.doc_id AS td, p.doc_id AS pd FROM t FULL JOIN p ON t.doc_id = p.doc_id AND t.label = p.label AND t.lang = p.lang)"""


@query(f"""WITH x AS (SELECT * FROM {_TWO}), {_SETS}, c AS (SELECT lang, label, count(*) FILTER (td IS NOT NULL AND pd IS NOT NULL)::BIGINT AS true_positives, count(pd)::BIGINT AS n_predicted, count(td)::BIGINT AS n_truths FROM b GROUP BY lang, label)
SELECT *, {_div('true_positives', 'n_predicted')} AS precision, {_div('true_positives', 'n_truths')} AS recall FROM c""")
def q_eval_sets(x):
    rows = _two_labels(x)
    side = lambda c: rows.filter(F.col(c) != "").select("lang", F.col(c).alias("label"), F.col("doc_id").alias("id"))
    return metrics.set_metrics(side("truth"), side("prediction"), ["lang", "label"])


@query(f"""WITH m AS ({_one_vs_rest(_TRUTH, ('positive', 'negative'))}), a AS (SELECT count(*) FILTER (t = p) / count(*)::DOUBLE AS v FROM {_TRUTH})
SELECT 'accuracy' AS metric, v AS value FROM a UNION ALL SELECT 'macro_precision', avg(precision) FROM m UNION ALL SELECT 'macro_recall', avg(recall) FROM m
UNION ALL SELECT 'macro_f1', avg(f1) FROM m UNION ALL SELECT 'micro', sum(tp) / sum(support)::DOUBLE FROM m""")
def q_eval_report(x):
    return metrics.overall(_aligned(x), ("positive", "negative"))


@query("WITH b AS (SELECT event_id // 50 AS b, count(*) AS n, bool_or(event_type = 'error') AS bad FROM events GROUP BY 1) SELECT CASE WHEN bad THEN 'failed' ELSE 'ok' END AS outcome, sum(n)::BIGINT AS n FROM b GROUP BY 1")
def q_eval_errors(x):
    return metrics.batch_errors(x.events, F.floor(F.col("event_id") / 50), F.col("event_type") == "error")


@query("SELECT source, count(*)::BIGINT AS current, 60::BIGINT AS target, greatest(0, 60 - count(*))::BIGINT AS gap FROM documents GROUP BY source")
def q_gap(x):
    return reports.gap(x.documents.groupBy("source").agg(F.count("*").alias("current")), 60)


@query(f"SELECT sha256({_norm('text')}) AS fingerprint, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def q_duplicates(x):
    return dedupe.duplicates(x.documents, F.sha2(dedupe.normalize(F.col("text")), 256), "doc_id").withColumnRenamed("value", "fingerprint")


@query(f"SELECT {_title('split_part(text, chr(10), 1)')} AS title, count(DISTINCT doc_id)::BIGINT AS n FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) > 1")
def q_title_duplicates(x):
    return dedupe.title_duplicates(x.papers, F.col("title"), "doc_id")


@query(f"WITH f AS (SELECT doc_id, source, {_title('split_part(text, chr(10), 1)')} AS k FROM documents) SELECT doc_id FROM f WHERE NOT {_OLD} AND k IN (SELECT k FROM f WHERE {_OLD})")
def q_title_collisions(x):
    p = x.papers
    return dedupe.title_collisions(p.filter(f"NOT {_OLD}").select("doc_id", "title"), p.filter(_OLD).select("doc_id", "title"), "title", "doc_id").select("doc_id")


@query("SELECT CASE WHEN doc_id % 11 = 0 THEN 'added' WHEN doc_id % 7 = 0 THEN 'updated' ELSE 'unchanged' END AS status, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def q_import_diff(x):
    old = x.documents.select("doc_id", "lang", "text")
    new = old.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, F.upper("lang")).otherwise(F.col("lang"))).withColumn("doc_id", F.when(F.col("doc_id") % 11 == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id")))
    return importer.diff(new, old, "doc_id", ["lang", "text"]).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT -1 - doc_id AS doc_id FROM labels WHERE doc_id % 5 = 0")
def q_fk_violations(x):
    ids = x.labels.select("doc_id").union(x.labels.filter("doc_id % 5 = 0").select(-1 - F.col("doc_id")))
    return validation.fk_violations(ids, x.documents, "doc_id")


_LEGACY = "CASE doc_id % 4 WHEN 0 THEN 'hard' WHEN 1 THEN 'easy' WHEN 2 THEN 'in_domain' ELSE 'positive' END"


@query(f"SELECT doc_id, CASE WHEN {_LEGACY} = 'positive' THEN 'positive' ELSE 'negative' END AS tier, CASE WHEN {_LEGACY} = 'positive' THEN lang ELSE '' END AS labels FROM documents")
def q_legacy_cleanup(x):
    rows = x.documents.select("doc_id", F.expr(_LEGACY).alias("tier"), F.array("lang").alias("labels"), F.array("source").alias("target_preference_labels"))
    return importer.legacy_clean(rows, "tier", "labels").select("doc_id", "tier", F.array_join("labels", "|").alias("labels"))


# browsing

_BROWSE = f"""{_MERGE}, b AS (SELECT d.doc_id, d.lang, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS tier, CASE WHEN d.doc_id % 3 = 0 THEN {_SPLIT.replace('doc_id', 'd.doc_id')} ELSE 'unassigned' END AS split,
 CASE WHEN r.route = 'conflict_open' THEN 'conflict' WHEN coalesce(l.quality, 0) <> 1 AND l.doc_id IS NULL THEN 'negative' WHEN l.doc_id IS NOT NULL THEN 'completed' ELSE 'pending' END AS status
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN r ON d.doc_id = r.doc_id)"""


def _browsed(x) -> DataFrame:
    _, _, conflicts = merge.merge(x.labelled_records, x.ai, x.human, strict=False)
    held = x.documents.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("paper_id"), splits.choose_split(F.col("doc_id")).alias("split"))
    rows = browse.browse(x.labelled_records, x.ai, x.human, conflicts, held)
    return rows.select(F.col("paper_id").alias("doc_id"), "lang", F.col("candidate_negative_tier").alias("tier"), "split", "status")


@query(f"WITH {_BROWSE} SELECT doc_id, status, tier, split FROM b WHERE lang = 'en'")
def q_browse(x):
    return _browsed(x).filter(browse.kept_by({"lang": "en", "status": "all", "split": None})).select("doc_id", "status", "tier", "split")


@query(f"""WITH {_BROWSE} SELECT 'status' AS facet, v.s AS value, count(b.doc_id)::BIGINT AS n FROM (VALUES ('pending'), ('completed'), ('negative'), ('conflict')) v(s) LEFT JOIN b ON b.status = v.s AND split = 'dev' GROUP BY v.s
 UNION ALL SELECT 'split', v.s, count(b.doc_id) FROM (VALUES ('dev'), ('dev_validation'), ('test'), ('unassigned')) v(s) LEFT JOIN b ON b.split = v.s AND status = 'completed' GROUP BY v.s""")
def q_facets(x):
    return reports.facets(
        _browsed(x), {"status": F.col("status") == "completed", "split": F.col("split") == "dev"}, {"status": F.col("status"), "split": F.col("split")},
        {"status": browse.STATUSES, "split": (*rules.SPLITS, "unassigned")},
    )


_FACETS = {"lang": "f_lang", "source": "f_source", "length": "f_length", "words": "f_words"}


@query(f"""WITH d AS (SELECT *, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END AS length, list_filter(['the', 'der', 'que'], lambda w: contains(lower(text), w)) AS words FROM documents),
 f AS (SELECT *, lang IN ('en', 'de') AS f_lang, source <> 'src0' AS f_source, length <> 'short' AS f_length, list_contains(words, 'der') AS f_words FROM d)
 {" UNION ALL ".join(f"SELECT '{k}' AS facet, value, count(*)::BIGINT AS n FROM (SELECT unnest({k if k == 'words' else f'[{k}]'}) AS value FROM f WHERE {' AND '.join(v for n, v in _FACETS.items() if n != k)}) GROUP BY value" for k in _FACETS)}
 UNION ALL SELECT 'lang', 'xx', 0""")
def q_facet_bitmap(x):
    length = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "middle").otherwise("long")
    words = t.matched(F.lower("text"), ("the", "der", "que"))
    d = x.documents.select("lang", "source", length.alias("length"), words.alias("words"))
    filters = {"lang": F.col("lang").isin("en", "de"), "source": F.col("source") != "src0", "length": F.col("length") != "short", "words": F.array_contains("words", "der")}
    return reports.facets(d, filters, {k: F.col(k) for k in filters}, {"lang": ("xx",)})


@query("SELECT DISTINCT 'lang' AS facet, lang AS value FROM documents UNION SELECT DISTINCT 'labels', unnest([lang, source]) FROM documents")
def q_facet_values(x):
    return browse.facet_values(x.documents, lang=F.col("lang"), labels=F.array("lang", "source"))


@query(f"WITH {_MERGE} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id % 2 = 0) AND doc_id NOT IN (SELECT doc_id FROM r WHERE route <> 'conflict_open')")
def q_pending(x):
    _, merged, _ = merge.merge(x.labelled_records, x.ai, x.human, strict=False)
    records = x.documents.select(F.col("doc_id").alias("paper_id"))
    return browse.pending(records, x.human.filter("paper_id % 2 = 0"), merged).withColumnRenamed("paper_id", "doc_id")


@query("SELECT doc_id FROM documents WHERE trim(text, ' ' || chr(10)) <> '' AND (doc_id % 3 = 0 OR doc_id % 5 = 0) AND doc_id NOT IN (SELECT doc_id FROM labels)")
def q_needs_work(x):
    title = F.substring_index("text", "\n", 1)
    holder = F.concat(F.lit("中文摘要："), title)
    d = x.documents.withColumn("zh", F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).when(F.col("doc_id") % 5 == 0, holder).otherwise(F.lit("done")))
    return browse.pending(d.filter(browse.needs_backfill(F.col("text"), F.col("zh"), holder)), x.labels, key="doc_id").select("doc_id")


@query("SELECT doc_id, 'b' || (doc_id % 4) AS tag FROM documents WHERE doc_id % 4 IN (1, 2)")
def q_batch_tag(x):
    notes = F.concat(F.lit("x=1；"), F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("augment_batch=b"), (F.col("doc_id") % 4).cast("string"), F.lit(" ; y=2"))).otherwise(F.lit("augment_batch=；")))
    return x.documents.select("doc_id", t.key_value(notes, "augment_batch").alias("tag")).filter(F.col("tag").isin("b1", "b2"))


@query("SELECT event_type AS kind, count(*)::BIGINT AS calls, count(*) FILTER (value < 10)::BIGINT AS failures, sum(round(value * 100)::BIGINT)::BIGINT AS total_duration, max(round(value * 100)::BIGINT) AS longest FROM events GROUP BY event_type")
def q_audit_rollup(x):
    return models.audit_rollup(x.events, F.col("event_type"), F.col("value") < 10, F.round(F.col("value") * 100).cast("long"))


# data quality


@query("SELECT event_id, '$' AS path, CASE event_id % 10 WHEN 3 THEN 'not JSON' ELSE 'not an object' END AS message FROM events WHERE event_id % 10 IN (3, 4)")
def q_dq_json(x):
    raw = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("{"), F.col("props"))).when(F.col("event_id") % 10 == 4, F.concat(F.lit("["), F.col("props"), F.lit("]"))).otherwise(F.col("props"))
    return validation.json_issues(x.events.select("event_id", raw.alias("raw")), "event_id", F.col("raw"))


def _objects(x) -> DataFrame:
    """Documents as JSON objects with faults by rule."""
    year = F.when(F.col("doc_id") % 6 == 0, F.lit('"2025"')).when(F.col("doc_id") % 6 == 1, F.lit("true")).otherwise(F.lit("2025"))
    lang = F.when(F.col("doc_id") % 5 == 0, F.lit('"xx"')).otherwise(F.concat(F.lit('"'), F.col("lang"), F.lit('"')))
    extra = F.when(F.col("doc_id") % 4 == 0, F.lit(', "zz": 1, "aa": 2')).otherwise(F.lit(""))
    tags = F.when(F.col("doc_id") % 9 == 0, F.lit("")).otherwise(F.lit(', "tags": ["a"]'))
    return x.documents.select("doc_id", F.concat(F.lit('{"year": '), year, F.lit(', "lang": '), lang, tags, extra, F.lit("}")).alias("raw"))


@query("SELECT doc_id, '$' AS path, 'missing: tags' AS message FROM documents WHERE doc_id % 9 = 0 UNION ALL SELECT doc_id, '$', 'extra: aa, zz' FROM documents WHERE doc_id % 4 = 0")
def q_dq_fields(x):
    return validation.field_issues(_objects(x), "doc_id", F.col("raw"), ["year", "lang", "tags"])


@query("SELECT doc_id, 'year' AS path, 'not integer' AS message FROM documents WHERE doc_id % 6 IN (0, 1) UNION ALL SELECT doc_id, 'lang', 'not enum' FROM documents WHERE doc_id % 5 = 0 OR lang NOT IN ('en', 'fr', 'de', 'es')")
def q_dq_types(x):
    return validation.type_issues(_objects(x), "doc_id", F.col("raw"), {"year": "integer", "lang": "enum", "tags": "string[]"}, {"lang": ("en", "fr", "de", "es")})


@query("SELECT doc_id, 'lang' AS path, 'out of the domain' AS message FROM documents WHERE lang NOT IN ('en', 'fr') UNION ALL SELECT doc_id, 'tags', 'out of the domain' FROM documents WHERE source NOT IN ('src0', 'src1')")
def q_dq_enum(x):
    return validation.enum_issues(x.documents.withColumn("tags", F.array("source")), "doc_id", {"lang": ("en", "fr"), "tags": ("src0", "src1")})


@query("SELECT doc_id, 'spans' AS path, 'unknown key' AS message FROM documents WHERE lang = 'de' UNION ALL SELECT doc_id, 'spans', 'blank quote' FROM documents WHERE doc_id % 8 = 0")
def q_dq_evidence(x):
    quote = F.when(F.col("doc_id") % 8 == 0, F.lit(" \t")).otherwise(F.lit("q"))
    return validation.evidence_issues(x.documents.withColumn("spans", F.create_map("lang", F.array(quote))), "doc_id", "spans", ("en", "fr", "es"))


def _translated(x) -> DataFrame:
    zh = F.when(F.col("doc_id") % 6 == 0, F.lit(" ")).when(F.col("doc_id") % 6 == 1, F.lit("抱歉，无法进行忠实翻译。")).otherwise(F.substring("text", 1, 40))
    return x.documents.withColumn("zh", zh)


@query("SELECT doc_id, 'zh' AS path, 'required_pair' AS message FROM documents WHERE trim(text, ' ' || chr(10)) <> '' AND (doc_id % 6 = 0 OR (doc_id % 6 > 1 AND trim(substr(text, 1, 40), ' ' || chr(10)) = ''))")
def q_dq_required_pair(x):
    return validation.translation_issues(_translated(x), "doc_id", [("text", "zh")]).filter("message = 'required_pair'")


@query("SELECT doc_id, 'zh' AS path, 'refusal' AS message FROM documents WHERE doc_id % 6 = 1")
def q_dq_refusal(x):
    return validation.translation_issues(_translated(x), "doc_id", [("text", "zh")]).filter("message = 'refusal'")


@query("""WITH z AS (SELECT doc_id, length(trim(text, ' ' || chr(10))) AS a, length(trim(CASE doc_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN '抱歉，无法进行忠实翻译。' ELSE substr(text, 1, 40) END, ' ' || chr(10))) AS b FROM documents)
SELECT doc_id, 'zh' AS path, 'short' AS message FROM z WHERE b > 0 AND a >= 400 AND b < 120 AND b / a::DOUBLE < 0.12""")
def q_dq_short(x):
    return validation.translation_issues(_translated(x), "doc_id", [], ("text", "zh"))


@query("SELECT doc_id AS paper_id, 'title' AS path, 'blank' AS message FROM documents WHERE trim(split_part(text, chr(10), 1)) = '' UNION ALL SELECT doc_id, 'primary_research_object', 'out of the domain' FROM documents WHERE lang = 'es' UNION ALL SELECT doc_id, 'candidate_negative_tier', 'out of the domain' FROM documents WHERE doc_id % 7 = 0")
def q_dq_semantic(x):
    rows = x.documents.select(
        F.col("doc_id").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("source").alias("venue"), "source", F.col("source").alias("source_path"),
        F.when(F.col("lang") == "es", "?").otherwise("LLM").alias("primary_research_object"), F.array(F.lit(rules.SCHEDULING_LABEL)).alias("candidate_preference_labels"),
        F.when(F.col("doc_id") % 7 == 0, "hard").otherwise(" positive ").alias("candidate_negative_tier"),
    )
    return validation.record_issues(rows)


# views, classes, alignment, release, patches and raw lines


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND quality IS NOT NULL THEN quality::VARCHAR ELSE lang END AS value FROM documents LEFT JOIN labels USING (doc_id)")
def q_resolved(x):
    d = x.documents.join(x.labels, "doc_id", "left")
    rows = d.select("doc_id", "lang", F.when(F.col("doc_id") % 3 == 0, F.col("quality").cast("string")).when(F.col("doc_id") % 3 == 1, F.lit(" ")).alias("final_value"))
    return rows.select("doc_id", merge.resolved("final_value", "lang").alias("value"))


_CASE = lambda c, held: "CASE " + c + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in held.items()) + " END"


@query(f"""WITH {_BROWSE} SELECT b.doc_id, CASE WHEN b.doc_id % 4 = 0 THEN 'zh ' || b.doc_id ELSE split_part(d.text, chr(10), 1) END AS display_title, d.text AS display_abstract,
 CASE WHEN b.doc_id % 2 = 0 THEN ['seed'] ELSE [d.lang] END AS display_labels, CASE WHEN b.doc_id % 2 = 0 THEN 'seed' ELSE 'LLM' END AS display_object,
 {_CASE('status', browse.CAPTIONS['status'])} AS status_caption, {_CASE('split', browse.CAPTIONS['split'])} AS split_caption, {_CASE('tier', browse.CAPTIONS['tier'])} AS tier_caption FROM b JOIN documents d USING (doc_id)""")
def q_display(x):
    d, even = x.documents.select("doc_id", "text", F.col("lang").alias("l")), F.col("doc_id") % 2 == 0
    rows = _browsed(x).select("doc_id", "status", "split", "tier").join(d, "doc_id").select(
        "doc_id", "status", "split", F.col("tier").alias("candidate_negative_tier"), F.substring_index("text", "\n", 1).alias("title"), F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("zh "), F.col("doc_id").cast("string"))).otherwise("").alias("title_zh"),
        F.col("text").alias("abstract"), F.lit(None).cast("string").alias("abstract_zh"), F.array("l").alias("candidate_preference_labels"), F.lit("LLM").alias("primary_research_object"),
        F.when(even, F.array(F.lit("seed"))).alias("seed_labels"), F.when(even, F.lit("seed")).alias("seed_object"),
    )
    return browse.shown(rows).select("doc_id", *[f"display_{c}" for c in ("title", "abstract", "labels", "object")], "status_caption", "split_caption", "tier_caption")


_KINDS = [*rules.RESEARCH_OBJECTS, "unknown"]
_KIND_SQL = "[" + ", ".join(f"'{k}'" for k in _KINDS) + "][1 + doc_id % " + str(len(_KINDS)) + "]"


@query(f"""SELECT bucket, count(*)::BIGINT AS n FROM (SELECT CASE WHEN k IN ({", ".join(f"'{k}'" for k in rules.RESEARCH_OBJECTS)}) THEN coalesce({_CASE('k', rules.OBJECT_BUCKETS)}, '{rules.OTHER_BUCKET}') END AS bucket
 FROM (SELECT {_KIND_SQL} AS k FROM documents)) GROUP BY bucket""")
def q_object_bucket(x):
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (1 + F.col("doc_id") % len(_KINDS)).cast("int"))
    return x.documents.groupBy(metrics.object_bucket(kind).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"SELECT CASE WHEN doc_id % 3 = 0 THEN '{rules.NEGATIVE_CLASS}' ELSE lang END AS class, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def q_label_class(x):
    labels = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
    return x.documents.groupBy(metrics.label_class(labels).alias("class")).agg(F.count("*").alias("n"))


@query("SELECT doc_id::VARCHAR AS request_id, quality::BIGINT AS truth, toxic::BIGINT AS prediction FROM labels WHERE doc_id % 5 <> 0")
def q_align(x):
    truths = x.labels.select(F.col("doc_id").cast("string").alias("request_id"), F.col("quality").alias("v"))
    answers = x.labels.filter("doc_id % 5 != 0").select(F.col("doc_id").cast("string").alias("request_id"), F.col("toxic").alias("v"))
    return models.align(truths, answers).select("request_id", F.col("truth.v").alias("truth"), F.col("prediction.v").alias("prediction"))


@query("""WITH r AS (SELECT doc_id // 2 AS id, source, lang, CASE WHEN doc_id % 5 = 0 THEN 'negative' ELSE 'positive' END AS tier, CASE WHEN doc_id % 7 = 0 THEN 'conflict' ELSE 'final' END AS status FROM documents)
SELECT 'total' AS section, '' AS key, count(*)::BIGINT AS n FROM r UNION ALL SELECT 'venue', source, count(*) FROM r GROUP BY source UNION ALL SELECT 'object', lang, count(*) FROM r GROUP BY lang
UNION ALL SELECT 'unresolved', '', count(*) FROM r WHERE status <> 'final' HAVING count(*) > 0 UNION ALL SELECT 'duplicate_ids', id::VARCHAR, count(*) FROM r GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'positive', v.l, count(r.id) FROM (VALUES ('en'), ('xx')) v(l) LEFT JOIN r ON r.lang = v.l GROUP BY v.l
UNION ALL SELECT 'negative', v.l, count(r.id) FROM (VALUES ('en'), ('xx')) v(l) LEFT JOIN r ON r.lang = v.l AND r.tier = 'negative' GROUP BY v.l""")
def q_release(x):
    rows = x.documents.select(F.floor(F.col("doc_id") / 2).alias("id"), "source", "lang", F.when(F.col("doc_id") % 5 == 0, "negative").otherwise("positive").alias("tier"), F.when(F.col("doc_id") % 7 == 0, "conflict").otherwise("final").alias("status"))
    return reports.release(rows, "id", F.col("source"), F.col("lang"), F.array("lang"), F.col("tier"), F.col("status"), ("en", "xx"))


@query("SELECT doc_id::VARCHAR AS paper_id, CASE WHEN doc_id % 3 = 0 THEN 'second' ELSE 'first' END AS title_zh FROM documents WHERE doc_id % 2 = 0")
def q_patches(x):
    path, d = new_path(x.spark, "patches"), x.documents.filter("doc_id % 2 = 0")
    for word, rows, when in (("first", d, "2025-01-01T00:00:00"), ("second", d.filter("doc_id % 3 = 0"), "2025-01-02T00:00:00")):
        files.append_sorted(rows.select(F.col("doc_id").cast("string").alias("paper_id"), F.lit("t").alias("title"), F.lit(word).alias("title_zh"), F.lit("").alias("abstract_zh"), F.lit("m").alias("model"), F.lit(when).alias("translated_at")), path)
    return files.scan_patches(x.spark, path).select("paper_id", "title_zh")


@query("SELECT doc_id AS id, split_part(text, chr(10), 1) AS title FROM documents WHERE doc_id % 2 <> 0 OR doc_id % 3 = 0")
def q_unpatched(x):
    """Records without a usable patch: patches are written to files and read back; a blank one, being the last of its id, does not count."""
    path, d = new_path(x.spark, "patches"), x.documents.filter("doc_id % 2 = 0")
    for word, rows, when in (("made", d, "2025-01-01T00:00:00"), (" ", d.filter("doc_id % 3 = 0"), "2025-01-02T00:00:00")):
        files.append_sorted(rows.select(F.col("doc_id").cast("string").alias("paper_id"), F.lit("t").alias("title"), F.lit(word).alias("title_zh"), F.lit("").alias("abstract_zh"), F.lit("m").alias("model"), F.lit(when).alias("translated_at")), path)
    patched = files.scan_patches(x.spark, path).filter(t.strip(F.col("title_zh")) != "")
    return browse.pending(x.papers.select("paper_id", F.col("doc_id").alias("id"), "title"), patched).select("id", "title")


@query("""WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS line FROM documents)
SELECT line::BIGINT AS line, path, message FROM d, (SELECT unnest([{'k': 0, 'path': '$', 'message': 'not JSON'}, {'k': 1, 'path': '$', 'message': 'not an object'}, {'k': 2, 'path': '$', 'message': 'missing: b'},
 {'k': 3, 'path': 'b', 'message': 'not integer'}, {'k': 4, 'path': '$', 'message': 'extra: c'}], recursive := true)) WHERE doc_id % 7 = k""")
def q_dq_lines(x):
    path, k = new_path(x.spark, "lines"), F.col("doc_id") % 7
    bad = F.when(k == 0, "{").when(k == 1, "[1]").when(k == 2, '{"a": "x"}').when(k == 3, '{"a": "x", "b": true}').when(k == 4, '{"a": "x", "b": 1, "c": 2}').when(k == 5, '{"a": "x", "b": 1}').otherwise(" ")
    # lines are numbered by file: the files are in the order of the ids, and each begins where those before end
    x.documents.select("doc_id", bad.alias("value")).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    lines = files.scan_lines(x.spark, path)
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = lines.groupBy("file").agg(F.count("*").alias("n")).select("file", before.alias("before"))  # a row a file
    found = validation.line_issues(lines, {"a": "string", "b": "integer"}).join(F.broadcast(starts), "file")
    return found.select((F.col("line") + F.col("before")).alias("line"), "path", "message")


@query(f"SELECT fp AS value, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM (SELECT doc_id, {_FP} AS fp FROM documents) GROUP BY fp HAVING count(*) > 1")
def q_fingerprint_duplicates(x):
    return dedupe.duplicates(x.papers, dedupe.fingerprint(F.col("title"), F.col("abstract")), "doc_id")


_ATTEMPTS = "CASE WHEN doc_id % 11 = 0 THEN 3 WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END"


@query(f"""SELECT doc_id::VARCHAR AS paper_id, k::BIGINT AS attempt, doc_id % 11 <> 0 AND k + 1 = {_ATTEMPTS} AS success, CASE WHEN doc_id % 11 = 0 OR k + 1 < {_ATTEMPTS} THEN 'try again' END AS error,
 'Label this. ' || split_part(text, chr(10), 1) AS prompt, CASE WHEN doc_id % 11 <> 0 AND k + 1 = {_ATTEMPTS} THEN upper(lang) END AS response, CASE WHEN doc_id % 11 <> 0 AND k + 1 = {_ATTEMPTS} THEN strlen(lang) END::BIGINT AS response_chars,
 n_chars::BIGINT AS prompt_tokens FROM documents, unnest(range({_ATTEMPTS})) AS u(k)""")
def q_audit(x):
    """The log of a run of calls over all documents, some of which fail once or always: written by batch and read back, an entry a call."""
    path, run = new_path(x.spark, "audit"), "one"
    asked = x.documents.select(F.col("doc_id").cast("string").alias("paper_id"), "doc_id", F.substring_index("text", "\n", 1).alias("title"), "lang", "n_chars")
    done = models.run_model(asked, _stub_model, "label string", attempts=3, partitions=8)
    kept = new_path(x.spark, "calls")
    done.write.parquet(kept)
    files.write_audit(x.spark.read.schema(done.schema).parquet(kept), path, "stub", run)
    log = x.spark.read.schema("paper_id string, attempt long, success boolean, error string, prompt string, response string, response_chars long, prompt_tokens long").json(path)
    return log.select("paper_id", "attempt", "success", "error", "prompt", "response", "response_chars", "prompt_tokens")


def _stub_model():
    """Fails once for every fifth id, and always for every eleventh."""

    def model(row: dict) -> dict:
        models.note(prompt=f"Label this. {row['title']}", prompt_tokens=row["n_chars"])
        if row["doc_id"] % 11 == 0 or (row["doc_id"] % 5 == 0 and row["attempt"] == 0):
            raise ValueError("try again")
        models.note(response=row["lang"].upper())
        return {"label": row["lang"]}

    return model


_SAID = ("Vision", "search engine", "VLM system paper", "reinforcement agents", "LLM", "a dataset of cats", "cooking", "检索", "Audio things", "AI 系统 / 基础设施 (serving)")
_SAID_SQL = "CASE " + " ".join(f"WHEN doc_id % {len(_SAID)} = {i} THEN '{x}'" for i, x in enumerate(_SAID)) + " END"
_CHOICE_SQL = (
    "CASE " + " ".join(f"WHEN said = '{d}' THEN '{d}'" for d in rules.RESEARCH_OBJECTS) + " " + " ".join(f"WHEN contains(said, '{d}') OR contains('{d}', said) THEN '{d}'" for d in rules.RESEARCH_OBJECTS)
    + " " + " ".join(f"WHEN contains(lower(said), '{k}') THEN '{d}'" for k, d in rules.OBJECT_ALIASES.items()) + " END"
)


@query(f"""WITH a AS (SELECT doc_id, {_SAID_SQL} AS said, doc_id % 3 AS labels, CASE WHEN doc_id % 4 = 0 THEN 'negative' ELSE 'clearly positive' END AS tier FROM documents),
 c AS (SELECT *, {_CHOICE_SQL} AS object FROM a), ok AS (SELECT *, object IS NOT NULL AND (labels < 2 OR tier = 'negative') AS good FROM c)
 SELECT doc_id, good AS success, CASE WHEN good THEN object END AS object, CASE WHEN good AND labels = 1 AND tier <> 'negative' THEN '{rules.PREFERENCE_LABELS[1]}' WHEN good THEN '' END AS labels,
 CASE WHEN good THEN CASE WHEN tier = 'negative' THEN 'negative' ELSE 'positive' END END AS tier, CASE WHEN good THEN 1 ELSE 2 END::BIGINT AS attempts FROM ok""")
def q_choices(x):
    """Answers made from documents, parsed: choices by containment and alias, answers with two labels refused and asked for again."""
    said = F.element_at(F.array(*[F.lit(v) for v in _SAID]), (1 + F.col("doc_id") % len(_SAID)).cast("int"))
    labels = F.slice(F.array(F.lit(rules.PREFERENCE_LABELS[1]), F.lit(rules.PREFERENCE_LABELS[2])), F.lit(1), (F.col("doc_id") % 3).cast("int"))
    tier = F.when(F.col("doc_id") % 4 == 0, "negative").otherwise("clearly positive")
    answer = F.to_json(F.struct(said.alias("primary_research_object"), labels.alias("preference_labels"), tier.alias("negative_tier")))
    done = models.run_model(x.documents.select("doc_id", answer.alias("answer")), _parsing_model, "primary_research_object string, preference_labels array<string>, negative_tier string", partitions=8)
    return done.select("doc_id", "success", F.col("primary_research_object").alias("object"), F.array_join("preference_labels", "|").alias("labels"), F.col("negative_tier").alias("tier"), "attempts")


def _parsing_model():
    return lambda row: models.parse_annotation(row["answer"])


@query("""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id, (doc_id // 3)::VARCHAR AS i, (n_chars % 300)::VARCHAR AS f FROM documents),
 w AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ids, []::VARCHAR[] AS prints, NULL::VARCHAR AS reason
   UNION ALL SELECT n, CASE WHEN reason IS NULL THEN list_append(ids, i) ELSE ids END, CASE WHEN reason IS NULL THEN list_append(prints, f) ELSE prints END, reason
   FROM (SELECT r.n, i, f, ids, prints, CASE WHEN list_contains(ids, i) THEN 'duplicate_id' WHEN list_contains(prints, f) THEN 'duplicate_fingerprint' END AS reason FROM w JOIN r ON r.n = w.n + 1))
SELECT doc_id, reason FROM w JOIN r USING (n)""")
def q_dedupe_repeated_ids(x):
    """A walk in order over rows that share ids in threes and fingerprints widely: what is kept bars, what is dropped does not."""
    rows = x.documents.select("doc_id", F.floor(F.col("doc_id") / 3).cast("string").alias("paper_id"), (F.col("n_chars") % 300).cast("string").alias("fingerprint"))
    return dedupe.greedy(rows, "doc_id").select("doc_id", "reason")


@query(f"WITH {_DECON} SELECT doc_id, reason FROM c")
def q_blocked_index(x):
    """The same as q_decontaminate, by an index on disk that was added to twice."""
    p = x.papers.withColumn("fingerprint", dedupe.fingerprint(F.col("title"), F.col("abstract"))).select("doc_id", "paper_id", "source", "fingerprint")
    index = blocked.BlockedIndex(x.spark, new_path(x.spark, "blocked"), 8)
    index.add(p.filter(f"{_OLD} AND doc_id % 2 = 0"))
    index.add(p.filter(_OLD))
    return index.label(p.filter(f"NOT {_OLD}"), "doc_id").select("doc_id", "reason")


def _record(rows: DataFrame, tier: Column) -> DataFrame:
    none, text = F.array().cast("array<string>"), lambda c: F.col(c).cast("string")
    given = {"paper_id": text("doc_id"), "title": F.col("source"), "venue": F.col("lang"), "year": F.lit(2026), "primary_research_object": F.col("lang"), "candidate_negative_tier": tier}
    return rows.select(*[given.get(f.name, none if f.dataType.typeName() == "array" else F.lit("")).cast(f.dataType).alias(f.name) for f in schemas.RECORDS])


_AFTER = """WITH r AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN 'negative' WHEN doc_id % 5 = 0 THEN 'negative' ELSE 'positive' END AS tier FROM documents),
 a AS (SELECT * FROM r UNION ALL SELECT -1 - doc_id, 'xx', 'positive' FROM documents WHERE doc_id % 7 = 0)"""


@query(f"""{_AFTER} SELECT 'total' AS section, '' AS key, count(*)::BIGINT AS n FROM a UNION ALL SELECT 'object', lang, count(*) FROM a GROUP BY lang UNION ALL SELECT 'tier', tier, count(*) FROM a GROUP BY tier
 UNION ALL SELECT 'records', 'positive', count(*) FILTER (tier = 'positive') FROM a""")
def q_upsert_statistics(x):
    """Statistics of a benchmark after upserts, which follow from the new and the replaced rows' counts; all documents are its records, a third of them are replaced and some added."""
    root, d = files.SnapshotRoot(x.spark, new_path(x.spark, "root")), x.documents.select("doc_id", "lang", "source")
    first = {workflows.REC: _record(d, F.when(F.col("doc_id") % 5 == 0, "negative").otherwise("positive"))}
    none = {name: x.spark.createDataFrame([], schema) for name, schema in workflows.TABLES.items() if name != workflows.REC}
    root.commit(first | none, {"stats.json": workflows.stats(first | none)})
    changed = _record(d.filter("doc_id % 3 = 0"), F.lit("negative")).unionByName(_record(d.filter("doc_id % 7 = 0").withColumns({"doc_id": -1 - F.col("doc_id"), "lang": F.lit("xx")}), F.lit("positive")))
    workflows.commit_rows(root, workflows.load(root), {workflows.REC: changed})
    got = root.read_document("stats.json")
    rows = [("total", "", got["total_records"]), *(("object", k, n) for k, n in got["by_primary_research_object"].items()), *(("tier", k, n) for k, n in got["by_negative_tier"].items()), ("records", "positive", got["by_layer"]["records"]["positive"])]
    return x.spark.createDataFrame(rows, "section string, key string, n long")


@query("""WITH d AS (SELECT doc_id, lang, doc_id % 6 AS k FROM documents) SELECT doc_id, CASE k WHEN 0 THEN 'not an object' WHEN 1 THEN 'not JSON' WHEN 2 THEN 'negative_tier: odd' END AS problem,
 CASE WHEN k >= 2 THEN '{"own":{"n":[' || doc_id || ',null]},"paper_id":"' || doc_id || '","preference_labels":' || CASE WHEN k IN (3, 5) THEN '[]' ELSE '["' || lang || '"]' END || ',"negative_tier":"' || CASE k WHEN 2 THEN 'odd' WHEN 4 THEN 'positive' ELSE 'negative' END || '"}' END AS cleaned
 FROM d""")
def q_clean_objects(x):
    """Legacy rows of open schema: keys go, tiers are mapped, labels of negatives are emptied, and fields that nobody knows stay."""
    k, n = F.col("doc_id") % 6, F.col("doc_id").cast("string")
    tier = F.when(k == 2, "odd").when(k == 3, " hard ").when(k == 4, "positive").otherwise("easy")
    row = F.concat(F.lit('{"paper_id":"'), n, F.lit('","own":{"n":['), n, F.lit(',null]},"target_preference_labels":["x"],"preference_labels":["'), F.col("lang"), F.lit('"],"negative_tier":"'), tier, F.lit('"}'))
    lines = x.documents.select(F.when(k == 0, "[1]").when(k == 1, "{").otherwise(row).alias("value"), F.lit("f").alias("file"), F.col("doc_id").alias("line"))
    tiers = {v: "negative" for v in rules.LEGACY_NEGATIVE_TIERS} | {v: v for v in rules.TIERS}
    out = importer.clean_objects(lines, {"negative_tier": tiers}, emptied={"negative_tier": "preference_labels"})
    parts = [F.concat(F.lit(f'"{c}":'), F.get_json_object("cleaned", f"$.{c}")) for c in ("own",)] + [F.concat(F.lit('"paper_id":"'), F.get_json_object("cleaned", "$.paper_id"), F.lit('"')), F.concat(F.lit('"preference_labels":'), F.get_json_object("cleaned", "$.preference_labels")), F.concat(F.lit('"negative_tier":"'), F.get_json_object("cleaned", "$.negative_tier"), F.lit('"'))]
    legacy = F.coalesce(F.size(F.json_object_keys("cleaned")) != 4, F.lit(False))
    ordered = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return out.select(F.col("line").alias("doc_id"), "problem", F.when(legacy, "a legacy key is left").when(F.col("cleaned").isNotNull(), ordered).alias("cleaned"))


_TITLE = "split_part(text, chr(10), 1)"


@query(f"""SELECT doc_id, 'status=' || replace(url_encode(lang), '%20', '+') || '&q=' || replace(url_encode({_TITLE}), '%20', '+') || '&label=a%26b&label=%C3%A9+x' AS form, lang AS status, {_TITLE} AS q, 'a&b|é x' AS labels, 3::BIGINT AS names FROM documents""")
def q_forms(x):
    """Filters of a page as a URL's query, and read back: repeated names keep all their values, blank ones go."""
    d = x.documents.select("doc_id", "lang", F.substring_index("text", "\n", 1).alias("title"))
    form = F.concat_ws("&", forms.encode_form({"status": F.col("lang"), "q": F.col("title")}), F.lit("label=a%26b&label=%C3%A9+x"))
    read = d.withColumn("form", form).withColumn("m", forms.parse_form(F.concat(F.col("form"), F.lit("&split=&odd"))))
    return read.select("doc_id", "form", F.get(F.col("m")["status"], 0).alias("status"), F.get(F.col("m")["q"], 0).alias("q"), F.array_join(F.col("m")["label"], "|").alias("labels"), F.size("m").alias("names"))
