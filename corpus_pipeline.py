"""The corpus pipeline: quality rules, near-dedup, suffix-array dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of ``documents``; where a stage changes texts, ``n_chars``
follows. The last returns packed pieces: doc_id, piece, start, length, ids_crc32,
sequence_id, offset.

Null and empty texts fail the quality rules' least length; later stages, by themselves,
treat a null text as an empty one. Rows with a null doc_id pass stages that need an id
unchanged. Repeated rows stay repeated but for near-dedup, which keeps one row of each
doc_id and text; of copies that tie, the smallest id stays. Extra columns of ``documents``
are carried along up to packing, whatever their names but for ``_text_id`` and ``_digest``.
Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import decontamination, minhash, packing, quality, suffix_dedup
from curatrix.llm.common import files_for, reachable, scratch_path, written

#: Similarity in percent from which texts are near copies; op1's 85 is its own.
NEAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.kept_documents(docs).coalesce(files_for(docs))


def _ids_repeat(docs: DataFrame) -> bool:
    return bool(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").head(1))


def _with_text_ids(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that have an id, with ``_text_id``: one for each doc_id and text, in the order of doc_id, then the text's digest."""
    keyed = docs.filter("doc_id IS NOT NULL").withColumn("_digest", F.coalesce(F.sha2("text", 256), F.lit("")))
    ids = keyed.select("doc_id", "_digest").distinct().repartitionByRange("doc_id", "_digest").sortWithinPartitions("doc_id", "_digest")
    ids = written(ids.withColumn("_text_id", F.monotonically_increasing_id()), "text_ids")
    return written(keyed.join(ids, ["doc_id", "_digest"]).drop("_digest"), "texts")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity of 0.8 or more) stays, that of the smallest id.

    Different texts that share an id are judged as documents of their own; of rows that share
    id and text the least by the other columns stays.
    """
    reachable(spark)
    if not _ids_repeat(docs):
        return _first_of_near_copies(docs, "doc_id").coalesce(files_for(docs))
    row = F.struct(*docs.columns)
    one = _with_text_ids(docs).groupBy("_text_id").agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_text_id", "_row.*")
    kept = _first_of_near_copies(written(one, "texts"), "_text_id").select(*docs.columns)
    return kept.union(docs.filter("doc_id IS NULL"))


def _first_of_near_copies(docs: DataFrame, key: str) -> DataFrame:
    judged = minhash.near_duplicates(docs, doc_id=key, percent=NEAR)
    gone = judged.filter(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)


def _with_texts(docs: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``docs`` with the texts of ``changed`` (key, new_text) where it has any; its n_chars follows."""
    row = docs.select(F.col(key), F.struct(*docs.columns).alias("row")).join(changed, key, "left")
    new = F.col("new_text")
    put = {"text": F.coalesce(new, "row.text")} | ({"n_chars": F.when(new.isNotNull(), F.length(new).cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {})
    return row.select(*[put.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 50 that start in an earlier document are cut; documents of which nothing is left go.

    Different texts that share an id are documents of their own.
    """
    reachable(spark)
    repeat = _ids_repeat(docs)
    rows, key = (_with_text_ids(docs), "_text_id") if repeat else (docs, "doc_id")
    cut = suffix_dedup.remove_repeats(rows, doc_id=key, keep_text=True).filter("n_removed > 0").select(F.col("doc_id").alias(key), F.col("kept_text").alias("new_text"))
    if repeat:  # rows that share id and text lose the same
        cut = cut.dropDuplicates([key])
    out = _with_texts(rows, cut, key).select(*docs.columns)
    if repeat:
        out = out.union(docs.filter("doc_id IS NULL"))
    return out.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).coalesce(files_for(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are more than half benchmark go."""
    return decontamination.cut_documents(docs, reachable(spark).read.parquet(f"{sf_dir}/benchmark.parquet")).coalesce(files_for(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    reachable(spark)
    return packing.pack_documents(docs).coalesce(files_for(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenization and packing are none of SQL's; ``test_pipeline_brute.py`` holds ``run`` and each stage against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's docs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
