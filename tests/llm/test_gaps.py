"""Empty tables, ties and repeated rows of operators whose other tests do not have them."""

import corpus_pipeline
from pyspark.sql import functions as F

from curatrix.llm import chat, decontamination as dc, lengths, queries, quality

DOCS = "doc_id long, text string"


def test_lengths_of_nothing(spark):
    assert lengths.suffix_sums(lengths.length_histogram(spark.createDataFrame([], "text string"))).collect() == []


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    none = spark.createDataFrame([], DOCS)
    assert dc.occurrences(none, items).collect() == [] and dc.cut_documents(none, items).collect() == []
    some = spark.createDataFrame([(1, "a b c"), (2, None)], DOCS)
    got = dc.occurrences(some, items.limit(0)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in got) == [(1, 3, 0), (2, 0, 0)]


def test_equal_turns(spark):
    """Turns that tie are ordered by role and text, and repeated rows are turns of their own."""
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (1, 0, "user", "a")]
    back = chat.read_back(chat.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))).collect()
    longest = max(back, key=lambda r: len(r.turns))
    assert [(t.role, t.text) for t in longest.turns] == [("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")]


def test_quality_of_repeated_rows(spark):
    text = "The way that this is written is how a page of plain prose in the language would be, with its own words and no noise at all in it."
    df = spark.createDataFrame([(1, text), (1, text), (1, "x"), (2, text)], DOCS)
    got = quality.quality(df)
    q = F.col(got.columns[-1])
    assert sorted((r.doc_id, r.kept) for r in got.select("doc_id", q["kept"].alias("kept")).collect()) == [(1, False), (1, True), (1, True), (2, True)]


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert queries.op12_importance_resampling(spark, str(tmp_path)).collect() == []
