"""The pipeline on planted cases; ``test_pipeline_brute.py`` holds whole stages against brute-force versions."""

import random

import corpus_pipeline as cp


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8))) + (" the" if k % 5 == 0 else "") for k in range(n))


def test_planted_cases(spark, tmp_path):
    r = random.Random(9)
    item, passage = words(r, 14), words(r, 60)
    clean = [words(r, 80) for _ in range(12)]
    near = clean[0].split(" ")
    near[5] = "changed"
    rows = list(enumerate(clean)) + [
        (100, clean[1]), (101, " ".join(near)), (102, words(r, 50) + " " + passage), (103, words(r, 50) + " " + passage), (104, words(r, 60) + " " + item + " " + words(r, 60)),
        (105, "%%% " * 40), (106, "short"), (107, None),
    ]
    more = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], more).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, at = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in cp.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        at[name] = docs.collect()
    ids = lambda name: {x.doc_id for x in at[name]}
    everything = {i for i, _ in rows}
    assert ids("quality_rules") == everything - {105, 106, 107}
    assert ids("minhash_near_dedup") == everything - {105, 106, 107, 100, 101}
    texts = {x.doc_id: x.text for x in at["suffix_array_dedup"]}
    assert passage in texts[102] and passage not in texts[103] and all(texts[i] == clean[i] for i in range(12))
    final = {x.doc_id: x for x in at["benchmark_decontamination"]}
    assert item in texts[104] and item not in final[104].text and final[104].n_chars == len(final[104].text)
    assert all(final[i].text == clean[i] for i in range(12))
    assert at["benchmark_decontamination"][0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    run = cp.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(x)[:5] for x in run) == sorted(tuple(x)[:5] for x in at["best_fit_packing"])
    assert {x.doc_id for x in run} == set(final)


def test_repeated_rows(spark, tmp_path):
    text = words(random.Random(2), 60)
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, text, "y")], "doc_id long, text string, extra string")
    got = cp.near_dedup(spark, df, "")
    assert sorted((x.doc_id, x.extra) for x in got.collect() if x.doc_id) == [(1, "x")] and got.count() == 2


def test_pairs_from_80_percent_are_near_copies(spark):
    r = random.Random(6)
    base = [f"w{r.randrange(10**6)}" for _ in range(204)]  # 200 shingles
    rows = []
    for i, changes in enumerate((4, 5)):  # apart by 5 shingles a change: 180 of 220 are shared (0.818), 175 of 225 (0.778)
        other = [f"{i}{w}" for w in base]
        rows += [(10 * i, " ".join(other)), (10 * i + 1, " ".join("changed" + w if k % 40 == 20 and k // 40 < changes else w for k, w in enumerate(other)))]
    got = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {x.doc_id for x in got.collect()} == {0, 10, 11}


def test_different_texts_of_one_id_stay(spark):
    r = random.Random(3)
    a, b, c = (words(r, 60) for _ in "abc")
    near = a.split(" ")
    near[5] = "changed"
    rows = [(1, a, "x"), (4, a, "x"), (4, b, "z"), (4, b, "y"), (4, " ".join(near), "x"), (9, b, "x"), (9, c, "x"), (9, None, "x"), (9, None, "x"), (None, a, "x")]
    for n in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(n)
        got = sorted(map(tuple, cp.near_dedup(spark, df, "").collect()), key=str)
        assert got == sorted([(1, a, "x"), (4, b, "y"), (9, c, "x"), (9, None, "x"), (None, a, "x")], key=str)


def test_repeats_are_cut_row_by_row_where_ids_repeat(spark):
    r = random.Random(8)
    passage, a, b, c = (words(r, 40) for _ in "abcd")
    rows = [(1, passage), (4, a + " " + passage), (4, b), (4, c + passage), (4, c + passage), (None, passage)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = [tuple(x) for x in cp.suffix_array_dedup(spark, df, "").collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    texts = sorted(t.strip() for i, t, _ in got if i == 4)
    assert texts == sorted([a, b, c, c]) and {t for i, t, _ in got if i != 4} == {passage}
