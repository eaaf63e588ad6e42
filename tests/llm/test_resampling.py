"""Importance resampling against a plain count of every n-gram."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from curatrix.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def grams(text, n_max):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, n_max=1, n_buckets=10_000, percent=10, min_words=20, seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % n_buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(x, n_max)) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + n_buckets) / ((s[b] + 1) * (total_t + n_buckets))))
    out = []
    for k, text in docs:
        found = [gain(bucket(g)) for g in grams(text, n_max)]
        weight = sum(found) // len(found) if found else 0
        score = None
        if k is not None:
            h = int(hashlib.sha256(f"{seed}:{k}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([k, len(found), weight, score, None, len(words(text))])
    able = sorted((x for x in out if x[5] >= min_words and x[0] is not None), key=lambda x: (-x[3], x[0]))
    for i, x in enumerate(able[: percent * len(able) // 100]):
        x[4] = i + 1
    return sorted(map(str, (tuple(x[:5]) for x in out)))


def corpus(r, n):
    pool = [f"w{i}" for i in range(60)] + ["Ünï", "中文", "A1", "don't", "x_y"]
    texts = [" ".join(r.choices(pool, k=r.randrange(0, 70))) for _ in range(n)]
    return texts + [None, "", " \n", "UPPER upper Upper", "same same same same " * 30, "long words here " * 4000]


def test_runs_are_the_ngrams():
    r = random.Random(3)
    texts = corpus(r, 20)
    found, counts = resampling.ngram_buckets(pa.array(texts), 4, 997)
    assert counts.tolist() == [len(words(x)) for x in texts]
    ends = np.cumsum(counts)
    for n in range(1, 5):
        for text, a, b in zip(texts, ends - counts, ends, strict=True):
            w = words(text)
            want = [zlib.crc32(" ".join(w[i : i + n]).encode()) % 997 if i + n <= len(w) else -1 for i in range(len(w))]
            assert found[n - 1][a:b].tolist() == want


def test_resample_against_plain_counts(spark):
    r = random.Random(4)
    texts = corpus(r, 150)
    docs = [(i * 7 % 1009, x) for i, x in enumerate(texts)] + [(None, texts[0] + " more " * 30)]
    target = ["w1 w2 w3 w1", None, "", "w5 Ünï w9 " * 20]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).withColumn("_i", F.lit(2)).repartition(6)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    for kw in ({}, {"n_max": 3, "n_buckets": 101, "percent": 35, "min_words": 5, "seed": 7}, {"percent": 100, "min_words": 0}, {"percent": 0}):
        got = resampling.resample(df, goal, **kw)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(str(tuple(x)) for x in got.collect()) == brute(docs, target, **kw)


def test_repeated_ids_and_rows(spark):
    """Rows that share an id get ranks of their own, however many there are."""
    docs = [(1, "a b c d e f")] * 300 + [(k, f"a b c d e {k}") for k in range(2, 120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([("a b",)], "text string")
    got = resampling.resample(df, goal, percent=50, min_words=3)
    rows = got.collect()
    assert len(rows) == len(docs) and sorted(x.rank for x in rows if x.rank) == list(range(1, len(docs) // 2 + 1))
    assert sorted(str(tuple(x)) for x in rows) == brute(docs, ["a b"], percent=50, min_words=3)
    assert resampling.drawn(df, got).select("doc_id").distinct().count() == len({x.doc_id for x in rows if x.rank})


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two three " * 10)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert [tuple(x) for x in resampling.resample(some, none, percent=100).collect()] == [eval(x) for x in brute([(1, "one two three " * 10)], [], percent=100)]


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "one two " * 20), ("a", "one two " * 20)], "doc_id string, text string")
    got = {x.doc_id: x.rank for x in resampling.resample(df, df.select("text"), percent=100).collect()}
    assert sorted(got.values()) == [1, 2]
