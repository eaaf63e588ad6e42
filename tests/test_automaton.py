"""The term automaton against a plain search for each term."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curatrix.functions import automaton as au, rules, text as t
from curatrix.operators import scoring

TEXTS = [None, "", "a", "he she his hers ushers", "KV Cache kv cache", "é中文é中", "x" * 5000, "ab" * 3000 + "needle" + "ab" * 3000, "中" * 2000 + "末尾"]
TERMS = ("he", "she", "his", "hers", "needle", "ab", "aba", "kv cache", "中文", "中", "末尾", "é", "xxxx", "zz", "x" * 40)


def test_bitmaps_are_the_contained_terms(monkeypatch):
    for lane in (7, au.LANE):
        monkeypatch.setattr(au, "LANE", lane)
        machine = au.Terms(TERMS).automaton
        for step in (1, 8_000_000):
            monkeypatch.setattr(au, "STEP", step)
            got = machine.column(pa.array(TEXTS)).to_pylist()
            assert [{x for i, x in enumerate(TERMS) if row[i // 64] >> i % 64 & 1} for row in got] == [{x for x in TERMS if x in (text or "")} for text in TEXTS]
    assert machine.column(pa.array(TEXTS).slice(3, 4)).to_pylist() == got[3:7]
    assert machine.column(pa.array([], pa.string())).to_pylist() == []


def test_many_random_terms():
    r = random.Random(8)
    word = lambda n: "".join(r.choices("abc", k=n))
    terms = list(dict.fromkeys(word(r.randrange(1, 7)) for _ in range(300)))
    texts = [word(r.randrange(0, 3000)) for _ in range(30)]
    got = au.Automaton([x.encode() for x in terms]).column(pa.array(texts)).to_pylist()
    for row, text in zip(got, texts, strict=True):
        assert [row[i // 64] >> i % 64 & 1 for i in range(len(terms))] == [int(x in text) for x in terms]


def test_found_asks_like_a_haystack(spark):
    df = spark.createDataFrame([(x,) for x in TEXTS if x is not None], "h string")
    found = au.Terms(TERMS, [f"t{i}" for i in range(200)])
    df = df.withColumn("b", found.bits(F.col("h")))
    for terms in ((), TERMS, ("he", "he", "she", "t7", "he"), ("t199", "中文"), ("xxxx", "x" * 40)):
        for ask in (t.hits, t.any_of, t.all_of, t.matched):
            assert df.filter(~ask(F.col("h"), terms).eqNullSafe(ask(found.on("b"), terms))).count() == 0
    with pytest.raises(ValueError, match="empty"):
        au.Terms(["a", ""])


def test_scores_of_the_rules_are_the_same(spark):
    """Every rule of the library, on texts made of its own terms."""
    r = random.Random(2)
    texts = [" ".join(r.choices(scoring.TERMS.terms, k=r.randrange(0, 25))) for _ in range(150)]
    df = spark.createDataFrame([(x,) for x in texts], "h string").withColumn("b", scoring.TERMS.bits(F.col("h")))
    h, b = F.col("h"), scoring.TERMS.on("b")
    for ask in (scoring.term_score, scoring.matched_terms, scoring.group_score, scoring.matched_groups, scoring.research_object, lambda x: scoring.best_label(scoring.label_scores(x)), lambda x: t.hits(x, rules.OBJECT_RULES[0][1].split())):
        assert df.filter(~ask(h).eqNullSafe(ask(b))).count() == 0


def test_time_does_not_follow_the_number_of_terms():
    r = random.Random(6)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(6, 12)))
    texts = pa.array([" ".join(word() for _ in range(300)) for _ in range(2000)])

    def seconds(n):
        machine = au.Automaton(list({word().encode() for _ in range(n)}))
        times = []
        for _ in range(3):
            began = time.process_time()
            machine.column(texts)
            times.append(time.process_time() - began)
        return min(times)

    assert seconds(500) < 4 * seconds(50)
