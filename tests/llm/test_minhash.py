"""MinHash near-dedup against all pairs of full sets."""

import random
import re

import pytest

from curatrix.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent=85):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), d == find(d)) for d in sets}


def collected(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def corpus(seed, n_bases=12, copies=12):
    r = random.Random(seed)
    rows, words = [], [f"w{i}" for i in range(400)]
    for _ in range(n_bases):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 30, 120, 300]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((len(rows) * 3 + 1, r.choice([" ", "\n", "\t "]).join(text)))
    r.shuffle(rows)
    return rows + [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "One Two"), (9004, "one two"), (9005, "é ß \xa0 x")]


@pytest.mark.parametrize("block", [minhash.BLOCK, 600])
def test_against_all_pairs(spark, block):
    rows = corpus(block)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block=block)
    assert collected(got) == brute(rows)


def test_one_large_group_split_over_blocks(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(80)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(r.choice([1, 2, 3])):
            text[r.randrange(80)] = f"x{r.randrange(9)}"
        rows.append((i, " ".join(text)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=900)
    assert collected(got) == brute(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 2), (None, "a b c d e f", 3), (2, "a b c d e f", 4), (7, "other words are here now", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label long").selectExpr("doc_id", "text", "label", "label as rep", "label as component", "text as block")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 2, False), (5, 2, 2, False), (None, 2, None, True), (2, 2, 2, True), (7, 1, 7, True)], key=str)


def test_one_id_for_two_texts(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    df = spark.createDataFrame([(1, a), (4, a), (4, b), (9, b)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} <= {1, 4}


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_candidates_are_found_at_the_threshold():
    import numpy as np

    rng = np.random.default_rng(3)
    missed = 0
    for n in (7, 40, 400):
        for _ in range(60):
            shared, only = int(n * 0.85) or 1, n - int(n * 0.85)
            x = rng.integers(0, 1 << 63, shared + 2 * only, dtype=np.uint64)
            a, b = np.sort(x[: shared + only // 2]), np.sort(np.concatenate([x[:shared], x[shared + only :][: only - only // 2]]))
            s = minhash.bands(minhash.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
            missed += not (s[0] == s[1]).any()
    assert missed == 0


@pytest.mark.parametrize("percent, want", [(85, (25, 5)), (80, (32, 4)), (50, (64, 2)), (30, (128, 1))])
def test_bands_follow_the_threshold(percent, want):
    assert minhash.banding(percent) == want


def test_against_all_pairs_at_80_percent(spark):
    rows = corpus(80)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent=80)
    assert collected(got) == brute(rows, 80) != brute(rows)
