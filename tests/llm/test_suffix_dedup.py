"""Removal of repeated byte strings against a dictionary of all of them."""

import hashlib
import random

import numpy as np
import pytest

from curatrix.llm import suffix_dedup as sd


def brute(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - length + 1):
                w = b[i : i + length]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **kw)
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()], key=str)


def corpus(seed):
    r = random.Random(seed)
    words = ["the", "of", "éa", "and", "ß", *("".join(r.choice("abcdeé") for _ in range(r.randrange(2, 8))) for _ in range(60))]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(n) for n in (12, 20, 60)]
    rows = []
    for i in range(60):
        parts = [text(r.randrange(1, 60))]
        for _ in range(r.randrange(3)):
            parts.insert(r.randrange(len(parts) + 1), r.choice(passages))
        if rows and r.random() < 0.4:
            old = list(r.choice(rows)[1].split(" "))
            for _ in range(r.randrange(3)):
                old[r.randrange(len(old))] = r.choice(words)
            parts = [" ".join(old)]
        rows.append((i * 7 % 61, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 300), (103, "ab" * 40 + "a" * 120), (104, "a" * 49), (105, "a" * 50), (3, "a" * 200), (106, "é" * 60), (107, "x" + "é" * 60)]
    rows += [(None, rows[0][1]), (None, "a" * 300), (5, rows[1][1]), (5, rows[1][1]), (400, rows[1][1])]
    return rows


@pytest.mark.parametrize("bucket", [sd.BUCKET_BYTES, 4000])
def test_against_all_strings(spark, bucket):
    rows = corpus(bucket)
    assert got(spark, rows, bucket_bytes=bucket) == brute(rows)


@pytest.mark.parametrize("bucket", [sd.BUCKET_BYTES, 4000])
def test_anchors_that_are_dealt_anew(spark, bucket, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 3)
    rows = corpus(bucket + 1) + [(200 + i, f"{i * 77777} before a line that is in every document, whatever is around it, and {i * 55555} after") for i in range(40)]
    assert got(spark, rows, bucket_bytes=bucket) == brute(rows)


def test_many_copies(spark):
    rows = [(i, "some common passage that every one of these documents holds, word by word. " * (1 + i % 2) + str(i)) for i in range(80)]
    assert got(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert got(spark, []) == []
    df = spark.createDataFrame([(1, "a" * 60, 5), (2, "a" * 60, 6)], "doc_id long, text string, bucket long").selectExpr("*", "bucket as kind", "text as blob")
    assert {(r.doc_id, r.n_removed) for r in sd.remove_repeats(df).collect()} == {(1, 0), (2, 60)}


def test_blind_trie_orders_and_groups():
    r = random.Random(2)
    keys = ["".join(r.choice("ab") for _ in range(12)).encode() for _ in range(400)]
    trie = sd.BlindTrie()
    for i, k in enumerate(keys):
        trie.insert(k, i)
    leaves = list(trie.leaves())
    assert [k for k, _ in leaves] == sorted(set(keys))
    assert sorted(i for _, m in leaves for i in m) == list(range(400))
    assert all(keys[i] == k for k, m in leaves for i in m)


def test_sorting_finds_later_copies_at_any_depth():
    r = random.Random(6)
    stems = ["".join(r.choice("ab") for _ in range(n)) for n in (8, 16, 31, 33, 47)]
    texts = [r.choice(stems) + "".join(r.choice("ab") for _ in range(r.randrange(50, 60))) for _ in range(150)] + [r.choice(stems) * 7 for _ in range(50)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(x) for x in texts])
    starts = np.concatenate([np.arange(e - len(x), e - 49) for x, e in zip(texts, ends, strict=True)])
    owner = np.searchsorted(ends, starts, side="right") // 2
    order = np.array(r.sample(range(len(starts)), len(starts)))
    first = {}
    for s, o in zip(starts, owner, strict=True):
        first[data[s : s + 50].tobytes()] = min(o, first.get(data[s : s + 50].tobytes(), o))
    want = [first[data[s : s + 50].tobytes()] < o for s, o in zip(starts[order], owner[order], strict=True)]
    assert sd.later_copies(data, starts[order], 50, owner[order]).tolist() == want and 0 < sum(want) < len(want)


def test_equal_hashes_are_no_proof(spark, monkeypatch):
    """Runs that only hash alike stay apart: the bytes decide."""
    found = sd.runs
    monkeypatch.setattr(sd, "runs", lambda *a: (lambda x: (x[0] * 0, x[1] * 0, *x[2:]))(found(*a)))
    r = random.Random(8)
    rows = [(i, "".join(r.choice("abcd") for _ in range(120)) + "the same passage in all of these documents, over and over. " * (i % 3)) for i in range(12)]
    texts = [t.encode() for _, t in rows]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    anchor, run, value, start, count = sd.runs(data, offsets, 50)
    held = [(np.arange(12), np.zeros(12, np.uint32), anchor, run, value, start, count, data, offsets[:-1])]
    for bucket, kind, blob in sd._send(held, 50, 2, 2):
        if kind == sd.REMOVED:
            docs, _, starts, counts = sd.load(blob[8:])
            for d, s, c in zip(np.cumsum(docs), starts, counts, strict=True):
                assert any(texts[d][s : s + c + 49] in t for t in texts[:d])


def test_dump_and_load():
    arrays = [np.arange(1000, dtype=np.int64), np.random.default_rng(1).integers(0, 255, 99).astype(np.uint8), np.zeros(0, np.uint32)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, sd.load(sd.dump(*arrays)), strict=True))


def test_kept_text_leaves_whole_characters():
    whole = "aéb".encode()
    assert sd.kept_text(whole, np.array([False, True, False, True])) == "aé"
    assert sd.kept_text(whole, np.array([True, True, True, False])) == "b"


@pytest.mark.parametrize("length", [255, 256, 300])
def test_long_strings(spark, length):
    """Runs of as many windows as a string has bytes, below and above what a byte counts."""
    r = random.Random(length)
    shared = "".join(r.choices("abcdefgh ", k=length * 2 + 60))
    rows = [(1, shared[: 2 * length - 45]), (2, shared[: 2 * length - 45]), (3, "x" + shared), (4, shared[30 : 30 + length]), (5, shared[30 : 29 + length]), (6, "".join(r.choices("xyz", k=700)))]
    assert got(spark, rows, length=length) == brute(rows, length)
