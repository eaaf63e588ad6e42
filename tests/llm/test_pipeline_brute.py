"""Each stage's whole output, and ``run``'s pieces, against brute-force versions in plain Python."""

import random
import unicodedata
import zlib

import numpy as np
from test_minhash import WORD, brute as near_copies
from test_rows import brute_quality

import corpus_pipeline as cp
from curatrix.llm import quality, tokens

STOP = set(quality.STOP_WORDS)


def passes(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    n_words, word_chars, n_symbols, n_dup_lines, _, base_failed = brute_quality(t)
    letters = [c for c in t if unicodedata.category(c)[0] == "L"]
    ratios = {
        "mean_word_chars": (word_chars, n_words), "symbol_ratio": (n_symbols, word_chars), "exclamation_ratio": (t.count("!"), n_words), "upper_ratio": (sum(unicodedata.category(c) == "Lu" for c in letters), len(letters)),
        "letter_word_ratio": (sum(any(unicodedata.category(c)[0] == "L" for c in x) for x in w), n_words), "stop_word_ratio": (sum(x.lower() in STOP for x in w), n_words), "dup_line_ratio": (n_dup_lines, len(lines)),
    }
    for r in quality.RULES:
        a, b = ratios[r.metric]
        if b and n_words >= r.min_words and ((r.low is not None and a / b < r.low) or (r.high is not None and a / b > r.high)):
            return False
    return not base_failed


def without_repeats(rows, length=50):
    """Every string of so many bytes that starts in a smaller id is cut; characters stay whole."""
    seen, out = {}, []
    for i, t in rows:
        b = t.encode()
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            seen[s] = min(seen.get(s, i), i)
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept, at = [], 0
        for c in t:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        if WORD.search("".join(kept)):
            out.append((i, "".join(kept)))
    return out


def folded(text):
    """(word, start, end) in characters; words are runs of letters and digits of ASCII, and of all else beyond it."""
    out, start = [], None
    for k, c in enumerate(text + " "):
        inside = ord(c) > 127 or c.isalnum()
        if inside and start is None:
            start = k
        elif not inside and start is not None:
            out.append(("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text[start:k]), start, k))
            start = None
    return out


def without_benchmark(rows, items, window=10):
    by_size = {}
    for item in items:
        v = [x[0] for x in folded(item or "")]
        n = min(len(v), window)
        if n:
            by_size.setdefault(n, set()).update(tuple(v[k : k + n]) for k in range(len(v) - n + 1))
    out = []
    for i, t in rows:
        w = folded(t)
        hit = [False] * len(w)
        for n, grams in by_size.items():
            for k in range(len(w) - n + 1):
                if tuple(x[0] for x in w[k : k + n]) in grams:
                    hit[k : k + n] = [True] * n
        if 2 * sum(hit) > len(w):
            continue
        kept, at, k = [], 0, 0
        while k < len(w):
            if hit[k]:
                kept.append(t[at : w[k][1]])
                while k < len(w) and hit[k]:
                    at = w[k][2]
                    k += 1
            else:
                k += 1
        out.append((i, "".join(kept) + t[at:]))
    return out


def token_pieces(rows, capacity=4096):
    tok, out = tokens.ChunkTokenizer().tokenizer, []
    for i, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        out += [(i, k, a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]
    return out


def test_stages_against_brute_force(spark, tmp_path):
    given = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [x.text for x in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
    r, top, planted = random.Random(4), max(x[0] for x in given) + 1, []
    for k in range(6):  # pairs of 200 shingles, 4 changes apart: similarity 0.82
        base = " ".join(("the " if j % 6 == 0 else "") + "".join(r.choice("aeioustnr") for _ in range(6)) for j in range(175)).split()[:204]
        near = [x + "q" if j % 45 == 20 and j // 45 < 4 else x for j, x in enumerate(base)]
        planted += [(top + 2 * k, " ".join(base)), (top + 2 * k + 1, " ".join(near))]
    edge = "é中" * 20 + " the passage of the page is here "
    more = [(top + 20 + k, " ".join("".join(r.choice("abcdé") for _ in range(5)) + " the" for _ in range(30)) + " " + edge) for k in range(3)]
    given += [(i, t, "en", "planted", len(t)) for i, t in planted + more]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = sorted((x[:2] for x in given), key=lambda x: x[0])
    want = {"quality_rules": [x for x in rows if passes(x[1])]}
    kept = near_copies(want["quality_rules"], 80)
    want["minhash_near_dedup"] = [x for x in want["quality_rules"] if kept[x[0]][2]]
    want["suffix_array_dedup"] = without_repeats(want["minhash_near_dedup"])
    want["benchmark_decontamination"] = without_benchmark(want["suffix_array_dedup"], items)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in cp.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = docs.collect()
        assert sorted((x.doc_id, x.text) for x in got) == want[name], name
        before = {x[0]: x for x in given}
        assert all(x.n_chars == (len(x.text) if x.text != before[x.doc_id][1] else before[x.doc_id][4]) and x.lang == before[x.doc_id][2] for x in got)
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(x)[:5] for x in pieces) == sorted(token_pieces(want["benchmark_decontamination"]))
    filled = {}
    for x in sorted(pieces, key=lambda x: (x.sequence_id, x.offset)):
        assert filled.get(x.sequence_id, 0) == x.offset
        filled[x.sequence_id] = x.offset + x.length
    assert max(filled.values()) <= 4096
    ids = {x[0] for x in want["minhash_near_dedup"]}
    assert all((i in ids) == ((i - top) % 2 == 0) for i, _ in planted)
    assert all(want[a] != want[b] for a, b in zip(list(want), list(want)[1:], strict=False))
