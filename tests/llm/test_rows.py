"""Operators that work row by row: quality, chat, WARC, HTML, tokens, decontamination, sharding, packing."""

import base64
import hashlib
import json
import random
import re
import time
import zlib
from html.parser import HTMLParser
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import chat, decontamination as dc, html, lengths, packing, quality, sharding, tokens, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "one two", "a b c d e a b c d e", "x " * 400, "the of and " * 7 + "\nsame line\nsame line\n\n", "Ünïcode ß 中文 word #tag $5 <b> | & %", "W" * 30_000, "a b c d e f " + " ".join(map(str, range(3000)))]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def brute_quality(t):
    t = t or ""
    w = WORD.findall(t)
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {i + k for i in range(len(w) - 4) if g[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)


def test_quality(spark):
    df = docs(spark, TEXTS).withColumn("quality", F.lit(1)).withColumn("row", F.lit("r")).withColumn("q_quality", F.lit(2))
    got = quality.quality(df)
    assert got.columns[:-1] == df.columns and got.columns[-1] == "q_quality_"
    for r in got.collect():
        q = r["q_quality_"]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute_quality(r.text)
    assert quality.kept_documents(df).columns == df.columns
    assert quality.quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_quality_keeps_prose_and_drops_junk(spark):
    prose = "The way that this is written is how a page of plain prose in the language would be, with its own words and no noise at all in it."
    junk = [" ".join(f"word{i}%%%" for i in range(30)), " ".join(f"WORD{chr(65 + i % 26)}X!!" for i in range(30)), "same " * 50, "short one"]
    got = {r.doc_id for r in quality.kept_documents(docs(spark, [prose, *junk])).collect()}
    assert got == {0}


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\s", "<s>\\</s>", "<\\s>", "[/INST]", None, "", "é\n\n"]
    r = random.Random(1)
    rows = [(c, i, r.choice(["user", "assistant", "system", None, "a[/INST]b"]), r.choice(nasty)) for c in range(12) for i in range(r.randrange(1, 7))] + [(None, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    ex = chat.chat_examples(df)
    back = chat.read_back(ex).collect()
    for c in {x[0] for x in rows}:
        turns = [(role or "", text or "") for _, _, role, text in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        mine = sorted((b for b in back if b.conv_id == c), key=lambda b: b.example)
        assert max(([tuple(t) for t in b.turns] for b in mine), key=len) == turns
        assert [b.loss_text for b in mine if b.target_turn >= 0] == [text for role, text in turns if role == "assistant"]
        assert all([tuple(t) for t in b.turns] == turns[: b.target_turn + 1] for b in mine if b.target_turn >= 0)
    assert chat.chat_examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/", "<p>x</p>"), (2, "http://b/ c\n", "<p>x</p>"), (3, None, "é" * 5000), (4, "u", None), (5, "u", ""), (6, "u", "WARC/1.1\r\n\r\nz\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.0\r\n"), (None, "n", "<p>x</p>"), (7, "r", "same"), (7, "r", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    warc.write_archives(df, str(tmp_path / "w"))
    got = sorted(map(tuple, warc.read_archives(spark, str(tmp_path / "w")).collect()), key=str)
    digest = lambda x: base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode()
    want = []
    for i, u, h in pages:
        first = min(j for j, _, g in pages if j is not None and (g or "") == (h or ""))
        kind = "response" if i == first else "revisit"
        want.append((i, None if u is None else re.sub(r"[\x00-\x20\x7f]", "%20", u), kind, len((h or "").encode()), digest(h), None if kind == "response" else first, (h or "") if kind == "response" else None))
    assert got == sorted(want, key=str)
    warc.write_archives(df, str(tmp_path / "small"), archive_bytes=3000)
    assert len(list((tmp_path / "small").glob("*.gz"))) > len(list((tmp_path / "w").glob("*.gz")))
    assert sorted(map(tuple, warc.read_archives(spark, str(tmp_path / "small")).collect()), key=str) == got
    warc.write_archives(df.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).collect() == []
    small = warc.resolve(df, min_bytes=100).filter("record_type = 'revisit'").count()
    assert small == 0


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text only, no tags.", "plain text only, no tags."),
    ("<article><h1>T</h1><p>a &amp; b<p>c\n  d<ul><li>x<li>y</ul></article><footer>f</footer>", "T\na & b\nc d\nx\ny"),
    ("<nav>menu</nav><div class='ad'>buy</div>", ""),
    ("<article><p>one<script>var a='<p>no</p>';</script> two<style>p{}</style></p><form>no</form><div class='cookie-notice'>no</div><section id=comments><p>no</p></section></article>", "one two"),
    ("<article><p>unclosed <b>bold<p>next<!-- c --></article><aside>no</aside>", "unclosed bold\nnext"),
    ("<main><p>m&#233;&nbsp;x</p></main><header>no</header>", "mé x"),
    ("<div class=content><p>Long text, with many words; and marks. It goes on.</p><p>Short.</p></div><div id=sidebar>s</div>", "Long text, with many words; and marks. It goes on.\nShort."),
])
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_main_text_judges_paths_inside_and_outside_an_article():
    story = "It was a long story, told in many words; it went on and on, as stories do. Then it went on some more, and more, until at last it came to its end. " * 3
    teaser = "<section><article><h3>Other</h3><p>teaser</p></article></section>"
    assert html.main_text(f"<div><p>{story}</p></div>{teaser}") == story.strip()
    assert html.main_text(f"<article><p>{story}</p></article><div><p>Short link</p></div>") == story.strip()
    links = "".join(f"<li>tag{i % 9}" for i in range(300))
    assert html.main_text(f"<article><h1>Title</h1><p>{story}</p><p>{story}</p></article>") == "\n".join(["Title", story.strip(), story.strip()])
    assert html.main_text(f"<article><p>{story}</p><ul>{links}</ul></article>") == story.strip()


class Brute(HTMLParser):
    """Blocks of a well-formed page: path with classes, article number, role weight, text outside links, text."""

    def __init__(self, page):
        super().__init__()
        self.path, self.found, self.text, self.link, self.articles = [], [], [], 0, 0
        self.feed(page)
        self.block()

    def block(self):
        words = " ".join("".join(x for x, _ in self.text).split())
        if words:
            around = [x[2] for x in self.path if x[2]]
            weight = min([1.0, *(x[1] for x in self.path)])
            outside = " ".join("".join(x for x, linked in self.text if not linked).split())
            self.found.append(("/".join(x[0] for x in self.path), "/".join(x[0] for x in self.path[:-1]), around[0] if around else 0, weight, len(outside), words))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link += 1
            return
        self.block()
        name = dict(attrs).get("class", "")
        weight = 0.0 if tag in ("nav", "footer") or name in ("ad", "comments") else html.HINT if "guide" in name else 1.0
        self.articles += tag == "article"
        self.path.append((tag, weight, self.articles if tag == "article" else 0))

    def handle_endtag(self, tag):
        if tag == "a":
            self.link -= 1
            return
        self.block()
        self.path.pop()

    def handle_data(self, data):
        self.text.append((data, self.link > 0))

    def main(self):
        def ratios(same):
            these = [b for b in self.found if b[3] and same(b)]
            return [sum(b[4] for b in these) / len(these), sum(len(re.findall("[.,;:!?]", b[5])) + 1 for b in these) / len(these)]

        inside, whole = (sum(len(b[5]) for b in self.found if b[3] and (b[2] or every)) for every in (False, True))
        scores = []
        for path, container, holder, weight, _, _ in self.found:
            own = [b for b in self.found if (b[0], b[2], b[3]) == (path, holder, weight)]
            if not weight or len(own) > 1 and not sum(b[4] for b in own):
                scores.append(0)
                continue
            mine = ratios(lambda b: (b[0], b[2], b[3]) == (path, holder, weight))  # noqa: B023
            near = ratios(lambda b: b[2] == holder and (holder or b[1] == container))  # noqa: B023
            length, marks = ((x + y) / 2 for x, y in zip(mine, near if weight == 1 else mine, strict=True))
            share = inside / whole
            side = 1 if not inside else share**2 if holder else html.OUTSIDE * (1 - share) ** 2
            scores.append((length * marks) ** 0.5 * weight * side)
        return "\n".join(b[5] for b, s in zip(self.found, scores, strict=True) if s and s >= html.THRESHOLD * max(scores))


def test_main_text_is_what_the_ratios_say():
    r = random.Random(11)
    decided = 0

    def text(n):
        return " ".join(r.choice(["word", "more,", "end.", "of", "it;"]) for _ in range(n))

    def element(depth):
        kind = r.choice(["div", "section", "p", "p", "p", "ul", "nav", "article", "footer"])
        name = r.choice(["", "", "", ' class="ad"', ' class="login-guide"', ' class="comments"']) if kind in ("div", "section") else ""
        if kind == "p":
            inner = text(r.choice([1, 3, 10, 80]))
        elif kind == "ul":
            inner = "".join(f"<li>{x}</li>" if r.random() < 0.5 else f'<li><a href="/">{x}</a></li>' for x in (text(r.choice([1, 2, 9])) for _ in range(r.randrange(1, 9))))
        else:
            inner = "".join(element(depth + 1) for _ in range(r.randrange(1, 5))) if depth < 3 else text(4)
        return f"<{kind}{name}>{inner}</{kind}>"

    for _ in range(400):
        page = f"<html><body>{''.join(element(0) for _ in range(r.randrange(1, 6)))}</body></html>"
        brute = Brute(page)
        assert html.main_text(page) == brute.main(), page
        decided += brute.main() != "\n".join(b[5] for b in brute.found if b[3])
    assert decided > 100  # pages of which ratios leave out more than roles do


def test_pages_that_close_nothing_are_scanned_in_linear_time():
    for page in ("<b" * 100_000, '<a "' * 50_000, '<a "' * 50_000 + ">", "<!--" * 50_000, "<a b='\">" * 50_000, "<p class=\"" * 50_000, "<script>" * 50_000):
        began = time.process_time()
        html.main_text(page)
        assert time.process_time() - began < 1
    assert html.main_text("<p>" + "a b. " * 300_000 + "</p>").count("a b.") == 300_000


def test_a_word_in_a_class_is_a_hint_only():
    story = "It was a long story, told in many words; it went on and on, as stories do. "
    page = '<article><p>{0}</p><div class="login-guide"><p>{0}</p></div><div class="comments"><p>{0}</p></div><section class="related-links"><p>x</p></section></article>'
    assert html.main_text(page.format(story * 3)) == "\n".join([(story * 3).strip()] * 2)


def test_extract(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>é</p></article>"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(map(tuple, html.extract(df).collect()), key=str) == [(1, "u", "é", 1), (None, None, "", 0)]
    assert html.extract(df.limit(0)).collect() == []


def plain_ids(tok, t):
    return tok.encode(t or "", add_special_tokens=False).ids


def test_tokens_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(tokens, "STORE", 50)
    tok = tokens.ChunkTokenizer()
    r = random.Random(4)
    texts = [*TEXTS[:8], "<|endoftext|> a<|startoftext|>", "A\tB\x1cC　D", "don't I'll ''s", "É́ ﬁ İ Σς", "x.y,z 3a4...", "</w> a</w>"] + ["".join(r.choice("aAeéÉ.,!#' \n\t9中") for _ in range(60)) for _ in range(60)]
    for k in range(0, len(texts), 7):
        part = texts[k : k + 7]
        assert [np.frombuffer(x, "<u4").tolist() for x in tok.encode(part)] == [plain_ids(tok.tokenizer, t) for t in part]


def test_length_histogram(spark):
    tok = tokens.ChunkTokenizer().tokenizer
    n = [len(plain_ids(tok, t)) for t in TEXTS]
    sums = lengths.suffix_sums(lengths.length_histogram(docs(spark, TEXTS)))
    for r in sums.collect():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (n.count(r.length), sum(x >= r.length for x in n), sum(x for x in n if x >= r.length))
        assert (r.tokens_if_cut, r.docs_up_to, r.total_docs, r.total_tokens) == (sum(min(x, r.length) for x in n), sum(x <= r.length for x in n), len(n), sum(n))
    limits = [0, 1, 7, 100, 10**6]
    assert [(r.limit, r.docs_over, r.tokens_if_cut) for r in lengths.at_limits(sums, limits).orderBy("limit").collect()] == [(x, sum(y > x for y in n), sum(min(y, x) for y in n)) for x in limits]


def fold(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(text, items, window):
    w, hit, names = fold(text), set(), set()
    for name, value in items:
        v = fold(value)
        n = min(len(v), window)
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1) if v else ():
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block", [dc.BLOCK_WORDS, 12])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    r = random.Random(block)
    vocabulary = ["a", "b", "c", "é", "d1"]
    text = lambda n: r.choice([" ", "-", ", "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 8, 9, 15]) if i else 0)) for i in range(9)] + [(50, None)]
    rows = [(i, None if i % 9 == 8 else text(r.randrange(0, 60)) + " zz " + (r.choice(items)[1] or "").upper()) for i in range(40)]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.occurrences(spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit(1)), b, window=9)
    assert len(list(dc.item_blocks(b))) == 1 if block > 12 else len(list(dc.item_blocks(b))) >= 5
    for x in got.collect():
        assert (x.n_words, x.n_hit, x["items"]) == brute_hits(dict(rows)[x.doc_id], items, 9)


def test_an_automaton_is_built_once_a_pass(monkeypatch):
    built = []

    class Held:
        value = [("1", [b"a", b"b", b"c"])]

    make = dc.SuffixAutomaton
    monkeypatch.setattr(dc, "SuffixAutomaton", lambda *a: built.append(1) or make(*a))
    for key in ("x", "x", "x", "y", "y"):
        dc._automaton((key, 3), Held, 3)
    assert len(built) == 2 and len(dc._automata) == 1


def test_decontamination_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two three more text", 5, "x")], "doc_id long, text string, n_chars long, n_removed string").withColumn("spans", F.lit(2)).withColumn("carried", F.lit(3))
    out = dc.cut_documents(df, spark.createDataFrame([(1, "one two three")], "item_id long, text string"), max_coverage=0.9)
    assert out.columns == df.columns and out.collect() == [(1, " more text", 10, "x", 2, 3)]


def test_cutting_leaves_clean_documents_alone(spark):
    item = "one two three four five six seven eight nine ten eleven"
    clean, dirty = "Some clean text, é " * 9, "Before it. One-two three FOUR five six seven eight nine ten eleven! And after it there is so much more text that it stays, é, for sure, yes."
    got = {r.doc_id: (r.text, r.n_removed) for r in dc.decontaminate(docs(spark, [clean, dirty, item, None]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {0: (clean, 0), 1: ("Before it. ! And after it there is so much more text that it stays, é, for sure, yes.", 11), 3: (None, 0)}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert dc.occurrences(docs(spark, [dirty]), nothing).first().n_hit == 0


def test_sharding(spark, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=1 << 20, fanout=2)
    assert store.versions() == [] and store.read().count() == 0
    df = docs(spark, TEXTS * 3).withColumn("arrival", F.lit("x"))
    for i in range(4):
        store.append(df.filter(F.col("doc_id") % 4 == i).repartition(2))
    before = len(store.manifest()["shards"])
    assert store.compact() > 4 and len(store.manifest()["shards"]) < before
    rows = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert rows(store.read()) == rows(df) == rows(store.read(4))
    assert store.vacuum() == 0  # all too young
    late = sharding.ShardStore(spark, store.root)
    late._commit = lambda *a: store.vacuum() and None  # another writer cleans up before this one commits
    late.append(df.limit(1))
    sharding.ShardStore._commit(late, store.versions()[-1] + 1, store.manifest()["schema"], [*(sharding.Shard(*x) for x in store.manifest()["shards"]), *late._written(max((tmp_path / "s" / "data").iterdir(), key=lambda p: p.stat().st_mtime).name)])
    assert store.read().count() == df.count() + 1
    store.append(df.limit(0))
    assert store.read().count() == df.count() + 1
    with pytest.raises(ValueError, match="columns"):
        store.append(df.withColumnRenamed("arrival", "other"))
    with pytest.raises(ValueError, match="columns"):
        store.append(df.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert store.vacuum(grace_seconds=0) > 0
    assert store.read().count() == df.count() + 1
    with pytest.raises(sharding.CommitConflict):
        store._commit(store.versions()[-1], None, [])
    with pytest.raises(sharding.CommitConflict):
        store._commit(1, json.loads(df.schema.json()), [])


def test_two_compactors_and_an_append(spark, tmp_path):
    """Whoever commits while another compacts loses nothing, and doubles nothing."""
    path = str(tmp_path / "s")
    store, other = (sharding.ShardStore(spark, path, target_bytes=8 << 20, fanout=2) for _ in range(2))
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    for i in range(4):
        store.append(df.filter(F.col("doc_id") % 4 == i).coalesce(1))
    runs = store.runs

    def meanwhile(work):
        def once(*args):
            store.runs = runs
            work()
            return runs(*args)

        return once

    store.runs = meanwhile(other.compact)  # between the choice of runs and their commit
    with pytest.raises(sharding.CommitConflict):
        store.compact()
    assert store.read().count() == 40
    store.append(df.filter("doc_id < 3").coalesce(1))
    store.append(df.filter("doc_id < 4").coalesce(1))
    store.runs = meanwhile(lambda: other.append(df.filter("doc_id < 5").coalesce(1)))
    with pytest.raises(sharding.CommitConflict):
        store.compact()
    assert store.read().count() == 52
    store.compact()
    assert sorted(r.doc_id for r in store.read().collect()) == sorted([*range(40), *range(3), *range(4), *range(5)])


def test_tiers_are_rewritten_apart(spark, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), target_bytes=8 << 20, fanout=4)
    r = random.Random(2)
    for i in range(4):
        for kind, n in (("small", 10), ("big", 200_000)):
            store.append(spark.createDataFrame([(i, kind, r.randbytes(n).hex())], "doc_id long, kind string, text string").coalesce(1))
    before = store.versions()[-1]
    assert store.compact() == before + 1 and len(store.manifest()["shards"]) == 2
    kinds = [spark.read.parquet(f"{store.root}/data/{s[0]}").groupBy("kind").count().collect() for s in store.manifest()["shards"]]
    assert sorted(tuple(x[0]) for x in kinds if len(x) == 1) == [("big", 4), ("small", 4)]


def test_op2_appends_one_arrival_after_another(spark, monkeypatch, tmp_path):
    from curatrix.llm import queries

    stores, opened = [], sharding.ShardStore

    def spy(*args, **kwargs):
        stores.append(opened(*args, **kwargs))
        return stores[-1]

    monkeypatch.setattr(sharding, "ShardStore", spy)
    rows = [(i, "en", "s", len(str(i)), str(i)) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op2_sharding(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id, x.text_md5) for x in got) == [(i, hashlib.md5(str(i).encode()).hexdigest()) for i in range(40)]
    assert len(stores[0].versions()) >= 17


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    r = random.Random(3)
    texts = [None, "", *(" ".join(r.choice(["cat", "dog", "house"]) for _ in range(r.randrange(1, 90))) for _ in range(150)), "cat " * 300]
    df = docs(spark, texts).union(docs(spark, texts[:5])).withColumn("piece", F.lit(1))
    got = packing.pack_documents(df, capacity=64).collect()
    tok = tokens.ChunkTokenizer().tokenizer
    want = []
    for i, t in [*enumerate(texts), *enumerate(texts[:5])]:
        ids = [*plain_ids(tok, t), 1]
        want += [(i, k, a, len(ids[a : a + 64]), zlib.crc32(np.array(ids[a : a + 64], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    assert sorted(tuple(x)[:5] for x in got) == sorted(want)
    by = {}
    for x in got:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert len(by) <= -(-sum(w[3] for w in want) // 64) * 1.03 + 1
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_genetic_steps_keep_all_items():
    r = random.Random(1)
    sizes = [r.randrange(1, 60) for _ in range(300)]
    a, b = (packing.Packing(sizes, 100).best_fit(r.sample(range(300), 300)) for _ in "ab")
    before = [[list(g) for g in x.groups] for x in (a, b)]
    for p in (packing.cross(a, b, r), packing.mutate(a, r)):
        assert sorted(x for g in p.groups for x in g) == list(range(300)) and all(sum(sizes[x] for x in g) == f <= 100 for g, f in zip(p.groups, p.fills, strict=True))
    assert before == [[list(g) for g in x.groups] for x in (a, b)]  # parents are left as they were
    best = packing.evolve(sizes, 100, 1)[0]
    assert len(best.groups) <= len(a.groups) and max(best.numbers()) + 1 == len(best.groups)


def least_sequences(sizes, capacity):
    """By trying every way to put each piece."""

    def rest(i, free):
        if i == len(sizes):
            return len(free)
        found = [rest(i + 1, tuple(sorted((*free[:k], f - sizes[i], *free[k + 1 :])))) for k, f in enumerate(free) if f >= sizes[i] and f not in free[:k]]
        return min([*found, rest(i + 1, tuple(sorted((*free, capacity - sizes[i]))))])

    return rest(0, ())


def test_evolved_packings_are_the_least():
    r = random.Random(5)
    for trial in range(25):
        sizes = [r.randrange(10, 70) for _ in range(8)]
        assert len(packing.evolve(sizes, 100, trial)[0].groups) == least_sequences(sizes, 100), sizes
    assert packing.evolve([], 100, 1)[0].numbers() == []


def test_the_genetic_algorithm_makes_the_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 400)
    r = random.Random(4)
    rows = [(i, 0, 0, r.randrange(15, 62), i) for i in range(1500)]
    parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    shards = packing.report(parts, 100).collect()
    assert len(shards) == 4 and all(x.least <= x.sequences <= x.plain for x in shards)
    assert sum(x.made in ("cross", "mutate") for x in shards) >= 2  # the first population may have a best one, too


def test_equal_pieces_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    parts = spark.createDataFrame([(1, 0, 0, 30, 7)] * 600, "doc_id long, piece int, start long, length long, ids_crc32 long")
    assert max(x["count"] for x in packing._shards(packing.written(parts, "pieces"))[0].select("shard", F.explode("items")).groupBy("shard").count().collect()) < 100
    got = packing.pack(parts, 100)
    assert got.count() == 600 and 200 <= got.select("sequence_id").distinct().count() <= 212  # three to a sequence, but for each shard's last


def test_html_depth_changes_nothing():
    """Ten and a hundred thousand elements around the same page give the same text, in linear time."""
    story = "A sentence of the story, which is long enough to be read as one. " * 4
    for page in ("<div><nav>{}<p>Menu text, with words and a full stop.</p>{}</nav><div><p>" + story + "</p></div></div>", "<article><p>" + story + "</p>{}<nav><p>Menu, again.</p></nav><p>" + story + "</p>{}</article>"):
        few, many = (html.main_text(page.format("<div>" * n, "</div>" * n)) for n in (10, 100_000))
        assert few == many and "Menu" not in few and few.count("A sentence") >= 4
    began = time.process_time()
    html.main_text("<x><div>" + "<y>" * 50_000 + "</x>" * 50_000)
    html.main_text("<li>" + "<y>" * 50_000 + "<p>a" * 50_000)
    assert time.process_time() - began < 20


def test_warc_headers_are_fresh(spark, tmp_path):
    """Every record has a date, an id of its own, and revisits say what they refer to; a payload full of separators is read in linear time."""
    df = spark.createDataFrame([(2, "http://b/", "same"), (1, "http://a/ x", "same"), (3, "http://c/", "other"), (3, "http://c/2", "more")], "page_id long, url string, html string")
    texts = {r.value for r in warc.records(warc.resolve(df)).collect()}
    heads = [dict(x.split(": ", 1) for x in t.split("\r\n\r\n")[0].split("\r\n")[1:]) for t in texts]
    assert len({h["WARC-Record-ID"] for h in heads}) == 4
    age = time.time() - __import__("calendar").timegm(time.strptime(heads[0]["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ"))
    assert 0 <= age + 1 < 600 and len({h["WARC-Date"] for h in heads}) == 1
    [revisit] = [h for h in heads if h["WARC-Type"] == "revisit"]
    [response] = [h for h in heads if h["WARC-Target-URI"] == "http://a/%20x"]
    assert (revisit["WARC-Refers-To"], revisit["WARC-Refers-To-Target-URI"], revisit["WARC-Refers-To-Date"]) == (response["WARC-Record-ID"], "http://a/%20x", response["WARC-Date"])
    nasty = spark.createDataFrame([(1, "u", "x\r\n\r\nWARC/1.0" * 100_000), (2, "v", "y")], "page_id long, url string, html string")
    warc.write_archives(nasty, str(tmp_path / "n"))
    began = time.time()
    got = {r.page_id: r.payload for r in warc.read_archives(spark, str(tmp_path / "n")).collect()}
    assert got == {1: "x\r\n\r\nWARC/1.0" * 100_000, 2: "y"} and time.time() - began < 60
