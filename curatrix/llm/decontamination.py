"""Benchmark decontamination by a generalised suffix automaton.

The automaton of all normalised test items is built once a worker; the words of training
texts are streamed through it, and at each word it knows the length of the longest match
that ends there. A match of ``window`` words or more, or of the whole of a shorter item,
is an occurrence, and its words are hit. A word that no item has sends the automaton back
to its start, so only runs of item words need streaming; which words may be item words is
found for whole batches at once, and confirmed on the words themselves.

Items are dealt into blocks of about ``BLOCK_WORDS`` words at most, on the cluster; each has
an automaton of its own and makes a pass over the documents, which adds to what the last
pass found. So what the driver holds, what is broadcast and what a worker keeps is bounded
by a block, whatever the number of items, and every worker builds each automaton once. A
benchmark of one block, the usual one, makes one pass: documents are read once and not
shuffled.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, written
from .hashing import raw, separators, slices, word_hashes

#: Words of test items in a block; a longer item is one block's.
BLOCK_WORDS = 400_000
#: All ASCII but digits and letters parts words.
SEPARATORS = separators([b for b in range(128) if not chr(b).isalnum()])
_FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256))
STEP = 2_000_000
FILTER_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    """Normalised words: A-Z lower-cased, runs of anything but ASCII that is no letter or digit."""
    return (text or "").encode().translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of the items' word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary, self.names = window, {}, [name for name, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.own: dict[int, list[int]] = {}  # items of which a prefix ends in a state
        self.whole: dict[int, list[tuple[int, int]]] = {}  # shorter items that end in a state: length, item
        for i, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
                self.own.setdefault(last, []).append(i)
            if 0 < len(words) < window:
                self.whole.setdefault(last, []).append((len(words), i))
        # states are only split while building, so places of whole items are looked up once all are in
        short, self.whole = self.whole, {}
        for found in short.values():
            for n, i in found:
                self.whole.setdefault(self._walk(items[i][1]), []).append((n, i))
        self.children: dict[int, list[int]] = {}
        for v in range(1, len(self.link)):
            self.children.setdefault(self.link[v], []).append(v)
        self.nearest = [-1] * len(self.link)  # the first state with whole items at or above
        for v in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.nearest[v] = v if v in self.whole else (self.nearest[self.link[v]] if v else -1)
        self.least = min([window, *(n for x in self.whole.values() for n, _ in x)])
        self._items: dict[int, frozenset[int]] = {}
        listed = list(self.vocabulary)
        hashes, _, _, _ = word_hashes(np.frombuffer(b"".join(listed), np.uint8), np.cumsum([0, *map(len, listed)]), SEPARATORS)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def _walk(self, words: list[bytes]) -> int:
        v = 0
        for w in words:
            v = self.next[v][self.vocabulary[w]]
        return v

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of its own for the part of q that is one longer than p."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        cur, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, c, self.next[p][c])
        return cur

    def items(self, v: int) -> frozenset[int]:
        """Items that hold the strings of a state: those with a prefix that ends there or below."""
        if v not in self._items:
            found, todo = set(), [v]
            while todo:
                x = todo.pop()
                found.update(self.own.get(x, ()))
                todo.extend(self.children.get(x, ()))
            self._items[v] = frozenset(found)
        return self._items[v]

    def stream(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which of the words are hit, and the items that occur."""
        hit, found = np.zeros(len(words), bool), set()
        nxt, link, length, window, get = self.next, self.link, self.length, self.window, self.vocabulary.get
        v = n = 0
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                v = n = 0
                continue
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c not in nxt[v]:
                continue
            v = nxt[v][c]
            n += 1
            if n >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                hit[i - window + 1 : i + 1] = True
                found |= self.items(u)
            u = self.nearest[v]
            while u >= 0:
                for size, item in self.whole[u]:
                    if size <= n:
                        hit[i - size + 1 : i + 1] = True
                        found.add(item)
                u = self.nearest[link[u]] if link[u] >= 0 else -1
        return hit, found


_automata: dict[tuple, SuffixAutomaton] = {}


def _automaton(key: tuple, items, window: int) -> SuffixAutomaton:
    """The automaton of a pass: built once a worker, in place of the last pass's."""
    if key not in _automata:
        _automata.clear()
        _automata[key] = SuffixAutomaton(items.value, window)
    return _automata[key]


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[tuple[bool, list[tuple[str, list[bytes]]]]]:
    """Blocks of the items that have words, and whether it is the last. A null id is the empty string; null texts have no words; repeated items are one."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))).first()[0] or 0
    n = 1 if total <= BLOCK_WORDS else math.ceil(total / (0.75 * BLOCK_WORDS))  # dealt by hash: a block comes out at three quarters in the mean
    if n > 1:
        dealt, path = rows.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(n)).cast("int")), scratch_path(rows.sparkSession, "items")
        dealt.write.partitionBy("block").parquet(path)
        rows = rows.sparkSession.read.schema(dealt.schema).parquet(path)
    for k in range(n):
        part = rows.filter(F.col("block") == k).select("name", "text") if n > 1 else rows
        yield k == n - 1, [(name, words) for name, value in part.toLocalIterator() if (words := words_of(value))]


SCHEMA = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def occurrences(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 10, keep_text: bool = False, carry: list[str] | None = None, max_coverage: float | None = None) -> DataFrame:
    """For every row of ``docs``: doc_id (and text, and the columns named in ``carry`` as one struct, ``carried``), n_words, n_hit, items (sorted), spans.

    Spans are maximal runs of hit words, as byte offsets into the text's UTF-8, from the
    first word's start to the last one's end. Null and empty texts have no words. Rows
    are independent of each other, so repeated rows, null ids and other columns do not
    matter. Items of equal texts all occur; an id that stands for several items is
    named once. Without items nothing is hit; an empty ``docs`` gives no rows.

    With ``max_coverage`` the last pass also cuts the spans out of the texts (null ones
    stay null) and leaves out the rows whose words are hit beyond it.
    """
    context = docs.sparkSession.sparkContext
    more = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *more)
    given = rows.dtypes
    for last, items in item_blocks(benchmark):
        held = (uuid.uuid4().hex, context.broadcast(items))
        rows = _pass(rows, given, held, window, keep_text or not last, max_coverage if last else None)
        if not last:
            rows = written(rows, "hits")
            held[1].destroy()
    return rows


def _pass(rows: DataFrame, given: list[tuple[str, str]], items: tuple, window: int, keep_text: bool, max_coverage: float | None) -> DataFrame:
    def scan(batches):
        for batch in batches:
            _, offsets = raw(batch.column(1))
            for a, b in slices(offsets, STEP):
                found = _scan(batch.slice(a, b - a), len(given), items, window, keep_text)
                yield found if max_coverage is None else _cut_batch(found, max_coverage)

    return rows.mapInArrow(scan, f"{', '.join(f'{c} {t}' for c, t in given if c != 'text' or keep_text)}, {SCHEMA}")


def _scan(batch: pa.RecordBatch, n_given: int, items: tuple, window: int, keep_text: bool) -> pa.RecordBatch:
    data, offsets = raw(batch.column(1))
    hashes, counts, starts, ends = word_hashes(data, offsets, SEPARATORS)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    hit = np.zeros(len(hashes), bool)
    found: dict[int, set[str]] = {}
    if batch.num_columns > n_given:  # what former passes found
        for doc, (names, held) in enumerate(zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
            if names:
                found[doc] = set(names)
            for s in held or ():
                hit[np.searchsorted(starts, offsets[doc] + s["start"]) : np.searchsorted(ends, offsets[doc] + s["end"], side="right")] = True
    automaton, folded = _automaton((items[0], window), items[1], window), bytes(data).translate(_FOLD)
    known = automaton.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
    # runs of words that may be item words, within one text
    edge = np.zeros(len(known) + 1, bool)
    edge[firsts] = True
    begin = np.flatnonzero(known & np.concatenate([[True], ~known[:-1]]) | known & edge[:-1]) if len(known) else np.zeros(0, np.int64)
    stop = np.flatnonzero(known & np.concatenate([~known[1:], [True]]) | known & edge[1:]) + 1 if len(known) else begin
    long = stop - begin >= automaton.least
    for x, y in zip(begin[long].tolist(), stop[long].tolist(), strict=True):
        mask, names = automaton.stream([folded[s:e] for s, e in zip(starts[x:y].tolist(), ends[x:y].tolist(), strict=True)])
        if names:
            hit[x:y] |= mask
            doc = int(np.searchsorted(firsts, x, side="right")) - 1
            found.setdefault(doc, set()).update(automaton.names[i] for i in names)
    n_hit = np.add.reduceat(np.concatenate([hit, [False]]).astype(np.int64), firsts[:-1]) if len(counts) else np.zeros(0, np.int64)
    n_hit[counts == 0] = 0
    spans: list[list] = [[]] * len(counts)
    for doc in found:
        a, b = firsts[doc], firsts[doc + 1]
        m = np.concatenate([[False], hit[a:b], [False]])
        turn = np.flatnonzero(m[1:] != m[:-1])
        spans[doc] = [{"start": int(starts[a + s] - offsets[doc]), "end": int(ends[a + e - 1] - offsets[doc])} for s, e in zip(turn[::2], turn[1::2], strict=True)]
    kept = [i for i in range(n_given) if i != 1 or keep_text]
    columns, names = [batch.column(i) for i in kept], [batch.schema.names[i] for i in kept]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(found.get(i, ())) for i in range(len(counts))], pa.list_(pa.string())),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
        names=[*names, "n_words", "n_hit", "items", "spans"],
    )


def cut(text: str | None, spans: list[dict] | None) -> str:
    """The text without the spans' bytes."""
    whole, out, at = (text or "").encode(), [], 0
    for s in spans or ():
        out.append(whole[at : s["start"]])
        at = s["end"]
    return b"".join([*out, whole[at:]]).decode()


def _cut_batch(batch: pa.RecordBatch, max_coverage: float) -> pa.RecordBatch:
    n, hit = batch.column("n_words").to_numpy(), batch.column("n_hit").to_numpy()
    batch = batch.filter(pa.array(hit <= max_coverage * n))
    hit = batch.column("n_hit").to_numpy()
    if not hit.any():
        return batch
    texts, spans = batch.column("text"), batch.column("spans")
    cuts = pa.array([cut(texts[i].as_py(), spans[i].as_py()) if hit[i] else texts[i].as_py() for i in range(len(hit))], pa.string())
    return batch.set_column(batch.schema.get_field_index("text"), "text", cuts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 10, max_coverage: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """doc_id, text, n_removed (words) and the columns named in ``carry``: spans are cut out of texts; of documents whose words are hit beyond ``max_coverage`` none is left.

    Clean documents come back unchanged, null texts included.
    """
    out = occurrences(docs, benchmark, doc_id, text, window, keep_text=True, carry=carry, max_coverage=max_coverage)
    return out.select("doc_id", "text", F.col("n_hit").alias("n_removed"), *[F.col("carried")[c].alias(c) for c in carry or ()])


def cut_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` with all its columns, by position and whatever their names, but the spans cut out of texts; see ``decontaminate``.

    A column ``n_chars`` follows a text that was cut.
    """
    others = [c for c in docs.columns if c not in (doc_id, text)]
    inner = docs.select(doc_id, text, F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")) if others else docs.select(doc_id, text)
    out = decontaminate(inner, benchmark, doc_id, text, window, max_coverage, ["row"] if others else None)
    put = {doc_id: F.col("doc_id"), text: F.col("text")} | {c: F.col("row")[c] for c in others}
    if "n_chars" in others:
        put["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row")["n_chars"])
    return out.select(*[put[c].alias(c) for c in docs.columns])
