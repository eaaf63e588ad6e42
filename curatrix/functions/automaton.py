"""Many terms found in one pass over each text: an Aho-Corasick automaton over packed arrays.

The automaton is a table of next states by (state, byte class), closed over the failure
links, and a table of the terms that end in each state. Texts are cut into lanes that
overlap by the longest term less a byte, and all lanes of a batch take a step at a time in
numpy. A row's result is one bitmap, from which every score is then computed by built-in
bit functions, so neither the scan's time nor the plan's size follow the number of terms.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shipped

#: Bytes of a lane, without its overlap, and of the texts scanned at once.
LANE, STEP = 1_024, 8_000_000


class Automaton:
    """Finds which of some byte strings (none of them empty, each once) texts contain."""

    def __init__(self, terms: Sequence[bytes]):
        self.n_words, self.longest = -(-len(terms) // 64), max(map(len, terms), default=1)
        alphabet = sorted(set(b"".join(terms)))
        self.classes = np.zeros(256, np.int32)
        self.classes[alphabet] = np.arange(1, len(alphabet) + 1)
        width = len(alphabet) + 1
        moves: list[dict[int, int]] = [{}]
        ends: list[int] = [0]  # the terms that end in a state, as bits
        for k, term in enumerate(terms):
            at = 0
            for byte in self.classes[list(term)].tolist():
                if byte not in moves[at]:
                    moves[at][byte] = len(moves)
                    moves.append({})
                    ends.append(0)
                at = moves[at][byte]
            ends[at] |= 1 << k
        table, fail, queue = np.zeros((len(moves), width), np.int32), [0] * len(moves), deque([0])
        while queue:
            at = queue.popleft()
            if at:
                ends[at] |= ends[fail[at]]
                table[at] = table[fail[at]]
            for byte, to in moves[at].items():
                fail[to] = int(table[fail[at], byte]) if at else 0
                queue.append(to)
            for byte, to in moves[at].items():
                table[at, byte] = to
        self.next = (table * width).reshape(-1)  # states are rows' first places
        self.ends = np.array([[e >> 64 * w & (1 << 64) - 1 for w in range(self.n_words)] for e in ends], np.uint64)
        self.last = np.zeros(len(self.next), bool)
        self.last[np.flatnonzero(self.ends.any(axis=1)) * width] = True
        self.width = width

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row of 64-bit words for each text ``data[offsets[i]:offsets[i+1]]``."""
        n = len(offsets) - 1
        out = np.zeros((n, self.n_words), np.uint64)
        lengths = np.diff(offsets)
        counts = -(-lengths // LANE)
        if not counts.sum() or not self.n_words:
            return out
        owner = np.repeat(np.arange(n), counts)
        begin = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * LANE
        size = np.minimum(begin + LANE, lengths[owner])
        begin = np.maximum(begin - self.longest + 1, 0)
        size -= begin
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], (begin + offsets[owner])[order], size[order]
        active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # lanes longer than each step
        classes, state, found = self.classes[data], np.zeros(len(owner), np.int32), []
        for t, k in enumerate(active):
            state[:k] = self.next[state[:k] + classes[start[:k] + t]]
            hit = np.flatnonzero(self.last[state[:k]])
            if len(hit):
                found.append(owner[hit] * len(self.ends) + state[hit] // self.width)
        if found:
            seen = np.unique(np.concatenate(found))
            rows, states = seen // len(self.ends), seen % len(self.ends)
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            out[rows[first]] = np.bitwise_or.reduceat(self.ends[states], first, axis=0)
        return out

    def column(self, texts: pa.Array) -> pa.Array:
        """The bitmaps of a string column as lists of longs; a null text contains nothing."""
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        parts, at = [np.zeros((0, self.n_words), np.uint64)], 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP, side="right")) - 1)
            parts.append(self.scan(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]))
            at = end
        words = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * self.n_words), pa.array(words.reshape(-1).view(np.int64)))


class Terms:
    """A set of terms that is looked for at once; ``bits`` finds them, ``on`` reads what was found."""

    def __init__(self, *lists: Iterable[str]):
        self.terms = tuple(dict.fromkeys(x for terms in lists for x in terms))
        if "" in self.terms:
            raise ValueError("a term is empty")
        self.places = {x: i for i, x in enumerate(self.terms)}

    @functools.cached_property
    def automaton(self) -> Automaton:
        return Automaton([x.encode() for x in self.terms])

    def bits(self, texts: Column) -> Column:
        """array<long>: a bit for each term that the text contains."""
        shipped(SparkSession.active())
        automaton = self.automaton

        def found(column: pa.Array) -> pa.Array:
            return automaton.column(column)

        found.__annotations__ = {"column": pa.Array, "return": pa.Array}
        return F.arrow_udf(found, "array<bigint>")(texts)

    def on(self, bits: Column | str) -> Found:
        return Found(self, F.col(bits) if isinstance(bits, str) else bits)


class Found:
    """What ``Terms.bits`` found, asked as the functions of ``text`` ask a haystack."""

    def __init__(self, terms: Terms, bits: Column):
        self.terms, self.bits = terms, bits

    def _masks(self, terms: Sequence[str]) -> list[tuple[Column, Column]]:
        """(word, mask) for each word that holds some of the terms; those named again come again."""
        left, out = list(terms), []
        while left:
            now = set(left)
            masks: dict[int, int] = {}
            for x in now:
                place = self.terms.places[x]
                masks[place // 64] = masks.get(place // 64, 0) | 1 << place % 64
            out += [(F.get(self.bits, F.lit(w)), F.lit(m - (1 << 64) if m >> 63 else m).cast("long")) for w, m in sorted(masks.items())]
            for x in now:
                left.remove(x)
        return out

    def hits(self, terms: Sequence[str]) -> Column:
        counts = [F.bit_count(w.bitwiseAND(m)) for w, m in self._masks(terms)]
        return functools.reduce(Column.__add__, counts) if counts else F.lit(0)

    def any_of(self, terms: Sequence[str]) -> Column:
        tests = [w.bitwiseAND(m) != 0 for w, m in self._masks(list(dict.fromkeys(terms)))]
        return functools.reduce(Column.__or__, tests) if tests else F.lit(False)

    def all_of(self, terms: Sequence[str]) -> Column:
        tests = [w.bitwiseAND(m) == m for w, m in self._masks(list(dict.fromkeys(terms)))]
        return functools.reduce(Column.__and__, tests) if tests else F.lit(True)

    def matched(self, terms: Sequence[str]) -> Column:
        terms = list(dict.fromkeys(terms))
        if not terms:
            return F.array().cast("array<string>")
        named, places = F.split(F.lit("\x1f".join(terms)), "\x1f"), F.split(F.lit(",".join(str(self.terms.places[x]) for x in terms)), ",").cast("array<int>")
        return F.filter(named, lambda _, i: F.getbit(F.get(self.bits, (F.get(places, i) / 64).cast("int")), F.get(places, i) % 64) == 1)
