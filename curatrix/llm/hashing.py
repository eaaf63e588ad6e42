"""Hashes of words and of byte windows of whole Arrow columns at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BASE, BASE_INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: One random 64-bit number a byte.
BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Random odd multipliers for the words of a shingle.
ODD = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xC2B2AE3D27D4EB4F)
    x ^= x >> U(32)
    return x


def powers(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        _powers[base] = held
    return held[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's values end to end, and the n + 1 offsets. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(offsets: np.ndarray, limit: int):
    """Runs of values of about so many bytes, one value at least: (first, end)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every word of the values, A-Z lower-cased, how many words each value has, and where words start and end in ``data``.

    ``separator`` says of each byte whether it parts words. Equal words have equal hashes;
    different ones differ but for odds of about 2 to the minus 60 a pair.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64), none, none
    inside = ~separator[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a value's first byte, and the end
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & ~(before & ~first[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & ~(after & ~first[1:])) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTES[LOWER[data]] * powers(BASE, n), out=total[1:])
    words = mix((total[end] - total[start]) * powers(BASE_INV, n)[start] + (end - start).astype(np.uint64) * ODD[63])
    counts = np.searchsorted(start, offsets[1:]) - np.searchsorted(start, offsets[:-1])
    return words, counts, start, end


def separators(pattern_bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


#: Blank and tab to carriage return.
SPACES = separators([0x20, *range(0x09, 0x0E)])


def shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each value, sorted within it, and n + 1 offsets.

    A value of fewer words than ``size``, but some, has its whole sequence as its one shingle.
    """
    data, offsets = raw(column)
    words, counts, _, _ = word_hashes(data, offsets, SPACES)
    ends = np.cumsum(counts)
    begins = ends - counts
    many = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(many)])
    out = np.empty(int(at[-1]), np.uint64)
    if len(words) >= size:
        full = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            full += words[k : k + len(full)] * ODD[k]
        full = mix(full)
    for i in np.flatnonzero(counts):
        a, b, n = at[i], at[i + 1], counts[i]
        if n >= size:
            out[a:b] = full[begins[i] : begins[i] + n - size + 1]
            out[a:b].sort()
        else:
            out[a] = mix(np.array([sum(int(w) * int(m) for w, m in zip(words[begins[i] : ends[i]], ODD, strict=False)) + int(n) & (1 << 64) - 1], np.uint64))[0]
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[at[:-1][many > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[at]
