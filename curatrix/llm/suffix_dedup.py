"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts in a document with a smaller id.

Only suffixes that can matter are sorted, in four steps over packed blocks of numbers:

1. Each window of ``length`` bytes belongs to its least hashed k-gram, its anchor (64
   bits). Runs of neighbouring windows of one anchor are kept together (a super-k-mer: 18
   windows in the mean), as anchor, document and position. A batch sends runs of equal
   bytes once, with the batch's smallest document, and settles the others itself, so what
   a common passage sends grows with batches, not with the documents that hold it.
2. Anchors meet. Equal windows have equal anchors, so runs whose anchor no other document
   has hold nothing that repeats, and go. All others are asked for. Of an anchor with very
   many runs (a common line in different surroundings) each block of documents settles
   its own copies, and deals the rest by anchors of longer grams, which tell the
   surroundings apart.
3. The documents give the bytes of those runs, and the suffixes that start in them are
   sorted by the deep-shallow method: multikey steps of eight bytes, each sorting what the
   last one left equal, down to a depth of 40; groups that still hang together, with
   documents of their own, are compared whole or go to blind tries. Equal strings end up
   side by side, and the smallest document keeps them.
4. Each document's removed windows meet its text.

Hashes only tell what need not be compared: every byte removed was found equal to another
document's byte by byte. Blocks are of a size set by bytes; nothing is gathered on the
driver.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import files_for, tidy, tidy_pair, tidy_stream, written
from .hashing import BASE, BYTES, U, mix, raw, slices

LENGTH = 50
#: Bytes of text for which a block of anchors, and one of documents, is made.
BUCKET_BYTES = 8 << 20
#: Bytes hashed at once, and runs that a batch sends at once.
STEP, FLUSH = 1_000_000, 500_000
SHALLOW = 40
#: Runs from which an anchor is dealt anew, by grams of this share of a window.
HOT, LONG_GRAM = 4000, 0.72


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: for each its type, sizes, and content, compressed if that helps."""
    out, press = [], zstandard.ZstdCompressor(level=1)
    for a in arrays:
        whole = np.ascontiguousarray(a).tobytes()
        small = press.compress(whole)
        kind = a.dtype.str[1:].encode()
        part = small if len(small) < 0.95 * len(whole) else whole
        out += [kind, len(whole).to_bytes(8, "little"), len(part).to_bytes(8, "little"), part]
    return b"".join(out)


def load(blob: bytes) -> list[np.ndarray]:
    out, at, loose = [], 0, zstandard.ZstdDecompressor()
    while at < len(blob):
        kind, n, m = blob[at : at + 2].decode(), int.from_bytes(blob[at + 2 : at + 10], "little"), int.from_bytes(blob[at + 10 : at + 18], "little")
        part = blob[at + 18 : at + 18 + m]
        out.append(np.frombuffer(part if m == n else loose.decompress(part, max_output_size=n), "<" + kind))
        at += 18 + m
    return out


def _power(n: int) -> np.uint64:
    return U(pow(BASE, n, 1 << 64))


class _Hashes:
    """Polynomial hashes of the 1, 2, 4, ... bytes from each place."""

    def __init__(self, data: np.ndarray, most: int):
        self.by = {1: BYTES[data]}
        n = 1
        while 2 * n <= most:
            f = self.by[n]
            self.by[2 * n] = f[:-n] * _power(n) + f[n:] if len(f) > n else f[:0]
            n *= 2

    def at(self, starts, size: int) -> np.ndarray:
        """Of ``size`` bytes from each start (an index array, or how many places from 0)."""
        out, done = None, 0
        while done < size:
            n = max(k for k in self.by if k <= size - done)
            f = self.by[n]
            part = f[starts + done] if isinstance(starts, np.ndarray) else f[done : done + starts]
            out = part if out is None else out * _power(n) + part
            done += n
        return out


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    cur, n = a, 1
    while 2 * n <= width:
        cur = np.minimum(cur[:-n], cur[n:])
        n *= 2
    return np.minimum(cur[: len(a) - width + 1], cur[width - n :]) if n < width else cur


def runs(data: np.ndarray, offsets: np.ndarray, length: int, share: float = 0.4) -> tuple[np.ndarray, ...]:
    """Runs of windows of one anchor in the values: anchor, hash of the run, value number, first window, number of windows."""
    gram = max(4, int(share * length))
    sizes = np.diff(offsets)
    if len(data) < length:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    hashes = _Hashes(data, min(gram, 16))
    least = sliding_min(hashes.at(len(data) - gram + 1, gram), length - gram + 1)
    n = len(least)
    step = np.zeros(n + 1, np.int32)
    whole = np.flatnonzero(sizes >= length)
    np.add.at(step, offsets[whole], 1)
    np.add.at(step, np.minimum(offsets[whole + 1] - length + 1, n), -1)
    valid = np.cumsum(step[:n], dtype=np.int32) > 0
    turn = np.ones(n, bool)
    turn[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    turn[offsets[whole]] = True
    first = np.flatnonzero(turn)
    end = np.append(first[1:], n)
    first, end = first[valid[first]], end[valid[first]]
    # long runs are cut so that their first and last window hold all their bytes
    pieces = -(-(end - first) // length)
    if (pieces > 1).any():
        again = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = first[again] + nth * length
        first, end = start, np.minimum(start + length, end[again])
    run = mix(hashes.at(first, length) * U(0x9E3779B97F4A7C15) ^ mix(hashes.at(end - 1, length) + (end - first).astype(np.uint64)))
    anchor = mix(least[first])
    value = np.searchsorted(offsets, first, side="right") - 1
    return anchor, run, value, first - offsets[value], end - first


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether ``n`` bytes from places a and from places b are the same."""
    if not len(a):
        return np.zeros(0, bool)
    ends = np.cumsum(n)
    step = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
    return np.logical_and.reduceat(data[np.repeat(a, n) + step] == data[np.repeat(b, n) + step], ends - n)


def _bucket(anchor: np.ndarray, n: int) -> np.ndarray:
    """Ascending, as anchors are."""
    return ((anchor >> U(32)) * U(n) >> U(32)).astype(np.int64)


def _counts(count: np.ndarray) -> np.ndarray:
    """Windows of runs (``length`` at most) in as few bytes as hold them."""
    return count.astype(np.uint8 if count.max(initial=0) < 256 else np.uint32)


def _blocks(doc: np.ndarray, check: np.ndarray, start: np.ndarray, count: np.ndarray, n_docs: int, kind: int, head: bytes = b""):
    """Rows (bucket, kind, blob) of entries dealt by document."""
    to = doc % n_docs
    order = np.argsort(to, kind="stable")
    places = np.flatnonzero(np.diff(to[order], prepend=-1))
    for a, b in zip(places, [*places[1:], len(order)] if len(order) else [], strict=True):
        part = order[a:b]
        part = part[np.lexsort((start[part], doc[part]))]
        yield int(to[part[0]]), kind, head + dump(np.diff(doc[part], prepend=0), check[part], start[part].astype(np.uint32), _counts(count[part]))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], names=["bucket", "kind", "blob"])


ROWS = "bucket long, kind int, blob binary"
REMOVED, WANTED, RUNS, BYTES_OF_RUNS, WANTED_HOT = 0, 1, 2, 3, 4


def _check(texts: pa.Array) -> np.ndarray:
    """A number that tells apart texts that share an id."""
    data, offsets = raw(texts)
    view = memoryview(data) if len(data) else b""
    return np.array([zlib.crc32(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint32)


def _send(held: list, length: int, n_anchors: int, n_docs: int):
    """Step 1's rows of some runs: those of one anchor meet, those settled here are passed on to their documents."""
    texts, bytes_ = np.cumsum([0, *(len(h[0]) for h in held[:-1])]), np.cumsum([0, *(len(h[7]) for h in held[:-1])])
    doc_ids, all_checks, data = (np.concatenate([h[k] for h in held]) for k in (0, 1, 7))
    base = np.concatenate([h[8] + f for h, f in zip(held, bytes_, strict=True)])
    row = np.concatenate([h[4] + f for h, f in zip(held, texts, strict=True)])
    anchor, run, start, count = (np.concatenate([h[k] for h in held]) for k in (2, 3, 5, 6))
    order = np.lexsort((run, anchor))
    anchor, run, row, start, count = (x[order] for x in (anchor, run, row, start, count))
    doc, check, place = doc_ids[row], all_checks[row], base[row] + start
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1]) | (count[1:] != count[:-1])))
    sizes = np.diff(np.append(first, len(doc)))
    least = np.minimum.reduceat(doc, first)
    holder = np.minimum.reduceat(np.where(doc == np.repeat(least, sizes), np.arange(len(doc)), len(doc)), first)
    later = np.flatnonzero(doc > np.repeat(least, sizes))
    holder = np.repeat(holder, sizes)[later]
    later = later[_same_bytes(data, place[later], place[holder], count[later] + length - 1)]
    rows = _passed_on(list(_blocks(doc[later], check[later], start[later], count[later], n_docs, REMOVED)), n_anchors)
    keep = np.ones(len(doc), bool)
    keep[later] = False
    anchor, row, start, count = (x[keep] for x in (anchor, row, start, count))
    to = _bucket(anchor, n_anchors)
    cuts = np.flatnonzero(np.diff(to, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(to)), strict=True):
        names, index = np.unique(row[a:b], return_inverse=True)
        index = index.astype(np.uint16 if len(names) < 65536 else np.uint32)
        rows.append((int(to[a]), RUNS, dump(np.diff(anchor[a:b], prepend=U(0)), doc_ids[names], all_checks[names], index, start[a:b].astype(np.uint32), _counts(count[a:b]))))
    return rows


def _find_runs(length: int, n_anchors: int, n_docs: int):
    def find(batches):
        held, n = [], 0
        for batch in batches:
            doc_ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            data, offsets = raw(texts)
            for a, b in slices(offsets, STEP):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                anchor, run, value, start, count = runs(part, at, length)
                if len(anchor):
                    held.append((doc_ids[a:b], _check(texts.slice(a, b - a)), anchor, run, value, start, count, part, at[:-1]))
                    n += len(anchor)
                if n >= FLUSH:
                    yield _rows(_send(held, length, n_anchors, n_docs))
                    held, n = [], 0
        if held:
            yield _rows(_send(held, length, n_anchors, n_docs))

    return find


def _ask(n_docs: int):
    """Step 2: runs whose anchor several documents have are asked for."""

    def ask(table: pa.Table) -> pa.Table:
        rows, parts = [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True):
            blob = blob.as_py()
            if kind == REMOVED:
                rows.append((int.from_bytes(blob[:8], "little"), REMOVED, blob[8:]))
                continue
            deltas, docs, checks, index, start, count = load(blob)
            parts.append((np.cumsum(deltas, dtype=np.uint64), docs[index], checks[index], start, count))
        if parts:
            anchor, doc, check, start, count = (np.concatenate(c) for c in zip(*parts, strict=True))
            del parts
            order = np.argsort(anchor)
            anchor, held = anchor[order], doc[order]
            first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            shared = np.minimum.reduceat(held, first) != np.maximum.reduceat(held, first)
            home, sizes = table.column("bucket")[0].as_py().to_bytes(8, "little"), np.diff(np.append(first, len(anchor)))
            for kind, groups in ((WANTED, shared & (sizes <= HOT)), (WANTED_HOT, shared & (sizes > HOT))):
                these = order[np.repeat(groups, sizes)]
                rows += _blocks(doc[these], check[these], start[these], count[these], n_docs, kind, home)
        return pa.Table.from_batches([_rows(rows)])

    return ask


def _places(docs: pa.Table, doc: np.ndarray, check: np.ndarray):
    """For entries, the numbers of the rows they mean; rows of one id and text come as (entry, row) pairs."""
    texts = pa.concat_arrays([c for c in docs.column("text").chunks]) if docs.num_rows else pa.array([], pa.string())
    ids, checks = docs.column("doc_id").to_numpy(), _check(texts)
    order = np.lexsort((checks, ids))
    both = lambda i, c: np.rec.fromarrays([i.astype(np.int64), c.astype(np.uint32)], names="i,c")
    keys = both(ids[order], checks[order])
    want = both(doc, check)
    a, b = np.searchsorted(keys, want, side="left"), np.searchsorted(keys, want, side="right")
    n = b - a
    entry = np.repeat(np.arange(len(doc)), n)
    row = order[np.repeat(a, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)] if len(entry) else np.zeros(0, np.int64)
    return texts, entry, row


def _entries(table: pa.Table, head: int = 0) -> list[np.ndarray] | None:
    """doc, check, start, count of all blobs, and the number in the blob's head if it has one."""
    parts = []
    for blob in table.column("blob"):
        blob = blob.as_py()
        docs, *rest = load(blob[head:])
        parts.append((np.cumsum(docs), *rest, *([np.full(len(docs), int.from_bytes(blob[:head], "little"))] if head else [])))
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else None


def _bytes_of(docs: pa.Table, wanted: pa.Table, kind: int, length: int):
    """doc, check, start, count, home of the runs asked for in one way, their bytes end to end, and where each one's begin."""
    entries = _entries(wanted.filter(pc.equal(wanted.column("kind"), kind)), 8)
    if entries is None or not docs.num_rows:
        return None
    texts, entry, row = _places(docs, entries[0], entries[1])
    _, once = np.unique(entry, return_index=True)  # rows of one id and text have one copy of the run
    entry, row = entry[once], row[once]
    data, offsets = raw(texts)
    doc, check, start, count, home = (x[entry] for x in entries)
    start, count = start.astype(np.int64), count.astype(np.int64)
    n = count + length - 1
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return doc, check, start, count, home, data[np.arange(total) + np.repeat(offsets[row] + start - (ends - n), n)], np.concatenate([[0], ends])


def _packed(to: np.ndarray, doc, check, start, count, data: np.ndarray, at: np.ndarray, length: int) -> list[tuple]:
    """Rows of runs and their bytes (``data`` from ``at``), dealt by ``to``."""
    order, rows = np.argsort(to, kind="stable"), []
    cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        part = order[a:b]
        n = count[part] + length - 1
        index = np.arange(int(n.sum())) + np.repeat(at[part] - (np.cumsum(n) - n), n)
        rows.append((int(to[part[0]]), BYTES_OF_RUNS, dump(np.diff(doc[part], prepend=0), check[part], start[part].astype(np.uint32), _counts(count[part]), data[index])))
    return rows


def _windows(count: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of runs: the run, the number within it, and the place."""
    owner = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, nth, at[owner] + nth


def _gone(gone: np.ndarray, owner: np.ndarray, nth: np.ndarray, doc, check, start, n_docs: int):
    """Rows of the windows that go; neighbours of a run go together."""
    x = np.flatnonzero(gone)
    if not len(x):
        return []
    first = np.flatnonzero(np.append(True, (np.diff(x) != 1) | (np.diff(owner[x]) != 0)))
    head, of = x[first], owner[x[first]]
    return list(_blocks(doc[of], check[of], start[of] + nth[head], np.diff(np.append(first, len(x))), n_docs, REMOVED))


def _passed_on(rows: list[tuple], n: int) -> list[tuple]:
    """Rows for documents, on their way through another bucket."""
    return [(b % n, kind, b.to_bytes(8, "little") + blob) for b, kind, blob in rows]


def _fetch(length: int, n_anchors: int, n_docs: int):
    """Step 3's bytes: those of the runs asked for, sent to who asked; those of hot anchors dealt anew."""

    def fetch(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = []
        if (found := _bytes_of(docs, wanted, WANTED, length)) is not None:
            doc, check, start, count, home, data, at = found
            rows += _packed(home, doc, check, start, count, data, at[:-1], length)
        if (found := _bytes_of(docs, wanted, WANTED_HOT, length)) is not None:
            doc, check, start, count, _, data, at = found
            owner, nth, places = _windows(count, at[:-1], length)
            gone = later_copies(data, places, length, doc[owner])
            rows += _passed_on(_gone(gone, owner, nth, doc, check, start, n_docs), n_anchors)
            anchor, _, value, first, n = runs(data, at, length, LONG_GRAM)
            window = (np.cumsum(count) - count)[value] + first
            up_to = np.concatenate([[0], np.cumsum(gone)])
            left = up_to[window + n] - up_to[window] < n
            value, first, n = value[left], first[left], n[left]
            rows += _packed(_bucket(anchor[left], n_anchors), doc[value], check[value], start[value] + first, n, data, at[value] + first, length)
        return pa.Table.from_batches([_rows(rows)])

    return fetch


class BlindTrie:
    """Orders strings of one size by their branching bytes alone; strings are compared in full once, when they arrive.

    An inner node is [depth, {byte: child}], a leaf is (string, members).
    """

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, member: int) -> None:
        if self.root is None:
            self.root = (key, [member])
            return
        node = self.root
        while isinstance(node, list):
            node = node[1].get(key[node[0]]) or next(iter(node[1].values()))
        if node[0] == key:
            node[1].append(member)
            return
        differ = int.from_bytes(node[0], "big") ^ int.from_bytes(key, "big")
        depth = len(key) - (differ.bit_length() + 7) // 8
        above, node_, byte = None, self.root, None
        while isinstance(node_, list) and node_[0] < depth:
            above, byte = node_, key[node_[0]]
            node_ = node_[1][byte]
        leaf = (key, [member])
        if isinstance(node_, list) and node_[0] == depth:
            node_[1][key[depth]] = leaf
            return
        inner = [depth, {node[0][depth]: node_, key[depth]: leaf}]
        if above is None:
            self.root = inner
        else:
            above[1][byte] = inner

    def leaves(self):
        """Leaves in the order of their strings."""
        todo = [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo.extend(child for _, child in sorted(node[1].items(), reverse=True))
            else:
                yield node


def later_copies(data: np.ndarray, starts: np.ndarray, length: int, owner: np.ndarray) -> np.ndarray:
    """Which of the strings of ``length`` bytes from the starts also start at a place of a smaller owner.

    Shallow: multikey steps of eight bytes; each sorts every group that the last one left
    equal, and groups of one owner go. Deep: groups that the shallow depth leaves are
    compared whole, and those that aren't all one string go to blind tries.
    """
    gone = np.zeros(len(starts), bool)
    if not len(starts):
        return gone
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)

    def word(at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(words[at]).view(">u8").reshape(-1).astype(np.uint64)

    order, bounds = np.arange(len(starts)), np.array([0, len(starts)])
    for depth in range(0, min(SHALLOW, length - 7), 8):
        keys = word(starts[order] + depth)
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        by = np.argsort(keys)
        if depth:  # and back to its group
            by = by[np.argsort(group[by].astype(np.uint64) << U(32) | np.arange(len(by), dtype=np.uint64))]
        order, keys, group = order[by], keys[by], group[by]
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])))
        sizes = np.diff(np.append(first, len(order)))
        owners = owner[order]
        live = np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)
        order = order[np.repeat(live, sizes)]
        bounds = np.concatenate([[0], np.cumsum(sizes[live])])
        if not len(order):
            return gone
    sizes = np.diff(bounds)
    same = np.ones(len(order), bool)
    for at in [*range(min(SHALLOW, length - 7) // 8 * 8, length - 7, 8), length - 8]:
        keys = word(starts[order] + at)
        same &= keys == np.repeat(keys[bounds[:-1]], sizes)
    whole = np.logical_and.reduceat(same, bounds[:-1])
    owners = owner[order]
    gone[order] = (owners > np.repeat(np.minimum.reduceat(owners, bounds[:-1]), sizes)) & np.repeat(whole, sizes)
    text = data.tobytes()
    for i in np.flatnonzero(~whole & (sizes > 2)):  # two strings that differ have no copy
        trie, members = BlindTrie(), order[bounds[i] : bounds[i + 1]]
        for x, s in zip(members.tolist(), starts[members].tolist(), strict=True):
            trie.insert(text[s : s + length], x)
        for _, equal in trie.leaves():
            if len(equal) > 1:
                these = owner[equal]
                gone[equal] = these > these.min()
    return gone


def _sort(length: int, n_docs: int):
    """Step 3: the suffixes of a bucket's runs, sorted; the runs of windows that go."""

    def sort(table: pa.Table) -> pa.Table:
        rows, parts = [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True):
            blob = blob.as_py()
            if kind == REMOVED:
                rows.append((int.from_bytes(blob[:8], "little"), REMOVED, blob[8:]))
                continue
            docs, *rest = load(blob)
            parts.append((np.cumsum(docs), *rest))
        if parts:
            doc, check, start, count, data = (np.concatenate(c) for c in zip(*parts, strict=True))
            start, count = start.astype(np.int64), count.astype(np.int64)
            owner, nth, places = _windows(count, np.cumsum(count + length - 1) - (count + length - 1), length)
            rows += _gone(later_copies(data, places, length, doc[owner]), owner, nth, doc, check, start, n_docs)
        return pa.Table.from_batches([_rows(rows)])

    return sort


def _apply(length: int, keep_text: bool):
    """Each document of a block with its removed bytes."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept_text"] if keep_text else [])]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def apply(docs: pa.Table, removed: pa.Table) -> pa.Table:
        entries = _entries(removed)
        if entries is None:
            entries = [np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.uint8)]
        texts, entry, row = _places(docs, entries[0], entries[1])
        data, offsets = raw(texts)
        step = np.zeros(len(data) + 1, np.int32)
        at = offsets[row] + entries[2][entry].astype(np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + entries[3][entry].astype(np.int64) + length - 1, -1)
        mask = np.cumsum(step[:-1], dtype=np.int32) > 0
        out, view = [], data.tobytes()
        touched = np.zeros(docs.num_rows, bool)
        touched[row] = True
        for i in range(docs.num_rows):
            a, b = int(offsets[i]), int(offsets[i + 1])
            if not touched[i]:
                out.append((b - a, 0, 0, hashlib.sha256(view[a:b]).hexdigest(), [], texts[i].as_py() if keep_text else None))
                continue
            m = mask[a:b]
            turn = np.flatnonzero(np.diff(np.concatenate([[False], m, [False]]).astype(np.int8)))
            kept = data[a:b][~m].tobytes()
            text = None
            if keep_text:
                text = kept_text(view[a:b], m)
            out.append((b - a, int(m.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(), [{"start": int(s), "end": int(e)} for s, e in zip(turn[::2], turn[1::2], strict=True)], text))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.string()]
        arrays = [docs.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        return pa.table(dict(zip(names, arrays, strict=False)))

    return apply


def kept_text(whole: bytes, gone: np.ndarray) -> str:
    """The kept bytes as text; characters of which a removed run holds only a part stay whole."""
    gone = gone.copy()
    data = np.frombuffer(whole, np.uint8)
    lead = (data & 0xC0) != 0x80
    if not lead.all():
        char = np.cumsum(lead) - 1
        all_gone = np.ones(int(char[-1]) + 1, bool)
        np.logical_and.at(all_gone, char, gone)
        gone = all_gone[char]
    return data[~gone].tobytes().decode()


def _prime(n: int) -> int:
    n = max(2, n)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte offsets of maximal removed runs), and kept_text if asked for.

    One row for each row of ``docs``. Strings are judged on the input. Null texts are
    empty; texts shorter than ``length`` lose nothing. Rows with a null doc_id neither
    lose nor take anything. Rows that share an id take nothing from each other, and each
    loses what starts in smaller ids; kept_text leaves characters whole of which only a
    part is removed. Other columns are not read; an empty table gives no rows.
    """
    if length < 16:
        raise ValueError("length must be 16 at least")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    named = rows.filter("doc_id IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = _prime(-(-total // bucket_bytes))
    dealt = named.select(F.pmod("doc_id", F.lit(n)).cast("long").alias("bucket"), "doc_id", "text")
    found = named.mapInArrow(tidy_stream(_find_runs(length, n, n)), ROWS).groupBy("bucket").applyInArrow(tidy(_ask(n)), ROWS)
    found = written(found, "runs", files_for(docs))
    wanted = found.filter(F.col("kind").isin(WANTED, WANTED_HOT))
    pieces = dealt.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(tidy_pair(_fetch(length, n, n)), ROWS)
    parted = pieces.groupBy("bucket").applyInArrow(tidy(_sort(length, n)), ROWS)
    removed = found.filter(F.col("kind") == REMOVED).union(parted)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>" + (", kept_text string" if keep_text else "")
    out = dealt.groupBy("bucket").cogroup(removed.groupBy("bucket")).applyInArrow(tidy_pair(_apply(length, keep_text)), schema)
    nameless = rows.filter("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"), *([F.col("text").alias("kept_text")] if keep_text else []),
    )
    return out.union(nameless)
