"""Token ids and counts by a public tokenizer, fast enough for a whole corpus.

The tokenizer's pre-tokenizer never lets a token span a blank or a newline, and parts
letters from punctuation, so a text's ids are those of its blank-separated chunks in a
row. A block of texts has each of its distinct chunks looked up once, in a store that
each worker keeps as Arrow and numpy arrays; the tokenizer itself does those not in it,
many a call: the last token of each pre-token is marked as its end, so the ids of a line
of chunks fall apart again. The store keeps what the last block needed and then the
newest, which bounds its memory and changes no result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .hashing import raw, slices

#: Chunks kept by a worker.
STORE = 600_000
#: Longer chunks (bytes) are not kept.
LONGEST = 64
#: Chunks a line, and lines a call of the tokenizer.
TOGETHER, LINES = 500, 64
#: Bytes of text whose distinct chunks are looked up together, and chunks whose ids are put together at once.
BLOCK, STEP = 6_000_000, 200_000
#: Letters that are single, composed code points are one pre-token, marks behind them another; all else the tokenizer gets alone.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r'[!"#$%&()*+,\-./:;=?@\[\]^_{|}~]+'


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Ids of whole texts by a ``tokenizers`` file whose tokens never span white space, and whose words' last tokens end in ``</w>``."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.store = pa.array([], pa.large_string())
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tokenize(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chunks' ids: where each one's begin, how many there are, and all of them."""
        n = len(chunks)
        sizes, starts, parts, at = np.zeros(n, np.int32), np.zeros(n, np.int64), [], 0
        words = pc.match_substring_regex(chunks, f"^{_LETTERS}$").to_numpy(zero_copy_only=False)
        marked = pc.match_substring_regex(chunks, f"^{_LETTERS}{_MARKS}$").to_numpy(zero_copy_only=False)
        odd = ~(words | marked)
        plain = np.flatnonzero(~odd)
        texts = chunks.take(pa.array(plain)).to_pylist()
        for first in range(0, len(plain), TOGETHER * LINES):
            these = plain[first : first + TOGETHER * LINES]
            lines = [" ".join(texts[k : k + TOGETHER]) for k in range(first, first + len(these), TOGETHER)]
            ids = np.concatenate(self._encode(lines))
            stops = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(1 + marked[these]) - 1
            if last[-1] + 1 != len(stops):  # this tokenizer does not mark the end of each word: one by one
                odd[these] = True
                continue
            ends = stops[last]
            starts[these[0]], starts[these[1:]] = at, at + ends[:-1]
            sizes[these] = np.diff(ends, prepend=0)
            parts.append(ids)
            at += len(ids)
        alone = np.flatnonzero(odd)
        for first in range(0, len(alone), 4096):
            these = alone[first : first + 4096]
            found = self._encode(chunks.take(pa.array(these)).to_pylist())
            sizes[these] = [len(x) for x in found]
            starts[these] = at + np.cumsum(sizes[these]) - sizes[these]
            parts += found
            at += int(sizes[these].sum())
        return starts, sizes, np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def _lookup(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_tokenize`` for different chunks, by the store where it has them."""
        place = pc.index_in(chunks, value_set=self.store).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        miss = np.flatnonzero(place < 0)
        new = chunks.take(pa.array(miss))
        starts, sizes, flat = self._tokenize(new)
        place[miss] = len(self.store) + np.arange(len(miss))
        all_starts, all_sizes, all_flat = np.concatenate([self.starts, starts + len(self.flat)]), np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        self._keep(pa.concat_arrays([self.store, new]), all_starts, all_sizes, all_flat, place)
        return all_starts[place], all_sizes[place], all_flat

    def _keep(self, chunks: pa.Array, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, used: np.ndarray) -> None:
        if len(chunks) > STORE:
            rank = np.arange(len(chunks))  # the newest last, those of this block behind all others
            rank[used] += len(chunks)
            kept = np.sort(np.argpartition(rank, len(chunks) - STORE)[len(chunks) - STORE :])
        else:
            kept = np.arange(len(chunks))
        kept = kept[pc.binary_length(chunks).to_numpy()[kept] <= LONGEST]
        if len(kept) < len(chunks):
            chunks, starts, sizes = chunks.take(pa.array(kept)), starts[kept], sizes[kept]
            flat, starts = _gather(flat, starts, sizes), np.cumsum(sizes) - sizes
        self.store, self.starts, self.sizes, self.flat = chunks, starts, sizes, flat

    def _looked_up(self, texts: pa.Array):
        """Where each text's chunks begin, the number of each chunk among the distinct ones, and their ids."""
        lists = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        return lists.offsets.to_numpy() - lists.offsets[0].as_py(), coded.indices.to_numpy(), *self._lookup(coded.dictionary)

    def counts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """How many ids each text has, a block at a time; null has none."""
        for a, b in _blocks(column):
            at, index, _, sizes, _ = self._looked_up(column.slice(a, b - a))
            yield np.diff(np.concatenate([[0], np.cumsum(sizes[index], dtype=np.int64)])[at])

    def encoded(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of texts: the first one's number, the ids of all end to end, and where each text's begin; null is empty."""
        for a, b in _blocks(column):
            at, index, starts, sizes, flat = self._looked_up(column.slice(a, b - a))
            for x, y in slices(at, STEP):
                part = index[at[x] : at[y]]
                ends = np.concatenate([[0], np.cumsum(sizes[part], dtype=np.int64)])
                yield a + x, _gather(flat, starts[part], sizes[part]), ends[at[x : y + 1] - at[x]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        return [ids[a:b].tobytes() for _, ids, at in self.encoded(pa.array(texts, pa.string())) for a, b in zip(at[:-1], at[1:], strict=True)]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]`` end to end."""
    ends = np.cumsum(sizes, dtype=np.int64)
    n = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(n) + np.repeat(starts - (ends - sizes), sizes)]


def _blocks(column: pa.Array):
    """Runs of a string column of about ``BLOCK`` bytes: (first, end)."""
    return slices(raw(column)[1], BLOCK)


_tokenizers: dict[str | None, ChunkTokenizer] = {}


def tokenizer_of(path: str | None) -> ChunkTokenizer:
    """The worker's tokenizer for a path: what it has met serves later tasks, too."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def crc32(ids) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
