"""Words of whole texts and 64-bit hashes of word sequences, on numpy arrays.

The texts of an Arrow column lie in one UTF-8 buffer. Word classes are given
by ASCII ranges with every non-ASCII character on one side, so they can be
decided byte by byte, and all words of many texts are found and lowered in a
few array operations.

Words are coded by a dictionary, and each distinct one is hashed by BLAKE2, so
no two words, however made, share a hash but by a chance of 2**-64. A
sequence's hash is a polynomial over word hashes modulo 2**64, taken from
running sums: the hash of any window costs one subtraction and one product.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

# Byte classes: whether a byte belongs to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.ones(256, bool)  # digits, letters and everything beyond ASCII
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    ALNUM[_a:_b + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 2**64))


@lru_cache(maxsize=1)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << log2
    up, down = np.full(n, _P), np.full(n, _PINV)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The integers first[i] .. first[i] + size[i] - 1 for every i, in a row."""
    total = int(size.sum())
    if not total:
        return np.empty(0, np.int64)
    skip = np.concatenate(([0], np.cumsum(size[:-1])))
    return np.repeat(first - skip, size) + np.arange(total)


class Words:
    """The words of some texts. ``start``/``end``: byte ranges in ``data``;
    ``first[i]:first[i + 1]``: the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool):
        self.data = data = _LOWER[data] if lower else data
        self.n_texts = len(offsets) - 1
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = is_word[data]
        starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = offsets[:-1][offsets[:-1] < offsets[1:]]  # a word never runs over a text's end
        starts[cut] = inside[1:-1][cut]
        cut = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[cut] = inside[1:-1][cut]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sums = self._coded = None

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def coded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A 64-bit hash of every word; the words' bytes in a row, and their ends."""
        if self._coded is None:
            size = self.end - self.start
            data, ends = self.data[ranges(self.start, size)], np.concatenate(([0], np.cumsum(size)))
            column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            words = column.dictionary_encode()
            known = np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
                                 for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
            self._coded = known[words.indices.to_numpy()], data, ends
        return self._coded

    def _running(self) -> None:
        up, down = _powers(max(20, int(len(self.start) + 1).bit_length()))
        word = self.coded()[0]
        self._sums = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(word * up[:len(word)], out=self._sums[1:])
        self._down = down

    def windows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a[i] .. b[i] - 1, for every i."""
        if self._sums is None:
            self._running()
        h = (self._sums[b] - self._sums[a]) * self._down[a]
        return mix(h + np.asarray(b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def all_windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and text of every window of k words within one text."""
        n = np.maximum(self.count - k + 1, 0)
        return ranges(self.first[:-1], n), np.repeat(np.arange(self.n_texts), n)


def word_shingles(text: str | None, k: int) -> set:
    """The distinct k-word shingles of a text in lower case (A-Z), as words; of fewer words, all as one."""
    w = (text or "").encode().lower().split()  # of bytes: A-Z and the six ASCII spaces only
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else {tuple(w)} if w else set()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def texts_in_chunks(column: pa.Array, is_word: np.ndarray, lower: bool,
                    limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, their words) for chunks of a string column."""
    data, offsets = utf8(column)
    for i, j in chunks(offsets, limit):
        yield i, j, Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], is_word, lower)
