"""Words of many texts at once, as 64-bit hashes in NumPy arrays.

A word is a run of ASCII letters, digits and characters beyond ASCII, with A-Z in
lower case. In UTF-8 those are exactly the runs of such bytes, so whole buffers
are cut and hashed without decoding a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 20  # text handled in one go; a longer text goes alone
LONG_WORD = 512  # longer words get a hash of their own kind

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; the same number always gives the same result."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_BYTE_VALUE[65:91] = _BYTE_VALUE[97:123]
_BYTE_VALUE[~_IS_WORD] = 0

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """The words of some texts: ``hashes``, ``starts``, ``ends`` (bytes), ``first``.

    ``first[i]`` is the index of the first word of text i, and ``first[-1]`` the
    number of words; ``data`` and ``offsets`` are the bytes they come from.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = _IS_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        after = np.zeros(len(data) + 1, bool)  # a word runs up to this byte
        after[1:] = inside
        begins = inside & (~after[:-1] | edge[:-1])
        self.starts = np.flatnonzero(begins)
        before = np.zeros(len(data) + 1, bool)
        before[:-1] = inside
        self.ends = np.flatnonzero(inside & (~before[1:] | edge[1:])) + 1
        if len(self.starts):
            power, inverse = _power(len(data))
            sums = np.add.reduceat(_BYTE_VALUE[data] * power, self.starts)
            self.hashes = mix(sums * inverse[self.starts])
            for i in np.flatnonzero(self.ends - self.starts > LONG_WORD):
                word = data[self.starts[i] : self.ends[i]].tobytes().lower()
                self.hashes[i] = xxhash.xxh3_64_intdigest(word)
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a NULL is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(begin, end, words) for consecutive texts of bounded size."""
    if len(texts) == 0:
        return
    data, offsets = text_buffer(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        piece = data[offsets[begin] : offsets[end]]
        yield begin, end, Words(piece, offsets[begin : end + 1] - offsets[begin])
        begin = end


def all_words(texts: pa.Array) -> Words:
    """The words of some texts in one go; for few texts."""
    return Words(*text_buffer(texts))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of ``size`` words.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    count = np.diff(words.first)
    n = len(words.hashes)
    full = np.maximum(count - size + 1, (count > 0).astype(count.dtype))
    owner = np.repeat(np.arange(len(count)), full)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    at = words.first[:-1][owner] + inside
    found = np.zeros(len(owner), np.uint64)
    last = words.first[1:][owner]
    for step in range(size):
        here = at + step
        valid = here < last
        if n:
            piece = np.where(valid, words.hashes[np.minimum(here, n - 1)], np.uint64(0))
            found = found * np.uint64(0xE7037ED1A0B428DB) + piece
    return mix(found), owner
