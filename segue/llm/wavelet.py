"""Wavelet matrices: sequences of numbers as bit planes with rank and select."""

from __future__ import annotations

from functools import cached_property

import numpy as np

WORD = 64  # bits per entry of the rank directory


class Plane:
    """A bit vector whose ones can be counted and found.

    Its directory, the ones before every 64-bit word, takes one pass over the
    words and is made when it is first asked for.
    """

    def __init__(self, packed: np.ndarray, size: int):
        self.packed, self.size = packed, size
        self.words = packed.view(np.uint64)

    @classmethod
    def build(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(bits) // WORD + 1) * (WORD // 8), np.uint8)
        padded[: len(packed)] = packed
        return cls(padded, len(bits))

    @classmethod
    def load(cls, packed: bytes, size: int) -> Plane:
        return cls(np.frombuffer(packed, np.uint8), size)

    @cached_property
    def ones(self) -> np.ndarray:
        found = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=found[1:])
        return found

    @cached_property
    def zeros(self) -> int:
        return self.size - int(np.bitwise_count(self.words).sum(dtype=np.int64))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.size, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position (0 to size)."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[word] + np.bitwise_count(self.words[word] & below)

    def select(self, wanted: np.ndarray, one: bool) -> np.ndarray:
        """Position of the wanted-th (from 0) one or zero."""
        before = self.ones if one else np.arange(len(self.ones)) * WORD - self.ones
        word = np.searchsorted(before, wanted, side="right") - 1
        bits = np.unpackbits(
            self.packed.reshape(-1, WORD // 8)[word], axis=1, bitorder="little"
        )
        running = np.cumsum(bits == one, axis=1)
        return word * WORD + (running <= (wanted - before[word])[:, None]).sum(axis=1)


class WaveletMatrix:
    """A sequence over [0, 2^levels), highest bit in the first plane.

    Every plane holds one bit of each number in the order of the plane before it
    with its zeros first, both in their old order.
    """

    def __init__(self, planes: list[Plane], size: int):
        self.planes, self.size = planes, size

    @classmethod
    def build(cls, values: np.ndarray, levels: int) -> WaveletMatrix:
        planes, now = [], values
        for level in reversed(range(levels)):
            bits = (now & now.dtype.type(1 << level)) != 0
            planes.append(Plane.build(bits))
            now = np.concatenate([now[~bits], now[bits]])
        return cls(planes, len(values))

    def dump(self) -> list[bytes]:
        return [p.packed.tobytes() for p in self.planes]

    @classmethod
    def load(cls, packed: list[bytes], size: int) -> WaveletMatrix:
        return cls([Plane.load(p, size) for p in packed], size)

    def decode(self, kind=np.uint32) -> np.ndarray:
        """The whole sequence, by undoing the planes from the last to the first."""
        now = np.zeros(self.size, kind)
        for level, plane in enumerate(reversed(self.planes)):
            bits = plane.bits()
            before = np.empty_like(now)
            before[~bits] = now[: plane.zeros]
            before[bits] = now[plane.zeros :] | kind(1 << level)
            now = before
        return now

    def descend(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at some positions, and where they lie after the last plane."""
        at = np.asarray(at, np.int64)
        values = np.zeros(len(at), np.int64)
        for plane in self.planes:
            bits, ones = plane.get(at), plane.rank1(at)
            at = np.where(bits, plane.zeros + ones, at - ones)
            values = values << 1 | bits
        return values, at

    def access(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some positions."""
        return self.descend(at)[0]

    def follow(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``value`` at or after each position lies after the last plane."""
        value, at = np.asarray(value, np.int64), np.asarray(at, np.int64)
        for level, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            ones = plane.rank1(at)
            at = np.where(value >> level & 1, plane.zeros + ones, at - ones)
        return at

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position."""
        return self.follow(value, at) - self.follow(value, np.zeros_like(at))

    def occurrences(self, value: int) -> np.ndarray:
        """All positions of a value, ascending."""
        begin, end = np.zeros(1, np.int64), np.full(1, self.size, np.int64)
        for level, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            low, high = plane.rank1(begin), plane.rank1(end)
            if value >> level & 1:
                begin, end = plane.zeros + low, plane.zeros + high
            else:
                begin, end = begin - low, end - high
        at = np.arange(begin[0], end[0])
        for level, plane in enumerate(reversed(self.planes)):
            one = bool(value >> level & 1)
            at = plane.select(at - plane.zeros if one else at, one)
        return at
