"""FM-index over the words of a block of documents."""

from __future__ import annotations

import numpy as np

from segue.llm.wavelet import Plane, WaveletMatrix

SAMPLE = 16  # every so many positions of a document are stored


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; the numbers of ``codes`` are above 0.

    Suffixes are sorted by as many numbers as fit 62 bits, then by twice as many
    each time; only those still equal to another one are sorted again.
    """
    size = len(codes)
    width = max(1, int(codes.max(initial=1)).bit_length())
    depth = max(1, 62 // width)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(depth, np.int64)])
    key = np.zeros(size, np.int64)
    for step in range(depth):
        key = key << width | padded[step : step + size]
    order = np.argsort(key)
    key = key[order]
    place = np.arange(size)
    head = np.ones(size, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(size + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))
    rank[size] = -1
    open_ = ~head
    open_[:-1] |= ~head[1:]
    slots = place[open_]
    while len(slots):
        starts = order[slots]
        key = rank[starts] * (size + 1) + rank[np.minimum(starts + depth, size)] + 1
        by = np.argsort(key)
        starts, key = starts[by], key[by]
        order[slots] = starts
        head = np.ones(len(slots), bool)
        head[1:] = key[1:] != key[:-1]
        rank[starts] = np.maximum.accumulate(np.where(head, slots, 0))
        open_ = ~head
        open_[:-1] |= ~head[1:]
        slots = slots[open_]
        depth *= 2
    return order


class FmIndex:
    """Backward search for runs of words, and where they lie.

    The sequence holds the words of all documents, each document followed by an
    end of its own, so that no run crosses from one to the next. Words are known
    by their hashes; frequent ones get small codes, the ends code 0.
    """

    def __init__(self, size, first, hashes, counts, matrix, marks, samples):
        self.size, self.first, self.hashes, self.counts = size, first, hashes, counts
        self.matrix, self.marks, self.samples = matrix, marks, samples
        ends = len(first) - 1
        # Suffixes that start with a smaller code; the ends come first.
        self.before = np.concatenate([[0], ends + np.cumsum(counts) - counts])
        self.base = matrix.follow(
            np.arange(len(counts) + 1), np.zeros(len(counts) + 1, np.int64)
        )
        self.by_hash = np.argsort(hashes)
        self.sorted_hashes = hashes[self.by_hash]

    @classmethod
    def build(cls, words: np.ndarray, doc_words: np.ndarray) -> FmIndex:
        """From the hashes of all words and the number of words per document."""
        docs = len(doc_words)
        first = np.concatenate([[0], np.cumsum(doc_words + 1)])
        size = int(first[-1])
        hashes, codes, counts = np.unique(words, return_inverse=True, return_counts=True)
        falling = np.argsort(-counts, kind="stable")
        number = np.empty(len(hashes), np.int64)
        number[falling] = np.arange(len(hashes)) + 1
        sequence = np.zeros(size, np.int64)
        is_end = np.zeros(size, bool)
        is_end[first[1:] - 1] = True
        sequence[~is_end] = number[codes]
        # For the order, ends differ and come before all words.
        ordered = sequence + docs
        ordered[is_end] = np.arange(1, docs + 1)
        order = suffix_order(ordered)
        last = sequence[order - 1]
        marked = np.zeros(size, bool)
        inside = np.arange(size) - np.repeat(first[:-1], doc_words + 1)
        marked[inside % SAMPLE == 0] = True
        marks = marked[order]
        return cls(
            size,
            first,
            hashes[falling],
            counts[falling],
            WaveletMatrix.build(last.astype(np.uint32), max(1, len(hashes).bit_length())),
            Plane.build(marks),
            order[marks],
        )

    def dump(self) -> dict:
        return {
            "size": self.size,
            "hashes": self.hashes.tobytes(),
            "counts": self.counts.astype("<u4").tobytes(),
            "planes": self.matrix.dump(),
            "marks": self.marks.packed.tobytes(),
            "samples": self.samples.astype("<u4").tobytes(),
        }

    @classmethod
    def load(cls, row: dict, doc_words: np.ndarray) -> FmIndex:
        return cls(
            row["size"],
            np.concatenate([[0], np.cumsum(doc_words + 1)]),
            np.frombuffer(row["hashes"], np.uint64),
            np.frombuffer(row["counts"], "<u4").astype(np.int64),
            WaveletMatrix.load(row["planes"], row["size"]),
            Plane.load(row["marks"], row["size"]),
            np.frombuffer(row["samples"], "<u4").astype(np.int64),
        )

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of words, 0 for those that do not occur."""
        if len(self.sorted_hashes) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.sorted_hashes, hashes), len(self.sorted_hashes) - 1)
        return np.where(self.sorted_hashes[at] == hashes, self.by_hash[at] + 1, 0)

    def _step(self, code: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.before[code] + self.matrix.follow(code, row) - self.base[code]

    def search(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(phrase, from row, to row) of the phrases that occur.

        A phrase is a stretch of ``codes``; from its last word to its first, the
        range of suffixes that begin with what was read narrows.
        """
        unknown = np.concatenate([[0], np.cumsum(codes == 0)])
        phrase = np.flatnonzero(unknown[starts + lengths] == unknown[starts])
        low = np.zeros(len(phrase), np.int64)
        high = np.full(len(phrase), self.size, np.int64)
        step = 1
        while len(phrase):
            reading = step <= lengths[phrase]
            if not reading.any():
                break
            code = codes[np.where(reading, starts[phrase] + lengths[phrase] - step, 0)]
            both = self._step(
                np.concatenate([code[reading]] * 2), np.concatenate([low[reading], high[reading]])
            )
            low[reading], high[reading] = np.split(both, 2)
            found = low < high
            phrase, low, high = phrase[found], low[found], high[found]
            step += 1
        return phrase, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of some suffixes: steps back to the nearest sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            here = self.marks.get(rows)
            if here.any():
                found[open_[here]] = self.samples[self.marks.rank1(rows[here])] + steps
                open_, rows = open_[~here], rows[~here]
            if len(open_):
                code, at = self.matrix.descend(rows)
                rows = self.before[code] + at - self.base[code]
                steps += 1
        return found
