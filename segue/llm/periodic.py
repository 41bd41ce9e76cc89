"""Periodic runs of words, found with minimizers at growing scales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.llm.simhash import word_pieces
from segue.llm.words import mix

LEAST_WORDS = 24
LEAST_PERIODS = 3
FIRST_SCALE = 8  # words of a minimizer's stretch at the smallest scale
CHUNK_WORDS = 1 << 17  # words searched in one go; a longer text goes alone
_NONE = np.uint64((1 << 64) - 1)


class _Codes(dict):
    """Numbers of words, in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class _Repeats:
    """Maximal stretches that repeat with some lag, in a sequence of codes.

    A stretch of lag q is [start, end) with equal codes q apart; ``period`` is the
    smallest lag found for it.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.period: dict[tuple[int, int], int] = {}
        self.reached: dict[int, int] = {}  # by lag, the end of the last stretch looked at

    def add(self, start: int, end: int, lag: int) -> None:
        self.period[start, end] = min(lag, self.period.get((start, end), lag))

    def scan(self, lag: int, least: int) -> None:
        """All stretches of a lag that have at least ``least`` words."""
        if len(self.codes) <= lag:
            return
        same = np.zeros(len(self.codes) - lag + 2, bool)
        same[1:-1] = self.codes[lag:] == self.codes[:-lag]
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, past = edges[::2], edges[1::2]
        for at in np.flatnonzero(past - starts + lag >= least).tolist():
            self.add(int(starts[at]), int(past[at]) + lag, lag)

    def _equal(self, at: int, lag: int, step: int) -> int:
        """How many codes from ``at`` on (or before it) equal those ``lag`` later."""
        codes, found, block = self.codes, 0, 16
        while True:
            if step > 0:
                a, b = at + found, min(at + found + block, len(codes) - lag)
            else:
                a, b = max(at - found - block, 0), at - found
            if a >= b:
                return found
            same = codes[a:b] == codes[a + lag : b + lag]
            if not same.all():
                return found + int(np.argmin(same) if step > 0 else np.argmin(same[::-1]))
            found += b - a
            block *= 2

    def extend(self, at: int, lag: int, least: int) -> None:
        """The stretch of this lag around ``at``; positions of a lag come ascending."""
        if at < self.reached.get(lag, 0):
            return
        end = at + self._equal(at, lag, 1)
        start = at - self._equal(at, lag, -1)
        self.reached[lag] = end
        if end - start + lag >= least:
            self.add(start, end + lag, lag)


def _window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Positions of the first smallest value of every window of ``size`` (a power of 2)."""
    best, at, step = values, np.arange(len(values)), 1
    while step < size:
        lower = best[step:] < best[:-step]
        at = np.where(lower, at[step:], at[:-step])
        best = np.where(lower, best[step:], best[:-step])
        step *= 2
    return np.unique(at[best < _NONE])


def find_repeats(codes: np.ndarray, lengths: np.ndarray) -> dict[tuple[int, int], int]:
    """{(start, end): period} of the stretches with at least three periods.

    ``codes`` holds several sequences of ``lengths`` codes in a row, each followed by
    a code that occurs nowhere else, so that no stretch crosses from one to the next.

    Lags below twice ``FIRST_SCALE`` are scanned directly. For a scale of w words,
    stretches of w words get a hash, and those that are smallest in a window of w
    such stretches are minimizers. A run of period q in [2 w, 4 w) holds a window
    and the same one q words later, which have the same minimizer, so pairs of equal
    minimizers q apart are seeds, which are extended word by word. Stretches
    that themselves repeat within w / 3 words lie in what smaller scales found and
    are left out (a run does not consist of them alone), so that equal ones lie
    more than w / 3 apart and each has few partners. Larger scales only look at
    sequences that can hold three of their periods.
    """
    found = _Repeats(codes)
    longest = int(lengths.max(initial=0))
    for lag in range(1, 2 * FIRST_SCALE):
        # Short ones are kept as well: whether a stretch is left out must follow from
        # its own words.
        found.scan(lag, max(FIRST_SCALE, LEAST_PERIODS * lag))
    width = FIRST_SCALE
    # The sequences still looked at, where their codes lie, and their hashes.
    place = np.arange(len(codes))
    hashes = mix(codes.astype(np.uint64) + np.uint64(1))
    owner_length = np.repeat(lengths, lengths + 1)
    step = 1
    while 2 * LEAST_PERIODS * width <= longest:
        kept = owner_length >= 2 * LEAST_PERIODS * width
        if not kept.all():
            place, hashes, owner_length = place[kept], hashes[kept], owner_length[kept]
        while step < width:  # hashes of twice as many words
            hashes = hashes * np.uint64(0xE7037ED1A0B428DB)
            hashes[:-step] += mix(hashes[step:])
            step *= 2
        shown = hashes[: len(hashes) - width + 1].copy()
        shown[shown == _NONE] = 0
        out = np.zeros(len(codes) + 1, np.int64)
        for (start, end), period in found.period.items():
            if LEAST_PERIODS * period <= width <= end - start:
                out[start] += 1
                out[end - width + 1] -= 1
        shown[(np.cumsum(out) > 0)[place[: len(shown)]]] = _NONE
        seeds = _window_minima(shown, width)
        order = np.lexsort((seeds, shown[seeds]))
        seeds = seeds[order]
        pairs, ahead = [], 1
        while ahead < len(seeds):
            a, b = seeds[:-ahead], seeds[ahead:]
            near = (shown[a] == shown[b]) & (b - a < 4 * width)
            if not near.any():
                break
            near &= b - a >= 2 * width
            pairs.append(np.stack([(b - a)[near], a[near]]))
            ahead += 1
        if pairs:
            lags, at = np.concatenate(pairs, axis=1)
            for lag, p in sorted(zip(lags.tolist(), place[at].tolist(), strict=True)):
                found.extend(p, lag, LEAST_PERIODS * lag)
        width *= 2
    return found.period


def _search(counts: list[int], codes: list[np.ndarray], least: int) -> list[np.ndarray]:
    """Per sequence its runs (start, length, period), by start and then period."""
    lengths = np.array(counts, np.int64)
    first = np.cumsum(lengths + 1) - lengths - 1
    ends = np.arange(len(counts)) - len(counts)  # codes of words are not below 0
    joined = np.empty(int(lengths.sum()) + len(counts), np.int64)
    for at, own, end in zip(first, codes, ends, strict=True):
        joined[at : at + len(own)], joined[at + len(own)] = own, end
    found = find_repeats(joined, lengths)
    runs = [
        (s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, LEAST_PERIODS * q)
    ]
    rows = np.array(sorted(runs), np.int64).reshape(-1, 3)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    edges = np.searchsorted(rows[:, 0], first)
    parts = np.split(rows, edges[1:]) if len(first) else []
    return [part - np.array([at, 0, 0]) for part, at in zip(parts, first, strict=True)]


def repeated_words(runs: np.ndarray, words: int) -> np.ndarray:
    """Which words lie in a run after its first period."""
    edges = np.zeros(words + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def _collapse(text: bytes, runs: np.ndarray, words: int) -> bytes:
    """The words that are kept, joined by one space."""
    if not len(runs):
        return b" ".join([b" ".join(p) for p in word_pieces(text) if p])
    kept, done, parts = ~repeated_words(runs, words), 0, []
    for piece in word_pieces(text):
        chosen = kept[done : done + len(piece)].tolist()
        parts += [w for w, k in zip(piece, chosen, strict=True) if k]
        done += len(piece)
    return b" ".join(parts)


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(id, n_words, runs, collapsed), one row per input row.

    Words are what ASCII white space separates. A run is a maximal stretch of
    consecutive words with a smallest period q (words q apart are equal) of at least
    ``least_words`` words and three periods. ``runs`` lists (start, length,
    period) by start, then period; ``collapsed`` is the text without those words
    that lie in a run after its first q words, joined by one space.

    Rows stay where they lie; there is no shuffle. Texts are searched together in
    chunks of about ``CHUNK_WORDS`` words (``find_repeats``).

    A NULL or empty text has no words and no runs; its ``collapsed`` is empty. The id
    is only passed on, NULL too. A very long text is cut into words in pieces and
    takes about 100 bytes of memory per word while it is searched. Runs may overlap,
    and a shorter period may run inside a longer one: all are listed. Repeated
    rows are judged alike, other columns of ``docs`` play no part, and an empty
    table gives no rows.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", kind), ("collapsed", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, counts, codes, numbers = [], [], [], [], _Codes()

        def close() -> pa.RecordBatch:
            runs = _search(counts, codes, least_words)
            flat = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            collapsed = [_collapse(*x).decode() for x in zip(texts, runs, counts, strict=True)]
            columns = [ids, counts, pa.ListArray.from_arrays(offsets, structs, type=kind), collapsed]
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                own = [
                    np.fromiter(map(numbers.__getitem__, p), np.int64, len(p)) for p in word_pieces(data)
                ]
                codes.append(np.concatenate([np.zeros(0, np.int64), *own]))
                ids.append(key.as_py())
                texts.append(data)
                counts.append(len(codes[-1]))
                held += counts[-1] + 1
                if held >= CHUNK_WORDS:
                    yield close()
                    ids, texts, counts, codes, numbers, held = [], [], [], [], _Codes(), 0
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(search, f"id bigint, n_words bigint, runs {_RUNS}, collapsed string").withColumnRenamed(
        "id", id_col
    )
