"""Exact token counts at every prefix of a text, by dynamic programming."""

from __future__ import annotations

import json
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters the library's pattern takes for white space.
# fixed values
LIBRARY_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0         "
    "       　"
)
# Word endings that the library's pattern cuts off.
# fixed values
CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}

# White space followed by other characters: no piece of the library's pattern
# crosses from the second to the first, for a whole text and for any prefix.
UNIT = re.compile(f"[{LIBRARY_SPACE}]*[^{LIBRARY_SPACE}]+|[{LIBRARY_SPACE}]+")

# Letters of the Latin-1 block, which every Unicode version classes alike.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_COMMON = re.compile(f"[\\x00-\\x7f{_LATIN}]*")
# The library's pattern, for text of such letters and ASCII alone.
_COMMON_PIECE = re.compile(
    f" ?[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\\t-\\r {_LATIN}0-9]+"
    "|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+"
)
# Where a prefix may be cut differently from the whole text.
_SPACE_RUN = re.compile(r"[\t-\r ]{2}")
# Byte-level vocabularies write bytes as characters: printable ones as they are,
# the others from U+0100 upwards.
_SHIFTED = {
    b: 256 + i
    for i, b in enumerate(
        b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)
    )
}
_SYMBOLS = "".join(chr(_SHIFTED.get(b, b)) for b in range(256))
# Symbols of bytes inside a character.
_INNER = {chr(_SHIFTED.get(b, b)) for b in range(0x80, 0xC0)}

CACHED = 600_000  # entries of each cache of a worker
CACHED_CHARS = 64  # longer units are not cached


def byte_symbols(text: str) -> str:
    """A text as byte-level vocabularies write it: one symbol per byte."""
    return charmap_decode(text.encode(), "strict", _SYMBOLS)[0]


class _Cache(dict):
    """Values made on demand; emptied by the owner when it has grown too long."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= CACHED_CHARS:
            self[key] = value
        return value


class PrefixCounter:
    """Token counts of all prefixes for a byte-level BPE of the tokenizers library.

    The last token of a prefix is the one token that ends there and may follow the
    last token of the prefix before it; two tokens may be neighbours if merging
    their joined bytes gives the same two back. So counts follow from shorter
    prefixes, and no prefix is encoded on its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.special = [t["content"] for t in content["added_tokens"]]
        self.vocab = set(model["vocab"]) - set(self.special)
        self.longest = max(map(len, self.vocab))
        self.merge_rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.never = len(self.merge_rank)
        # The parts of each token and the rank at which they merge into it.
        self.origin = {a + b: (a, b, i) for (a, b), i in reversed(self.merge_rank.items())}
        self.split_special = (
            re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.states: dict[str, tuple[str, int]] = {}
        self.pieces = _Cache(self._piece)
        self.units = _Cache(self._unit)

    def _may_follow(self, left: str, right: str) -> bool:
        fits = self.neighbours[left, right] = self._stay_apart(left, right)
        return fits

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the joined bytes leaves both tokens.

        Goes back in time along the symbols at the boundary: at every moment one
        symbol ends there and one begins. A merge across the boundary would have
        happened if its rank is below the ranks at which these two were merged
        into the symbols after them (at an equal rank, the left place goes first).
        """
        left_until = right_until = self.never
        while True:
            crossing = self.merge_rank.get((left, right), self.never)
            if crossing < left_until and (crossing <= right_until and crossing < self.never):
                return False
            before, end, left_born = self.origin.get(left, ("", "", -1))
            begin, after, right_born = self.origin.get(right, ("", "", -1))
            if left_born < 0 and right_born < 0:
                return True
            if left_born >= right_born:
                left, left_until = end, left_born
            else:
                right, right_until = begin, right_born

    def _counts(self, symbols: str) -> list[int]:
        """Counts after each byte of one piece of the library's pattern."""
        size, states, vocab, near = len(symbols), self.states, self.vocab, self.neighbours
        last, counts = [""], [0]
        for end in range(1, size + 1):
            state = states.get(symbols[:end])
            if state is None:
                break
            last.append(state[0])
            counts.append(state[1])
        for end in range(len(last), size + 1):
            for begin in range(end - self.longest if end > self.longest else 0, end):
                token = symbols[begin:end]
                if token in vocab:
                    if begin:
                        fits = near.get((last[begin], token))
                        if fits is None:
                            fits = self._may_follow(last[begin], token)
                        if not fits:
                            continue
                    break
            else:
                raise ValueError(f"no token ends {symbols[:end]!r}")
            last.append(token)
            counts.append(counts[begin] + 1)
            if end <= CACHED_CHARS:
                states[symbols[:end]] = token, counts[end]
        del counts[0]
        return counts

    def _steps(self, symbols: str, text: str) -> bytes:
        """Differences of the counts along the characters of a piece."""
        counts = self._counts(symbols)
        if len(symbols) != len(text):
            following = symbols[1:] + "."
            counts = [n for n, s in zip(counts, following, strict=True) if s not in _INNER]
        if text in CONTRACTIONS:
            # Cut short, its characters are pieces of their own.
            counts = [*range(1, len(text)), counts[-1]]
        return array("b", map(sub, counts, [0, *counts])).tobytes()

    def _piece(self, text: str) -> bytes:
        return self._steps(byte_symbols(text), text)

    def _unit(self, unit: str) -> bytes:
        """Differences of the counts along a unit, one signed byte a character."""
        space = len(unit) - len(unit.lstrip(LIBRARY_SPACE))
        if _COMMON.fullmatch(unit):
            pieces = _COMMON_PIECE.findall(unit)
            steps = b"".join(map(self.pieces.__getitem__, pieces))
        else:
            split = self.library.pre_tokenizer.pre_tokenize_str(unit)
            steps = b"".join(self._steps(s, unit[a:b]) for s, (a, b) in split)
        if space < 2:
            return steps
        # A prefix that ends in white space has all of it in one piece, unlike
        # the whole unit, where what follows takes the last blank.
        run = self._steps(byte_symbols(unit[:space]), unit[:space])
        if space == len(unit):
            return run
        there = sum(array("b", steps[: space + 1])) - sum(array("b", run))
        return run + array("b", [there]).tobytes() + steps[space + 1 :]

    def _plain(self, text: str) -> bytes:
        if _COMMON.fullmatch(text) and not _SPACE_RUN.search(text):
            return b"".join(map(self.pieces.__getitem__, _COMMON_PIECE.findall(text)))
        return b"".join(map(self.units.__getitem__, UNIT.findall(text)))

    def steps(self, text: str) -> np.ndarray:
        """Differences of the token counts from each prefix to the next.

        Special strings in the text are their single token, as the library has
        them by default; a cut inside one leaves ordinary characters.
        """
        for cache in (self.units, self.pieces, self.states, self.neighbours):
            if len(cache) > CACHED:
                cache.clear()
        parts = self.split_special.split(text) if self.split_special else [text]
        if len(parts) == 1:
            return np.frombuffer(self._plain(text), np.int8)
        found = [np.zeros(0, np.int8)]
        for before, special in zip(parts[::2], [*parts[1::2], ""], strict=True):
            steps = np.frombuffer(self._plain(before + special[:-1]), np.int8)
            if special:
                whole = int(steps[: len(before)].sum(dtype=np.int64)) + 1
                closing = whole - int(steps.sum(dtype=np.int64))
                steps = np.append(steps, np.int8(closing))
            found.append(steps)
        return np.concatenate(found)


def longest_within(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(steps, dtype=np.int32) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def counts_at(steps: np.ndarray) -> np.ndarray:
    """Token counts of all prefixes of at least one character."""
    return np.cumsum(steps, dtype=np.int64)


_counters: dict[str, PrefixCounter] = {}  # of this worker


def prefix_tokens(
    docs: DataFrame,
    tokenizer: str,
    budget: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, kept_chars, prefix_steps), one row per input row.

    ``prefix_steps`` holds the exact token count at every prefix as one signed
    byte per character: the difference to the prefix before. ``kept_chars`` is
    the length of the longest prefix of at most ``budget`` tokens. Both follow
    from one pass over the whole text, without a shuffle. ``tokenizer`` is the
    path of a byte-level BPE file of the tokenizers library on the executors.

    Texts are split where white space follows other characters; what the parts
    give is kept in a cache of bounded size per worker. A NULL text counts as an
    empty one: 0 bytes, 0 tokens, no steps. Repeated rows are counted alike. An
    empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(tokenizer, None) or PrefixCounter(tokenizer)
        _counters[tokenizer] = counter
        for batch in batches:
            tokens, kept, steps = [], [], []
            for text in batch.column(2):
                found = counter.steps(text.as_py())
                total = int(found.sum(dtype=np.int64))
                tokens.append(total)
                within = total <= budget and (found >= 0).all()
                kept.append(len(found) if within else longest_within(found, budget))
                steps.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(tokens, pa.int64()),
                    pa.array(kept, pa.int64()),
                    pa.array(steps, pa.binary()),
                ],
                ["id", "n_bytes", "n_tokens", "kept_chars", "prefix_steps"],
            )

    whole = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.octet_length(whole).cast("bigint").alias("n_bytes"),
        whole.alias("text"),
    )
    counted = rows.mapInArrow(
        count,
        "id bigint, n_bytes bigint, n_tokens bigint, kept_chars bigint, prefix_steps binary",
    )
    return counted.withColumnRenamed("id", id_col)
