"""Scalar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket limits (inclusive upper bounds) and their labels; the
# last label takes everything else, NULL included.
LENGTH_EDGES = [10, 25, 50, 100, 150]
LENGTH_LABELS = ["5-10", "11-25", "26-50", "51-100", "101-150", "151-250"]
FREQUENCY_EDGES = [1, 5, 20, 100, 1000, 10000]
FREQUENCY_LABELS = [
    "1 (appears once)",
    "2-5",
    "6-20",
    "21-100",
    "101-1000",
    "1001-10000",
    "10000+",
]
FOLLOWER_LABELS = ["1", "2", "3-5", "6-10", "11-50", "50+"]


def bucketize(value: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the first edge that ``value`` does not exceed."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    chain = F
    for edge, label in zip(edges, labels):
        chain = chain.when(value <= edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def follower_bucket(value: Column) -> Column:
    """Follower label: 1 and 2 are matched exactly, so 0 counts as '3-5'."""
    first, second, *rest = FOLLOWER_LABELS
    return (
        F.when(value == 1, F.lit(first))
        .when(value == 2, F.lit(second))
        .otherwise(bucketize(value, [5, 10, 50], rest))
    )


def flag(value: Column) -> Column:
    """'true' becomes true, other texts false, NULL stays NULL."""
    return value == F.lit("true")


def normalize_title(value: Column) -> Column:
    return F.lower(F.trim(value))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` with two decimals."""
    return F.round(part.cast("double") * 100.0 / whole.cast("double"), 2)


# Shifts and multipliers of a published 32-bit integer mixer. The
# multipliers are below 2^31, so products of 32-bit words fit in a bigint.
MIX_ROUNDS = [(16, 0x21F0AAAD), (15, 0x735A2D97)]
MIX_LAST_SHIFT = 15
WORD = 2**32


def hash_word(key: Column, seed: int = 0) -> Column:
    """A number in [0, 2^32) mixed from an integer key and a seed.

    The seed is added once the key is mixed: before, seed s would draw a key as
    another seed draws a neighbouring key.

    Plain integer arithmetic: it stays in generated code and costs a fraction of
    a digest of the key's text, which matters where every row is drawn.
    """
    mask = F.lit(WORD - 1)
    key = key.cast("bigint")
    word = key.bitwiseXOR(F.shiftright(key, 32)).bitwiseAND(mask)
    for number, (shift, multiplier) in enumerate(MIX_ROUNDS):
        word = word.bitwiseXOR(F.shiftright(word, shift))
        word = (word * F.lit(multiplier)).bitwiseAND(mask)
        if number == 0:
            word = (word + F.lit(seed % WORD)).bitwiseAND(mask)
    return word.bitwiseXOR(F.shiftright(word, MIX_LAST_SHIFT))


def hash_below(key: Column, fraction: float, seed: int = 0) -> Column:
    """True for about ``fraction`` of the keys, always the same ones."""
    return hash_word(key, seed) < F.lit(math.ceil(fraction * WORD))


def relative_gain(value: Column, base: Column) -> Column:
    """Gain over ``base`` in percent; NULL where the base is not positive, never -0.0."""
    return F.when(base > 0, unsigned_zero((value - base) / base * 100.0))


def unsigned_zero(value: Column) -> Column:
    """The same number, with 0.0 for -0.0."""
    return F.when(value == 0.0, F.lit(0.0)).otherwise(value)
