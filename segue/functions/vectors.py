"""Expressions over array<float> and array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def normalize(vector: Column) -> Column:
    """Unit-length vector in doubles; a zero vector stays zero, NULL stays NULL."""
    norm = l2_norm(vector)
    safe = F.when(norm > 0, norm).otherwise(F.lit(1.0))
    return F.transform(vector, lambda x: x.cast("double") / safe)


def is_nonzero(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != F.lit(0.0))


def scale(vector: Column, factor: Column) -> Column:
    return F.transform(vector, lambda x: x * factor)
