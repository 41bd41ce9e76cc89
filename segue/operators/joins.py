"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

import math
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.sources.storage import stage

# A key is hot when it holds more than this share of the left rows, so there
# are never more than 1 / HOT_SHARE hot keys and broadcasting them is safe.
HOT_SHARE = 1 / 512

# Largest table (in rows and bytes) that is broadcast after its size was checked.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20
# With so few rows, only values of more than 25 kB each could exceed the bytes.
SURELY_FEW = 10_000


def hot_keys(counts: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``share`` of all rows and the parts to split them in.

    ``counts`` is (keys, n). Each part holds at most about ``share`` of the rows,
    and all parts together number at most ``2 / share``.
    """
    limit = counts.agg((F.sum("n") * F.lit(share)).alias("limit")).scalar()
    return counts.filter(F.col("n") > limit).select(
        *on, F.ceil(F.col("n") / limit).cast("int").alias("_parts")
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Equi join of a large ``left`` with a ``right`` whose keys are not hot.

    Rows of a hot left key are spread over several parts and the matching right
    rows are copied to each part. Every left row meets each of its matches
    exactly once, so inner, left, left_semi and left_anti joins keep their
    results. The part follows from the row and its input partition, which a
    repeated task finds unchanged; a random number it would not. Left rows with a
    NULL key match nothing, so they are spread without any copies.

    ``counts`` (keys, n), when the caller has them stored, saves counting the
    left keys. The hot keys are written down, so both sides split alike; without
    any, this is a plain join. No side is hinted: Spark still broadcasts the
    right one when its measured size allows that.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if counts is None:
        counts = stage(left.groupBy(*keys).agg(F.count("*").alias("n")), "counts")
    hot = stage(hot_keys(counts, keys, share), "hot")
    if hot.isEmpty():
        return left.join(right, keys, how)
    hot = F.broadcast(hot)
    spot = F.xxhash64(*left.columns) + F.spark_partition_id()
    keyless = reduce(or_, (F.col(k).isNull() for k in keys))
    salted = left.join(hot, keys, "left").withColumn(
        "_part",
        F.when(keyless, F.pmod(spot, F.lit(math.ceil(1 / share))))
        .when(F.col("_parts").isNull(), F.lit(0))
        .otherwise(F.pmod(spot, F.col("_parts").cast("bigint")))
        .cast("int"),
    )
    copies = (
        right.join(hot, keys, "left")
        .withColumn(
            "_part",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)),
        )
        .drop("_parts")
    )
    joined = salted.drop("_parts").join(copies, keys + ["_part"], how)
    return joined.drop("_part")


def _width(kind: T.DataType, value: Column) -> Column:
    """Bytes of a value, about as Spark holds it."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType | T.StructType | T.MapType):
            each = F.aggregate(
                F.coalesce(value, F.array().cast(kind)), F.lit(16).cast("bigint"),
                lambda total, x: total + _width(kind.elementType, x),
            )
            return each
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
    if isinstance(kind, T.StructType):
        return reduce(add, (_width(f.dataType, value[f.name]) for f in kind), F.lit(16))
    if isinstance(kind, T.MapType):
        return _width(T.ArrayType(kind.keyType), F.map_keys(value)) + _width(T.ArrayType(kind.valueType), F.map_values(value))
    return F.lit(8)


def fits_broadcast(
    df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most ``limit`` rows, which take at most ``most_bytes``.

    A plain count: every task sends one number, whereas a limit would send up to
    that many rows of each task to a single one. The bytes are summed up only for
    tables that pass the count and could exceed them.
    """
    rows = df.count()
    if rows > limit:
        return False
    varying = T.StringType | T.BinaryType | T.ArrayType | T.StructType | T.MapType
    if not any(isinstance(f.dataType, varying) for f in df.schema):
        return rows * 8 * (len(df.columns) + 1) <= most_bytes
    if rows < SURELY_FEW:
        return True
    width = reduce(add, (_width(f.dataType, F.col(f"`{f.name}`")) for f in df.schema), F.lit(8))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] <= most_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi join of many rows with a table whose keys are not hot.

    The right side is broadcast once it is known to have at most ``limit`` rows
    (and BROADCAST_BYTES), so the left rows stay where they lie; a longer one is joined by shuffle with
    hot left keys spread. ``right`` is read twice: pass a stored table.
    """
    if fits_broadcast(right, limit):
        return left.join(F.broadcast(right), on, how)
    return spread_join(left, right, on, how, counts)


def restrict_to(
    df: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (unique values)."""
    return lookup_join(df, keys.select(on), on, "left_semi", limit=limit)


def without(
    df: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``; the complement of restrict_to."""
    return lookup_join(df, keys.select(on), on, "left_anti", limit=limit)
