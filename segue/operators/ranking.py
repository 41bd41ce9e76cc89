"""Global numbers without a single-task window over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.operators.joins import fits_broadcast
from segue.sources.storage import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in these bits


def global_rank(counts: DataFrame, by: str, name: str) -> DataFrame:
    """``RANK() OVER (ORDER BY by DESC)`` for a column of counts.

    The rank of a count is one more than the number of rows with a greater
    count, so it follows from the histogram of counts. Counts that are all
    different sum to at least v * (v + 1) / 2, so N underlying rows give at most
    sqrt(2 N) histogram rows (4.5 million for 10^13): small enough for one
    window task, and never the counted table itself. They are broadcast when their
    measured size allows that.

    The counts are staged, as they are read for the histogram and for the result.
    """
    counts = stage(counts, name)
    histogram = counts.groupBy(by).agg(F.count("*").alias("_rows"))
    greater = W.orderBy(F.desc(by)).rowsBetween(W.unboundedPreceding, -1)
    ranks = histogram.select(
        by,
        (F.coalesce(F.sum("_rows").over(greater), F.lit(0)) + 1)
        .cast("bigint")
        .alias(name),
    )
    ranks = stage(ranks, f"{name}-by-count")
    ranks = F.broadcast(ranks) if fits_broadcast(ranks) else ranks
    return counts.join(ranks, by).select(*counts.columns, name)


def dense_index(keys: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Numbers 0..N-1 in the given order (which must be total).

    Rows are range-partitioned and sorted, each gets its number inside its
    partition, and that is written down; the start of every partition is then a
    running sum over one row per partition. Writing first fixes the partition
    bounds for both uses.
    """
    tagged = stage(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_tag", F.monotonically_increasing_id()),
        name,
    )
    tagged = tagged.select(
        *keys.columns,
        F.shiftright("_tag", _ROW_BITS).alias("_range"),
        F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
        )
    )
    return tagged.join(F.broadcast(starts), "_range").select(
        *keys.columns, (F.col("_start") + F.col("_row")).cast("bigint").alias(name)
    )


def group_positions(
    df: DataFrame, keys: list[str], coarse: str, order: list[str], name: str, tasks: int | None = None
) -> DataFrame:
    """``row_number() - 1`` per group, sorted in pieces of the group.

    ``coarse`` is a column that never decreases along ``order`` (a date for a
    time order). Rows are numbered inside (group, coarse) and shifted by the
    size of the earlier pieces, so no task sorts a whole large group. The sizes
    come from a second pass that reads the keys alone and combines before its
    shuffle; each lies before the rows of its piece as one more row, so that all rows are
    shuffled and sorted once, and joined with nothing. NULL keys are a group, and a NULL
    ``coarse`` comes first. ``tasks`` is the number of tasks that sort, if not the one of
    the session.
    """
    piece = keys + [coarse]
    before = W.partitionBy(*keys).orderBy(coarse).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*piece)
        .agg(F.count("*").alias("_size"))
        .select(*piece, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    )
    marked = df.unionByName(offsets, allowMissingColumns=True)
    if tasks is not None:
        marked = marked.repartition(tasks, *piece)
    sorted_piece = W.partitionBy(*piece).orderBy(F.col("_off").isNull(), *order)
    start = F.first("_off").over(sorted_piece.rowsBetween(W.unboundedPreceding, W.currentRow))
    # The size is the first row of its piece.
    position = (start + F.row_number().over(sorted_piece) - 2).cast("bigint")
    return marked.withColumn(name, position).filter(F.col("_off").isNull()).select(*df.columns, name)


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank"
) -> DataFrame:
    """First ``n`` rows of each group, numbered from 1.

    The limit on row_number lets Spark cut every group to n rows before the
    shuffle, so a huge group reaches its task already reduced.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("bigint")).filter(
        F.col(name) <= n
    )
