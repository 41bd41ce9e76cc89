"""Exact top-k by inner product with an impact-ordered index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.sources.storage import stage

SHARD_ROWS = 1 << 14  # rows of one shard of the index
QUERY_ROWS = 1 << 12  # queries that meet a shard together
LEVELS = 16  # quantised impacts on either side of a dimension's middle
QUERY_BLOCK = 64  # queries that read the postings together
CHECKS = (8, 4, 2, 1, 0)  # levels left at which proofs are tried
FEW = 64  # possible members that are cheaper to score than to bound


class ImpactIndex:
    """Postings of a block of integer vectors, by falling quantised impact.

    In every dimension, values become whole steps from the middle of their range.
    A segment holds the rows of one dimension and one number of steps, and adds the
    same impact to all of them. Steps towards zero are read last, none never.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        low, high = rows.min(axis=0).astype(float), rows.max(axis=0).astype(float)
        middle = low + (high - low) / 2
        self.step = np.where(high > low, (high - low) / (2 * LEVELS), 1.0)
        steps = np.clip(np.rint((rows - middle) / self.step), -LEVELS, LEVELS).astype(np.int8)
        # What the steps of a dimension leave of its values at most.
        self.error = np.abs(rows - middle - steps * self.step).max(axis=0)
        self.slack = (np.abs(low) + np.abs(high)) * 1e-9
        self.segments: list[list] = [[] for _ in range(LEVELS + 1)]
        for d in range(rows.shape[1]):
            order = np.argsort(steps[:, d], kind="stable")
            numbers = np.arange(-LEVELS, LEVELS + 1)
            ends = np.searchsorted(steps[order, d], numbers, side="right")
            for number, begin, end in zip(numbers, [0, *ends[:-1]], ends, strict=True):
                if number and end > begin:
                    self.segments[abs(number)].append((d, number, order[begin:end]))

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the best ``k`` rows for every query, its own id left out."""
        for begin in range(0, len(query_ids), QUERY_BLOCK):
            part = slice(begin, begin + QUERY_BLOCK)
            possible = self._possible(query_ids[part], queries[part], k)
            for query, among in zip(queries[part], possible, strict=True):
                rows = np.flatnonzero(among)
                scores = self.rows[rows].astype(np.int64) @ query.astype(np.int64)
                best = np.lexsort((self.ids[rows], -scores))[:k]
                yield self.ids[rows][best], scores[best]

    def _possible(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """Which rows may be among the best of which query."""
        size = np.abs(queries).astype(float)
        impact = np.ascontiguousarray((queries * self.step).T)
        error = size @ (self.error + self.slack)
        others = self.ids[None, :] != query_ids[:, None]
        known = np.zeros((len(self.ids), len(queries)))
        possible = others
        for level in range(LEVELS, 0, -1):
            for d, number, rows in self.segments[level]:
                known[rows] += impact[d] * number
            if level - 1 not in CHECKS or len(self.ids) <= k + 1:
                continue
            # What is unread moves a row by at most `left`, up or down.
            left = (level - 1) * (size @ self.step) + error
            sums = np.where(others, known.T, -np.inf)
            bar = np.partition(sums, sums.shape[1] - k, axis=1)[:, sums.shape[1] - k]
            possible = others & (sums >= (bar - 2 * left)[:, None])
            if possible.sum(axis=1).max() <= max(FEW, k):
                break
        return possible


def integer_vector(vector: Column, scale: int) -> Column:
    """floor(scale * component); NULL for vectors that hold NULL, NaN or infinities."""
    sound = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.when(
        sound,
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint")),
    )


def _block(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("id").to_numpy()
    vectors = batch.column("vector").combine_chunks()
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.zeros((len(ids), lengths.max(initial=0)), np.int64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
    return ids, rows


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the best ``k`` other rows of each query row.

    Scores are inner products of ``floor(scale * component)``. Equal scores are
    ordered by id. ``queries`` is a condition on the rows.

    Rows are dealt by a hash of their id into shards of about ``SHARD_ROWS``
    rows, queries into groups of about ``QUERY_ROWS``; every shard meets every
    group in one task. There, blocks of queries read the segments of postings by
    falling quantised impact, all dimensions one level at a time. Reading stops,
    and rows are given up, only on proof that they cannot reach the best k. Those
    left are scored exactly. Per query, k rows leave each shard.

    Rows with a NULL id, and vectors that are NULL or hold a NULL, NaN or
    infinity, take no part. A shorter vector counts as if zeros followed. Rows
    with the id of the query are never its results; other ids that occur several
    times are several results. Equal query rows, id and vector, give one list;
    different vectors under one id give a list each. An empty table, or one without queries, gives no
    rows.
    """
    sound = stage(
        vectors.filter(F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("id"),
            integer_vector(F.col(vector_col), scale).alias("vector"),
            queries.alias("asks"),
        ).filter(F.col("vector").isNotNull()),
        "vectors",
    )
    rows, asking = sound.agg(F.count("*"), F.count_if("asks")).first()
    shards, groups = -(-rows // SHARD_ROWS) or 1, -(-asking // QUERY_ROWS) or 1
    place = F.xxhash64("id")
    index = sound.select(
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "id",
        "vector",
    )
    asked = sound.filter("asks").select("id", "vector").distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int").alias("group"),
        "id",
        F.xxhash64("vector").alias("key"),
        "vector",
    )
    schema = pa.schema([("query_id", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def search(queries: pa.Table, shard: pa.Table) -> pa.Table:
        query_ids, query_rows = _block(queries)
        query_keys = queries.column("key").to_numpy()
        ids, rows = _block(shard)
        width = max(rows.shape[1], query_rows.shape[1])
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        query_rows = np.pad(query_rows, ((0, 0), (0, width - query_rows.shape[1])))
        found = [[], [], [], []]
        if len(ids):
            index = ImpactIndex(ids, rows)
            results = index.search(query_ids, query_rows, k)
            for query_id, key, (best, scores) in zip(query_ids, query_keys, results, strict=True):
                own = np.full(len(best), query_id), np.full(len(best), key)
                for column, values in zip(found, (*own, best, scores), strict=True):
                    column.append(values)
        columns = [np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64) for c in found]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)

    keys = ["shard", "group"]
    local = (
        asked.groupBy(*keys)
        .cogroup(index.groupBy(*keys))
        .applyInArrow(search, "query_id bigint, key bigint, id bigint, score bigint")
    )
    order = W.partitionBy("query_id", "key").orderBy(F.desc("score"), "id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
