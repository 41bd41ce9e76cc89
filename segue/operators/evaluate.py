"""Offline quality of recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.functions.columns import relative_gain

PAGE = 10  # items shown per page, the unit of the clicks metric


def _gain(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank.cast("double") + 1.0)


def list_metrics(
    recs: DataFrame,
    holdout: DataFrame,
    models: list[str],
    keys: list[str],
    n: int = 500,
) -> DataFrame:
    """(keys, model, r_precision, ndcg, clicks) per list.

    ``recs`` is (keys, model, track_uri, rank from 1), ``holdout`` is (keys,
    track_uri) without repeats. Every model is scored on every holdout, so a
    model without any hit, or without a list, gets zeros and the most clicks.
    """
    sizes = holdout.groupBy(*keys).agg(F.count("*").alias("held"))
    wanted = sizes.withColumn(
        "model", F.explode(F.array(*[F.lit(m) for m in models]))
    )
    # Hits carry their holdout size, which the R-precision cut needs.
    hits = (
        recs.filter(F.col("rank") <= n)
        .join(holdout, keys + ["track_uri"])
        .join(sizes, keys)
        .groupBy(*keys, "model")
        .agg(
            F.count(F.when(F.col("rank") <= F.col("held"), 1)).alias("_early"),
            F.sum(_gain(F.col("rank"))).alias("_dcg"),
            F.min("rank").alias("_first"),
        )
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("held"), F.lit(n)).cast("int")),
        F.lit(0.0),
        lambda acc, i: acc + _gain(i),
    )
    pages_without_hit = n // PAGE + 1
    return wanted.join(hits, keys + ["model"], "left").select(
        *keys,
        "model",
        (F.coalesce(F.col("_early"), F.lit(0)) / F.col("held")).alias("r_precision"),
        (F.coalesce(F.col("_dcg"), F.lit(0.0)) / ideal).alias("ndcg"),
        F.coalesce(
            F.floor((F.col("_first") - 1) / PAGE), F.lit(pages_without_hit)
        )
        .cast("bigint")
        .alias("clicks"),
    )


def summarize(metrics: DataFrame) -> DataFrame:
    """Means and number of evaluated playlists per scenario and model."""
    return metrics.groupBy("scenario", "model").agg(
        F.avg("r_precision").alias("r_precision"),
        F.avg("ndcg").alias("ndcg"),
        F.avg("clicks").alias("clicks"),
        F.count("*").alias("evaluated"),
    )


def evaluate(
    recs: DataFrame, holdout: DataFrame, models: list[str], n: int = 500
) -> DataFrame:
    """The grid of scenarios and models."""
    return summarize(list_metrics(recs, holdout, models, ["scenario", "pid"], n))


def best_model(summary: DataFrame, models: list[str]) -> DataFrame:
    """Model with the highest R-precision per scenario; the first one on ties.

    Means of the same values differ in their last bits with the order in which
    tasks add them, so ties are judged on twelve decimals.
    """
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    window = W.partitionBy("scenario").orderBy(
        F.round("r_precision", 12).desc(), order
    )
    return (
        summary.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .select("scenario", "model", "r_precision", "ndcg")
    )


def improvement(summary: DataFrame, baseline: str = "Popularity") -> DataFrame:
    """R-precision gain of the other models over the baseline, in percent."""
    of_baseline = F.when(F.col("model") == baseline, F.col("r_precision"))
    # A window needs the summary once, a join with its own rows twice.
    based = summary.withColumn("_base", F.max(of_baseline).over(W.partitionBy("scenario")))
    return based.filter(
        (F.col("model") != baseline) & F.col("_base").isNotNull()
    ).select(
        "scenario",
        "model",
        relative_gain(F.col("r_precision"), F.col("_base")).alias("gain_pct"),
    )
