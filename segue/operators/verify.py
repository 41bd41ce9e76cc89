"""Checks of finished recommendation lists against their requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.sources.storage import stage


def verify_recommendations(
    recs: DataFrame, requests: DataFrame, seeds: DataFrame, n: int = 500
) -> DataFrame:
    """(pid, violation, detail), empty for a valid set of lists.

    * ``unknown_pid``: a list nobody asked for
    * ``missing_pid``: a request without a list
    * ``wrong_count``: not ``n`` items; detail is the number of items
    * ``duplicates``: not ``n`` different items (so a short list is reported
      here as well); detail is the number of different items
    * ``seed_overlap``: seeds recommended; detail is the number of such seeds
    """
    # (pid, item) first: the second step counts different items without
    # gathering them. Both are read by several of the checks.
    items = stage(
        recs.groupBy("pid", "track_uri").agg(F.count("*").alias("times")), "items"
    )
    lists = stage(
        items.groupBy("pid").agg(
            F.sum("times").alias("listed"), F.count("*").alias("different")
        ),
        "lists",
    )
    asked = requests.select("pid").distinct()
    unknown = lists.join(asked, "pid", "left_anti")
    missing = asked.join(lists, "pid", "left_anti")
    overlap = (
        items.join(seeds.select("pid", "track_uri").distinct(), ["pid", "track_uri"], "left_semi")
        .groupBy("pid")
        .agg(F.count("*").alias("shared"))
    )

    def rows(found: DataFrame, violation: str, detail) -> DataFrame:
        return found.select(
            "pid",
            F.lit(violation).alias("violation"),
            detail.cast("bigint").alias("detail"),
        )

    one = F.lit(1)
    return (
        rows(unknown, "unknown_pid", one)
        .unionByName(rows(missing, "missing_pid", one))
        .unionByName(
            rows(lists.filter(F.col("listed") != n), "wrong_count", F.col("listed"))
        )
        .unionByName(
            rows(
                lists.filter(F.col("different") != n), "duplicates", F.col("different")
            )
        )
        .unionByName(rows(overlap, "seed_overlap", F.col("shared")))
    )
