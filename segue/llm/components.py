"""Connected components by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.sources.storage import stage

ROUNDS = 60  # each round at least halves long chains


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the smallest node.

    In each round a node takes the smallest label among its own and its
    neighbours', and then the label of that label, which halves the way to the
    smallest node. Labels are reduced before they are shuffled and written after
    every round; only the number of changes comes to the driver.
    """
    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        "labels",
    )
    for _ in range(ROUNDS):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = stage(lower, "lower")
        jump = lower.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        after = stage(
            lower.join(jump, F.col("label") == F.col("via"), "left").select(
                "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
            ),
            "labels",
        )
        labels = after.select("node", "label")
        if after.filter("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"no end after {ROUNDS} rounds")
