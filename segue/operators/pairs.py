"""Items that appear together in a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.functions.columns import hash_below
from segue.operators.joins import fits_broadcast, restrict_to, spread_join
from segue.sources.storage import stage

# Different items of one collection that a single task pairs with each other.
CHUNK = 4_000


def support_bounds(folded: DataFrame) -> DataFrame:
    """(track_uri, bound): no pair with this item can be counted more often.

    ``folded`` is (pid, track_uri, m). In a collection an item adds at most its own
    m times the largest m among the others, and ``bound`` is the sum of that. A
    collection gives its largest two m's from the numbers of items per m, of which
    there are few, so neither a long collection nor a frequent item is gathered.
    """
    levels = folded.groupBy("pid", "m").agg(F.count("*").alias("items"))
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    tops = (
        levels.groupBy("pid")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("m", "items")), asc=False), 1, 2).alias("top"))
        .select(
            "pid",
            first["m"].alias("most"),
            # The largest m among the others of the item that has the most.
            F.when(first["items"] > 1, first["m"]).otherwise(F.coalesce(second["m"], F.lit(0))).alias("next"),
        )
    )
    largest_other = F.when(F.col("m") < F.col("most"), F.col("most")).otherwise(F.col("next"))
    sizes = levels.groupBy("pid").agg(F.sum("items").alias("n"))
    return (
        spread_join(folded, tops, "pid", counts=sizes)
        .groupBy("track_uri")
        .agg(F.sum(F.col("m") * largest_other).alias("bound"))
    )


def supported(folded: DataFrame, min_count: int) -> DataFrame:
    """The rows of items that can occur ``min_count`` times in a pair; stored.

    Exact: items below the bound have no such pair, and the counts of all other
    pairs do not depend on them.
    """
    bounds = support_bounds(folded)
    able = stage(bounds.filter(F.col("bound") >= min_count).select("track_uri"), "able-items")
    return stage(restrict_to(folded, able, "track_uri"), "supported")


def pair_counts(
    rows: DataFrame, min_count: int, chunk: int = CHUNK, prune: bool = True
) -> DataFrame:
    """(track_uri_1, track_uri_2, co_count) with track_uri_1 < track_uri_2.

    Repeats are folded first: an item m times and another k times in the same
    collection add m * k, as pairing every appearance would. The folded rows
    are staged because both sides of the self join read them. With ``prune``,
    items that cannot reach ``min_count`` with any other leave before it.

    A collection with more than ``chunk`` different items is cut into g pieces
    and its pairs into g * (g + 1) / 2 cells, one per pair of pieces. Each pair
    of items belongs to exactly one cell, so the result stays whole while no
    task pairs more than two pieces.
    """
    folded = stage(
        rows.groupBy("pid", "track_uri").agg(F.count("*").alias("m")), "folded"
    )
    if prune and min_count > 1:
        folded = supported(folded, min_count)
    long = (
        folded.groupBy("pid")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > chunk)
        .select("pid", F.ceil(F.col("n") / chunk).cast("int").alias("g"))
    )
    if long.isEmpty():
        left = folded.select("pid", F.col("track_uri").alias("a"), F.col("m").alias("ma"))
        right = folded.select("pid", F.col("track_uri").alias("b"), F.col("m").alias("mb"))
        pairs = left.join(right, "pid").filter(F.col("a") < F.col("b"))
    else:
        sized = F.broadcast(long) if fits_broadcast(long) else long
        pieces = (
            folded.join(sized, "pid", "left")
            .withColumn("g", F.coalesce("g", F.lit(1)))
            .withColumn("c", F.pmod(F.xxhash64("track_uri"), F.col("g")).cast("int"))
        )
        left = pieces.select(
            "pid",
            F.col("c").alias("i"),
            F.explode(F.sequence(F.col("c"), F.col("g") - 1)).alias("j"),
            F.col("track_uri").alias("a"),
            F.col("m").alias("ma"),
        )
        right = pieces.select(
            "pid",
            F.explode(F.sequence(F.lit(0), F.col("c"))).alias("i"),
            F.col("c").alias("j"),
            F.col("track_uri").alias("b"),
            F.col("m").alias("mb"),
        )
        pairs = left.join(right, ["pid", "i", "j"]).filter(
            (F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))
        )
    return (
        pairs.groupBy(
            F.least("a", "b").alias("track_uri_1"),
            F.greatest("a", "b").alias("track_uri_2"),
        )
        .agg(F.sum(F.col("ma") * F.col("mb")).alias("co_count"))
        .filter(F.col("co_count") >= min_count)
    )


def cooccurrence(
    playlist_tracks: DataFrame,
    popularity: DataFrame,
    top_k: int = 10_000,
    min_count: int = 10,
) -> DataFrame:
    """Pair counts among the ``top_k`` most popular items (ties at the cut stay)."""
    popular = popularity.filter(F.col("popularity_rank") <= top_k).select("track_uri")
    popular = stage(popular, "popular")
    kept = restrict_to(playlist_tracks.select("pid", "track_uri"), popular, "track_uri")
    # The most popular items can nearly all reach the count, so bounds would not pay.
    return pair_counts(kept, min_count, prune=False)


def sample_collections(
    playlist_tracks: DataFrame, fraction: float, seed: int = 0
) -> DataFrame:
    """Rows of a reproducible sample of collections.

    The draw depends on the pid alone, so it is a filter on the scan: no
    distinct, no join and no list of sampled keys.
    """
    return playlist_tracks.filter(hash_below(F.col("pid"), fraction, seed))


def cooccurrence_sampled(
    playlist_tracks: DataFrame,
    fraction: float = 0.01,
    min_count: int = 2,
    seed: int = 0,
) -> DataFrame:
    """Pair counts over a sample of collections, all items allowed."""
    sampled = sample_collections(playlist_tracks, fraction, seed)
    return pair_counts(sampled.select("pid", "track_uri"), min_count)


def top_pairs(cooccurring: DataFrame, tracks: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent pairs with both names; cut to ``n`` before the lookups."""
    head = cooccurring.orderBy(
        F.desc("co_count"), "track_uri_1", "track_uri_2"
    ).limit(n)
    # Both items of every pair, looked up in one scan of the tracks.
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(f"track_uri_{i}").alias("track_uri")) for i in (1, 2)])
    asked = head.withColumn("item", F.explode(sides)).select("*", "item.*")
    found = tracks.select("track_uri", "track_name", "artist_name").join(
        F.broadcast(asked), "track_uri"
    )
    named = [
        F.first(F.when(F.col("side") == i, F.col(field)), ignorenulls=True).alias(name)
        for i in (1, 2)
        for field, name in (("track_name", f"track_{i}"), ("artist_name", f"artist_{i}"))
    ]
    return (
        found.groupBy("track_uri_1", "track_uri_2", "co_count")
        .agg(*named, F.count_distinct("side").alias("sides"))
        .filter(F.col("sides") == 2)
        .drop("sides")
        .select(
            "track_uri_1", "track_uri_2", "track_1", "artist_1", "track_2", "artist_2", "co_count"
        )
        .orderBy(F.desc("co_count"), "track_uri_1", "track_uri_2")
    )
