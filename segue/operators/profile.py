"""Descriptive statistics of collections and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.functions.columns import (
    FREQUENCY_EDGES,
    FREQUENCY_LABELS,
    LENGTH_EDGES,
    LENGTH_LABELS,
    bucketize,
    follower_bucket,
    normalize_title,
    percent,
)
from segue.operators.counting import item_counts


def length_stats(playlists: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and exact percentiles of the lengths.

    Works on the histogram of lengths, so the percentile state holds one entry
    per different length however many playlists there are.
    """
    lengths = (
        playlists.filter(F.col("num_tracks").isNotNull())
        .groupBy("num_tracks")
        .agg(F.count("*").alias("n"))
    )
    length = F.col("num_tracks")
    return lengths.agg(
        F.min(length).cast("bigint").alias("min_length"),
        F.max(length).cast("bigint").alias("max_length"),
        (F.sum(length * F.col("n")).cast("double") / F.sum("n")).alias("avg_length"),
        *[
            F.percentile(length, p, F.col("n")).alias(name)
            for name, p in [("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95)]
        ],
    )


def bucket_histogram(
    df: DataFrame, value: str, bucket: Column, bucket_name: str, count: str, pct: str
) -> DataFrame:
    """Rows per bucket with their share, in order of the smallest value inside."""
    buckets = df.groupBy(bucket.alias(bucket_name)).agg(
        F.count("*").alias(count), F.min(value).alias("_least")
    )
    # The window runs over one row per bucket.
    everything = F.sum(count).over(W.partitionBy())
    return (
        buckets.withColumn(pct, percent(F.col(count), everything))
        .orderBy("_least")
        .drop("_least")
    )


def length_histogram(playlists: DataFrame) -> DataFrame:
    bucket = bucketize(F.col("num_tracks"), LENGTH_EDGES, LENGTH_LABELS)
    return bucket_histogram(
        playlists, "num_tracks", bucket, "length_bucket", "num_playlists", "pct"
    )


def follower_histogram(playlists: DataFrame) -> DataFrame:
    bucket = follower_bucket(F.col("num_followers"))
    return bucket_histogram(
        playlists, "num_followers", bucket, "follower_bucket", "num_playlists", "pct"
    )


def frequency_histogram(playlist_tracks: DataFrame) -> DataFrame:
    """How many items appear how often."""
    counts = item_counts(playlist_tracks)
    bucket = bucketize(F.col("playlist_count"), FREQUENCY_EDGES, FREQUENCY_LABELS)
    return bucket_histogram(
        counts, "playlist_count", bucket, "frequency_bucket", "num_tracks", "pct_of_tracks"
    )


def title_counts(playlists: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent normalised titles."""
    return (
        playlists.groupBy(normalize_title(F.col("name")).alias("title_normalized"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc("title_normalized"))
        .limit(n)
    )


def description_share(playlists: DataFrame) -> DataFrame:
    """Playlists with a description, as a count and as a percentage, in one pass."""
    counted = playlists.agg(
        F.count("description").alias("with_description"), F.count("*").alias("_all")
    )
    share = F.when(
        F.col("_all") > 0, percent(F.col("with_description"), F.col("_all"))
    )
    return counted.select("with_description", share.alias("pct"))


def top_tracks(playlist_tracks: DataFrame, tracks: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent (track name, artist name) pairs.

    Appearances are counted per item first, so the join meets one row per item
    instead of one per appearance; names shared by several items then add up.
    """
    return (
        item_counts(playlist_tracks)
        .join(tracks.select("track_uri", "track_name", "artist_name"), "track_uri")
        .groupBy("track_name", "artist_name")
        .agg(F.sum("playlist_count").alias("playlist_count"))
        .orderBy(F.desc("playlist_count"), "track_name", "artist_name")
        .limit(n)
    )


def top_artists(
    playlist_tracks: DataFrame, tracks: DataFrame, n: int = 20
) -> DataFrame:
    """Artists with most appearances, counted per item before the join."""
    return (
        item_counts(playlist_tracks)
        .join(tracks.select("track_uri", "artist_name"), "track_uri")
        .groupBy("artist_name")
        .agg(F.sum("playlist_count").alias("track_appearances"))
        .orderBy(F.desc("track_appearances"), "artist_name")
        .limit(n)
    )


def popularity_topn_labeled(
    popularity: DataFrame, tracks: DataFrame, n: int = 10
) -> DataFrame:
    """First ``n`` items of the ranking with their names.

    Ranks have no gaps before a tie ends, so rank <= n keeps at least the first
    n rows; the cut happens before the join.
    """
    head = (
        popularity.orderBy("pop_rank", "track_uri")
        .limit(n)
        .select("pop_rank", "track_uri", "playlist_count")
    )
    return (
        tracks.select("track_uri", "track_name", "artist_name")
        .join(F.broadcast(head), "track_uri")
        .select("pop_rank", "track_uri", "track_name", "artist_name", "playlist_count")
        .orderBy("pop_rank", "track_uri")
    )


def request_scenarios(requests: DataFrame) -> DataFrame:
    """Requests by number of seeds and presence of a title."""
    return (
        requests.groupBy(
            F.col("num_samples").cast("bigint").alias("num_samples"),
            F.col("name").isNotNull().alias("has_title"),
        )
        .agg(F.count("*").alias("requests"))
        .orderBy("num_samples", "has_title")
    )
