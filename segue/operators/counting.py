"""Feature tables: item counts, popularity ranks, artist statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.operators.joins import lookup_join
from segue.operators.ranking import global_rank
from segue.sources.storage import stage


def item_counts(playlist_tracks: DataFrame) -> DataFrame:
    """Appearances per item; an item twice in one playlist counts twice."""
    return playlist_tracks.groupBy("track_uri").agg(
        F.count("*").alias("playlist_count")
    )


def track_popularity(playlist_tracks: DataFrame) -> DataFrame:
    return global_rank(item_counts(playlist_tracks), "playlist_count", "popularity_rank")


def pop_baseline(train: DataFrame) -> DataFrame:
    """The popularity model: counts and ranks over the training rows."""
    return global_rank(item_counts(train), "playlist_count", "pop_rank")


def artist_popularity(playlist_tracks: DataFrame, tracks: DataFrame) -> DataFrame:
    """Appearances, different tracks, different playlists and rank per artist.

    The first two come from the per-item counts. For the third, appearances are
    reduced to (playlist, artist) before they are counted per artist, so neither
    a hot item, nor a hot playlist, nor a hot artist ends up in one task.
    """
    artist = ["artist_uri", "artist_name"]
    labels = tracks.select("track_uri", *artist)
    counts = stage(item_counts(playlist_tracks), "item_counts")
    totals = (
        counts.join(labels, "track_uri")
        .groupBy(*artist)
        .agg(
            F.sum("playlist_count").alias("total_appearances"),
            F.count("*").alias("unique_tracks"),
        )
    )
    playlists = (
        lookup_join(
            playlist_tracks.select("pid", "track_uri"),
            labels,
            "track_uri",
            counts=counts.withColumnRenamed("playlist_count", "n"),
        )
        .select("pid", *artist)
        .distinct()
        .groupBy(*artist)
        .agg(F.count("pid").alias("unique_playlists"))
        .withColumnsRenamed({name: f"_{name}" for name in artist})
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in artist]
    # Ranked before the playlists join in: the histogram behind the rank would
    # otherwise run that join a second time.
    return (
        global_rank(totals, "total_appearances", "popularity_rank")
        .join(playlists, same)
        .select(
            *artist,
            "total_appearances",
            "unique_tracks",
            "unique_playlists",
            "popularity_rank",
        )
    )
