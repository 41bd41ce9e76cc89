"""From nested slice documents to flat tables, and the counts that check them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.functions.columns import flag
from segue.schema import PLAYLIST_COLUMNS, TRACK_COLUMNS


def flatten_playlists(slices: DataFrame) -> DataFrame:
    """One row per playlist entry, with its track array."""
    entry = slices.select(F.explode("playlists").alias("p"))
    columns = [
        flag(F.col("p.collaborative")).alias("collaborative")
        if name == "collaborative"
        else F.col(f"p.{name}")
        for name in PLAYLIST_COLUMNS
    ]
    return entry.select(*columns, "p.tracks")


def flatten_interactions(playlists: DataFrame) -> DataFrame:
    """(pid, track_uri, pos), one row per appearance."""
    return playlists.select("pid", F.explode("tracks").alias("t")).select(
        "pid", "t.track_uri", "t.pos"
    )


def flatten_tracks(playlists: DataFrame) -> DataFrame:
    """Track attributes, one row per track_uri.

    The row of the lowest (pid, pos) is kept, by an aggregate that combines
    before the shuffle and holds one row per track.
    """
    details = [name for name in TRACK_COLUMNS if name != "track_uri"]
    appearances = playlists.select("pid", F.explode("tracks").alias("t"))
    return (
        appearances.groupBy(F.col("t.track_uri").alias("track_uri"))
        .agg(
            F.min_by(
                F.struct(*[F.col(f"t.{name}").alias(name) for name in details]),
                F.struct("pid", "t.pos"),
            ).alias("first")
        )
        .select("track_uri", *[f"first.{name}" for name in details])
    )


def drop_nested(playlists: DataFrame) -> DataFrame:
    return playlists.drop("tracks")


def table_counts(
    playlists: DataFrame, tracks: DataFrame, playlist_tracks: DataFrame
) -> DataFrame:
    """(name, actual): the counts by which an ingest is checked."""
    lists = playlists.agg(F.count("*").alias("n"))
    rows = playlist_tracks.agg(F.count("*").alias("n"))
    # Each distinct count aggregates in two steps on its own key; the three
    # single-row results are then laid out as named rows.
    artists = tracks.select("artist_uri").distinct().agg(F.count("artist_uri"))
    albums = tracks.select("album_uri").distinct().agg(F.count("album_uri"))
    return (
        lists.select(
            F.col("n").alias("playlists"),
            rows.scalar().alias("total_tracks"),
            tracks.agg(F.count("*")).scalar().alias("unique_tracks"),
            artists.scalar().alias("unique_artists"),
            albums.scalar().alias("unique_albums"),
        )
        .withColumn(
            "avg_playlist_length",
            F.when(F.col("playlists") > 0, F.col("total_tracks") / F.col("playlists")),
        )
        .selectExpr(
            "stack(6, 'playlists', double(playlists),"
            " 'total_tracks', double(total_tracks),"
            " 'unique_tracks', double(unique_tracks),"
            " 'unique_artists', double(unique_artists),"
            " 'unique_albums', double(unique_albums),"
            " 'avg_playlist_length', avg_playlist_length) AS (name, actual)"
        )
    )


def validate_counts(
    actual: DataFrame, expected: DataFrame, tolerance: float = 0.001
) -> DataFrame:
    """(name, actual, expected, ok): counts must agree, the average within a margin."""
    margin = F.when(
        F.col("name") == "avg_playlist_length",
        F.abs(F.col("actual") - F.col("expected")) < tolerance,
    ).otherwise(F.col("actual") == F.col("expected"))
    return expected.join(actual, "name", "left").select(
        "name", "actual", "expected", F.coalesce(margin, F.lit(False)).alias("ok")
    )
