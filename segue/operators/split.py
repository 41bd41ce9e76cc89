"""Validation sets, training rows, sequences, seeds and holdouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.functions.columns import hash_below, hash_word
from segue.operators.joins import lookup_join, restrict_to, spread_join, without
from segue.operators.ranking import group_positions, top_per_group
from segue.sources.storage import stage

# Scenario names and the number of leading items given as seeds.
SCENARIOS = {
    "title_only": 0,
    "first_5": 5,
    "first_10": 10,
    "first_25": 25,
    "first_100": 100,
}

# Positions of a part in training input; the models cut their sentences at this length.
SEQUENCE_LENGTH = 1_000


def reserve_validation(
    playlists: DataFrame,
    min_length: int = 100,
    fraction: float = 0.006,
    cap: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """(pid, name) of a reproducible sample of long playlists.

    With a ``cap``, the first that many in the order of the draw.
    """
    pid = F.col("pid")
    drawn = playlists.filter(F.col("num_tracks") >= min_length).filter(
        hash_below(pid, fraction, seed)
    )
    if cap is None:
        return drawn.select("pid", "name")
    order = drawn.select("pid", "name", hash_word(pid, seed).alias("_draw"))
    return order.orderBy("_draw", "pid").limit(cap).drop("_draw")


def validation_split(playlist_tracks: DataFrame, reserved: DataFrame) -> DataFrame:
    """Rows of the reserved playlists."""
    return restrict_to(playlist_tracks, reserved, "pid")


def train_split(playlist_tracks: DataFrame, reserved: DataFrame) -> DataFrame:
    """Rows of all other playlists."""
    return without(playlist_tracks, reserved, "pid")


def split_counts(playlist_tracks: DataFrame, reserved: DataFrame) -> DataFrame:
    """Reserved playlists, kept rows and removed rows, in one pass over the rows."""
    marks = reserved.select("pid", F.lit(True).alias("_held"))
    sizes = playlist_tracks.groupBy("pid").agg(F.count("*").alias("n"))
    return (
        lookup_join(sizes, marks, "pid", "left")
        .agg(
            F.count("_held").alias("validation_playlists"),
            F.coalesce(F.sum(F.when(F.col("_held").isNull(), F.col("n"))), F.lit(0)).alias(
                "train_rows"
            ),
            F.coalesce(F.sum(F.when(F.col("_held"), F.col("n"))), F.lit(0)).alias(
                "removed_rows"
            ),
        )
    )


def sequences(
    playlist_tracks: DataFrame,
    min_length: int = 5,
    min_count: int = 1,
    part_length: int | None = None,
) -> DataFrame:
    """(pid, part, num_tracks, track_sequence): items in order of position.

    A playlist is one row. With ``part_length``, one of more positions gives
    consecutive parts, so no task ever holds an unbounded list; training needs
    no more than the length at which it cuts its sentences. Items with
    fewer than ``min_count`` appearances in these playlists are dropped before
    the cut, as MLlib does; ``num_tracks`` still counts them.
    """
    # The length of the whole playlist decides, not that of a part.
    lengths = stage(
        playlist_tracks.groupBy("pid")
        .agg(F.count("*").alias("num_tracks"))
        .filter(F.col("num_tracks") >= min_length),
        "lengths",
    )
    counts = lengths.select("pid", F.col("num_tracks").alias("n"))
    if min_count > 1:
        playlist_tracks = _common_items(
            playlist_tracks, lengths, part_length or SEQUENCE_LENGTH, min_count
        )
    part = F.lit(0).cast("bigint") if part_length is None else F.floor(F.col("pos") / part_length)
    parts = playlist_tracks.groupBy("pid", part.alias("part")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "track_uri"))),
            lambda entry: entry["track_uri"],
        ).alias("track_sequence")
    )
    return spread_join(parts, lengths, "pid", counts=counts).select(
        "pid", "part", "num_tracks", "track_sequence"
    )


def _common_items(
    rows: DataFrame, lengths: DataFrame, part_length: int, min_count: int
) -> DataFrame:
    """Rows of the playlists whose item is frequent enough, positions without gaps."""
    rows = restrict_to(rows.select("pid", "track_uri", "pos"), lengths, "pid")
    common = stage(
        rows.groupBy("track_uri")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_count),
        "common-items",
    )
    kept = restrict_to(rows, common, "track_uri").withColumn(
        "_piece", F.floor(F.col("pos") / part_length)
    )
    order = ["pos", "track_uri"]
    placed = group_positions(kept, ["pid"], "_piece", order, "_nth")
    return placed.select("pid", "track_uri", F.col("_nth").alias("pos"))


def in_vocabulary(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows whose item occurs in the training data."""
    return restrict_to(rows, vocabulary, "track_uri")


def seed_rows(known: DataFrame, scenarios: dict[str, int] = SCENARIOS) -> DataFrame:
    """(scenario, pid, track_uri, pos): the first k rows of each playlist.

    ``known`` are the rows of in_vocabulary. Repeats stay. Only the largest k
    rows of a playlist are ever gathered.
    """
    chosen = _first(known, max(scenarios.values())).withColumn(
        "_s",
        F.explode(
            F.filter(_scenario_array(scenarios), lambda s: s["k"] >= F.col("_nth"))
        ),
    )
    return chosen.select("_s.scenario", "pid", "track_uri", "pos")


def holdout_rows(
    known: DataFrame, scenarios: dict[str, int] = SCENARIOS
) -> DataFrame:
    """(scenario, pid, track_uri): the different items after the first k rows.

    An item is held out when its last position lies beyond the k-th row, so
    items are reduced to their last position before scenarios multiply them.
    Playlists without held-out items do not appear.
    """
    last = known.groupBy("pid", "track_uri").agg(F.max("pos").alias("_last"))
    # The k-th row ends the seeds; without seeds the first one marks the playlist.
    ends = (
        _first(known, max(1, *scenarios.values()))
        .withColumn(
            "_s",
            F.explode(
                F.filter(
                    _scenario_array(scenarios),
                    lambda s: F.greatest(s["k"], F.lit(1)) == F.col("_nth"),
                )
            ),
        )
        .select(
            "pid",
            F.struct(
                F.col("_s.scenario").alias("scenario"),
                F.when(F.col("_s.k") > 0, F.col("pos")).alias("end"),
            ).alias("_end"),
        )
    )
    # At most one entry per scenario, so the list is as short as the scenarios.
    per_playlist = stage(
        ends.groupBy("pid").agg(F.collect_list("_end").alias("_ends")), "ends"
    )
    return (
        lookup_join(last, per_playlist, "pid")
        .withColumn("_e", F.explode("_ends"))
        .filter(F.col("_e.end").isNull() | (F.col("_last") > F.col("_e.end")))
        .select("_e.scenario", "pid", "track_uri")
    )


def _first(known: DataFrame, n: int) -> DataFrame:
    order = [F.col("pos"), F.col("track_uri")]
    return top_per_group(known, ["pid"], order, n, name="_nth")


def _scenario_array(scenarios: dict[str, int]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), F.lit(k).alias("k"))
            for name, k in scenarios.items()
        ]
    )
