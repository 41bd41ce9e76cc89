"""Longer plans made of the operators: model grids and request lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.operators.counting import pop_baseline
from segue.operators.scoring import (
    MODELS,
    align_factors,
    als_spans,
    candidate_index,
    hybrid_queries,
    pad_with_popularity,
    popularity_queries,
    profile_vectors,
    recommend,
    vector_queries,
)
from segue.operators.split import (
    SCENARIOS,
    holdout_rows,
    in_vocabulary,
    reserve_validation,
    seed_rows,
    train_split,
    validation_split,
)
from segue.sources.storage import stage


@dataclass
class Split:
    """Tables that training and evaluation start from.

    All are written down but ``train``, which is the given rows behind a filter.
    """

    reserved: DataFrame
    train: DataFrame
    validation: DataFrame
    baseline: DataFrame
    known: DataFrame


def split_tables(
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    min_length: int,
    fraction: float,
    cap: int | None = None,
) -> Split:
    """Reserve playlists and part the rows; ``playlist_tracks`` is a stored table.

    The reserved list is short and broadcast, so neither part shuffles the rows.
    """
    reserved = stage(reserve_validation(playlists, min_length, fraction, cap), "reserved")
    train = train_split(playlist_tracks, reserved)
    validation = stage(validation_split(playlist_tracks, reserved), "validation")
    baseline = stage(pop_baseline(train), "baseline")
    known = stage(in_vocabulary(validation, baseline), "known")
    return Split(reserved, train, validation, baseline, known)


def aligned_candidates(
    baseline: DataFrame, als_factors: DataFrame, word_factors: DataFrame
) -> DataFrame:
    """Candidates with vectors, written once for all later passes."""
    index = candidate_index(baseline)
    return stage(align_factors(index, als_factors, word_factors), "candidates")


def model_queries(
    queries: DataFrame,
    seeds: DataFrame,
    candidates: DataFrame,
    als_factors: DataFrame,
    word_factors: DataFrame,
    keys: list[str],
    models: list[str] = MODELS,
) -> DataFrame:
    """The given queries once per model: (keys, model, weight, vectors, shift).

    Queries without usable seeds fall back to popularity, or in the hybrid lose
    that part; they are kept because the profiles are joined to the list of
    queries and not the other way round.
    """
    als_profiles = word_profiles = None
    if {"ALS", "Hybrid"} & set(models):
        als_profiles = stage(profile_vectors(seeds, als_factors, keys), "als_profiles")
    if {"Word2Vec", "Hybrid"} & set(models):
        word_profiles = stage(
            profile_vectors(seeds, word_factors, keys, unit=True), "word_profiles"
        )
    built = []
    for model in models:
        if model == "Popularity":
            rows = popularity_queries(queries)
        elif model == "ALS":
            rows = vector_queries(queries, als_profiles, keys, "als")
        elif model == "Word2Vec":
            rows = vector_queries(queries, word_profiles, keys, "word")
        else:
            spans = als_spans(candidates, als_profiles, keys)
            rows = hybrid_queries(queries, als_profiles, spans, word_profiles, keys)
        built.append(rows.withColumn("model", F.lit(model)))
    union = built[0]
    for rows in built[1:]:
        union = union.unionByName(rows)
    return union


def scenario_lists(
    split: Split,
    als_factors: DataFrame,
    word_factors: DataFrame,
    n: int,
    scenarios: dict[str, int] = SCENARIOS,
    models: list[str] = MODELS,
    hits_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(recommendations, holdout) of the whole grid of scenarios and models.

    With ``hits_only``, the lists are ranked as without it, but of their rows only those that
    the holdout holds, too, are written down: all that the metrics read.
    """
    seeds = stage(seed_rows(split.known, scenarios), "seeds")
    holdout = stage(holdout_rows(split.known, scenarios), "holdout")
    candidates = aligned_candidates(split.baseline, als_factors, word_factors)
    queries = holdout.select("scenario", "pid").distinct()
    rows = model_queries(
        queries,
        seeds,
        candidates,
        als_factors,
        word_factors,
        ["scenario", "pid"],
        models,
    )
    wanted = holdout if hits_only else None
    recs = recommend(candidates, rows, seeds, ["scenario", "model", "pid"], n, wanted)
    return stage(recs, "lists"), holdout


def recommend_requests(
    requests: DataFrame,
    seeds: DataFrame,
    baseline: DataFrame,
    als_factors: DataFrame,
    word_factors: DataFrame,
    n: int = 500,
) -> DataFrame:
    """Hybrid lists of ``n`` items for every request: (pid, track_uri, score, rank).

    Seeds outside the training data do not shape the profile but still are never
    recommended.
    """
    candidates = aligned_candidates(baseline, als_factors, word_factors)
    asked = requests.select("pid").distinct()
    known = stage(in_vocabulary(seeds, baseline), "known-seeds")
    rows = model_queries(
        asked, known, candidates, als_factors, word_factors, ["pid"], ["Hybrid"]
    ).drop("model")
    recs = stage(recommend(candidates, rows, seeds, ["pid"], n), "recs")
    return pad_with_popularity(recs, asked, seeds, candidates, ["pid"], n)
