"""Registered queries over the test tables.

Each takes (spark, sf_dir) and works on the whole tables. Parameters that must
suit smaller data than the reference's are stated once, here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.functions.columns import flag, unsigned_zero
from segue.functions.vectors import l2_norm, normalize
from segue.operators import counting, evaluate, ingest, models, pairs, profile, scoring
from segue.operators import split as splits
from segue.operators.blocks import top_by_product
from segue.operators.verify import verify_recommendations
from segue.plans.continuation import (
    Split,
    aligned_candidates,
    model_queries,
    recommend_requests,
    scenario_lists,
    split_tables,
)
from segue.sources import export, purchases
from segue.sources import storage
from segue.sources.slices import (
    read_checked,
    read_quarantine,
    read_requests,
    read_slices,
    request_seeds,
    write_quarantine,
)
from segue.sources.storage import scratch_path, stage, temporary_views

TOP_ITEMS = 500
MIN_PAIRS = 3
MIN_PAIRS_SAMPLED = 2
LONG = 50
FRACTION = 0.1
N = 500
SCENARIOS = splits.SCENARIOS
SIMILAR_TO = "item:1"
# The full sizes of the reference; the names are those that the SQL reads.
ALS_SMALL = {"rank": 64, "maxIter": 10}
WORD2VEC_SMALL = {"vectorSize": 128, "maxIter": 5}
SLICE_PIDS = 25  # collections of a slice whose content follows from their ids
LITERAL_USERS = (1, 2, 5, 7)
FILES = 4
BUCKETS = 8
TOP_PRODUCTS = 10
RESIDUAL = 1e-3  # of a user's equations, for 32-bit vectors
WIDE = 1 << 40  # added to pids, beyond MLlib's ids
NATION_FRACTION = 0.3
VOCABULARIES = (50, 1_000, 1_000_000)  # words at most


# --- ingest ------------------------------------------------------------------


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_playlists(purchases.slices(spark, sf_dir))


def playlists_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A long collection spans several records with the same header.
    return ingest.drop_nested(_nested(spark, sf_dir)).distinct()


def interactions_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_interactions(_nested(spark, sf_dir))


def tracks_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_tracks(_nested(spark, sf_dir))


def read_slices_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "slices")
    purchases.write_slices(purchases.slices(spark, sf_dir), path)
    flat = ingest.flatten_playlists(read_slices(spark, path))
    appearances = flat.select(
        "pid", "name", "collaborative", F.explode("tracks").alias("t")
    )
    return appearances.select(
        "pid", "name", "collaborative", "t.pos", "t.track_uri", "t.album_name"
    )


def _whole(uneven: DataFrame) -> DataFrame:
    return uneven.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) if c != "status" else c for c in uneven.columns])


def slice_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a check of slice files reads and sets aside.

    One file for every ``SLICE_PIDS`` ids; each seventh is cut short, and of the others
    each fifth lacks its playlists. The rejected ones go through the quarantine.
    """
    number = F.floor(F.col("pid") / SLICE_PIDS)
    listed = purchases.slices(spark, sf_dir, by=number).select(
        F.col("info.slice").cast("bigint").alias("slice"), "playlists"
    )
    info = F.struct(F.lit("test").alias("generated_on"), F.col("slice").cast("string").alias("slice"))
    text = F.to_json(F.struct(info.alias("info"), "playlists"))
    written = (
        F.when(F.col("slice") % 7 == 3, F.expr("substring(text, 1, length(text) - 20)"))
        .when(F.col("slice") % 5 == 4, F.to_json(F.struct(info.alias("info"))))
        .otherwise(F.col("text"))
    )
    path = scratch_path(spark, "mixed-slices")
    files = listed.withColumn("text", text).select(written.alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    checked = read_checked(spark, path)
    bad = scratch_path(spark, "quarantine")
    write_quarantine(checked, bad)
    flat = checked.good.select(
        F.lit("read").alias("status"),
        F.size("playlists").alias("playlists"),
        F.aggregate("playlists", F.lit(0), lambda n, p: n + F.size(p["tracks"])).alias("tracks"),
    )
    set_aside = read_quarantine(spark, bad).select(F.col("reason").alias("status"), F.lit(None).cast("int"), F.lit(None).cast("int"))
    sums = flat.union(set_aside).groupBy("status").agg(
        F.count("*").alias("files"), F.sum("playlists").alias("playlists"), F.sum("tracks").alias("tracks")
    )
    return _whole(sums)


def literal_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items some users given by hand have."""
    users = storage.literal_queries(spark, [(u,) for u in LITERAL_USERS], "pid bigint")
    counts = purchases.interactions(spark, sf_dir).join(F.broadcast(users), "pid")
    return counts.groupBy("pid").agg(F.count("*").alias("num_tracks"))


def file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interactions written to a fixed number of files, and read back."""
    path = scratch_path(spark, "fixed-files")
    storage.write_table(purchases.interactions(spark, sf_dir), path, files=FILES)
    named = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
    return named.agg(F.count("*").alias("n")).agg(F.count("*").alias("files"), F.sum("n").alias("num_rows"))


def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per flag, from a table in folders joined with one in buckets.

    Of the headers in folders by flag only those of collaborative collections are
    read; they and the interactions are bucketed alike, so their join needs no
    exchange.
    """
    folders = scratch_path(spark, "folders")
    heads = purchases.headers(spark, sf_dir).withColumn("collaborative", flag(F.col("collaborative")))
    storage.write_table(heads, folders, partition_by=["collaborative"], target_bytes=64 << 20)
    # The values of folders are read as text.
    shared = spark.read.parquet(folders).filter("collaborative = 'true'")
    token = folders.rsplit("-", 1)[1]
    rows = storage.write_buckets(
        purchases.interactions(spark, sf_dir), f"rows_{token}", f"{folders}-rows", ["pid"], BUCKETS
    )
    owners = storage.write_buckets(
        shared.select("pid", flag(F.col("collaborative")).alias("collaborative")), f"owners_{token}", f"{folders}-owners", ["pid"], BUCKETS
    )
    return (
        rows.hint("merge").join(owners, "pid")
        .groupBy("pid", "collaborative")
        .agg(F.count("*").alias("n"))
        .groupBy("collaborative")
        .agg(F.count("*").alias("playlists"), F.sum("n").alias("tracks"))
    )


def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after ingest against the same counts taken from the source tables."""
    nested = stage(_nested(spark, sf_dir), "nested")
    actual = ingest.table_counts(
        ingest.drop_nested(nested).distinct(),
        ingest.flatten_tracks(nested),
        ingest.flatten_interactions(nested),
    )
    rows = purchases.interactions(spark, sf_dir)
    expected = ingest.table_counts(
        rows.select("pid").distinct(), purchases.tracks(spark, sf_dir), rows
    )
    return ingest.validate_counts(
        actual, expected.withColumnRenamed("actual", "expected")
    )


# --- profile -----------------------------------------------------------------


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_stats(purchases.lengths(spark, sf_dir))


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_histogram(purchases.lengths(spark, sf_dir))


def follower_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.follower_histogram(purchases.headers(spark, sf_dir))


def frequency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequency_histogram(purchases.interactions(spark, sf_dir))


def title_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.title_counts(purchases.headers(spark, sf_dir))


def description_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.description_share(purchases.headers(spark, sf_dir))


def collaborative_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = purchases.headers(spark, sf_dir).select(
        flag(F.col("collaborative")).alias("collaborative")
    )
    return flags.groupBy("collaborative").agg(F.count("*").alias("num_playlists"))


def top_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_tracks(
        purchases.interactions(spark, sf_dir), purchases.tracks(spark, sf_dir)
    )


def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_artists(
        purchases.interactions(spark, sf_dir), purchases.tracks(spark, sf_dir)
    )


def top_artists_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report written as SQL over registered views."""
    tables = {
        "playlist_tracks": purchases.interactions(spark, sf_dir),
        "tracks": purchases.tracks(spark, sf_dir),
    }
    with temporary_views(tables):
        return spark.sql(
            """
            WITH counted AS (
                SELECT track_uri, count(*) AS n FROM playlist_tracks GROUP BY track_uri
            )
            SELECT t.artist_name, sum(c.n) AS track_appearances
            FROM counted c JOIN tracks t ON c.track_uri = t.track_uri
            GROUP BY t.artist_name
            ORDER BY track_appearances DESC, artist_name
            LIMIT 20
            """
        )


# --- features ----------------------------------------------------------------


def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.item_counts(purchases.interactions(spark, sf_dir))


def track_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.track_popularity(purchases.interactions(spark, sf_dir))


def artist_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.artist_popularity(
        purchases.interactions(spark, sf_dir), purchases.tracks(spark, sf_dir)
    )


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases.interactions(spark, sf_dir)
    popularity = stage(counting.track_popularity(rows), "track_popularity")
    return pairs.cooccurrence(rows, popularity, TOP_ITEMS, MIN_PAIRS)


def cooccurrence_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.cooccurrence_sampled(
        purchases.interactions(spark, sf_dir), FRACTION, MIN_PAIRS_SAMPLED, seed=42
    )


def top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.top_pairs(
        cooccurrence(spark, sf_dir), purchases.tracks(spark, sf_dir)
    )


# --- split -------------------------------------------------------------------


def _reserved(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    heads = purchases.headers(spark, sf_dir, rows)
    return stage(splits.reserve_validation(heads, LONG, FRACTION), "reserved")


def _split(spark: SparkSession, sf_dir: str) -> Split:
    return split_tables(
        purchases.headers(spark, sf_dir),
        stage(purchases.playlist_tracks(spark, sf_dir), "playlist_tracks"),
        LONG,
        FRACTION,
    )


def validation_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reserved(spark, sf_dir)


def validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.validation_split(
        purchases.playlist_tracks(spark, sf_dir), _reserved(spark, sf_dir)
    )


def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.train_split(
        purchases.playlist_tracks(spark, sf_dir), _reserved(spark, sf_dir)
    )


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_counts(
        purchases.interactions(spark, sf_dir), _reserved(spark, sf_dir)
    )


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.train_split(
        purchases.interactions(spark, sf_dir), _reserved(spark, sf_dir)
    )


def pop_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.pop_baseline(_train(spark, sf_dir))


def popularity_topn_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.popularity_topn_labeled(
        pop_baseline(spark, sf_dir), purchases.tracks(spark, sf_dir)
    )


def dense_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.track_id_map(_train(spark, sf_dir))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.sequences(
        purchases.playlist_tracks(spark, sf_dir), part_length=splits.SEQUENCE_LENGTH
    )
    return rows.select(
        "pid",
        "part",
        "num_tracks",
        F.size("track_sequence").cast("bigint").alias("part_tracks"),
        F.array_join("track_sequence", " ").alias("track_sequence"),
    )


def seed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.seed_rows(_split(spark, sf_dir).known, SCENARIOS)


def seed_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.holdout_rows(_split(spark, sf_dir).known, SCENARIOS)


# --- scoring -----------------------------------------------------------------


def candidate_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = scoring.candidate_index(pop_baseline(spark, sf_dir))
    return index.withColumn("popularity", F.round("popularity", 6))


def aligned_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = purchases.item_factors(spark, sf_dir)
    index = scoring.candidate_index(pop_baseline(spark, sf_dir))
    aligned = scoring.align_factors(index, factors, factors)
    return aligned.select(
        "track_uri",
        F.round(l2_norm(F.col("als")), 6).alias("als_norm"),
        F.round(l2_norm(normalize(F.col("word"))), 6).alias("word_unit_norm"),
    )


def factor_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = purchases.item_factors(spark, sf_dir)
    index = scoring.candidate_index(pop_baseline(spark, sf_dir))
    return scoring.factor_coverage(scoring.align_factors(index, factors, factors))


def _first_10(spark: SparkSession, sf_dir: str):
    tables = _split(spark, sf_dir)
    seeds = splits.seed_rows(tables.known, {"first_10": 10})
    return tables, stage(seeds.select("pid", "track_uri"), "seeds")


def profile_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, seeds = _first_10(spark, sf_dir)
    factors = purchases.item_factors(spark, sf_dir)
    plain = scoring.profile_vectors(seeds, factors, ["pid"])
    unit = scoring.profile_vectors(seeds, factors, ["pid"], unit=True)
    both = plain.join(unit.withColumnRenamed("profile", "unit_profile"), "pid")
    return both.select(
        "pid", F.posexplode(F.arrays_zip("profile", "unit_profile")).alias("dim", "x")
    ).select(
        "pid",
        F.col("dim").cast("bigint").alias("dim"),
        F.round("x.profile", 6).alias("mean"),
        F.round("x.unit_profile", 6).alias("unit_mean"),
    )


def similar_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    nearest = models.similar_items(
        purchases.item_factors(spark, sf_dir),
        SIMILAR_TO,
        10,
        purchases.tracks(spark, sf_dir),
    )
    return nearest.withColumn("similarity", F.round("similarity", 6))


def _lists(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Lists of one model for the reserved playlists, first 10 items as seeds."""
    tables, seeds = _first_10(spark, sf_dir)
    factors = purchases.item_factors(spark, sf_dir)
    candidates = aligned_candidates(tables.baseline, factors, factors)
    queries = tables.reserved.select("pid")
    rows = model_queries(
        queries, seeds, candidates, factors, factors, ["pid"], [model]
    ).drop("model")
    return scoring.recommend(candidates, rows, seeds, ["pid"], N)


def _rounded(recs: DataFrame) -> DataFrame:
    return recs.withColumn("score", F.round("score", 6))


def score_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_lists(spark, sf_dir, "Popularity"))


def score_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_lists(spark, sf_dir, "ALS"))


def score_w2v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_lists(spark, sf_dir, "Word2Vec"))


def score_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_lists(spark, sf_dir, "Hybrid"))


def pad_with_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALS lists of ten items filled up to N."""
    tables, seeds = _first_10(spark, sf_dir)
    factors = purchases.item_factors(spark, sf_dir)
    candidates = aligned_candidates(tables.baseline, factors, factors)
    queries = tables.reserved.select("pid")
    rows = model_queries(
        queries, seeds, candidates, factors, factors, ["pid"], ["ALS"]
    ).drop("model")
    short = stage(scoring.recommend(candidates, rows, seeds, ["pid"], 10), "short")
    padded = scoring.pad_with_popularity(short, queries, seeds, candidates, ["pid"], N)
    return padded.select("pid", "track_uri", "rank")


# --- evaluation --------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = purchases.item_factors(spark, sf_dir)
    recs, holdout = scenario_lists(
        _split(spark, sf_dir), factors, factors, N, SCENARIOS, hits_only=True
    )
    return evaluate.list_metrics(
        recs, holdout, scoring.MODELS, ["scenario", "pid"], N
    )


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _metrics(spark, sf_dir)
    return metrics.withColumns(
        {name: F.round(name, 6) for name in ["r_precision", "ndcg"]}
    )


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluate.summarize(_metrics(spark, sf_dir))
    return summary.withColumns(
        {name: F.round(name, 6) for name in ["r_precision", "ndcg", "clicks"]}
    )


def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as the metric sink stores it."""
    path = scratch_path(spark, "metrics")
    export.write_metrics(eval_summary(spark, sf_dir), path)
    return spark.read.parquet(f"{path}/parquet")


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluate.summarize(_metrics(spark, sf_dir))
    best = evaluate.best_model(summary, scoring.MODELS)
    return best.withColumns(
        {name: F.round(name, 6) for name in ["r_precision", "ndcg"]}
    )


def improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    gains = evaluate.improvement(evaluate.summarize(_metrics(spark, sf_dir)))
    return gains.withColumn("gain_pct", unsigned_zero(F.round("gain_pct", 4)))


def eval_first_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the grid for collections of at least 100 items.

    A collection is here all that customers of a nation bought; positions follow the
    time, so all five scenarios have seeds and holdouts.
    """
    rows = stage(purchases.nation_tracks(spark, sf_dir), "nation_tracks")
    heads = rows.groupBy("pid").agg(F.count("*").alias("num_tracks")).withColumn("name", F.lit("nation"))
    tables = split_tables(heads, rows, 100, NATION_FRACTION)
    factors = purchases.item_factors(spark, sf_dir)
    recs, holdout = scenario_lists(tables, factors, factors, N, SCENARIOS)
    summary = evaluate.evaluate(recs, holdout, scoring.MODELS, N)
    return summary.withColumns({name: F.round(name, 6) for name in ["r_precision", "ndcg", "clicks"]})


# --- requests ----------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests written as JSON and read back: reserved playlists, the first 0,
    5, 10 or 25 items as seeds, every third one without a title."""
    rows = purchases.playlist_tracks(spark, sf_dir)
    reserved = _reserved(spark, sf_dir)
    sizes = F.array(*[F.lit(k) for k in SCENARIOS.values()])
    asked = reserved.select(
        "pid",
        F.when(F.col("pid") % 3 != 0, F.col("name")).alias("name"),
        F.element_at(sizes, (F.col("pid") % 4 + 1).cast("int")).alias("num_samples"),
    )
    given = (
        splits.validation_split(rows, reserved)
        .filter(F.col("pos") < max(SCENARIOS.values()))
        .groupBy("pid")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "track_uri"))).alias("first"))
    )
    entries = asked.join(given, "pid").select(
        F.array(
            F.struct(
                "pid",
                "name",
                "num_samples",
                F.transform(
                    F.filter("first", lambda t: t["pos"] < F.col("num_samples")),
                    lambda t: F.struct(t["track_uri"].alias("track_uri")),
                ).alias("tracks"),
            )
        ).alias("playlists")
    )
    path = scratch_path(spark, "requests")
    entries.write.json(path)
    return read_requests(spark, path, multi_line=False)


def request_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.request_scenarios(_requests(spark, sf_dir))


def _request_lists(spark: SparkSession, sf_dir: str):
    requests = stage(_requests(spark, sf_dir), "requests")
    seeds = request_seeds(requests).select("pid", "track_uri")
    baseline = stage(pop_baseline(spark, sf_dir), "baseline")
    factors = purchases.item_factors(spark, sf_dir)
    recs = recommend_requests(requests, seeds, baseline, factors, factors, N)
    return requests, seeds, recs


def requests_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, recs = _request_lists(spark, sf_dir)
    return recs.select("pid", "track_uri", "rank")


def export_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, recs = _request_lists(spark, sf_dir)
    return export.recommendation_lines(recs, N)


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists written as gzipped lines and read back."""
    _, _, recs = _request_lists(spark, sf_dir)
    path = scratch_path(spark, "export")
    export.export_recommendations(recs, path, N)
    return export.read_recommendations(spark, path)


def verify_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on popularity lists that were left as they are, seeds included."""
    requests = stage(_requests(spark, sf_dir), "requests")
    seeds = request_seeds(requests).select("pid", "track_uri")
    baseline = stage(pop_baseline(spark, sf_dir), "baseline")
    candidates = scoring.candidate_index(baseline)
    nothing = seeds.filter(F.lit(False))
    empty = nothing.select("pid", "track_uri", F.lit(0.0).alias("score")).withColumn(
        "rank", F.lit(0).cast("bigint")
    )
    recs = scoring.pad_with_popularity(
        empty, requests.select("pid"), nothing, candidates, ["pid"], N
    )
    return verify_recommendations(recs, requests, seeds, N + 1)


# --- models ------------------------------------------------------------------


def _als(spark: SparkSession, sf_dir: str):
    train = stage(_train(spark, sf_dir), "train")
    id_map = stage(models.track_id_map(train), "track_id_map")
    ratings = stage(models.als_input(train, id_map), "ratings")
    return train, id_map, models.fit_als(ratings, **ALS_SMALL)


def als_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = stage(_train(spark, sf_dir), "train")
    id_map = stage(models.track_id_map(train), "track_id_map")
    ratings = models.als_input(train, id_map)
    return ratings.groupBy("user_id", "item_id").agg(
        F.sum(F.col("rating").cast("double")).alias("rating")
    )


def als_wide_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings of collections whose pids do not fit MLlib's ids."""
    train = stage(_train(spark, sf_dir).withColumn("pid", F.col("pid") + F.lit(WIDE)), "train")
    id_map = stage(models.track_id_map(train), "track_id_map")
    users = stage(models.user_id_map(train), "user_id_map")
    ratings = models.als_input(train, id_map, users=users).groupBy("user_id").agg(F.count("*").alias("ratings"))
    named = ratings.join(users, "user_id")
    return named.select("pid", F.col("user_id").cast("bigint").alias("user_id"), "ratings")


def als_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which users' vectors solve their equations, of all users with ratings."""
    train = stage(_train(spark, sf_dir), "train")
    id_map = stage(models.track_id_map(train), "track_id_map")
    ratings = stage(models.als_input(train, id_map), "ratings")
    model = models.fit_als(ratings, **ALS_SMALL)
    params = models.ALS_PARAMS
    gaps = models.als_residuals(model, ratings, params["regParam"], params["alpha"])
    return gaps.select(
        F.col("user_id").cast("bigint").alias("pid"), "ratings", (F.col("residual") < RESIDUAL).alias("solved")
    )


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item vectors of a stored and reloaded model against the fitted ones."""
    _, id_map, model = _als(spark, sf_dir)
    path = scratch_path(spark, "als-model")
    storage.save_model(model, path)
    again = models.als_item_vectors(storage.load_als(path), id_map).withColumnRenamed("features", "stored")
    fitted = models.als_item_vectors(model, id_map)
    return fitted.join(again, "track_uri", "full").select(
        "track_uri",
        F.size("stored").cast("bigint").alias("dim"),
        F.col("features").eqNullSafe(F.col("stored")).alias("same"),
    )


def top_items_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items for every collection, by the mean vector of its items."""
    factors = purchases.item_factors(spark, sf_dir)
    rows = purchases.interactions(spark, sf_dir)
    people = scoring.profile_vectors(rows, factors, ["pid"]).select(
        F.col("pid").alias("user_id"), F.col("profile").alias("features")
    )
    ids = stage(models.track_id_map(factors), "factor-ids")
    items = factors.join(ids, "track_uri").select(F.col("track_id").alias("item_id"), "features")
    best = top_by_product(people, items, TOP_PRODUCTS)
    named = best.join(ids.withColumnRenamed("track_id", "item_id"), "item_id")
    return named.select(F.col("user_id").alias("pid"), "rank", "track_uri", F.round("score", 6).alias("score"))


def als_item_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which items got an ALS vector, and how long it is."""
    _, id_map, model = _als(spark, sf_dir)
    vectors = models.als_item_vectors(model, id_map)
    return vectors.select("track_uri", F.size("features").cast("bigint").alias("dim"))


def als_user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, model = _als(spark, sf_dir)
    return models.als_user_vectors(model)


def fit_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, id_map, model = _als(spark, sf_dir)
    return models.als_item_vectors(model, id_map)


def als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items for every user with training rows, by MLlib."""
    _, id_map, model = _als(spark, sf_dir)
    users = models.als_user_vectors(model).select(
        F.col("pid").cast("int").alias("user_id")
    )
    return models.als_recommend(
        model, users, 10, id_map, purchases.tracks(spark, sf_dir)
    )


def als_recommend_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items that the user does not have yet, for every user."""
    train, id_map, model = _als(spark, sf_dir)
    users = models.als_user_vectors(model).select(F.col("pid").alias("user_id"))
    seen = train.select(F.col("pid").alias("user_id"), "track_uri")
    return models.als_recommend_unseen(model, users, 10, id_map, seen)


def word_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which items got a word vector, and how long it is."""
    vectors = fit_word2vec(spark, sf_dir)
    return vectors.select("track_uri", F.size("features").cast("bigint").alias("dim"))


def fit_word2vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(purchases.playlist_tracks(spark, sf_dir), "playlist_tracks")
    train = splits.train_split(rows, _reserved(spark, sf_dir, rows))
    track_sequences = stage(models.word2vec_input(train), "sequences")
    model = models.fit_word2vec(track_sequences, **WORD2VEC_SMALL)
    return models.word_vectors(model)


def word_min_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``minCount`` that leaves a vocabulary of some sizes at most."""
    rows = stage(purchases.playlist_tracks(spark, sf_dir), "playlist_tracks")
    train = splits.train_split(rows, _reserved(spark, sf_dir, rows))
    whole = stage(splits.sequences(train), "sequences")
    histogram = stage(models.count_histogram(whole), "word-counts")
    least = models.WORD2VEC_PARAMS["minCount"]
    found = [
        models.smallest_min_count(histogram, most, least).select(F.lit(most).cast("bigint").alias("most"), "*")
        for most in VOCABULARIES
    ]
    return reduce(DataFrame.union, found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        playlists_flat,
        interactions_flat,
        tracks_dedup,
        read_slices_roundtrip,
        slice_quarantine,
        literal_queries,
        file_count,
        table_layout,
        validate_counts,
        length_stats,
        length_histogram,
        follower_histogram,
        frequency_histogram,
        title_counts,
        description_share,
        collaborative_counts,
        top_tracks,
        top_artists,
        top_artists_sql,
        item_counts,
        track_popularity,
        artist_popularity,
        cooccurrence,
        cooccurrence_sampled,
        top_pairs,
        validation_playlists,
        validation_split,
        train_split,
        split_counts,
        pop_baseline,
        popularity_topn_labeled,
        dense_index,
        sequences,
        seed_items,
        seed_holdout,
        candidate_index,
        aligned_factors,
        factor_coverage,
        profile_vectors,
        similar_items,
        score_popularity,
        score_als,
        score_w2v,
        score_hybrid,
        pad_with_popularity,
        eval_metrics,
        eval_summary,
        best_model,
        improvement,
        eval_first_100,
        metrics_roundtrip,
        request_scenarios,
        requests_hybrid,
        export_recommendations,
        export_roundtrip,
        verify_lists,
        als_ratings,
        als_wide_ids,
        als_residuals,
        model_roundtrip,
        top_items_by_product,
        als_item_dims,
        als_user_vectors,
        fit_als,
        als_recommend,
        als_recommend_unseen,
        word_vocabulary,
        word_min_count,
        fit_word2vec,
    ]
    # Two queries share their names with the operators they run.
    names = {
        "requests_hybrid": "recommend_requests",
        "verify_lists": "verify_recommendations",
    }
    return {names.get(q.__name__, q.__name__): q for q in registered}
