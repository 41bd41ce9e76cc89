"""Timings of the headline queries; prints one JSON line.

The tables are first prepared once (timed as ``ingest``), as the later steps
read tables that ingest has written. Every query is run once after a small
warm-up of the session, and its whole result is computed.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from segue.operators import counting, evaluate, models, pairs, profile, scoring, split  # noqa: E402
from segue.plans.continuation import scenario_lists, split_tables  # noqa: E402
from segue.plans.queries import FRACTION, LONG, MIN_PAIRS, N, SCENARIOS, TOP_ITEMS  # noqa: E402
from segue.sources import purchases  # noqa: E402
from segue.sources.storage import read_table, write_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session(folder):
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("segue-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )


def finish(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(folder)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).groupBy((F.col("id") % 100).alias("k")).count().collect()
    seconds = {}

    def timed(name, work):
        begin = time.time()
        result = work()
        seconds[name] = round(time.time() - begin, 3)
        return result

    def ingest():
        write_table(purchases.playlist_tracks(spark, SF_DIR), f"{folder}/playlist_tracks")
        rows = read_table(spark, folder, "playlist_tracks")
        write_table(purchases.playlists(spark, SF_DIR, rows), f"{folder}/playlists")
        write_table(purchases.tracks(spark, SF_DIR), f"{folder}/tracks")

    timed("ingest", ingest)
    rows = read_table(spark, folder, "playlist_tracks")
    playlists = read_table(spark, folder, "playlists")
    tracks = read_table(spark, folder, "tracks")
    timed("load_count", lambda: rows.cache().count())

    timed("group_by_track", lambda: counting.item_counts(rows).count())
    timed("top_artists", lambda: profile.top_artists(rows, tracks).collect())
    timed(
        "cooccurrence_sampled",
        lambda: pairs.cooccurrence_sampled(rows, FRACTION, 2, seed=42).count(),
    )
    timed("track_popularity", lambda: finish(counting.track_popularity(rows)))
    timed("artist_popularity", lambda: finish(counting.artist_popularity(rows, tracks)))
    timed("top_tracks", lambda: finish(profile.top_tracks(rows, tracks)))
    timed("length_stats", lambda: finish(profile.length_stats(playlists)))
    timed("length_histogram", lambda: finish(profile.length_histogram(playlists)))
    timed("frequency_histogram", lambda: finish(profile.frequency_histogram(rows)))

    def cooccurrence():
        popularity = counting.track_popularity(rows)
        finish(pairs.cooccurrence(rows, popularity, TOP_ITEMS, MIN_PAIRS))

    timed("cooccurrence", cooccurrence)
    timed("dense_index", lambda: finish(models.track_id_map(rows)))
    timed("sequences", lambda: finish(split.sequences(rows)))
    tables = timed("split", lambda: split_tables(playlists, rows, LONG, FRACTION))
    factors = purchases.item_factors(spark, SF_DIR)

    def evaluation():
        recs, holdout = scenario_lists(tables, factors, factors, N, SCENARIOS)
        finish(evaluate.evaluate(recs, holdout, scoring.MODELS, N))

    timed("evaluate_grid", evaluation)

    def als():
        id_map = models.track_id_map(tables.train)
        ratings = models.als_input(tables.train, id_map).cache()
        model = models.fit_als(ratings)
        finish(models.als_item_vectors(model, id_map))
        ratings.unpersist()

    timed("fit_als", als)

    def word2vec():
        model = models.fit_word2vec(
            models.word2vec_input(tables.train)
        )
        finish(models.word_vectors(model))

    timed("fit_word2vec", word2vec)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
