"""Rows that used to be lost, seeds that must not shape a profile, hot NULL keys."""

import pytest
from pyspark.sql import functions as F

from segue.operators import evaluate, pairs, split
from segue.operators.joins import spread_join
from segue.operators.ranking import group_positions
from segue.plans.continuation import recommend_requests


def test_seed_outside_training_has_no_part_in_the_profile(spark):
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [0.0, 1.0]), ("zz", [0.0, 1.0])],
        "track_uri string, features array<float>",
    )
    baseline = spark.createDataFrame(
        [("a", 4, 1), ("b", 2, 2), ("c", 1, 3)], "track_uri string, playlist_count long, pop_rank int"
    )
    requests = spark.createDataFrame([(1,)], "pid long")
    seeds = spark.createDataFrame([(1, "zz")], "pid long, track_uri string")
    got = recommend_requests(requests, seeds, baseline, vectors, vectors, 3).orderBy("rank").collect()
    assert [r.track_uri for r in got] == ["a", "b", "c"]
    assert [round(r.score, 6) for r in got] == [0.1, 0.05, 0.025]


def test_positions_keep_null_keys_and_days(spark):
    rows = [(None, 1, 3), (None, 1, 2), (1, None, 9), (1, 4, 1), (1, 4, 0), (2, 1, 0)]
    df = spark.createDataFrame(rows, "g int, day int, t int")
    got = {(r.g, r.day, r.t): r.pos for r in group_positions(df, ["g"], "day", ["t"], "pos").collect()}
    assert got == {
        (None, 1, 2): 0, (None, 1, 3): 1, (1, None, 9): 0, (1, 4, 0): 1, (1, 4, 1): 2, (2, 1, 0): 0
    }


def test_reserve_has_no_limit_by_default(spark):
    playlists = spark.range(3_000).selectExpr("id as pid", "'n' as name", "10 as num_tracks")
    everything = split.reserve_validation(playlists, min_length=5, fraction=1.0)
    assert everything.count() == 3_000
    assert "Limit" not in everything._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_null_keys_are_spread_and_match_nothing(spark, rows, how):
    left = spark.range(4_000).selectExpr("if(id % 4 = 0, id % 40, null) as k", "id as v")
    right = spark.createDataFrame([(0, "a"), (4, "b"), (None, "n")], "k long, w string")
    assert rows(spread_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_null_keys_do_not_meet_in_one_partition(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(20_000).selectExpr("if(id % 10 = 0, id, null) as k", "id as v")
        right = spark.range(100).selectExpr("id as k", "'w' as w")
        joined = spread_join(left, right, "k", "left")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count()
        assert joined.count() == 20_000
        assert max(r["count"] for r in sizes.collect()) < 8_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_improvement_reads_the_summary_once(spark):
    summary = spark.createDataFrame(
        [("s", "Popularity", 0.2), ("s", "ALS", 0.3), ("t", "ALS", 0.5)],
        "scenario string, model string, r_precision double",
    )
    gains = evaluate.improvement(summary)
    assert [(r.scenario, r.model, round(r.gain_pct, 6)) for r in gains.collect()] == [("s", "ALS", 50.0)]
    assert "Join" not in gains._jdf.queryExecution().optimizedPlan().toString()


def test_top_pairs_names_both_items_and_leaves_out_unknown_ones(spark, rows):
    counted = spark.createDataFrame(
        [("a", "b", 5), ("a", "c", 4), ("b", "x", 3)],
        "track_uri_1 string, track_uri_2 string, co_count long",
    )
    tracks = spark.createDataFrame(
        [("a", "A", "P"), ("b", "B", None), ("c", "C", "Q")],
        "track_uri string, track_name string, artist_name string",
    )
    assert rows(pairs.top_pairs(counted, tracks)) == [
        ("a", "b", "A", "P", "B", None, 5),
        ("a", "c", "A", "P", "C", "Q", 4),
    ]


def test_broadcasts_are_bounded_in_bytes(spark):
    from segue.operators import joins

    wide = spark.range(20_000).select("id", F.array(*[F.lit(1.0)] * 50).alias("v"), F.lit("x" * 100).alias("s"))
    assert joins.fits_broadcast(wide)
    assert joins.fits_broadcast(wide, most_bytes=20_000 * 600)
    assert not joins.fits_broadcast(wide, most_bytes=20_000 * 500)
    assert not joins.fits_broadcast(wide, limit=19_999)
    assert not joins.fits_broadcast(spark.range(20_000), most_bytes=200_000)
    nested = spark.range(20_000).select(F.struct("id", F.create_map(F.lit("k"), F.array(F.lit("y" * 1000)))).alias("n"))
    assert joins.fits_broadcast(nested) and not joins.fits_broadcast(nested, most_bytes=20_000 * 1000)
    assert joins.fits_broadcast(wide.filter("id < 0"), most_bytes=0)
