import numpy as np
import pytest

from segue.functions.columns import hash_below
from segue.operators import counting, pairs, profile
from segue.operators.joins import hot_keys, restrict_to, spread_join, without
from segue.operators.ranking import dense_index, global_rank, group_positions, top_per_group
from pyspark.sql import functions as F


def test_length_stats_match_numpy(spark):
    lengths = [5, 7, 7, 30, 101, 250, 12]
    df = spark.createDataFrame([(x,) for x in lengths] + [(None,)], "num_tracks int")
    got = profile.length_stats(df).first()
    assert (got.min_length, got.max_length) == (5, 250)
    assert got.avg_length == pytest.approx(np.mean(lengths))
    for name, p in [("p25", 25), ("median", 50), ("p75", 75), ("p95", 95)]:
        assert got[name] == pytest.approx(np.percentile(lengths, p))


def test_length_buckets(spark):
    values = [10, 11, 25, 26, 50, 51, 100, 101, 150, 151, None]
    df = spark.createDataFrame([(x,) for x in values], "num_tracks int")
    got = {r.length_bucket: r.num_playlists for r in profile.length_histogram(df).collect()}
    assert got == {"5-10": 1, "11-25": 2, "26-50": 2, "51-100": 2, "101-150": 2, "151-250": 2}


def test_follower_buckets_put_zero_and_null_in_the_else_branches(spark):
    values = [0, 1, 2, 3, 6, 11, 51, None]
    df = spark.createDataFrame([(x,) for x in values], "num_followers int")
    got = {r.follower_bucket: r.num_playlists for r in profile.follower_histogram(df).collect()}
    assert got == {"1": 1, "2": 1, "3-5": 2, "6-10": 1, "11-50": 1, "50+": 2}


def test_percentages_use_the_real_total(spark):
    rows = [(1, "a")] * 6 + [(2, "b"), (3, "c")]
    df = spark.createDataFrame(rows, "pid long, track_uri string")
    got = {r.frequency_bucket: (r.num_tracks, r.pct_of_tracks) for r in profile.frequency_histogram(df).collect()}
    assert got == {"1 (appears once)": (2, 66.67), "6-20": (1, 33.33)}


def test_titles_and_descriptions(spark, rows):
    df = spark.createDataFrame(
        [(" Rock ", "d"), ("rock", None), ("rock!", None), (None, None)],
        "name string, description string",
    )
    expected = [("rock!", 1), ("rock", 2), (None, 1)]
    assert rows(profile.title_counts(df)) == sorted(expected, key=repr)
    assert rows(profile.description_share(df)) == [(1, 25.0)]


TRACKS = [
    ("t:1", "same", "u1", "x"),
    ("t:2", "same", "u1", "x"),
    ("t:3", "other", "u2", "y"),
]


def test_top_tracks_merge_items_with_the_same_names(spark, rows):
    tracks = spark.createDataFrame(
        TRACKS, "track_uri string, track_name string, artist_uri string, artist_name string"
    )
    pt = spark.createDataFrame(
        [(1, "t:1"), (1, "t:2"), (2, "t:3"), (2, "t:3"), (3, "t:1")],
        "pid long, track_uri string",
    )
    assert [tuple(r) for r in profile.top_tracks(pt, tracks).collect()] == [
        ("same", "x", 3),
        ("other", "y", 2),
    ]
    assert [tuple(r) for r in profile.top_artists(pt, tracks, 1).collect()] == [("x", 3)]
    assert rows(counting.artist_popularity(pt, tracks)) == [
        ("u1", "x", 3, 2, 2, 1),
        ("u2", "y", 2, 1, 1, 2),
    ]


def test_rank_leaves_gaps_after_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 5), ("b", 5), ("c", 3), ("d", 1), ("e", 1)], "track_uri string, playlist_count long"
    )
    assert rows(global_rank(df, "playlist_count", "r"), "track_uri", "r") == [
        ("a", 1), ("b", 1), ("c", 3), ("d", 4), ("e", 4),
    ]


def test_dense_index_follows_the_order(spark):
    df = spark.createDataFrame([(f"k{i * 7919 % 1000:03d}",) for i in range(1000)], "k string")
    got = {r.k: r.i for r in dense_index(df.repartition(5), [F.col("k")], "i").collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))} and len(got) == 1000


def test_positions_equal_one_window_per_group(spark, rows):
    data = [(i % 3 if i % 2 else 0, i * 31 % 97 // 10, i * 31 % 97, i) for i in range(200)]
    df = spark.createDataFrame(data, "g long, day long, t long, i long")
    got = group_positions(df, ["g"], "day", ["t", "i"], "pos")
    expected, seen = [], {}
    for g, _, t, i in sorted(data, key=lambda r: (r[0], r[2], r[3])):
        expected.append((g, i, seen.get(g, 0)))
        seen[g] = seen.get(g, 0) + 1
    assert rows(got, "g", "i", "pos") == sorted(expected, key=repr)


@pytest.mark.parametrize("tasks", [None, 3])
def test_positions_sort_the_rows_once_and_join_nothing(spark, rows, tasks):
    """NULL keys, days and order columns keep their places without a join of all rows."""
    data = [(g, day, t, f"{g}-{day}-{t}") for g in (None, 1, 2) for day in (None, 0, 5) for t in (None, 0, 1)]
    df = spark.createDataFrame(data[::-1], "g int, day int, t int, label string")
    got = group_positions(df, ["g"], "day", ["t"], "pos", tasks)
    assert got.columns == ["g", "day", "t", "label", "pos"] and dict(got.dtypes)["pos"] == "bigint"
    # The rows above lie in the order of their places.
    assert rows(got, "label", "pos") == sorted(((r[3], i % 9) for i, r in enumerate(data)), key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window") == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_a_plain_join(spark, rows, how):
    # Key 0 holds a third of the rows and is split; keys 40.. have no partner.
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = {r.k: r["_parts"] for r in hot_keys(counts, ["k"], 0.1).collect()}
    assert list(hot) == [0] and hot[0] >= 3
    assert rows(spread_join(left, right, "k", how, share=0.1)) == rows(left.join(right, "k", how))


def test_restrict_and_without_agree_on_both_paths(spark, rows):
    df = spark.range(100).select((F.col("id") % 10).alias("pid"), "id")
    keys = spark.createDataFrame([(1,), (2,), (99,)], "pid long")
    for limit in (100, 1):
        kept, dropped = restrict_to(df, keys, "pid", limit), without(df, keys, "pid", limit)
        assert {r.pid for r in kept.collect()} == {1, 2}
        assert kept.count() + dropped.count() == 100


def test_top_per_group_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    top = top_per_group(df, ["g"], [F.desc("id")], 3)
    assert sorted((r.g, r.id, r["rank"]) for r in top.collect()) == [
        (0, 994, 3), (0, 996, 2), (0, 998, 1), (1, 995, 3), (1, 997, 2), (1, 999, 1),
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def brute_pairs(rows, min_count):
    groups, counts = {}, {}
    for pid, uri in rows:
        groups.setdefault(pid, []).append(uri)
    for items in groups.values():
        for a in items:
            for b in items:
                if a < b:
                    counts[a, b] = counts.get((a, b), 0) + 1
    return sorted((a, b, n) for (a, b), n in counts.items() if n >= min_count)


@pytest.mark.parametrize("chunk", [1, 3, 4_000])
def test_pairs_equal_brute_force_however_groups_are_cut(spark, rows, chunk):
    # Playlist 0 holds a third of all rows; several items repeat.
    data = [(0 if i % 3 == 0 else i % 7, f"t:{i * i % 23:02d}") for i in range(150)]
    df = spark.createDataFrame(data, "pid long, track_uri string")
    got = rows(pairs.pair_counts(df, 2, chunk))
    assert got == brute_pairs(data, 2)


def test_repeats_multiply(spark, rows):
    data = [(1, "a"), (1, "a"), (1, "b"), (1, "b"), (1, "b")]
    df = spark.createDataFrame(data, "pid long, track_uri string")
    assert rows(pairs.pair_counts(df, 1)) == [("a", "b", 6)]


def test_ties_at_the_popularity_cut_stay(spark, rows):
    data = [(1, "a"), (2, "a"), (1, "b"), (1, "c")]
    df = spark.createDataFrame(data, "pid long, track_uri string")
    popularity = counting.track_popularity(df)
    got = rows(pairs.cooccurrence(df, popularity, top_k=2, min_count=1))
    assert got == [("a", "b", 1), ("a", "c", 1), ("b", "c", 1)]


def test_sample_depends_on_the_key_alone(spark, rows):
    df = spark.range(-1000, 1000).select(F.col("id").alias("pid"))
    once = rows(df.filter(hash_below(F.col("pid"), 0.1, 42)))
    again = rows(df.repartition(7).filter(hash_below(F.col("pid"), 0.1, 42)))
    other = rows(df.filter(hash_below(F.col("pid"), 0.1, 43)))
    assert once == again and once != other and 140 < len(once) < 260
    assert df.filter(hash_below(F.col("pid"), 0.0)).isEmpty()
    same = hash_below(F.col("pid") + 1, 0.5, 0) == hash_below(F.col("pid"), 0.5, 1)
    assert 0.4 < df.filter(same).count() / 2000 < 0.6
    assert df.filter(hash_below(F.col("pid"), 1.0)).count() == 2000


def test_sample_is_even_over_large_keys(spark):
    keys = spark.range(40_000).select((F.col("id") * (2**33 + 8)).alias("pid"))
    share = keys.filter(hash_below(F.col("pid"), 0.25)).count() / 40_000
    assert abs(share - 0.25) < 0.01
