import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from segue.operators import ingest
from segue.sources import storage
from segue.sources.slices import read_requests, read_slices, request_seeds


def _track(pos, uri, name="n", artist="a", album="b"):
    return {
        "pos": pos,
        "artist_name": artist,
        "track_uri": uri,
        "artist_uri": f"artist:{artist}",
        "track_name": name,
        "album_uri": f"album:{album}",
        "duration_ms": 1000,
        "album_name": album,
    }


def _playlist(pid, tracks, **extra):
    base = {
        "name": f"list {pid}",
        "collaborative": "false",
        "pid": pid,
        "modified_at": 1,
        "num_albums": 1,
        "num_tracks": len(tracks),
        "num_followers": 1,
        "num_edits": 1,
        "duration_ms": 5,
        "num_artists": 1,
        "tracks": tracks,
    }
    return {**base, **extra}


@pytest.fixture(scope="module")
def slices(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    documents = [
        [
            _playlist(2, [_track(0, "t:a", name="second"), _track(1, "t:b")]),
            _playlist(1, [_track(0, "t:b", name="first"), _track(1, "t:b", name="late")]),
        ],
        [
            _playlist(
                3,
                [_track(0, "t:c", artist="z", album="y")],
                collaborative="true",
                description="words",
            ),
            _playlist(4, [], collaborative=None, name=None),
        ],
    ]
    for number, playlists in enumerate(documents):
        with open(os.path.join(folder, f"slice{number}.json"), "w") as out:
            # Written over several lines, as the real slices are.
            json.dump({"info": {"version": "v1"}, "playlists": playlists}, out, indent=1)
    return read_slices(spark, folder)


def test_playlists(slices, rows):
    flat = ingest.flatten_playlists(slices)
    assert rows(flat, "pid", "collaborative", "description", "num_tracks") == sorted(
        [(1, False, None, 2), (2, False, None, 2), (3, True, "words", 1), (4, None, None, 0)],
        key=repr,
    )
    assert "tracks" not in ingest.drop_nested(flat).columns


def test_interactions_keep_repeats(slices, rows):
    found = ingest.flatten_interactions(ingest.flatten_playlists(slices))
    assert rows(found) == [
        (1, "t:b", 0),
        (1, "t:b", 1),
        (2, "t:a", 0),
        (2, "t:b", 1),
        (3, "t:c", 0),
    ]


def test_tracks_take_the_lowest_appearance(slices, rows):
    tracks = ingest.flatten_tracks(ingest.flatten_playlists(slices))
    assert rows(tracks, "track_uri", "track_name") == [
        ("t:a", "second"),
        ("t:b", "first"),
        ("t:c", "n"),
    ]


def test_validate_counts(spark, slices, rows):
    playlists = ingest.flatten_playlists(slices)
    actual = ingest.table_counts(
        playlists, ingest.flatten_tracks(playlists), ingest.flatten_interactions(playlists)
    )
    expected = spark.createDataFrame(
        [
            ("playlists", 4.0),
            ("total_tracks", 5.0),
            ("unique_tracks", 3.0),
            ("unique_artists", 2.0),
            ("unique_albums", 9.0),
            ("avg_playlist_length", 1.2504),
        ],
        "name string, expected double",
    )
    checked = ingest.validate_counts(actual, expected)
    assert dict(rows(checked, "name", "ok")) == {
        "playlists": True,
        "total_tracks": True,
        "unique_tracks": True,
        "unique_artists": True,
        "unique_albums": False,
        "avg_playlist_length": True,
    }


def test_requests(spark, rows):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    playlists = [
        {"pid": 7, "num_samples": 2, "name": "x", "tracks": [{"track_uri": "b"}, {"track_uri": "a"}]},
        {"pid": 8, "num_samples": 0, "tracks": []},
    ]
    with open(os.path.join(folder, "requests.json"), "w") as out:
        json.dump({"playlists": playlists}, out, indent=2)
    requests = read_requests(spark, folder)
    assert rows(requests) == [(7, "x", 2, ["b", "a"]), (8, None, 0, [])]
    assert rows(request_seeds(requests)) == [(7, 0, "b"), (7, 1, "a")]


def test_write_table_and_views(spark, rows):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = spark.range(100).withColumn("x", F.col("id") % 3)
    storage.write_table(df, f"{folder}/t", files=3)
    assert len([f for f in os.listdir(f"{folder}/t") if f.endswith(".parquet")]) == 3
    storage.write_table(df.limit(10), f"{folder}/t")
    again = storage.read_table(spark, folder, "t")
    assert again.count() == 10
    storage.register_views({"t_view": again})
    assert spark.sql("SELECT count(*) FROM t_view WHERE x = 0").first()[0] == 4
    users = storage.literal_queries(spark, [(0,), (5,)], "user_id int")
    assert rows(users) == [(0,), (5,)]


def test_staged_tables_lie_in_the_folder_of_the_session(spark, rows):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = storage.stage(spark.range(5), "five")
    assert rows(staged) == [(i,) for i in range(5)]
    assert folder in staged.inputFiles()[0]
