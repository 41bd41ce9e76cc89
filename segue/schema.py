"""Explicit schemas of the JSON inputs and of the tables between the steps."""

from pyspark.sql import types as T

TRACK_ENTRY = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("track_uri", T.StringType()),
        T.StructField("artist_uri", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("album_uri", T.StringType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("album_name", T.StringType()),
    ]
)

# pid is wider than in the reference data (a 64-bit key) so that the same
# schema serves collections beyond the 32-bit range.
PLAYLIST_ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("collaborative", T.StringType()),
        T.StructField("pid", T.LongType()),
        T.StructField("modified_at", T.IntegerType()),
        T.StructField("num_albums", T.IntegerType()),
        T.StructField("num_tracks", T.IntegerType()),
        T.StructField("num_followers", T.IntegerType()),
        T.StructField("num_edits", T.IntegerType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("num_artists", T.IntegerType()),
        T.StructField("description", T.StringType()),
        T.StructField("tracks", T.ArrayType(TRACK_ENTRY)),
    ]
)

SLICE = T.StructType(
    [
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("generated_on", T.StringType()),
                    T.StructField("slice", T.StringType()),
                    T.StructField("version", T.StringType()),
                ]
            ),
        ),
        T.StructField("playlists", T.ArrayType(PLAYLIST_ENTRY)),
    ]
)

REQUEST_FILE = T.StructType(
    [
        T.StructField(
            "playlists",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("pid", T.LongType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("num_samples", T.IntegerType()),
                        T.StructField(
                            "tracks",
                            T.ArrayType(
                                T.StructType(
                                    [T.StructField("track_uri", T.StringType())]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

PLAYLIST_COLUMNS = [
    "pid",
    "name",
    "description",
    "collaborative",
    "modified_at",
    "num_tracks",
    "num_albums",
    "num_artists",
    "num_followers",
    "num_edits",
    "duration_ms",
]

TRACK_COLUMNS = [
    "track_uri",
    "track_name",
    "artist_uri",
    "artist_name",
    "album_uri",
    "album_name",
    "duration_ms",
]
