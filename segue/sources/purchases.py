"""The star-schema test tables seen as collections of items.

A collection is the purchase history of a customer, an item is a part. The
mapping is described in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.operators.joins import lookup_join
from segue.operators.ranking import group_positions
from segue.schema import PLAYLIST_COLUMNS
from segue.sources.storage import read_table, stage

# Tracks a nested playlist record holds at most. A longer collection is stored
# as several records with the same pid, so that no record is unbounded.
RECORD_TRACKS = 1_000
# Appearances that one task sorts or nests.
TASK_ROWS = 250_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, f"{name}.parquet")


def _uri(part_key):
    return F.concat(F.lit("item:"), F.col(part_key).cast("string"))


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("pid"),
        "o_orderdate",
    )
    return _table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks among which all appearances are dealt, so that none gets more as they grow."""
    appearances = _table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, min(appearances // TASK_ROWS + 1, 20_000))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, track_uri) per appearance, for work that needs no positions."""
    return _purchases(spark, sf_dir).select("pid", _uri("l_partkey").alias("track_uri"))


def playlist_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, track_uri, pos): appearances numbered in time order."""
    order = [
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    ]
    rows = _purchases(spark, sf_dir).select(
        "pid", F.to_date("o_orderdate").alias("day"), *order
    )
    return group_positions(rows, ["pid"], "day", order, "pos", _tasks(spark, sf_dir)).select(
        "pid", _uri("l_partkey").alias("track_uri"), "pos"
    )


def nation_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, track_uri, pos) with one collection per nation, numbered in time order."""
    order = [
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    ]
    nations = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pid"), F.col("c_nationkey").cast("bigint").alias("nation")
    )
    rows = (
        _purchases(spark, sf_dir)
        .join(nations, "pid")
        .select(F.col("nation").alias("pid"), F.to_date("o_orderdate").alias("day"), *order)
    )
    return group_positions(rows, ["pid"], "day", order, "pos", _tasks(spark, sf_dir)).select(
        "pid", _uri("l_partkey").alias("track_uri"), "pos"
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item with its attributes."""
    return _table(spark, sf_dir, "part").select(
        _uri("p_partkey").alias("track_uri"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist_uri"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("album_uri"),
        F.col("p_type").alias("album_name"),
        (F.col("p_size") * 1000).alias("duration_ms"),
    )


def lengths(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """(pid, num_tracks); ``rows`` as in playlists."""
    if rows is None:
        rows = interactions(spark, sf_dir)
    return rows.groupBy("pid").agg(F.count("*").cast("int").alias("num_tracks"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pid"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("name"),
        F.when(F.col("c_acctbal") >= 5000, F.col("c_name")).alias("description"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("true"))
        .otherwise(F.lit("false"))
        .alias("collaborative"),
        (F.col("c_custkey") % 97 + 1).cast("int").alias("num_followers"),
    )


def headers(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Length and customer-side attributes of every collection that has rows.

    ``rows`` as in playlists.
    """
    return lengths(spark, sf_dir, rows).join(_customers(spark, sf_dir), "pid")


def playlists(
    spark: SparkSession, sf_dir: str, rows: DataFrame | None = None
) -> DataFrame:
    """All header columns, ``collaborative`` still as text.

    ``rows`` are the interactions, when the caller has them written already.
    """
    if rows is None:
        rows = interactions(spark, sf_dir)
    last_orders = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("pid"))
        .agg(
            F.unix_seconds(F.max("o_orderdate").cast("timestamp"))
            .cast("int")
            .alias("modified_at"),
            F.count("*").cast("int").alias("num_edits"),
        )
    )
    items = lookup_join(
        rows.select("pid", "track_uri"),
        tracks(spark, sf_dir).select("track_uri", "artist_uri", "album_uri", "duration_ms"),
        "track_uri",
    )
    # Dealt by pid once, the distinct counts of both attributes need no other shuffle.
    details = (
        items.drop("track_uri")
        .repartition(_tasks(spark, sf_dir), "pid")
        .groupBy("pid")
        .agg(
            F.countDistinct("album_uri").cast("int").alias("num_albums"),
            F.countDistinct("artist_uri").cast("int").alias("num_artists"),
            F.count("*").cast("int").alias("num_tracks"),
            F.sum("duration_ms").cast("bigint").alias("duration_ms"),
        )
    )
    return (
        details.join(last_orders, "pid")
        .join(_customers(spark, sf_dir), "pid")
        .select(*PLAYLIST_COLUMNS)
    )


def slices(
    spark: SparkSession, sf_dir: str, playlists_per_slice: int = 1_000, by: Column | None = None
) -> DataFrame:
    """The same data nested as slice documents, the shape the JSON reader expects.

    Records hold at most RECORD_TRACKS consecutive tracks and slices about
    ``playlists_per_slice`` records, or the records of one value of ``by``, a number
    that follows from pid. Tracks and headers are dealt by slice together,
    and nested there: the nested records are never shuffled.
    """
    rows = stage(playlist_tracks(spark, sf_dir), "playlist_tracks")
    appearances = _table(spark, sf_dir, "lineitem").count()
    customers = _table(spark, sf_dir, "customer").count()
    at_most = customers + appearances // RECORD_TRACKS
    number = -(-at_most // playlists_per_slice) or 1
    part = F.floor(F.col("pos") / RECORD_TRACKS).alias("part")
    slice_of = (F.pmod(F.xxhash64("pid", "part"), F.lit(number)) if by is None else by).alias("slice")
    track = F.struct(
        F.col("pos").cast("int").alias("pos"),
        "artist_name",
        "track_uri",
        "artist_uri",
        "track_name",
        "album_uri",
        "duration_ms",
        "album_name",
    )
    entries = lookup_join(rows, tracks(spark, sf_dir), "track_uri").select("pid", part, track.alias("track"))
    heads = playlists(spark, sf_dir, rows).withColumn("head", F.struct(*PLAYLIST_COLUMNS))
    # One header per record; a header has no track and a track no header.
    headed = rows.select("pid", part).distinct().join(heads.select("pid", "head"), "pid")
    both = entries.select(slice_of, "pid", "part", "track").unionByName(
        headed.select(slice_of, "pid", "part", "head"), allowMissingColumns=True
    )
    records = (
        both.repartition(_tasks(spark, sf_dir), "slice")
        .groupBy("slice", "pid", "part")
        .agg(F.array_sort(F.collect_list("track")).alias("tracks"), F.collect_list("head").alias("heads"))
        .filter(F.size("tracks") > 0)
        .withColumn("head", F.explode("heads"))
    )
    fields = [
        "name",
        "collaborative",
        "pid",
        "modified_at",
        "num_albums",
        "num_tracks",
        "num_followers",
        "num_edits",
        "duration_ms",
        "num_artists",
        "description",
    ]
    playlist = F.struct(*[F.col(f"head.{name}").alias(name) for name in fields], "tracks")
    return (
        records.select("slice", playlist.alias("playlist"))
        .groupBy("slice")
        .agg(F.collect_list("playlist").alias("playlists"))
        .select(
            F.struct(
                F.lit("test").alias("generated_on"),
                F.col("slice").cast("string").alias("slice"),
                F.lit("v1").alias("version"),
            ).alias("info"),
            "playlists",
        )
    )


def write_slices(documents: DataFrame, path: str) -> None:
    """One JSON object per file, as the slice reader expects, compressed."""
    documents.write.option("maxRecordsPerFile", 1).option("compression", "gzip").json(path)


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(track_uri, features): the given embeddings as item vectors."""
    return _table(spark, sf_dir, "embeddings").select(
        _uri("vec_id").alias("track_uri"), F.col("embedding").alias("features")
    )


