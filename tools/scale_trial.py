"""Time the headline operators on many copies of the test tables.

    python tools/scale_trial.py FOLDER [copies] [skew]

Writes ``copies`` renumbered copies of the sf0.1 collections (110 give 66 million
rows, 1.65 million collections and 2.2 million items) to FOLDER unless they are
there, then times the operators on them. With ``skew``, a third of the rows go
to one collection and another third to one item, and tasks that ran much longer
than the others of their stage are listed.
"""

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from segue.operators import counting, models, pairs, profile, split  # noqa: E402
from segue.sources import purchases  # noqa: E402
from segue.sources.storage import stage  # noqa: E402

SOURCE = "/root/testdata/sf0.1"


def copies_of(spark, number, skew):
    numbers = spark.range(number).select(F.col("id").alias("copy"))
    rows = purchases.playlist_tracks(spark, SOURCE).join(F.broadcast(numbers))
    # A third of each collection keeps the common items, the rest spreads.
    spread = F.pmod(F.xxhash64("pid", "pos", "copy"), F.lit(number))
    spread = F.when(F.col("pos") % 3 == 0, 0).otherwise(spread)
    item = F.substring("track_uri", 6, 20).cast("bigint") + spread * 20_000
    draw = F.xxhash64("copy", "pid", "pos")
    pid = F.col("pid") + F.col("copy") * 15_000
    if skew:
        item = F.when(F.pmod(draw, F.lit(3)) == 0, 1).otherwise(item)
        hot = F.pmod(F.shiftright(draw, 9), F.lit(3)) == 0
        # Positions stay unique inside the one large collection.
        pos = F.col("pos") + F.when(hot, pid * 1_000).otherwise(0)
        pid = F.when(hot, 1).otherwise(pid + 2)
    else:
        pos = F.col("pos")
    return rows.select(
        pid.cast("bigint").alias("pid"),
        F.concat(F.lit("item:"), item.cast("string")).alias("track_uri"),
        pos.cast("bigint").alias("pos"),
    )


def track_table(spark, rows):
    base = purchases.tracks(spark, SOURCE).withColumnRenamed("track_uri", "base")
    number = F.substring("track_uri", 6, 20).cast("bigint")
    items = rows.select("track_uri").distinct()
    items = items.withColumn(
        "base", F.concat(F.lit("item:"), ((number - 1) % 20_000 + 1).cast("string"))
    )
    artist = F.concat(
        "artist_name", F.lit("/"), F.pmod(F.xxhash64("track_uri"), F.lit(10_000))
    )
    return (
        items.join(base, "base")
        .withColumn("artist_name", artist)
        .withColumn("artist_uri", F.col("artist_name"))
        .select("track_uri", "track_name", "artist_uri", "artist_name")
    )


def slow_tasks(event_file):
    stages, names = {}, {}
    for line in open(event_file):
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            info = event["Task Info"]
            took = (info["Finish Time"] - info["Launch Time"]) / 1000
            stages.setdefault(event["Stage ID"], []).append(took)
        elif event["Event"] == "SparkListenerJobStart":
            for info in event["Stage Infos"]:
                names[info["Stage ID"]] = event["Properties"].get("spark.job.description")
    for number, times in sorted(stages.items()):
        times.sort()
        middle = times[len(times) // 2]
        if times[-1] > 3 and times[-1] > 3 * middle:
            print(f"slow task in {names.get(number)}: {times[-1]:.1f}s, median {middle:.1f}s")


def main():
    folder = sys.argv[1]
    number = int(sys.argv[2]) if len(sys.argv) > 2 else 110
    skew = "skew" in sys.argv
    events = f"{folder}/events-{int(time.time())}"
    os.makedirs(events)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", 64 << 20)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", events)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    name = f"{folder}/rows-{number}{'-skew' if skew else ''}"
    if not os.path.exists(f"{name}/tracks"):
        copies_of(spark, number, skew).repartition(16).write.parquet(f"{name}/playlist_tracks")
        track_table(spark, spark.read.parquet(f"{name}/playlist_tracks")).write.parquet(
            f"{name}/tracks"
        )
    rows = spark.read.parquet(f"{name}/playlist_tracks")
    tracks = spark.read.parquet(f"{name}/tracks")

    def timed(label, work):
        spark.sparkContext.setJobDescription(label)
        begin = time.time()
        result = work()
        print(f"{label:24s} {time.time() - begin:7.2f}s  {result}", flush=True)

    timed("load, cache, count", lambda: rows.cache().count())
    timed("group by track", lambda: counting.item_counts(rows).count())
    timed("top artists", lambda: len(profile.top_artists(rows, tracks).collect()))
    if not skew:
        # One collection with millions of items has trillions of pairs.
        timed(
            "pairs, 1% sample",
            lambda: pairs.cooccurrence_sampled(rows, 0.01, 2, 42).count(),
        )
    timed("track popularity", lambda: stage(counting.track_popularity(rows), "p").count())
    timed(
        "artist popularity",
        lambda: stage(counting.artist_popularity(rows, tracks), "a").count(),
    )

    def cooccurrence():
        popularity = counting.track_popularity(rows)
        return pairs.cooccurrence(rows, popularity, 2_000, 10).count()

    timed("pairs of top 2,000", cooccurrence)
    timed("dense index", lambda: models.track_id_map(rows).count())
    timed("sequences", lambda: split.sequences(rows).count())
    spark.stop()
    slow_tasks(sorted(glob.glob(f"{events}/*"))[-1])


if __name__ == "__main__":
    main()
