"""ALS and Word2Vec through MLlib, and their factors as tables."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.functions import tiles
from segue.functions.vectors import is_nonzero, l2_norm
from segue.operators import skipgram
from segue.operators.blocks import top_by_product
from segue.operators.joins import lookup_join, spread_join
from segue.operators.ranking import dense_index
from segue.operators.scoring import VECTOR_ROWS, recommend
from segue.operators.split import SEQUENCE_LENGTH, sequences
from segue.sources.storage import scratch_path, set_checkpoint_dir, stage

# The hyperparameters of the two models.
ALS_PARAMS = {
    "rank": 64,
    "maxIter": 10,
    "regParam": 0.1,
    "alpha": 1.0,
    "implicitPrefs": True,
    "coldStartStrategy": "drop",
    "seed": 42,
}
WORD2VEC_PARAMS = {
    "vectorSize": 128,
    "windowSize": 5,
    "minCount": 5,
    "maxSentenceLength": SEQUENCE_LENGTH,
    "maxIter": 5,
    "numPartitions": 8,
    "seed": 42,
}
# als_residuals: users of a task, vectors of a packed block, ratings of a user beyond one task.
GROUP_USERS = 150_000
VECTOR_BLOCK = 4_096
HOT_RATINGS = 1_000_000


def track_id_map(train: DataFrame) -> DataFrame:
    """(track_uri, track_id): dense numbers in URI order."""
    items = train.select("track_uri").distinct()
    return dense_index(items, [F.col("track_uri")], "track_id")


def user_id_map(train: DataFrame) -> DataFrame:
    """(pid, user_id): dense numbers of the collections, in the order of pid.

    MLlib takes 32-bit ids. Collections are counted, not pids, so any pid will
    do as long as there are fewer than 2^31 collections.
    """
    return dense_index(train.select("pid").distinct(), [F.col("pid")], "user_id")


def als_input(
    train: DataFrame,
    id_map: DataFrame,
    baseline: DataFrame | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """(user_id, item_id, rating): every appearance counts as 1.0.

    MLlib takes 32-bit ids; the casts fail loudly beyond that range. ``users`` (a
    stored user_id_map) gives the user ids; without it they are the pids. The counts
    of ``baseline``, if given, tell which items are hot.
    """
    counts = baseline
    if baseline is not None:
        counts = baseline.select("track_uri", F.col("playlist_count").alias("n"))
    rows = train.select("pid", "track_uri")
    rows = lookup_join(rows, id_map, "track_uri", counts=counts)
    if users is not None:
        rows = lookup_join(rows, users, "pid")
    return rows.select(
        F.col("pid" if users is None else "user_id").cast("int").alias("user_id"),
        F.col("track_id").cast("int").alias("item_id"),
        F.lit(1.0).cast("float").alias("rating"),
    )


def fit_als(ratings: DataFrame, **overrides) -> ALSModel:
    """MLlib's ALS. The item vectors are checkpointed in every iteration, so that the
    shuffle files of the ones before are removed; by default all ten iterations
    keep theirs, up to blocks times the vectors of either side each.

    A fitted model keeps its vectors in the executors' storage, and the last iteration's
    shuffle files for as long as it lives. It is stored, and the model returned reads them
    from there.
    """
    spark = ratings.sparkSession
    params = {**ALS_PARAMS, "checkpointInterval": 1, **overrides}
    set_checkpoint_dir(spark)
    als = ALS(userCol="user_id", itemCol="item_id", ratingCol="rating", **params)
    path = scratch_path(spark, "als")
    als.fit(ratings).write().save(path)
    # Nothing refers to the fitted model any more; Spark's cleaner sees that after a collection.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return ALSModel.load(path)


def als_recommend(
    model: ALSModel,
    users: DataFrame,
    n: int,
    id_map: DataFrame,
    tracks: DataFrame,
) -> DataFrame:
    """Top ``n`` items of the given users with names, in order of rank.

    The vectors meet in packed blocks, and blocks of items that cannot add to a
    user's list are skipped (top_by_product); MLlib would multiply every user by
    every item. Equal scores are ordered by URI. Users without a vector have no
    list. Items a user already has are not left out; see als_recommend_unseen.
    """
    vectors = model.userFactors.select(F.col("id").alias("user_id"), "features")
    asked = users.select(F.col("user_id").cast("int").alias("user_id")).distinct()
    items = model.itemFactors.select(F.col("id").alias("item_id"), "features")
    listed = top_by_product(vectors.join(asked, "user_id"), items, n).select(
        F.col("user_id").cast("int").alias("user_id"),
        "rank",
        F.col("item_id").alias("track_id"),
        F.col("score").cast("float").alias("als_score"),
    )
    labels = tracks.select("track_uri", "track_name", "artist_name")
    named = lookup_join(listed, id_map.join(labels, "track_uri"), "track_id")
    return named.select(
        "user_id", "rank", "track_uri", "track_name", "artist_name", "als_score"
    ).orderBy("user_id", "rank")


def als_recommend_unseen(
    model: ALSModel, users: DataFrame, n: int, id_map: DataFrame, seen: DataFrame
) -> DataFrame:
    """(user_id, track_uri, score, rank): top ``n`` without the ``seen`` items.

    Uses the learned user vectors as queries of the general scoring, which keeps
    as many more items per user as that user has seen.
    """
    items = stage(
        als_item_vectors(model, id_map).select(
            "track_uri",
            F.lit(0).cast("bigint").alias("playlist_count"),
            F.lit(0.0).alias("popularity"),
            F.col("features").alias("als"),
            F.lit(None).cast("array<float>").alias("word"),
            F.lit(None).cast("double").alias("word_norm"),
        ),
        "als_items",
    )
    vectors = als_user_vectors(model).withColumnRenamed("pid", "user_id")
    queries = users.select(F.col("user_id").cast("bigint").alias("user_id")).join(
        vectors, "user_id"
    )
    rows = queries.select(
        "user_id",
        F.lit(0.0).alias("weight"),
        F.col("features").cast("array<double>").alias("als_q"),
        F.lit(None).cast("array<double>").alias("word_q"),
        F.lit(0.0).alias("shift"),
    )
    return recommend(items, rows, seen, ["user_id"], n)


def word2vec_input(train: DataFrame, min_count: int = WORD2VEC_PARAMS["minCount"]) -> DataFrame:
    """Sequences of (pid, track_uri, pos) from which training gets the same vectors as
    from whole playlists: rare items are gone, and parts end where MLlib would cut."""
    return sequences(train, min_count=min_count, part_length=SEQUENCE_LENGTH)


def count_histogram(track_sequences: DataFrame) -> DataFrame:
    """(n, items): how many items appear n times in all sequences."""
    counts = track_sequences.select(F.explode("track_sequence").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return counts.groupBy("n").agg(F.count("*").alias("items"))


def smallest_min_count(histogram: DataFrame, most: int, least: int = 1) -> DataFrame:
    """(min_count, vocabulary): the smallest ``min_count`` that leaves at most ``most`` items.

    ``histogram`` (n, items) has at most sqrt(2 rows) rows, as n different counts sum
    to more than n^2 / 2, so one window task holds it. ``min_count`` is at least
    ``least``, and ``vocabulary`` the number of items that are left.
    """
    rising = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0)
    reached = histogram.withColumn("from_n", F.sum("items").over(rising))
    too_many = F.max(F.when(F.col("from_n") > most, F.col("n")))
    chosen = reached.agg(F.greatest(F.lit(least), F.coalesce(too_many, F.lit(0)) + 1).cast("bigint").alias("min_count"))
    kept = histogram.join(F.broadcast(chosen), F.col("n") >= F.col("min_count"))
    left = kept.agg(F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("vocabulary"))
    return chosen.select("min_count", left.scalar().alias("vocabulary"))


def word2vec_bytes(vocabulary: int, vector_size: int) -> int:
    """Driver memory of MLlib's training: both layers, and about 200 bytes a word."""
    return vocabulary * (2 * 4 * vector_size + 200)


def _collected_bytes(spark: SparkSession) -> int:
    """What MLlib may collect after an iteration: ``spark.driver.maxResultSize``, 0 being no limit."""
    allowed = spark.sparkContext.getConf().get("spark.driver.maxResultSize", "1g")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(allowed) or 1 << 62


def fit_word2vec(
    track_sequences: DataFrame, max_driver_bytes: int | None = None, **overrides
) -> Word2VecModel | skipgram.WordVectors:
    """Item vectors from ordered sequences (``word2vec_input``).

    Sequences in parts must come without the items below ``minCount``, otherwise
    MLlib would cut elsewhere. MLlib keeps the vocabulary times the vector size on
    the driver. That is estimated first, and above half of the driver's heap or what
    the driver may collect, both layers are trained as tables (skipgram). With
    ``max_driver_bytes``, training is refused above it instead, with the ``minCount``
    that would fit.
    """
    params = {**WORD2VEC_PARAMS, **overrides}
    spark = track_sequences.sparkSession
    refuse = max_driver_bytes is not None
    if not refuse:
        heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
        max_driver_bytes = min(heap // 2, _collected_bytes(spark))
    size, least = params["vectorSize"], params["minCount"]
    # MLlib indexes all numbers of a layer by 32 bits.
    most = min(max_driver_bytes // word2vec_bytes(1, size), ((1 << 31) - 1) // size)
    histogram = stage(count_histogram(track_sequences), "word-counts")
    held = histogram.filter(F.col("n") >= least).agg(F.coalesce(F.sum("items"), F.lit(0))).first()[0]
    if held > most and refuse:
        fitting = smallest_min_count(histogram, most, least).first()
        raise ValueError(
            f"{held} items of {size} numbers take {word2vec_bytes(held, size)} bytes on the driver, "
            f"the limit is {max_driver_bytes}; minCount={fitting.min_count} leaves {fitting.vocabulary} items"
        )
    if held > most:
        return skipgram.train(track_sequences, **params)
    word2vec = Word2Vec(
        inputCol="track_sequence", outputCol="track_embedding", **params
    )
    return word2vec.fit(track_sequences.select("track_sequence"))


def als_item_vectors(model: ALSModel, id_map: DataFrame) -> DataFrame:
    """(track_uri, features) of the ALS items."""
    factors = model.itemFactors.select(
        F.col("id").cast("bigint").alias("track_id"), "features"
    )
    return factors.join(id_map, "track_id").select("track_uri", "features")


def als_user_vectors(model: ALSModel, users: DataFrame | None = None) -> DataFrame:
    """(pid, features) of the ALS users; ``users`` as in als_input."""
    factors = model.userFactors.select(F.col("id").cast("bigint").alias("user_id"), "features")
    if users is None:
        return factors.withColumnRenamed("user_id", "pid")
    return factors.join(users, "user_id").select("pid", "features")


def als_residuals(model: ALSModel, ratings: DataFrame, reg: float, alpha: float) -> DataFrame:
    """(user_id, ratings, residual): how well each user vector solves its equations.

    With the item vectors y, a user with ratings r of n items minimises the
    weighted squares of implicit feedback where

        (sum over all items of y y' + sum over its own of alpha r y y' + reg n) x
            = sum over its own of (1 + alpha r) y

    ``residual`` is the length of the difference of both sides over that of the right
    one. MLlib solves for the users last, so a fitted model leaves little but the
    rounding of 32-bit vectors.

    The matrix of all items is summed up per task and reaches the driver as
    rank x rank numbers. What a user's own items add is a multiple of each y. A task sums that
    up for a group of users while packed blocks of items pass it, each followed by the
    ratings of its items, so ratings are shuffled without any vector. Users with more than
    ``HOT_RATINGS`` are summed up before a shuffle instead, so none of them is a single task.
    """
    items = stage(
        model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("y")), "item-vectors"
    )
    people = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("x"))
    rank = model.rank

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().astype(np.float64).reshape(-1, rank)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rank)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"]
        )

    sums = items.select("y").mapInArrow(add_up, "i bigint, row array<double>")
    sums = sums.groupBy("i").agg(Summarizer.sum(array_to_vector("row")).alias("row")).collect()
    gram = np.array([r.row.toArray() for r in sorted(sums, key=lambda r: r.i)]).reshape(rank, rank)

    counts = stage(ratings.groupBy("user_id").agg(F.count("*").alias("n")), "rating-counts")
    hot = stage(counts.filter(F.col("n") > HOT_RATINGS).select("user_id"), "hot-users")
    if hot.isEmpty():
        return _grouped_residuals(items, people, ratings, gram, reg, alpha)
    some = _spread_residuals(items, lookup_join(people, hot, "user_id", "left_semi"), lookup_join(ratings, hot, "user_id", "left_semi"), gram, reg, alpha)
    rest = lookup_join(ratings, hot, "user_id", "left_anti")
    return _grouped_residuals(items, people, rest, gram, reg, alpha).unionByName(some)


def _grouped_residuals(
    items: DataFrame, people: DataFrame, ratings: DataFrame, gram: np.ndarray, reg: float, alpha: float
) -> DataFrame:
    """als_residuals, a group of users to a task, past which the blocks of items are led."""
    workers = items.sparkSession.sparkContext.defaultParallelism
    number = people.count()
    groups = max(-(-number // GROUP_USERS), min(workers, -(-number // 1_024)), 1)
    blocks = -(-items.count() // VECTOR_BLOCK) or 1
    group = F.pmod(F.xxhash64(F.col("user_id").cast("bigint")), F.lit(groups)).cast("int")
    block = F.pmod(F.xxhash64(F.col("item_id").cast("bigint")), F.lit(blocks)).cast("int")

    def packed(rows: DataFrame, number: Column, key: str, vector: str) -> DataFrame:
        keyed = rows.select(number.alias("block"), F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
        return keyed.groupBy("block").applyInArrow(tiles.pack_vectors, "block int, ids binary, vectors binary")

    def row(kind: int, group: Column, block: Column, **given: Column) -> list[Column]:
        none = {"user": "bigint", "item": "bigint", "rating": "double", "ids": "binary", "vectors": "binary"}
        return [group.alias("group"), block.cast("int").alias("block"), F.lit(kind).alias("kind")] + [
            given.get(name, F.lit(None)).cast(of).alias(name) for name, of in none.items()
        ]

    own = F.col("ids"), F.col("vectors")
    # Blocks of users are small, so that several tasks pack those of a group.
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("user_id")), F.lit(-(-number // (groups * VECTOR_BLOCK)) or 1))
    users = packed(people, (group + groups * part).cast("int"), "user_id", "x")
    users = users.select(*row(0, F.pmod("block", F.lit(groups)), F.lit(-1), ids=own[0], vectors=own[1]))
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    shown = packed(items, block, "item_id", "y").withColumn("group", each)
    shown = shown.select(*row(1, F.col("group"), F.col("block"), ids=own[0], vectors=own[1]))
    rated = ratings.select(*row(2, group, block, user=F.col("user_id"), item=F.col("item_id"), rating=F.col("rating")))
    dealt = users.unionByName(shown).unionByName(rated).repartitionById(groups, F.col("group"))
    ordered = dealt.sortWithinPartitions("group", "block", "kind")
    kind = people.schema["user_id"].dataType.simpleString()
    sums = ordered.mapInArrow(tiles.residual_kernel(gram, reg, alpha), "user_id bigint, ratings bigint, residual double")
    return sums.select(F.col("user_id").cast(kind).alias("user_id"), "ratings", "residual")


def _spread_residuals(
    items: DataFrame, people: DataFrame, ratings: DataFrame, gram: np.ndarray, reg: float, alpha: float
) -> DataFrame:
    """als_residuals of users with very many ratings."""
    rank = len(gram)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().astype(np.float64).reshape(-1, rank)
            products = pa.array(list(rows @ gram), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, products], ["user_id", "x", "of_all"])

    folded = ratings.groupBy("user_id", "item_id", "rating").agg(F.count("*").alias("m"))
    own = lookup_join(folded, items, "item_id", limit=VECTOR_ROWS)
    own = spread_join(own, people, "user_id")
    more = F.col("rating") * F.lit(alpha)
    product = _dot(F.col("x"), F.col("y"))
    times = lambda column: array_to_vector(F.transform("y", lambda v: v.cast("double") * column))
    parts = own.groupBy("user_id").agg(
        F.sum("m").alias("ratings"),
        vector_to_array(Summarizer.sum(times(F.col("m") * (more * product - more - 1)))).alias("left"),
        vector_to_array(Summarizer.sum(times(F.col("m") * (more + 1)))).alias("right"),
    )
    both = parts.join(people.mapInArrow(multiply, "user_id int, x array<float>, of_all array<double>"), "user_id")
    own_share = F.zip_with("left", "x", lambda v, x: v + F.col("ratings") * F.lit(reg) * x)
    return both.withColumn("gap", F.zip_with("of_all", own_share, lambda v, w: v + w)).select(
        "user_id", "ratings", (l2_norm(F.col("gap")) / l2_norm(F.col("right"))).alias("residual")
    )


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def word_vectors(model: Word2VecModel | skipgram.WordVectors) -> DataFrame:
    """(track_uri, features) of the Word2Vec vocabulary."""
    return model.getVectors().select(
        F.col("word").alias("track_uri"),
        vector_to_array("vector", "float32").alias("features"),
    )


def find_item(tracks: DataFrame, track_name: str, artist_name: str) -> str | None:
    """URI of the item with this name; the smallest one if there are several."""
    row = (
        tracks.filter(F.col("track_name") == track_name)
        .filter(F.col("artist_name") == artist_name)
        .agg(F.min("track_uri").alias("track_uri"))
        .first()
    )
    return row.track_uri


def similar_items(
    vectors: DataFrame,
    track_uri: str,
    n: int = 10,
    tracks: DataFrame | None = None,
    fallback_name: tuple[str, str] | None = None,
) -> DataFrame:
    """Items nearest to one item by cosine, the item itself left out.

    Only the vector of the asked item is fetched; the vectors are compared where
    they lie. ``fallback_name`` (track, artist) is looked up in ``tracks`` when
    the URI has no vector.
    """
    query = vectors.filter(F.col("track_uri") == track_uri).first()
    if query is None and fallback_name is not None and tracks is not None:
        found = find_item(tracks, *fallback_name)
        if found is not None:
            track_uri = found
            query = vectors.filter(F.col("track_uri") == track_uri).first()
    if query is None:
        raise ValueError(f"no vector for {track_uri}")
    target = F.array(*[F.lit(float(x)) for x in query.features])
    products = F.zip_with("features", target, lambda x, y: x.cast("double") * y)
    dot = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    nearest = (
        vectors.filter((F.col("track_uri") != track_uri) & is_nonzero(F.col("features")))
        .select(
            "track_uri",
            (dot / (l2_norm(F.col("features")) * l2_norm(target))).alias("similarity"),
        )
        .orderBy(F.desc("similarity"), "track_uri")
        .limit(n)
    )
    if tracks is None:
        return nearest
    labels = tracks.select("track_uri", "track_name", "artist_name")
    return (
        labels.join(F.broadcast(nearest), "track_uri")
        .select("track_uri", "track_name", "artist_name", "similarity")
        .orderBy(F.desc("similarity"), "track_uri")
    )
