import pathlib
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import models, split
from segue.sources import storage


@pytest.fixture(scope="module")
def train(spark):
    data = [(p, f"t:{(p * 3 + i * (1 + p % 4)) % 40:02d}", i) for p in range(60) for i in range(12)]
    return storage.stage(
        spark.createDataFrame(data, "pid long, track_uri string, pos long"), "train"
    )


@pytest.fixture(scope="module")
def fitted(train):
    id_map = storage.stage(models.track_id_map(train), "ids")
    ratings = storage.stage(models.als_input(train, id_map), "ratings")
    return id_map, models.fit_als(ratings, rank=4, maxIter=2), ratings


def test_every_appearance_is_a_rating(train, fitted):
    _, _, ratings = fitted
    assert ratings.count() == train.count()
    assert ratings.schema["user_id"].dataType.simpleString() == "int"
    assert ratings.filter(F.col("rating") != 1.0).isEmpty()


def test_als_vectors_and_repeatability(fitted):
    id_map, model, ratings = fitted
    vectors = models.als_item_vectors(model, id_map).collect()
    assert len(vectors) == id_map.count() and {len(v.features) for v in vectors} == {4}
    again = models.als_item_vectors(models.fit_als(ratings, rank=4, maxIter=2), id_map)
    first = {v.track_uri: v.features for v in vectors}
    for v in again.collect():
        assert v.features == pytest.approx(first[v.track_uri], abs=1e-4)


def test_als_is_checkpointed_in_every_iteration(spark, fitted):
    """Without it, the shuffle files of all iterations stay until the fit ends."""
    _, _, ratings = fitted
    folder = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("rdd-*"))
    models.fit_als(ratings, rank=3, maxIter=3)
    # Of the three checkpoints, the earlier two are deleted.
    assert len(set(folder.glob("rdd-*")) - before) == 1


def test_als_recommend(spark, train, fitted, rows):
    id_map, model, _ = fitted
    tracks = id_map.select("track_uri", F.lit("n").alias("track_name"), F.lit("a").alias("artist_name"))
    users = storage.literal_queries(spark, [(0,), (1,)], "user_id int")
    got = models.als_recommend(model, users, 5, id_map, tracks).collect()
    assert [(r.user_id, r["rank"]) for r in got] == [(u, k) for u in (0, 1) for k in range(1, 6)]
    for user in (0, 1):
        scores = [r.als_score for r in got if r.user_id == user]
        assert scores == sorted(scores, reverse=True)


def test_unseen_lists_equal_brute_force(spark, train, fitted):
    id_map, model, _ = fitted
    items = {r.track_uri: np.array(r.features, float) for r in models.als_item_vectors(model, id_map).collect()}
    people = {r.pid: np.array(r.features, float) for r in models.als_user_vectors(model).collect()}
    had = {}
    for r in train.collect():
        had.setdefault(r.pid, set()).add(r.track_uri)
    seen = train.select(F.col("pid").alias("user_id"), "track_uri")
    users = spark.createDataFrame([(p,) for p in people], "user_id long")
    got = {}
    for r in models.als_recommend_unseen(model, users, 6, id_map, seen).orderBy("rank").collect():
        got.setdefault(r.user_id, []).append(r.track_uri)
    for pid, vector in people.items():
        order = sorted((u for u in items if u not in had[pid]), key=lambda u: (-(items[u] @ vector), u))
        assert got[pid] == order[:6]


def test_word2vec_drops_rare_items_and_keeps_shape(train):
    rows = split.sequences(train)
    counts = train.groupBy("track_uri").count()
    limit = int(counts.agg(F.percentile("count", 0.5)).first()[0]) + 1
    vectors = models.word_vectors(
        models.fit_word2vec(rows, vectorSize=6, maxIter=1, numPartitions=1, minCount=limit)
    )
    kept = {r.track_uri for r in counts.filter(F.col("count") >= limit).collect()}
    got = vectors.collect()
    assert {r.track_uri for r in got} == kept and {len(r.features) for r in got} == {6}


def test_long_playlists_train_as_whole_ones(spark):
    """1,500 positions with rare items: the parts are what MLlib makes of the whole."""
    data = [(1, f"t{(i * i) % 37}" if i % 5 else f"rare{i}", i) for i in range(1500)]
    train = storage.stage(spark.createDataFrame(data, "pid long, track_uri string, pos long"), "long")
    whole = [r.track_sequence for r in split.sequences(train).collect()]
    assert [len(w) for w in whole] == [1500]
    common = [w for w in whole[0] if not w.startswith("rare")]
    parts = models.word2vec_input(train, 2)
    assert [r.track_sequence for r in parts.orderBy("part").collect()] == [common[:1000], common[1000:]]
    vectors = models.word_vectors(models.fit_word2vec(parts, vectorSize=4, maxIter=1, numPartitions=1, minCount=2))
    assert {r.track_uri for r in vectors.collect()} == set(common)


def test_a_vocabulary_beyond_the_driver_is_refused(spark):
    words = [f"w{i}" for i in range(20) for _ in range(i + 1)]
    rows = spark.createDataFrame([(words,)], "track_sequence array<string>")
    limit = models.word2vec_bytes(7, 10)
    with pytest.raises(ValueError, match="minCount=14 leaves 7 items"):
        models.fit_word2vec(rows, limit, vectorSize=10, minCount=2)
    histogram = models.count_histogram(rows)
    assert tuple(models.smallest_min_count(histogram, 20).first()) == (1, 20)
    assert tuple(models.smallest_min_count(histogram, 0, 3).first()) == (21, 0)


def test_models_survive_saving(spark, train, fitted):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _, model, _ = fitted
    storage.save_model(model, f"{folder}/als")
    assert storage.load_als(f"{folder}/als").itemFactors.count() == model.itemFactors.count()
    w2v = models.fit_word2vec(split.sequences(train), vectorSize=3, maxIter=1, numPartitions=1)
    storage.save_model(w2v, f"{folder}/w2v")
    assert storage.load_word2vec(f"{folder}/w2v").getVectors().count() == w2v.getVectors().count()


def test_similar_items(spark):
    schema = "track_uri string, features array<float>"
    vectors = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [10.0, 1.0]), ("c", [0.0, 3.0]), ("d", [0.0, 0.0]), ("e", [0.0, 1.0])], schema
    )
    tracks = spark.createDataFrame(
        [("a", "A", "x"), ("b", "B", "x"), ("c", "C", "y"), ("e", "E", "y")],
        "track_uri string, track_name string, artist_name string",
    )
    got = models.similar_items(vectors, "a", 3, tracks).collect()
    assert [r.track_uri for r in got] == ["b", "c", "e"]
    assert got[0].similarity == pytest.approx(10 / np.sqrt(101))
    named = models.similar_items(vectors, "gone", 1, tracks, fallback_name=("A", "x")).collect()
    assert [r.track_uri for r in named] == ["b"]
    with pytest.raises(ValueError):
        models.similar_items(vectors, "gone", 1)


def test_residuals_group_by_group(spark, train, fitted, monkeypatch):
    """Groups of users past blocks of items give what a join of all ratings gives."""
    _, model, ratings = fitted
    odd = ratings.union(ratings.limit(40)).filter("user_id > 3 or item_id > 9")
    odd = odd.union(spark.createDataFrame([(7, 9999, 1.0), (8888, 3, 1.0)], "user_id int, item_id int, rating float"))
    odd = storage.stage(odd.withColumn("rating", F.when(F.col("item_id") % 3 == 0, 2.5).otherwise(F.col("rating")).cast("float")), "odd")
    monkeypatch.setattr(models, "GROUP_USERS", 9)
    monkeypatch.setattr(models, "VECTOR_BLOCK", 6)
    joined = []
    monkeypatch.setattr(models, "spread_join", lambda *a, **b: joined.append(a))
    found = {r.user_id: (r.ratings, r.residual) for r in models.als_residuals(model, odd, 0.1, 1.0).collect()}
    # Ratings meet no vector in a join.
    assert not joined
    y = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    x = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    gram = sum(np.outer(v, v) for v in y.values())
    own = {}
    for r in odd.collect():
        if r.user_id in x and r.item_id in y:
            own.setdefault(r.user_id, []).append((r.rating, y[r.item_id]))
    assert set(found) == set(own)
    for user, rows in own.items():
        left = gram + sum(r * np.outer(v, v) for r, v in rows) + 0.1 * len(rows) * np.eye(4)
        right = sum((1 + r) * v for r, v in rows)
        assert found[user][0] == len(rows)
        assert found[user][1] == pytest.approx(np.linalg.norm(left @ x[user] - right) / np.linalg.norm(right), rel=1e-4)
    monkeypatch.undo()
    monkeypatch.setattr(models, "HOT_RATINGS", 12)
    hot = {r.user_id: (r.ratings, r.residual) for r in models.als_residuals(model, odd, 0.1, 1.0).collect()}
    assert {u: n for u, (n, _) in hot.items()} == {u: n for u, (n, _) in found.items()}
    assert all(hot[u][1] == pytest.approx(found[u][1], rel=1e-4, abs=1e-9) for u in found)


def test_a_fitted_model_is_read_from_files(fitted):
    """Else the executors keep its vectors, and the files of the last shuffle, while it lives."""
    _, model, _ = fitted
    for table in (model.userFactors, model.itemFactors):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan and "LogicalRDD" not in plan and "ExternalRDD" not in plan
