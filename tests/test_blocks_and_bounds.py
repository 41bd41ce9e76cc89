"""Packed blocks of vectors, and the pruning before pair counts, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import blocks, models, pairs
from segue.sources.storage import literal_queries, stage


def brute_force(users, items, n):
    found = {}
    for user, x in users:
        scores = [(-float((np.array(y, float) * np.array(x, float)).sum()), key) for key, y in items]
        found[user] = [(key, -s) for s, key in sorted(scores)[:n]]
    return found


def lists(df):
    got = {}
    for r in df.orderBy("rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    return got


@pytest.mark.parametrize("kind", ["falling", "equal", "negative", "few"])
def test_top_by_product(spark, kind):
    draw = np.random.default_rng(3)
    items = draw.normal(size=(150, 6))
    if kind == "falling":
        items *= (0.9 ** np.arange(150))[:, None]
    elif kind == "equal":
        items[::3] = items[0]
    elif kind == "negative":
        items = -np.abs(items)
    elif kind == "few":
        items = items[:3]
    people = np.abs(draw.normal(size=(70, 6)))
    people[5] = 0
    items = [(i, [float(v) for v in row]) for i, row in enumerate(items)]
    people = [(u, [float(v) for v in row]) for u, row in enumerate(people)]
    schema = "features array<double>"
    frame = spark.createDataFrame(items + [(999, None)], f"item_id long, {schema}")
    users = spark.createDataFrame(people + [(999, None)], f"user_id long, {schema}")
    got = lists(blocks.top_by_product(users, frame, 7, item_block=10, user_block=8))
    want = brute_force(people, items, 7)
    assert {u: [k for k, _ in v] for u, v in got.items()} == {u: [k for k, _ in v] for u, v in want.items()}
    for user, rows in got.items():
        assert [s for _, s in rows] == pytest.approx([s for _, s in want[user]])
    assert blocks.top_by_product(users.limit(0), frame, 7).count() == 0
    assert blocks.top_by_product(users, frame.limit(0), 7).count() == 0


def test_blocks_of_short_items_are_skipped(spark):
    """With falling lengths nearly all users stop after the first blocks."""
    draw = np.random.default_rng(4)
    items = draw.normal(size=(400, 6)) * (0.97 ** np.arange(400))[:, None]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(items)]
    packed = blocks.pack_items(spark.createDataFrame(rows, "item_id long, features array<double>"), 10)
    bounds = [r.longest for r in packed.orderBy("block").collect()]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) == 40
    users = spark.createDataFrame([(u, [float(v) for v in draw.normal(size=6)]) for u in range(50)], "user_id long, features array<double>")
    first = packed.filter("block = 0").first().asDict()
    reach = [r.reach for r in blocks.first_lists(users, first, bounds, 5).collect()]
    assert sum(reach) < 50 * 40 / 2


def test_no_cartesian_product(spark):
    data = [(p, f"t:{(p * 3 + i) % 40:02d}") for p in range(30) for i in range(12)]
    train = stage(spark.createDataFrame(data, "pid long, track_uri string"), "train")
    ids = stage(models.track_id_map(train), "ids")
    model = models.fit_als(models.als_input(train, ids), rank=4, maxIter=2)
    tracks = ids.select("track_uri", F.lit("n").alias("track_name"), F.lit("a").alias("artist_name"))
    got = models.als_recommend(model, literal_queries(spark, [(0,), (5,)], "user_id int"), 4, ids, tracks)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Join Cross" not in plan
    items = [(r.id, r.features) for r in model.itemFactors.collect()]
    people = [(r.id, r.features) for r in model.userFactors.collect() if r.id in (0, 5)]
    names = {r.track_id: r.track_uri for r in ids.collect()}
    want = {u: [names[k] for k, _ in v] for u, v in brute_force(people, items, 4).items()}
    found = {}
    for r in got.collect():
        found.setdefault(r.user_id, []).append(r.track_uri)
    assert found == want


def plain_counts(rows, least):
    times = {}
    for pid, item in rows:
        times.setdefault(pid, Counter())[item] += 1
    counts = Counter()
    for own in times.values():
        for a in own:
            for b in own:
                if a < b:
                    counts[a, b] += own[a] * own[b]
    return sorted((a, b, n) for (a, b), n in counts.items() if n >= least)


@pytest.mark.parametrize("least", [2, 3, 6])
def test_pruned_pairs_are_whole(spark, rows, least):
    draw = random.Random(least)
    data = []
    for pid in range(40):
        for _ in range(draw.randint(1, 12)):
            item = draw.randrange(8) if draw.random() < 0.4 else 10 + pid * 20 + draw.randrange(20)
            data += [(pid, f"i{item}")] * draw.choice([1] * 90 + [2, 3])
    frame = spark.createDataFrame(data, "pid long, track_uri string")
    assert rows(pairs.pair_counts(frame, least)) == plain_counts(data, least)
    assert rows(pairs.pair_counts(frame, least, chunk=3)) == plain_counts(data, least)
    folded = stage(frame.groupBy("pid", "track_uri").agg(F.count("*").alias("m")), "folded")
    joined = lambda f: f.alias("x").join(f.alias("y"), "pid").filter("x.track_uri < y.track_uri").count()
    assert joined(pairs.supported(folded, least)) < joined(folded) * 0.8
    for r in pairs.support_bounds(folded).collect():
        best = max((n for a, b, n in plain_counts(data, 1) if r.track_uri in (a, b)), default=0)
        assert r.bound >= best


def test_users_are_spread_by_number(spark, monkeypatch):
    """Few bytes of users are many products: they do not follow the size of files."""
    monkeypatch.setattr(blocks, "FIRST_USERS", 10)
    users = spark.createDataFrame([(u, [float(u % 7), 1.0]) for u in range(100)], "user_id long, features array<double>").coalesce(1)
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "item_id long, features array<double>")
    first = blocks.pack_items(items).first().asDict()
    lists = blocks.first_lists(users, first, [first["longest"]], 2)
    assert lists.rdd.getNumPartitions() == 10 and lists.count() == 100
    assert blocks.top_by_product(users, items, 2).count() == 200


def test_item_blocks_pass_groups_of_users(spark, monkeypatch):
    """A block of users goes to one task, not to one for each block of items."""
    draw = np.random.default_rng(6)
    items = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(draw.normal(size=(300, 5)))]
    people = [(u, [float(np.float32(v)) for v in row]) for u, row in enumerate(draw.normal(size=(90, 5)))]
    items[7] = items[130] = (items[7][0], items[200][1])
    items[130] = (130, items[200][1])
    frame = stage(spark.createDataFrame(items, "item_id long, features array<float>"), "items")
    users = stage(spark.createDataFrame(people, "user_id long, features array<float>"), "users")
    monkeypatch.setattr(blocks, "GROUP_USERS", 30)
    further = []
    whole = blocks._further_lists
    monkeypatch.setattr(blocks, "_further_lists", lambda *a: further.append(whole(*a)) or further[-1])
    got = lists(blocks.top_by_product(users, frame, 6, item_block=10, user_block=8))
    want = brute_force(people, items, 6)
    assert {u: [k for k, _ in v] for u, v in got.items()} == {u: [k for k, _ in v] for u, v in want.items()}
    plan = further[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan
    # The floors rise as blocks pass: what leaves is n items of a user at most.
    assert further[0].groupBy("user_id").count().agg(F.max("count")).first()[0] <= 6
