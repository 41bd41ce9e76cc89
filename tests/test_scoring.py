import numpy as np
import pytest
from pyspark.sql import functions as F

from segue.operators import scoring
from segue.plans.continuation import aligned_candidates, model_queries, recommend_requests
from segue.sources.storage import stage

URIS = [f"t:{i:02d}" for i in range(30)]
RNG = np.random.default_rng(5)
COUNTS = RNG.integers(1, 9, 30)
ALS = {u: RNG.normal(size=4).astype(np.float32) for u in URIS[:20]}
WORD = {u: (RNG.normal(size=3) * 7).astype(np.float32) for u in URIS[5:25]}
ALS["t:03"] = np.zeros(4, np.float32)  # counts as missing
SEEDS = {
    1: ["t:00", "t:01", "t:01", "t:07"],
    2: ["t:26"],  # no vector at all: popularity
    3: ["t:22", "t:03"],  # no usable ALS vector
    4: [],
    5: URIS[8:12],
    6: ["t:00", "unknown"],
}


def reference_scores(model, seeds):
    """Straight computation of one list on dense arrays."""
    als = np.array([ALS.get(u, np.zeros(4)) for u in URIS], np.float64)
    word = np.array([WORD.get(u, np.zeros(3)) for u in URIS], np.float64)
    popularity = COUNTS / COUNTS.max()

    def profile(matrix):
        picked = np.array([matrix[URIS.index(s)] for s in seeds if s in URIS])
        picked = picked[np.any(picked != 0, axis=1)] if len(picked) else picked
        return picked.mean(axis=0) if len(picked) else None

    a, w = profile(als), profile(word)
    if w is not None and np.linalg.norm(w) > 0:
        w = w / np.linalg.norm(w)
    norms = np.linalg.norm(word, axis=1)
    unit = word / np.where(norms > 0, norms, 1)[:, None]
    if model == "ALS":
        return als @ a if a is not None else popularity
    if model == "Word2Vec":
        return unit @ w if w is not None else popularity
    if model == "Popularity":
        return popularity
    score = 0.1 * popularity
    if a is not None:
        x = als @ a
        score = score + 0.5 * ((x - x.min()) / (x.max() - x.min()) if x.max() > x.min() else x)
    if w is not None:
        score = score + 0.4 * (unit @ w + 1) / 2
    return score


def reference_list(model, seeds, n):
    scores = reference_scores(model, seeds)
    order = sorted(range(len(URIS)), key=lambda i: (-scores[i], URIS[i]))
    kept = [i for i in order if URIS[i] not in seeds][:n]
    return [(URIS[i], scores[i]) for i in kept]


@pytest.fixture(scope="module")
def tables(spark):
    baseline = spark.createDataFrame(
        [(u, int(c)) for u, c in zip(URIS, COUNTS)], "track_uri string, playlist_count long"
    )
    schema = "track_uri string, features array<float>"
    als = spark.createDataFrame([(u, v.tolist()) for u, v in ALS.items()], schema)
    word = spark.createDataFrame([(u, v.tolist()) for u, v in WORD.items()], schema)
    seeds = spark.createDataFrame(
        [(p, u) for p, us in SEEDS.items() for u in us], "pid long, track_uri string"
    )
    queries = spark.createDataFrame([(p,) for p in SEEDS], "pid long")
    return baseline, als, word, stage(seeds, "seeds"), queries


def check(recs, model, n):
    got = {}
    for r in recs.orderBy("pid", "rank").collect():
        got.setdefault(r.pid, []).append((r.track_uri, r.score, r["rank"]))
    assert set(got) == set(SEEDS)
    for pid, seeds in SEEDS.items():
        expected = reference_list(model, seeds, n)
        assert [g[0] for g in got[pid]] == [e[0] for e in expected], (model, pid)
        assert [g[1] for g in got[pid]] == pytest.approx([e[1] for e in expected])
        assert [g[2] for g in got[pid]] == list(range(1, len(expected) + 1))


@pytest.mark.parametrize("model", scoring.MODELS)
@pytest.mark.parametrize("blocks", ["one", "many", "floors"])
def test_lists_equal_dense_arrays(spark, tables, monkeypatch, model, blocks):
    if blocks != "one":
        monkeypatch.setattr(scoring, "TILE_ITEMS", 3)
        monkeypatch.setattr(scoring, "TILE_QUERIES", 2)
        monkeypatch.setattr(scoring, "FLOOR_BLOCKS", 2 if blocks == "floors" else 99)
    baseline, als, word, seeds, queries = tables
    candidates = aligned_candidates(baseline, als, word)
    rows = model_queries(queries, seeds, candidates, als, word, ["pid"], [model])
    recs = scoring.recommend(candidates, rows.drop("model"), seeds, ["pid"], 12)
    check(recs, model, 12)


def test_popular_lists_by_position_join(spark, tables, monkeypatch):
    monkeypatch.setattr(scoring, "HEAD_ROWS", 5)
    baseline, als, word, seeds, queries = tables
    candidates = aligned_candidates(baseline, als, word)
    rows = scoring.popularity_queries(queries)
    check(scoring.recommend(candidates, rows, seeds, ["pid"], 12), "Popularity", 12)


def test_flat_als_scores_are_not_scaled(spark):
    baseline = spark.createDataFrame([("a", 4), ("b", 2)], "track_uri string, playlist_count long")
    schema = "track_uri string, features array<float>"
    als = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0])], schema)
    word = spark.createDataFrame([], schema)
    seeds = spark.createDataFrame([(1, "a")], "pid long, track_uri string")
    queries = spark.createDataFrame([(1,)], "pid long")
    candidates = aligned_candidates(baseline, als, word)
    rows = model_queries(queries, seeds, candidates, als, word, ["pid"], ["Hybrid"]).drop("model")
    recs = scoring.recommend(candidates, rows, seeds, ["pid"], 5).collect()
    assert [(r.track_uri, round(r.score, 9)) for r in recs] == [("b", 0.1 * 0.5 + 0.5)]


def test_ranks_are_contiguous_and_seeds_never_come_back(spark, tables):
    baseline, als, word, seeds, queries = tables
    recs = recommend_requests(queries, seeds, baseline, als, word, 40)
    got = {}
    for r in recs.collect():
        got.setdefault(r.pid, []).append((r["rank"], r.track_uri))
    for pid, seed in SEEDS.items():
        items = [u for _, u in sorted(got[pid])]
        assert sorted(r for r, _ in got[pid]) == list(range(1, len(items) + 1))
        assert len(set(items)) == len(items) and not set(items) & set(seed)
        assert len(items) == len(URIS) - len(set(seed) & set(URIS))


def test_padding_follows_the_list_and_skips_what_is_taken(spark, tables):
    baseline, als, word, _, _ = tables
    candidates = aligned_candidates(baseline, als, word)
    requests = spark.createDataFrame([(1,), (2,)], "pid long")
    seeds = spark.createDataFrame([(1, "t:05")], "pid long, track_uri string")
    recs = spark.createDataFrame(
        [(1, "t:20", 0.9, 1), (1, "t:11", 0.8, 2)],
        "pid long, track_uri string, score double, rank long",
    )
    padded = scoring.pad_with_popularity(recs, requests, seeds, candidates, ["pid"], 6)
    popular = sorted(range(30), key=lambda i: (-COUNTS[i], URIS[i]))
    for pid, first, taken in [(1, ["t:20", "t:11"], {"t:05"}), (2, [], set())]:
        got = [r.track_uri for r in padded.filter(F.col("pid") == pid).orderBy("rank").collect()]
        rest = [URIS[i] for i in popular if URIS[i] not in taken | set(first)]
        assert got == (first + rest)[:6]


def test_floors_never_change_a_list(spark, tables, monkeypatch):
    monkeypatch.setattr(scoring, "TILE_ITEMS", 3)
    monkeypatch.setattr(scoring, "FLOOR_BLOCKS", 2)
    baseline, als, word, seeds, queries = tables
    candidates = aligned_candidates(baseline, als, word)
    rows = model_queries(queries, seeds, candidates, als, word, ["pid"], ["Hybrid"])
    dense = rows.filter("als_q IS NOT NULL").withColumn("keep", F.lit(4))
    floors = scoring._with_floors(candidates, dense, ["pid"], 3)
    assert not floors.filter(F.col("floor") > float("-inf")).isEmpty()
    recs = scoring.recommend(candidates, rows.drop("model"), seeds, ["pid"], 3)
    check(recs, "Hybrid", 3)


def test_best_positions_prefers_the_first_of_equals():
    from segue.functions.tiles import best_positions

    scores = np.array([1.0, 3.0, 2.0, 3.0, 2.0, 2.0])
    assert sorted(best_positions(scores, 3, -np.inf)) == [1, 2, 3]
    assert sorted(best_positions(scores, 9, -np.inf)) == [0, 1, 2, 3, 4, 5]
    assert sorted(best_positions(scores, 9, 2.5)) == [1, 3]
    assert sorted(best_positions(scores, 3, 2.0)) == [1, 2, 3]


def test_items_without_vectors_are_in_no_tile(spark, tables, monkeypatch, rows):
    """They come from the popularity list, with the scores and order of a tile."""
    schema = "track_uri string, playlist_count bigint, popularity double, als array<double>, word array<double>, word_norm double"
    data = [(f"t:{i:02d}", i % 5, i % 5 / 4, [i - 3.0] if i < 6 else None, None, None) for i in range(40)]
    candidates = stage(spark.createDataFrame(data, schema), "candidates")
    asked = [(1, 0.0, 1.0, 2.0), (2, 0.5, -1.0, 0.0), (3, -0.5, 0.25, 1.0), (4, 0.1, 0.0, 0.0)]
    queries = spark.createDataFrame(
        [(q, w, [x], None, s) for q, w, x, s in asked],
        "pid long, weight double, als_q array<double>, word_q array<double>, shift double",
    )
    held = {1: ["t:06", "t:05"], 2: ["t:09", "t:14", "gone"], 3: ["t:10"], 4: []}
    seeds = spark.createDataFrame([(q, u) for q, us in held.items() for u in us], "pid long, track_uri string")
    met = []
    plain_tiles = scoring._tiles
    monkeypatch.setattr(scoring, "_tiles", lambda c, *more, **named: met.append(c.count()) or plain_tiles(c, *more, **named))
    got = {}
    for r in scoring.recommend(candidates, queries, seeds, ["pid"], 12).orderBy("pid", "rank").collect():
        got.setdefault(r.pid, []).append((r.track_uri, r.score))
    for q, w, x, s in asked:
        scores = {u: w * p + (x * a[0] if a else 0.0) + s for u, _, p, a, *_ in data if u not in held[q]}
        want = sorted(scores.items(), key=lambda e: (-e[1], e[0]))[:12]
        assert [u for u, _ in got[q]] == [u for u, _ in want]
        assert [v for _, v in got[q]] == pytest.approx([v for _, v in want])
    assert met == [6]


def test_popular_lists_unfold_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(scoring, "LIST_ROWS", 50)
    candidates = stage(spark.createDataFrame(
        [(f"t:{i:02d}", 40 - i, (40 - i) / 40) for i in range(40)], "track_uri string, playlist_count bigint, popularity double"
    ), "popular")
    queries = spark.createDataFrame([(p, 10, 1.0, 0.0) for p in range(40)] + [(40, 10, 1.0, 0.0)] * 2, "pid long, need long, weight double, shift double")
    seeds = spark.createDataFrame([(p, f"t:{p:02d}") for p in range(40)], "pid long, track_uri string")
    lists = scoring._popular_lists(candidates, queries, seeds, ["pid"])
    assert lists.rdd.getNumPartitions() == 9
    for p in range(40):
        got = [r.track_uri for r in lists.filter(F.col("pid") == p).orderBy("rank").collect()]
        assert got == [f"t:{i:02d}" for i in range(40) if i != p][:10]
        if p > 2:
            break
    # Two queries of the same keys share a list, as rows of one window do.
    twice = lists.filter("pid = 40").orderBy("rank").collect()
    assert [(r["rank"], r.track_uri) for r in twice] == [(k + 1, f"t:{k // 2:02d}") for k in range(10)]


def test_an_item_without_uri_comes_last_of_equals(spark):
    schema = "track_uri string, playlist_count bigint, popularity double, als array<double>, word array<double>, word_norm double"
    data = [(u, 1, 1.0, [-1.0] if u == "t:0" else None, None, None) for u in [None, "t:0", "t:1", "t:2", "t:3"]]
    candidates = stage(spark.createDataFrame(data, schema), "candidates")
    queries = spark.createDataFrame([(1, 0.0, [1.0], None, 0.0)], "pid long, weight double, als_q array<double>, word_q array<double>, shift double")
    seeds = spark.createDataFrame([(1, "t:1")], "pid long, track_uri string")
    got = scoring.recommend(candidates, queries, seeds, ["pid"], 2).orderBy("rank").collect()
    assert [r.track_uri for r in got] == ["t:2", "t:3"]


def test_a_list_leaves_its_task_once(spark, tables, monkeypatch, rows):
    """With as many groups of queries as workers, no task gives more than n items of a query."""
    monkeypatch.setattr(scoring, "TILE_ITEMS", 3)
    monkeypatch.setattr(scoring, "TILE_QUERIES", 1)
    monkeypatch.setattr(scoring, "QUERY_BLOCKS", 1)
    baseline, als, word, _, _ = tables
    candidates = aligned_candidates(baseline, als, word)
    schema = "pid long, weight double, als_q array<double>, word_q array<double>, shift double"
    queries = stage(spark.createDataFrame([(p, 0.0, [1.0, p % 3 - 1.0, 0.5, 0.0], None, 0.0) for p in range(9)], schema), "queries")
    seeds = stage(spark.createDataFrame([(p, f"t:{p:02d}") for p in range(9)], "pid long, track_uri string"), "seeds")
    left = []
    whole = scoring._top_of_tiles
    monkeypatch.setattr(scoring, "_top_of_tiles", lambda *a, **b: left.append(whole(*a, **b)) or left[-1])
    recs = scoring.recommend(candidates, queries, seeds, ["pid"], 7)
    assert recs.count() == 9 * 7 and left[-1].count() == 9 * 7
    assert "Window" not in recs._jdf.queryExecution().optimizedPlan().toString()
    # Items without a vector beyond the head of the popularity list are merged from lists of their own.
    expected = rows(recs)
    monkeypatch.setattr(scoring, "HEAD_ROWS", 5)
    assert rows(scoring.recommend(candidates, queries, seeds, ["pid"], 7)) == expected


@pytest.mark.parametrize("head", [5, 100])
def test_wanted_rows_keep_their_ranks(spark, tables, monkeypatch, rows, head):
    monkeypatch.setattr(scoring, "HEAD_ROWS", head)
    baseline, als, word, seeds, queries = tables
    candidates = aligned_candidates(baseline, als, word)
    asked = stage(model_queries(queries, seeds, candidates, als, word, ["pid"]), "asked")
    wanted = stage(spark.createDataFrame(
        [(p, u) for p in (1, 2, 3, 4) for u in URIS[p::3]] + [(5, None), (7, "t:01")], "pid long, track_uri string"
    ), "wanted")
    keys = ["model", "pid"]
    lists = stage(scoring.recommend(candidates, asked, seeds, keys, 12), "lists")
    expected = lists.join(wanted, ["pid", "track_uri"], "left_semi").select(*lists.columns)
    assert rows(scoring.recommend(candidates, asked, seeds, keys, 12, wanted)) == rows(expected)
    # Two queries of the same keys share a list.
    twice = asked.union(asked.filter("pid < 4"))
    lists = stage(scoring.recommend(candidates, twice, seeds, keys, 12), "lists")
    assert lists.filter("pid = 1").count() == 4 * 12
    expected = lists.join(wanted, ["pid", "track_uri"], "left_semi").select(*lists.columns)
    assert rows(scoring.recommend(candidates, twice, seeds, keys, 12, wanted)) == rows(expected)


def test_every_copy_of_a_seed_is_left_out(spark, rows):
    """Vectors that come twice make several rows of an item."""
    schema = "track_uri string, playlist_count bigint, popularity double, als array<double>, word array<double>, word_norm double"
    data = [(f"t:{i}", 1, 1.0, [float(i)], None, None) for i in range(8) for _ in range(1 + i % 3)]
    candidates = stage(spark.createDataFrame(data, schema), "candidates")
    queries = spark.createDataFrame([(1, 0.0, [1.0], None, 0.0)], "pid long, weight double, als_q array<double>, word_q array<double>, shift double")
    seeds = spark.createDataFrame([(1, "t:5"), (1, "t:7"), (1, "t:4")], "pid long, track_uri string")
    got = scoring.recommend(candidates, queries, seeds, ["pid"], 5).orderBy("rank").collect()
    assert [(r["rank"], r.track_uri) for r in got] == list(enumerate(["t:6", "t:3", "t:2", "t:2", "t:2"], 1))
