import gzip
import glob
import math
import tempfile

import pytest

from segue.operators import evaluate
from segue.operators.verify import verify_recommendations
from segue.sources import export


def _recs(spark, lists, model="A", scenario="s"):
    rows = [
        (scenario, model, pid, u, i + 1) for pid, items in lists.items() for i, u in enumerate(items)
    ]
    return spark.createDataFrame(
        rows, "scenario string, model string, pid long, track_uri string, rank long"
    )


def _holdout(spark, held, scenario="s"):
    rows = [(scenario, pid, u) for pid, items in held.items() for u in items]
    return spark.createDataFrame(rows, "scenario string, pid long, track_uri string")


def test_metrics_by_hand(spark):
    filler = [f"f{i}" for i in range(30)]
    recs = _recs(spark, {1: ["a", "b"], 2: filler, 3: filler[:14] + ["x"], 4: ["p", "q", "r"]})
    holdout = _holdout(spark, {1: "ab", 2: ["zz"], 3: ["x", "y"], 4: ["r", "z"], 5: ["n"]})
    got = {
        r.pid: (r.r_precision, r.ndcg, r.clicks)
        for r in evaluate.list_metrics(recs, holdout, ["A"], ["scenario", "pid"], 500).collect()
    }
    ideal2 = 1 + 1 / math.log2(3)
    assert got[1] == pytest.approx((1.0, 1.0, 0))
    assert got[2] == (0.0, 0.0, 51)
    assert got[3] == pytest.approx((0.0, 1 / math.log2(16) / ideal2, 1))
    assert got[4] == pytest.approx((0.0, 1 / math.log2(4) / ideal2, 0))
    assert got[5] == (0.0, 0.0, 51)  # no list at all


def test_denominator_is_the_holdout_even_beyond_n(spark):
    recs = _recs(spark, {1: ["a", "b", "c"]})
    holdout = _holdout(spark, {1: "abcde"})
    r = evaluate.list_metrics(recs, holdout, ["A"], ["scenario", "pid"], 2).first()
    assert (r.r_precision, r.ndcg, r.clicks) == pytest.approx((2 / 5, 1.0, 0))


def test_summary_best_and_improvement(spark):
    recs = _recs(spark, {1: ["a"], 2: ["x"]}, "Popularity").unionByName(
        _recs(spark, {1: ["a"], 2: ["b"]}, "ALS")
    )
    holdout = _holdout(spark, {1: "a", 2: "b"})
    models = ["Popularity", "ALS", "Word2Vec"]
    summary = evaluate.evaluate(recs, holdout, models)
    got = {r.model: (r.r_precision, r.evaluated) for r in summary.collect()}
    assert got == {"Popularity": (0.5, 2), "ALS": (1.0, 2), "Word2Vec": (0.0, 2)}
    assert evaluate.best_model(summary, models).first().model == "ALS"
    gains = {r.model: r.gain_pct for r in evaluate.improvement(summary).collect()}
    assert gains == {"ALS": 100.0, "Word2Vec": -100.0}


def test_first_model_wins_ties_and_zero_baseline_gives_null(spark):
    summary = spark.createDataFrame(
        [("s", "ALS", 0.2, 0.1), ("s", "Popularity", 0.2, 0.3), ("z", "Popularity", 0.0, 0.0), ("z", "ALS", 0.1, 0.1)],
        "scenario string, model string, r_precision double, ndcg double",
    )
    best = {r.scenario: r.model for r in evaluate.best_model(summary, ["Popularity", "ALS"]).collect()}
    assert best == {"s": "Popularity", "z": "ALS"}
    gains = {r.scenario: r.gain_pct for r in evaluate.improvement(summary).collect()}
    assert gains == {"s": 0.0, "z": None}


def test_every_verification_rule(spark, rows):
    lists = {1: ["a", "b", "c"], 2: ["a", "b"], 3: ["a", "a", "b"], 4: ["s", "b", "c"], 9: ["a", "b", "c"]}
    recs = _recs(spark, lists)
    requests = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5)], "pid long")
    seeds = spark.createDataFrame([(4, "s"), (4, "s"), (1, "z")], "pid long, track_uri string")
    assert rows(verify_recommendations(recs, requests, seeds, 3)) == sorted(
        [
            (2, "wrong_count", 2),
            (2, "duplicates", 2),
            (3, "duplicates", 2),
            (4, "seed_overlap", 1),
            (5, "missing_pid", 1),
            (9, "unknown_pid", 1),
        ],
        key=repr,
    )


def test_export_and_read_back(spark, rows):
    recs = _recs(spark, {1: ["b", "a"], 2: ["c"]}).select("pid", "track_uri", "rank")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    export.export_recommendations(recs, f"{folder}/out")
    lines = []
    for name in glob.glob(f"{folder}/out/*.gz"):
        with gzip.open(name, "rt") as f:
            lines += f.read().splitlines()
    assert sorted(lines) == ["1, b, a", "2, c"]
    assert rows(export.read_recommendations(spark, f"{folder}/out")) == rows(recs)


def test_metric_sink(spark, rows):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    summary = spark.createDataFrame([("s", "A", 0.5)], "scenario string, model string, r_precision double")
    export.write_metrics(summary, folder)
    assert rows(spark.read.parquet(f"{folder}/parquet")) == rows(summary)
    assert spark.read.option("header", True).csv(f"{folder}/csv").first().r_precision == "0.5"
