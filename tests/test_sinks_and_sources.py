"""Broken inputs, table layouts and stored models."""

import glob
import os
import tempfile

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segue.operators import ingest, models
from segue.schema import REQUEST_FILE
from segue.sources import slices, storage


FAILED = (PySparkException, Py4JJavaError)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


GOOD = '{"playlists": [{"pid": 1, "name": "a", "num_samples": 1, "tracks": [{"track_uri": "t"}]}]}'
WRONG = {
    "cut": GOOD[:-9],
    "type": GOOD.replace("1,", '"one",', 1),
    "bare": '{"info": {"slice": "x"}}',
    "null": '{"playlists": null}',
    "text": "not json",
}


def write(folder, **files):
    for name, text in files.items():
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(text.replace(", ", ",\n "))


@pytest.mark.parametrize("name", WRONG)
def test_broken_files_fail_loudly(spark, folder, name):
    write(folder, good=GOOD, wrong=WRONG[name])
    with pytest.raises(FAILED):
        ingest.flatten_interactions(ingest.flatten_playlists(slices.read_slices(spark, folder))).collect()
    with pytest.raises(FAILED):
        slices.read_requests(spark, folder).select("pid", "seeds").collect()
    kept = slices.read_requests(spark, folder, mode="DROPMALFORMED")
    assert [r.pid for r in kept.collect()] == [1]
    with pytest.raises(ValueError):
        slices.read_slices(spark, folder, mode="IGNORE")


def test_broken_files_are_set_aside(spark, folder):
    write(folder, good=GOOD, **WRONG)
    checked = slices.read_checked(spark, folder, REQUEST_FILE)
    assert [r.pid for r in slices.request_rows(checked.good).collect()] == [1]
    target = f"{folder}-bad"
    slices.write_quarantine(checked, target)
    slices.write_quarantine(checked, target)  # adds
    found = slices.read_quarantine(spark, target).collect()
    names = sorted(os.path.basename(r.file) for r in found)
    assert names == sorted(f"{n}.json" for n in WRONG) * 2 or names == sorted([f"{n}.json" for n in WRONG] * 2)
    reasons = {os.path.basename(r.file): r.reason for r in found}
    assert reasons["bare.json"] == reasons["null.json"] == "no playlists"
    assert reasons["cut.json"] == reasons["type.json"] == reasons["text.json"] == "malformed"
    assert any(r.record and "not json" in r.record for r in found)
    # Lines are judged one by one.
    lines = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{lines}/l.json", "w") as out:
        out.write("\n".join([GOOD, WRONG["cut"], GOOD]))
    checked = slices.read_checked(spark, lines, REQUEST_FILE, multi_line=False)
    assert (checked.good.count(), checked.rejected.count()) == (2, 1)
    clean = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write(clean, good=GOOD)
    checked = slices.read_checked(spark, clean, REQUEST_FILE)
    slices.write_quarantine(checked, f"{clean}-bad")
    assert slices.read_quarantine(spark, f"{clean}-bad").count() == 0


def test_folders_are_pruned_and_sized(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    held = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    rows = spark.range(200_000).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("kind"))
    storage.write_table(rows, f"{folder}/t", partition_by=["kind"], target_bytes=200_000)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == held
    files = {k: len(glob.glob(f"{folder}/t/kind={k}/*.parquet")) for k in ("hot", "cold")}
    assert files["hot"] > files["cold"] >= 1
    read = storage.read_table(spark, folder, "t")
    assert read.filter("kind = 'cold'").count() == 40_000
    plan = read.filter("kind = 'cold'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    storage.write_table(rows, f"{folder}/u", target_bytes=10 << 20)
    assert len(glob.glob(f"{folder}/u/*.parquet")) == 1


def test_bucketed_tables_join_without_exchange(spark, folder):
    left = storage.write_buckets(spark.range(1000).withColumn("x", F.lit(1)), "left_b", f"{folder}/l", ["id"], 4)
    storage.write_buckets(spark.range(500, 1500), "right_b", f"{folder}/r", ["id"], 4)
    spark.sql("DROP TABLE right_b")
    right = storage.register_buckets(spark, "right_b", f"{folder}/r", spark.range(1).schema, ["id"], 4)
    joined = left.hint("merge").join(right, "id").groupBy("id").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 500 and "Exchange" not in plan and "SortMergeJoin" in plan
    assert len(glob.glob(f"{folder}/l/*.parquet")) == 4
    spark.sql("DROP TABLE left_b")
    spark.sql("DROP TABLE right_b")


@pytest.fixture(scope="module")
def wide(spark):
    data = [((1 << 33) + p * 5, f"t:{(p * 3 + i * (1 + p % 4)) % 40:02d}") for p in range(60) for i in range(12)]
    train = storage.stage(spark.createDataFrame(data, "pid long, track_uri string"), "wide")
    ids = storage.stage(models.track_id_map(train), "ids")
    users = storage.stage(models.user_id_map(train), "users")
    ratings = storage.stage(models.als_input(train, ids, users=users), "ratings")
    return train, users, ratings, models.fit_als(ratings, rank=4, maxIter=3)


def test_any_pid_can_be_a_user(wide):
    train, users, ratings, model = wide
    pids = {r.pid for r in train.select("pid").distinct().collect()}
    assert min(pids) > 1 << 32 and ratings.count() == train.count()
    assert {r.pid for r in models.als_user_vectors(model, users).collect()} == pids
    assert sorted(r.user_id for r in users.collect()) == list(range(60))
    with pytest.raises(FAILED):
        models.als_input(train, train.select("track_uri", F.lit(1).alias("track_id")).distinct()).collect()


def test_user_vectors_solve_their_equations(spark, wide):
    _, _, ratings, model = wide
    found = models.als_residuals(model, ratings, 0.1, 1.0).collect()
    assert len(found) == 60 and all(r.residual < 1e-4 and r.ratings == 12 for r in found)
    other = models.als_residuals(model, ratings, 0.5, 1.0)
    assert other.agg(F.min("residual")).first()[0] > 1e-2
    few = ratings.filter("user_id > 0 or item_id > 5")
    gaps = {r.user_id: r.residual for r in models.als_residuals(model, few, 0.1, 1.0).collect()}
    assert gaps[0] > 1e-2 and gaps[1] < 1e-4


def test_views_do_not_outlive_their_block(spark):
    with storage.temporary_views({"seven": spark.range(7)}):
        counted = spark.sql("SELECT count(*) FROM seven")
    assert counted.first()[0] == 7 and not spark.catalog.tableExists("seven")


def test_models_are_checked_when_they_are_loaded(spark, wide, folder):
    _, _, _, model = wide
    storage.save_model(model, f"{folder}/als")
    stored = storage.load_als(f"{folder}/als")
    pairs = stored.itemFactors.withColumnRenamed("features", "f").join(model.itemFactors, "id")
    assert pairs.count() == 40 and pairs.filter("f <> features").isEmpty()
    manifest = storage.read_manifest(spark, f"{folder}/als")
    assert {(r["table"], r["rows"]) for r in manifest.collect()} == {("itemFactors", 40), ("userFactors", 60)}
    changed = storage.stage(manifest.withColumn("rows", F.col("rows") + 1), "changed")
    changed.write.mode("overwrite").json(f"{folder}/als/manifest")
    with pytest.raises(ValueError, match="manifest says"):
        storage.load_als(f"{folder}/als")
    changed.withColumn("version", F.lit(0)).write.mode("overwrite").json(f"{folder}/als/manifest")
    with pytest.raises(ValueError, match="version"):
        storage.load_als(f"{folder}/als")
    model.write().overwrite().save(f"{folder}/half")
    with pytest.raises(ValueError, match="not finished"):
        storage.load_als(f"{folder}/half")
