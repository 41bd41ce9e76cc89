import datetime
import glob
import tempfile

import pytest

from segue.operators import ingest
from segue.sources import purchases
from segue.sources.slices import read_slices

DAY = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """40 customers, some with more than a record of tracks; item 9 is no part."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    orders = [(c * 10 + o, c, DAY + datetime.timedelta(days=o)) for c in range(40) for o in range(c % 4)]
    orders += [(1_000, 77, DAY)]  # of no customer
    lines = [(k, n, (k * 7 + n) % 10, n, 1.0) for k, _, _ in orders for n in range(1 + k % 5)]
    parts = [(p, f"n{p}", f"b{p % 3}", f"t{p % 2}", p) for p in range(9)]
    people = [(c, "S", 1.0 * c, f"c{c}", c) for c in range(40)]
    for name, data, schema in [
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate date"),
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"),
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        ("customer", people, "c_custkey long, c_mktsegment string, c_acctbal double, c_name string, c_nationkey int"),
    ]:
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    held = {}
    for key, customer, _ in sorted(orders):
        held.setdefault(customer, []).extend(p for k, n, p, *_ in lines if k == key)
    return folder, {c: items for c, items in held.items() if c < 40}


def wanted(held):
    return sorted((c, f"item:{p}", i) for c, items in held.items() for i, p in enumerate(items) if p < 9)


def test_slices_hold_every_track_in_records(spark, tables, monkeypatch, rows):
    monkeypatch.setattr(purchases, "RECORD_TRACKS", 3)
    folder, held = tables
    nested = ingest.flatten_playlists(purchases.slices(spark, folder, 10))
    assert rows(ingest.flatten_interactions(nested)) == sorted(wanted(held), key=repr)
    got = nested.collect()
    assert all(1 <= len(r.tracks) <= 3 and [t.pos for t in r.tracks] == sorted(t.pos for t in r.tracks) for r in got)
    for r in got:
        known = [p for p in held[r.pid] if p < 9]
        assert (r.num_tracks, r.num_artists, r.num_albums, r.duration_ms) == (
            len(known), len({p % 3 for p in known}), len({p % 2 for p in known}), 1000 * sum(known)
        )


def test_tasks_follow_the_appearances(spark, tables, monkeypatch):
    """With a fixed number of tasks, what one task sorts and nests grows with the tables."""
    monkeypatch.setattr(purchases, "TASK_ROWS", 4)
    folder, held = tables
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert purchases.slices(spark, folder, 10).rdd.getNumPartitions() == lines // 4 + 1


def test_slice_files_are_compressed_and_read_back(spark, tables, rows):
    folder, held = tables
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/slices"
    purchases.write_slices(purchases.slices(spark, folder, 10), path)
    assert glob.glob(f"{path}/*.json.gz") and not glob.glob(f"{path}/*.json")
    nested = ingest.flatten_playlists(read_slices(spark, path))
    assert rows(ingest.flatten_interactions(nested)) == sorted(wanted(held), key=repr)
