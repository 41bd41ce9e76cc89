from segue.operators import split


def frame(spark, data):
    return spark.createDataFrame(data, "pid long, track_uri string, pos long")


def brute(data, vocabulary, scenarios):
    seeds, holdout = [], []
    for pid in sorted({r[0] for r in data}):
        items = [u for p, u, _ in sorted(data, key=lambda r: r[2]) if p == pid and u in vocabulary]
        for name, k in scenarios.items():
            seeds += [(name, pid, u) for u in items[:k]]
            holdout += [(name, pid, u) for u in set(items[k:])]
    return sorted(seeds), sorted(holdout)


def test_seeds_and_holdout_equal_slicing(spark, rows):
    # Repeats across the cut, unknown items, and a list of exactly k items.
    data = [(1, u, i) for i, u in enumerate("abxacdabee")]
    data += [(2, u, i) for i, u in enumerate("ab")]
    data += [(3, u, i) for i, u in enumerate("xxaabcd")]
    data += [(4, "x", 0)]
    vocabulary = spark.createDataFrame([(u,) for u in "abcde"], "track_uri string")
    scenarios = {"none": 0, "two": 2, "five": 5, "hundred": 100}
    known = split.in_vocabulary(frame(spark, data), vocabulary)
    seeds, holdout = brute(data, set("abcde"), scenarios)
    assert rows(split.seed_rows(known, scenarios), "scenario", "pid", "track_uri") == sorted(seeds, key=repr)
    assert rows(split.holdout_rows(known, scenarios)) == sorted(holdout, key=repr)


def test_split_is_disjoint_and_complete(spark, rows):
    data = [(p, f"t{i}", i) for p in range(60) for i in range(p % 12)]
    pt = frame(spark, data)
    playlists = pt.groupBy("pid").count().selectExpr("pid", "'n' AS name", "count AS num_tracks")
    reserved = split.reserve_validation(playlists, min_length=5, fraction=0.5, cap=10)
    held = {r.pid for r in reserved.collect()}
    assert 0 < len(held) <= 10 and all(p % 12 >= 5 for p in held)
    train = {r.pid for r in split.train_split(pt, reserved).collect()}
    validation = {r.pid for r in split.validation_split(pt, reserved).collect()}
    assert validation == held and not train & held
    assert train | held == {p for p, _, _ in data}
    counts = split.split_counts(pt, reserved).first()
    assert counts.validation_playlists == len(held)
    assert counts.train_rows + counts.removed_rows == len(data)
    assert rows(reserved) == rows(
        split.reserve_validation(playlists.repartition(3), min_length=5, fraction=0.5, cap=10)
    )


def test_sequences_are_ordered_and_long_ones_come_in_parts(spark, rows):
    data = [(1, f"t{i}", i) for i in range(7)] + [(2, f"t{i}", i) for i in range(4)]
    got = split.sequences(frame(spark, data[::-1]), min_length=5, part_length=3)
    assert rows(got) == [
        (1, 0, 7, ["t0", "t1", "t2"]),
        (1, 1, 7, ["t3", "t4", "t5"]),
        (1, 2, 7, ["t6"]),
    ]


def test_rare_items_leave_before_long_sequences_are_cut(spark, rows):
    from segue.plans import queries

    items = [f"r{i}" if i % 3 == 1 else f"t{i % 4}" for i in range(20)]
    data = [(1, u, i) for i, u in enumerate(items)] + [(2, f"r{i}", i) for i in range(4)]
    got = split.sequences(frame(spark, data[::-1]), part_length=5, min_count=2)
    common = [u for u in items if u[0] == "t"]
    assert rows(got) == [(1, n, 20, common[5 * n : 5 * n + 5]) for n in range(3)]
    assert queries.N == 500 and queries.SCENARIOS == split.SCENARIOS
