"""SimHash groups, periodic runs and lexical search against brute force, and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from segue.llm import periodic, simhash
from segue.llm.components import components
from segue.llm.lexical import lexical_search
from segue.llm.periodic import periodic_runs
from segue.llm.queries import queries, with_planted_runs
from segue.llm.simhash import fingerprint, fingerprint_links, segments, simhash_groups
from segue.sources.storage import stage

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (5, "one  TWO"), (None, "one two"),
    (None, "Ünlike a b c d"), (7, "x y\x85z " * 9000), (8, "x y\x85z " * 9000 + "end"), (9, "É é É é"),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    clashing = ["id", "fp", "key", "own", "mask", "n", "label", "runs", "item", "terms", "part", "rank", "_n"]
    return docs.select("*", *[F.lit("?").alias(c) for c in clashing])


def split(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain_fingerprint(text):
    words = split(text)
    runs = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(fps, ids, distance=4):
    """Smallest id of what links connect, for every row, by comparing all pairs."""
    label = list(range(len(fps)))
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= distance]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    best = {}
    for at, key in zip(label, ids, strict=True):
        best[at] = min((x for x in (best.get(at), key) if x is not None), default=None)
    return [best[at] for at in label]


def test_simhash_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = smallest(fps, [i for i, _ in rows])
    want = {i: (f"{fp:016x}", c) for (i, _), fp, c in zip(rows, fps, groups, strict=True)}
    got = queries()["op11_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(rows)
    assert len(set(groups)) < len(rows)


def test_simhash_of_odd_rows(spark, odd, monkeypatch):
    fps = [plain_fingerprint(t) for _, t in ODD]
    monkeypatch.setattr(simhash, "PIECE_BYTES", 50)
    assert [fingerprint(t or "") for _, t in ODD] == fps
    got = simhash_groups(odd).collect()
    want = [(i, fp, c) for (i, _), fp, c in zip(ODD, fps, smallest(fps, [i for i, _ in ODD]), strict=True)]
    found = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert simhash_groups(odd.limit(0)).count() == 0


@pytest.mark.parametrize(("count", "block"), [(100, 4096), (100, 4), (1 << 18, 5), (1 << 22, 4096), (1 << 31, 3)])
def test_links_connect_what_is_near(spark, monkeypatch, count, block):
    """Other numbers of fingerprints give other segments, small blocks large buckets."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(count + block)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        now = draw.getrandbits(64)
        for _ in range(draw.randint(1, 30)):
            fps.add(now)
            for _ in range(draw.randint(1, 6)):
                now ^= 1 << draw.randrange(64)
    for low in range(20):  # many that share almost all bits
        fps.add(0xABCDEF0000000000 | (1 << low) - 1 << 3)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    marks = stage(spark.createDataFrame(signed, "fp long"), "marks")
    links = fingerprint_links(marks, count).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in links)
    labels = {r.node: r.label for r in components(spark.createDataFrame(links or [(0, 0)], "a long, b long")).collect()}
    order = sorted(range(len(fps)), key=lambda i: signed[i][0])
    want = smallest([fps[i] for i in order], [signed[i][0] for i in order])
    assert [labels.get(signed[i][0], signed[i][0]) for i in order] == want


def test_segments_cover_all_distances():
    for count in (1, 1 << 15, 1 << 20, 1 << 24, 1 << 40):
        parts = segments(count)
        # The most that can differ without any segment noticing is one more in each.
        assert sum(radius + 1 for _, _, radius in parts) > 4
        assert all(bits >= min(count.bit_length() - 4, 12) for _, bits, _ in parts)


def plain_runs(words, least=24):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(draw):
    words = [str(draw.randrange(draw.choice([1, 2, 3, 5, 1000]))) for _ in range(draw.randrange(400))]
    for _ in range(draw.randrange(4)):
        base = words[: draw.randrange(1, 150)] or ["z"]
        if draw.random() < 0.4:  # nearly a shorter period
            short = draw.randrange(1, 6)
            base = [base[i % min(short, len(base))] for i in range(len(base))] + ["end"]
        at = draw.randrange(len(words) + 1)
        words[at:at] = (base * 500)[: draw.randrange(1, 500)]
    return words


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    texts = [periodic_words(draw) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    for r in periodic_runs(docs.repartition(3)).collect():
        words = texts[r.doc_id]
        runs = plain_runs(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE_BYTES", 100)
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 10)
    got = periodic_runs(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    by_text = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_text[7].runs] == [(0, 18000, 2)] and by_text[7].collapsed == "x y\x85z"
    assert by_text[8].collapsed == "x y\x85z end" and by_text[8].n_words == 18001
    assert by_text[1].runs == [] and by_text[1].collapsed == "" and by_text[3].n_words == 0
    assert periodic_runs(odd.limit(0)).count() == 0


def test_planted_runs(spark, odd):
    plain = odd.drop("_n")
    assert with_planted_runs(plain).columns == plain.columns and with_planted_runs(plain).count() == len(ODD)
    rows = [(i, f"a b c d e f g {i} h i j") for i in range(300)]
    planted = with_planted_runs(spark.createDataFrame(rows, "doc_id long, text string"))
    for key, text in [(r.doc_id, r.text) for r in planted.collect()]:
        words, h = f"a b c d e f g {key} h i j".split(), zlib.crc32(str(key).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        assert text.split() == words


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, k):
    bags = [Counter(terms(t)) for _, t in docs]
    count = sum(bool(b) for b in bags)
    total = sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    found = []
    for item, text in set(items):
        scores = []
        for (key, _), bag in zip(docs, bags, strict=True):
            m = 50 + (50 * sum(bag.values()) * count) // total if total else 0
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(terms(text)) if t in bag
            )
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        found += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scores)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_search_of_odd_rows(spark, odd, block_bytes, monkeypatch):
    from segue.llm import lexical

    monkeypatch.setattr(lexical, "EXPANDED", 7)
    items = [(1, "One! two, x"), (2, "é y"), (2, "é y"), (2, "end"), (3, None), (4, "--"), (None, "c D"), (5, "absent")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1))
    got = lexical_search(odd, asked, 3, block_bytes=block_bytes).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=repr) == plain_search(ODD, items, 3)
    assert lexical_search(odd.limit(0), asked, 3).count() == 0
    assert lexical_search(odd, asked.limit(0), 3).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_keeps_the_best_of_many_ties(spark):
    draw = np.random.default_rng(5)
    docs = [(int(i), " ".join(f"t{x}" for x in draw.integers(0, 6, 4))) for i in draw.permutation(700)]
    items = [(i, f"t{i} t{i + 1} t9") for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = lexical_search(frame, spark.createDataFrame(items, "item_id long, text string"), 50).collect()
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=repr) == plain_search(docs, items, 50)
