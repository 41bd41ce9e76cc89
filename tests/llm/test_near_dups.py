"""Near duplicates against all pairs that share a shingle."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from segue.llm import near_dups
from segue.llm.components import components
from segue.llm.near_dups import near_duplicates, one_of_each
from segue.llm.queries import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute_force(rows):
    """Smallest id of the class of every row, from exact similarities."""
    bags = []
    for _, text in rows:
        w = words(text)
        runs = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
        bags.append(Counter(runs))
    df = Counter(s for b in bags for s in b)
    n = len(rows)
    floor = max(2.0, near_dups.FREQUENT * sum(len((t or "").encode()) for _, t in rows))
    scale = math.log(n / floor) if n > floor else 0

    def idf(s):
        if df[s] < floor or not scale:
            return 2.0
        rare = min(max(math.log(n / df[s]) / scale, 0), 1)
        return near_dups.LEAST_IDF + (2 - near_dups.LEAST_IDF) * rare

    weights = [{s: t * idf(s) for s, t in b.items()} for b in bags]
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    by_text = {}
    for i, (_, text) in enumerate(rows):
        first = by_text.setdefault(text or "", i)
        parent[find(i)] = find(first)
        if first == i:
            for s in weights[i]:
                holders[s].append(i)
    pairs = {(a, b) for h in holders.values() for x, a in enumerate(h) for b in h[x + 1 :]}
    for a, b in pairs:
        both = sum(min(w, weights[b][s]) for s, w in weights[a].items() if s in weights[b])
        if both / (sum(weights[a].values()) + sum(weights[b].values()) - both) >= 0.8:
            parent[find(a)] = find(b)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        smallest[root] = min(smallest.get(root, key), key)
    return sorted((key, smallest[find(i)]) for i, (key, _) in enumerate(rows))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = queries()["op8_near_duplicates"](spark, SF)
    found = sorted((r.doc_id, r.class_id) for r in got.collect())
    assert found == brute_force(rows)
    assert len({c for _, c in found}) < len(found)


@pytest.fixture(scope="module")
def planted():
    """Long chains of near copies, passages shared by unlike texts, odd texts."""
    draw = random.Random(5)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    passage = new(40)
    rows, key = [], 0
    for _ in range(12):
        rows.append((key := key + 1, " ".join(new(15) + passage + new(15))))
    base = new(120)
    for step in range(30):
        base = list(base)
        base[draw.randrange(120)] = f"x{step}"
        rows.append((key := key + 1, " ".join(base)))
    rows += [(1000, None), (1001, ""), (1002, "..."), (1003, "one two"), (1004, "ONE two!")]
    rows += [(1005, "a b c d e"), (1006, "a b c d f"), (1005, "a b c d e")]
    return rows


def test_planted_texts(spark, planted, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 4)  # buckets in many blocks
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute_force(planted)


def test_copies_stay_linked_in_a_group_of_a_third(spark):
    draw = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for key in range(1, 201):
        copy = list(base)
        copy[draw.randrange(4, 56)] = f"edit{key}"  # plain Jaccard 51 / 61 to the base
        rows.append((key, " ".join(copy)))
    rows += [(key, " ".join(f"y{key}x{i}" for i in range(60))) for key in range(201, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert {classes[key] for key in range(201)} == {0}
    assert all(classes[key] == key for key in range(201, 600))
    assert one_of_each(docs).count() == 400


def test_links_grow_with_the_size_of_a_group(spark, monkeypatch):
    """Texts with two edits each are hardly similar: few links, however many pairs."""
    kept = {}
    plain = near_dups.stage
    monkeypatch.setattr(near_dups, "stage", lambda df, name: kept.setdefault(name, []).append(plain(df, name)) or kept[name][-1])
    draw = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for key in range(240):
        copy = list(base)
        for at in draw.sample(range(5, 115), 2):
            copy[at] = f"edit{key}x{at}"
        rows.append((key, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (120, 240):
        got = near_duplicates(docs.filter(F.col("doc_id") < n)).collect()
        assert sorted((r.doc_id, r.class_id) for r in got) == brute_force(rows[:n])
    links = [frame.count() for frame in kept["unlike-edges"]]
    assert links[1] <= 240 and sum(f.count() for f in kept["star-edges"]) < 2000


def test_one_row_of_each_class_stays(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string").select(
        "*", F.lit("x").alias("node"), F.lit(1).alias("v1"), F.lit(2).alias("label")
    )
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, c in brute_force(planted)})
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_null_ids_and_empty_table(spark):
    rows = [(None, "q r s t u v"), (None, "q r s t u v"), (7, "q r s t u v"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert [r.class_id for r in got].count(7) == 3 and len(got) == 4
    assert sum(r.stays for r in got) == 2
    assert one_of_each(docs).count() == 2
    assert near_duplicates(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(5, None), (5, ""), (6, "a b")], "doc_id long, text string")
    assert one_of_each(same).count() == 2
    assert one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.label) for r in got} == {(i, 0) for i in range(41)} | {
        (100, 100), (101, 100), (102, 100)
    }
