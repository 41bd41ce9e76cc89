"""The text operators against brute force, and on odd rows."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from segue.llm import licenses, oracle, quality
from segue.llm.decontaminate import clean_rows, contamination
from segue.llm.licenses import license_scan
from segue.llm.line_dedup import line_dedup
from segue.llm.mixing import mix, mix_rows
from segue.llm.prefix_tokens import PrefixCounter, counts_at, prefix_tokens
from segue.llm.queries import URL_RULES, queries, tokenizer
from segue.llm.token_files import read_token_files, token_counts, token_positions, tokens_at, write_token_files
from segue.llm.topk import ImpactIndex, top_k
from segue.llm.url_filter import filter_bits, url_filter
from segue.llm.wavelet import WaveletMatrix
from segue.sources.storage import scratch_path, stage

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]
ODD = [
    (1, None, "a"), (2, "", None), (3, "  \t shared line of text \n\nx", "a"),
    (4, "Shared Line of TEXT\nÉtude des lignes", "b"), (4, "Shared Line of TEXT\nÉtude des lignes", "b"),
    (5, "étude des lignes\nétude des lignes", "b"), (None, "shared line of text", None),
    (6, "it's <|endoftext|> they're  x\r\n\t日本語 <|startoftext|>", "a"), (7, "word " * 3000, "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    clashing = ["id", "doc", "version", "size", "line", "key", "row", "rank", "score", "n_copies"]
    return docs.select("*", *[F.lit("?").alias(c) for c in clashing])


def normalized(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle.oracle_sql()[name]).df()
    assert normalized(got) == normalized(want)


def test_prefix_counts(spark, odd):
    counter = PrefixCounter(tokenizer("byte_bpe_50k.json"))
    encode = lambda t: len(counter.library.encode(t, add_special_tokens=False).ids)
    for _, text, _ in ODD:
        text = (text or "")[:200]
        want = [encode(text[: i + 1]) for i in range(len(text))]
        assert counts_at(counter.steps(text)).tolist() == want
    got = prefix_tokens(odd, tokenizer("byte_bpe_50k.json"), 5).collect()
    want = [(i, len((t or "").encode()), encode(t or "")) for i, t, _ in ODD]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=repr) == sorted(want, key=repr)
    for r, (_, text, _) in zip(got, ODD, strict=True):
        fits = [i for i in range(len(text or "")) if encode((text or "")[: i + 1]) <= 5] if len(text or "") < 300 else None
        assert fits is None or r.kept_chars == (fits[-1] + 1 if fits else 0)


def test_query_counts_tokens(spark):
    library = PrefixCounter(tokenizer("byte_bpe_50k.json")).library
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries()["op2_prefix_tokens"](spark, SF).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert r.over_limit == (r.n_tokens > 1024)


def test_token_files(spark, odd):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    folder = scratch_path(spark, "test-files")
    write_token_files(odd, folder, path, 1, shard_tokens=100)
    got = read_token_files(spark, folder).orderBy("start").collect()
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in ODD}
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 4, 5, 6, 7, None]
    start, texts = 0, {i: t for i, t, _ in ODD}
    for r in got:
        want = ids[texts[r.doc_id]]
        assert (r.start, r.n_tokens) == (start, len(want))
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    write_token_files(odd.limit(0), folder + "-empty", path, 1)
    assert read_token_files(spark, folder + "-empty").count() == 0


def test_token_file_query_and_lookups(spark):
    """The whole table against the library, and single tokens of the written files."""
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    start = 0
    rows = {r.doc_id: r for r in queries()["op4_token_files"](spark, SF).collect()}
    assert len(rows) == len(texts)
    for i in sorted(texts):
        crc = zlib.crc32(np.array(ids[i], "<u4").tobytes())
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids[i]), crc)
        start += len(ids[i])
    folder = scratch_path(spark, "test-lookups")
    write_token_files(docs, folder, path, 1, shard_tokens=5000)
    counts = Counter(t for own in ids.values() for t in own)
    few = [t for t, _ in counts.most_common(3)] + [min(counts, key=counts.get), 49_000]
    found = token_counts(spark, folder, few).collect()
    assert {r.token: r.n for r in found} == {t: counts[t] for t in few}
    met = token_positions(spark, folder, few[2:]).collect()
    want = [(i, t, p) for i, own in ids.items() for p, t in enumerate(own) if t in few[2:]]
    assert sorted((r.doc_id, r.token, r.pos) for r in met) == sorted(want)
    asked = [(i, p) for i, own in ids.items() for p in range(0, len(own) + 5, 37)] + [(0, 0), (0, -1), (None, 0), (10**9, 0)]
    asked_rows = spark.createDataFrame(asked, "doc_id long, pos long").withColumn("token", F.lit(0))
    got = tokens_at(spark, folder, asked_rows)
    want = [(i, p, ids[i][p]) for i, p in asked if i in ids and 0 <= p < len(ids[i])]
    assert sorted((r.doc_id, r.pos, r.token) for r in got.collect()) == sorted(want)


def test_wavelet_matrix():
    values = np.random.default_rng(1).integers(0, 37, 5000).astype(np.uint16)
    matrix = WaveletMatrix.load(WaveletMatrix.build(values, 6).dump(), len(values))
    at = np.arange(0, 5000, 7)
    assert (matrix.decode() == values).all() and (matrix.access(at) == values[at]).all()
    assert matrix.rank(values[at], at).tolist() == [(values[:i] == values[i]).sum() for i in at]
    assert (matrix.occurrences(5) == np.flatnonzero(values == 5)).all()
    assert len(WaveletMatrix.build(values[:0], 1).decode()) == 0


def test_line_dedup(odd):
    got = {(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup(odd).collect()}
    assert (3, "  \t shared line of text \n\nx", 3, 0) in got
    assert (4, "Étude des lignes", 2, 1) in got  # É is not é
    assert (None, "", 1, 1) in got and (1, "", 1, 0) in got and (2, "", 1, 0) in got
    last = odd.sparkSession.createDataFrame([(None, "one shared line"), ((1 << 63) - 1, "one shared line")], "doc_id long, text string")
    assert {(r.doc_id, r.n_dropped) for r in line_dedup(last).collect()} == {(None, 1), ((1 << 63) - 1, 0)}
    assert line_dedup(odd).count() == len(ODD) and line_dedup(odd.limit(0)).count() == 0


def test_mixing(odd):
    got = mix(odd).collect()
    assert len(got) == len(ODD) and all(r.taken <= 2 * r.size for r in got)
    assert all(r.target <= 2 * r.source_size for r in got)
    total = sum(r.size for r in got)
    targets = {r.source: r.target for r in got}
    assert math.isclose(sum(targets.values()), 1.5 * total)
    rows = mix_rows(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r.n_copies for r in got)
    assert mix(odd.limit(0)).count() == 0 and mix_rows(odd.limit(0)).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://a.com", "http://a.com/", "x://EXAMPLE.com/en/q?x=/fr/",
            "http://www.example.com/en/#a", "http://xcom/", "http://b.net/fr/", "http://net/es/1", "http://net/es"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.select("*", F.lit("?").alias("host"), F.lit("?").alias("key"))
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter(pages, URL_RULES).collect()}
    assert [got[i][0] for i in range(len(urls))] == [
        None, None, None, None, "com/", "example.com/en/", "www.example.com/en/", None, "net/fr/", "net/es/", None
    ]
    assert got[5][1] == got[8][1] == got[9][1] == "block" and got[0][1] == got[6][1] == "allow"
    assert url_filter(pages.limit(0), URL_RULES).count() == 0


def test_url_filters_do_not_grow_with_the_urls():
    assert filter_bits(3, 0) == 64 and filter_bits(10**6, 10**6) == 8 * 10**6
    assert filter_bits(3, 10**12) < 100_000 and filter_bits(50_000, 10**11) < 1 << 24


def test_topk(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(0, 0.3, 8).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]
    rows += [(900, None), (950, [float("nan")] * 8), (960, [None] * 8), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1))
    got = top_k(df, F.col("vec_id") % 50 == 0, 5).collect()
    ints = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:420]}
    for q in range(0, 420, 50):
        best = sorted((-(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        found = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert found == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_topk_of_repeated_query_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(0, 0.3, 8).tolist()) for i in range(60)]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (50, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, F.col("vec_id") % 50 == 0, 5).collect()
    ints = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows]
    want = []
    for at in (0, 50, 62):
        own, query = ints[at]
        best = sorted((-(query @ v), i) for i, v in ints if i != own)[:5]
        want += [(own, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_contamination_in_blocks(spark, monkeypatch):
    from segue.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 4)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 200)  # several rounds
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(6)] + [(50, "Tiny Item"), (51, None), (52, "--")]
    docs = [(0, items[0][1] + " and " + items[3][1][:60]), (1, "x tiny, ITEM y"), (2, None), (3, ""),
            (4, "z " * 2000 + "tiny item"), (1, "x tiny, ITEM y")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("block", F.lit(1))
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in contamination(docs, items, shard_words=30).collect()}
    assert got[0]["items"] == ["0"] and got[0].n_hit == 20 and got[0].contaminated
    assert got[1]["items"] == ["50"] and got[1].n_hit == 2 and got[2].n_words == 0
    assert got[4].n_hit == 2 and not got[4].contaminated
    assert sorted(r.doc_id for r in clean_rows(docs, items).collect()) == [2, 3, 4]
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())
    assert contamination(docs.limit(0), items).count() == 0


def test_quality(spark, odd):
    got = queries()["op10_quality"](spark, "/root/testdata/sf0.01").alias("s")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    some = quality.classify(odd, labels.limit(0)).collect()
    assert len(some) == len(ODD) and {r["score"] for r in some} == {0.5}
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.classify(odd.limit(0), labels).count() == 0


def test_licenses(spark):
    notice = "Released under the MIT License."
    files = [(1, "a", notice), (2, "a/b", "plain text"), (3, "a/b/c", "more"), (4, "z", None), (5, None, ""),
             (6, "a/b/c", "text " * 99 + "\nLicensed under the Apache License, Version 2.0."), (1, "a", notice)]
    files = spark.createDataFrame(files, "doc_id long, folder string, text string").withColumn("w", F.lit(1))
    got = {r.doc_id: r for r in license_scan(files).collect()}
    assert got[1].own_license == "MIT" and got[6].license == "Apache-2.0"
    assert got[2].license == got[3].license == "MIT" and got[3].inherited_from == "a"
    assert got[4].license is None and got[5].license is None
    assert license_scan(files.limit(0)).count() == 0


def test_license_lines_with_common_words(spark):
    mit = dict(licenses.TEXTS)["MIT"]
    common = "All that was under and on it is by the way of those."
    mine = ["It is released under the MIT License.", "Released under the MIT License, and on it.",
            "# Licensed under the Apache License,\n# Version 2.0.\ncode()", "MIT License\n\nCopyright 2020 A\n\n" + mit,
            "\n\n".join(mit.split("\n")[:3]), "released mit",
            "\n\n".join(["int main() { return 0; }"] * 99 + mit.split("\n") + ["x = x + 1"] * 6000)]
    assert len(mine[-1]) > 60_000
    rows = [(i, str(i), t) for i, t in enumerate(mine)] + [(100 + i, "other", f"{common} w{i}") for i in range(900)]
    files = spark.createDataFrame(rows, "doc_id long, folder string, text string")
    got = {r.doc_id: r for r in license_scan(files).collect()}
    bag = lambda t: Counter(re.findall(r"[^\W_]+", t.lower()))
    df = Counter(w for _, _, t in rows for w in bag(t))
    idf = lambda w: math.log((1 + len(rows)) / (1 + df[w])) + 1

    def cosine(a, b):
        a, b = ({w: n * idf(w) for w, n in bag(t).items()} for t in (a, b))
        dot = sum(x * b.get(w, 0) for w, x in a.items())
        return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    most = licenses.STRETCH * max(sum(bag(t).values()) for _, t in licenses.TEXTS)
    for i, text in enumerate(mine):
        passages = [p for p in re.split(r"\n\s*\n", text) if bag(p)]
        long = passages[90:140]
        ends = [(a, b) for a in range(len(long)) for b in range(a + 2, len(long) + 1)] if len(passages) > 140 else [
            (a, b) for a in range(len(passages)) for b in range(a + 2, len(passages) + 1)]
        some = long if len(passages) > 140 else passages
        runs = ["\n\n".join(some[a:b]) for a, b in ends]
        runs = [r for r in runs if sum(bag(r).values()) <= most]
        units = {u for u in [*text.split("\n"), *passages] if bag(u)}
        found = [(cosine(u, t), n) for u in units for n, t in [*licenses.NOTICES, *licenses.TEXTS]]
        found += [(cosine(u, t), n) for u in runs for n, t in licenses.TEXTS]
        best, name = max(found)
        want = (name, round(best, 6)) if best >= 0.8 else (None, None)
        assert got[i].own_license == want[0], i
        assert got[i].cosine == (want[1] and pytest.approx(want[1], abs=2e-6))
    assert [got[i].own_license for i in (0, 1, 2, 3, 6)] == ["MIT", "MIT", "Apache-2.0", "MIT", "MIT"]
    assert got[100].own_license is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, SF), re.sub(" ", "-", name))
        assert after.columns == docs.columns
        counts.append(after.count())
        docs = after
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == counts[-1] == corpus_pipeline.run(spark, SF).count()


def test_word_encoder_matches_the_library_on_odd_texts():
    import random

    from tokenizers import Tokenizer

    from segue.llm.queries import tokenizer
    from segue.llm.token_files import WordEncoder

    path = tokenizer("word_bpe_49k.json")
    encoder, library = WordEncoder(path), Tokenizer.from_file(path)
    draw = random.Random(5)
    letters = "abÉß.., \n\n'sl7!\t\x1c\x85\u212a"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 14))) for _ in range(3000)]
    for text in [*texts, "<|endoftext|> a.", "a,b. c", "Plain, plain.\nText.", "x." * 9]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == ids, text
    every = [*texts, "", " ", "Plain, plain.\nText.", "<|endoftext|>", "日本 x"]
    for text, ids in zip(every, encoder.encode_all(every), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode_all([]) == []


@pytest.mark.parametrize("kind", ["normal", "outlier", "equal", "wide", "empty", "huge"])
def test_impact_index_is_exact(kind):
    random = np.random.default_rng(7)
    rows = random.normal(0, 100, (700, 12)).astype(np.int64)
    if kind == "outlier":
        rows[3] = 10**6
    elif kind == "equal":
        rows[:400] = rows[0]
    elif kind == "wide":
        rows = rows[:4]
    elif kind == "empty":
        rows = rows[:, :0]
    elif kind == "huge":
        rows *= 10**6
    ids = np.arange(len(rows))[::-1].copy()
    ids[-1] = ids[0]
    results = list(ImpactIndex(ids, rows).search(ids[:70], rows[:70], 5))
    assert len(results) == len(ids[:70])
    for own, query, (found, scores) in zip(ids, rows, results, strict=False):
        others = np.flatnonzero(ids != own)
        exact = rows[others] @ query
        best = np.lexsort((ids[others], -exact))[:5]
        assert found.tolist() == ids[others][best].tolist()
        assert scores.tolist() == exact[best].tolist()
