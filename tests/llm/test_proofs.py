"""The classifier and the pipeline against plain versions of the same definitions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_near_dups import brute_force, words

import corpus_pipeline
from segue.llm import quality
from segue.llm.queries import END_ID, queries, tokenizer
from segue.sources.storage import stage

SF = "/root/testdata/sf0.001"


def plain_statistics(text):
    data, own = text.encode(), words(text)
    n = len(own)
    sizes = [len(w.encode()) for w in own]
    mean = sum(sizes) / max(n, 1)
    share = lambda part, whole: math.log((part + 0.5) / (max(whole - part, 0) + 0.5))
    kinds = {
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "marks": b".,;:'\"-()", "calls": b"!?",
        "blanks": b" \t", "lines": b"\n\r", "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    }
    pairs = list(zip(own, own[1:], strict=False))
    found = {name: share(sum(b in chars for b in data), len(data)) for name, chars in kinds.items()} | {
        "words": math.log1p(n),
        "word_length": math.log1p(mean),
        "length_spread": math.log1p(math.sqrt(max(sum(s * s for s in sizes) / max(n, 1) - mean**2, 0))),
        "repeats": share(sum(a == b for a, b in pairs), max(n - 1, 0)),
        "new_words": share(len(set(own)), n),
        "new_pairs": share(len(set(pairs)), max(n - 1, 0)),
        "packed": math.log((len(zlib.compress(data, 1)) + 1) / (len(data) + 12)),
    }
    return [found[name] for name in quality.STATISTICS]


def plain_scores(rows, labels):
    """Scores of all rows by log densities, with no factor or sum shared between them."""
    stats = np.array([plain_statistics(t or "") for _, t in rows])
    place = {key: i for i, (key, _) in enumerate(rows)}
    train = [(place[k], q) for k, q in labels if k in place and q in (0, 1) and zlib.crc32(str(k).encode()) % 4 != 2]
    groups = [stats[[i for i, q in train if q == c]] for c in (0, 1)]
    spreads = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(s * len(g) for s, g in zip(spreads, groups, strict=True)) / len(train)
    logs = []
    for group, spread in zip(groups, spreads, strict=True):
        cov = 0.9 * spread + 0.1 * np.diag(np.diag(pooled))
        gap = stats - group.mean(axis=0)
        far = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
        logs.append(math.log(len(group) / len(train)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * far)
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


@pytest.fixture(scope="module")
def tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    return docs, labels, items


def test_quality_equals_plain_discriminant(spark, tables):
    docs, labels, _ = tables
    want = plain_scores([d[:2] for d in docs], labels)
    got = {r.doc_id: r for r in queries()["op10_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    for (key, _, _), score in zip(docs, want, strict=True):
        assert got[key].score == pytest.approx(score, abs=1e-6)
        assert got[key].held_out == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert got[key].predicted == int(got[key].score >= 0.7)


def plain_contaminated(text, items):
    own, hit = words(text), set()
    for _, item in items:
        w = words(item)
        size = min(13, len(w))
        runs = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in runs:
                hit |= set(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(own)


def plain_copies(rows):
    """{id: copies} by the mix of the contract."""
    size = {key: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for key, text, _ in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    held = {s: sum(size[k] for k, _, x in rows if x == s) for s in sources}
    target, amount, open_ = {}, 1.5 * sum(held.values()), set(sources)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if amount * weight[s] / total >= 2 * held[s]}
        if not full:
            target |= {s: amount * weight[s] / total for s in open_}
            break
        target |= {s: 2.0 * held[s] for s in full}
        amount -= sum(2 * held[s] for s in full)
        open_ -= full
    copies = {}
    for s in sources:
        each = target[s] / held[s] if held[s] else 0.0
        whole, part = math.floor(each), each - math.floor(each)
        draw = lambda k: (int(hashlib.md5(f"7:{k}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
        before, goal = 0, target[s] - whole * held[s]
        for key in sorted((k for k, _, x in rows if x == s), key=draw):
            copies[key] = whole + (part > 0 and before + size[key] / 2 <= goal)
            before += size[key]
    return copies


def test_pipeline_equals_plain_stages(spark, tables):
    docs, labels, items = tables
    by_id = {d[0]: d for d in docs}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    stages = iter(corpus_pipeline.STAGES)

    def after(name):
        nonlocal frame
        step_name, step = next(stages)
        assert step_name == name
        frame = stage(step(spark, frame, SF), "step")
        return sorted(r.doc_id for r in frame.select("doc_id").collect())

    scores = plain_scores([d[:2] for d in docs], labels)
    kept = [d for d, s in zip(docs, scores, strict=True) if s >= 0.7]
    assert after("quality classifier") == sorted(d[0] for d in kept)
    classes = brute_force([d[:2] for d in kept])
    kept = [by_id[key] for key, c in classes if key == c]
    assert after("near duplicates") == sorted(d[0] for d in kept)
    kept = [d for d in kept if not plain_contaminated(d[1], items)]
    assert after("benchmark decontamination") == sorted(d[0] for d in kept)
    copies = plain_copies(kept)
    mixed = sorted(key for key, n in copies.items() for _ in range(n))
    assert after("source mixing") == mixed

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want, start = [], 0
    for key in mixed:
        ids = [*library.encode(by_id[key][1] or "", add_special_tokens=False).ids, END_ID]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_pipeline_of_odd_and_empty_tables(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    good = [r.text for r in frame.orderBy("doc_id").limit(40).collect()]
    odd = [(None, None, None, None, None), (1, "", "x", None, 0), (1, None, None, "a", None), (2, "...", "x", "a", 3)]
    odd += [(10 + i, t, "en", "a" if i % 2 else None, len(t)) for i, t in enumerate(good)]
    odd += [odd[-1], (None, good[0], "en", "a", 5), (99, good[1] * 40, "en", "b", None)]
    kind = frame.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    docs = spark.createDataFrame(odd, kind)
    docs = docs.select("*", *[F.lit("?").alias(c) for c in ("id", "version", "size", "_v", "label", "row", "node")])
    for table in (docs, docs.limit(0)):
        rows, counts = table, [table.count()]
        for _, step in corpus_pipeline.STAGES[:-1]:
            rows = stage(step(spark, rows, SF), "step")
            assert rows.columns == docs.columns
            counts.append(rows.count())
        last = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
        assert last.count() == counts[-1]
        assert counts[0] >= counts[1] >= counts[2] >= counts[3]
        assert (counts[-1] > 0) == (counts[0] > 0)
        held = Counter(r.doc_id for r in table.collect())
        assert all(key in held for key in {r.doc_id for r in rows.collect()})
