"""Near duplicates by consistent weighted sampling of TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segue.llm.components import components
from segue.llm.names import unused
from segue.llm.words import Words, all_words, chunks, mix, shingles
from segue.operators.joins import fits_broadcast, spread_join
from segue.sources.storage import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 18, 4
SAMPLES = BANDS * ROWS
# Members of a bucket that are not connected yet get a longer signature, a byte per
# sample. At a similarity of 0.8, 410 of 512 samples agree with a standard deviation
# of 9, so fewer than this many agree once in about 50,000 cases.
LONG_SAMPLES = 512
LIKELY = 373
LEAST_IDF = 1.8  # in all documents; so near 2 that a group's size hardly moves the limit
FREQUENT = 2.5e-7  # documents per byte of text from which a shingle has its own weight
BLOCK = 512  # members of a bucket compared in one go
BLOCK_BYTES = 16 << 20  # and their shingles
FLUSH = 1 << 21  # shingles a task gathers before it passes them on

BATCH_ROWS = 256  # rows with their shingles that go to Python in one go
PAIRS = 64  # pairs of texts compared in one go

_ID_BITS = 44  # of a shingle's hash
_TABLE_BITS = 16
_GAP = 1 << 32


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Draws of the sampling scheme: r and c from Gamma(2, 1), beta from U(0, 1)."""
    random = np.random.Generator(np.random.PCG64(20240229))
    n = 1 << _TABLE_BITS
    r, c = random.gamma(2, 1, n), random.gamma(2, 1, n)
    beta = random.random(n)
    factors = random.integers(0, 1 << 63, SAMPLES + LONG_SAMPLES, dtype=np.uint64)
    return r, np.log(c), beta, factors * np.uint64(2) + np.uint64(1)


_R, _LOG_C, _BETA, _FACTORS = _tables()


def _sample(log_weight, at: np.ndarray) -> np.ndarray:
    """What elements of some weights offer, as numbers to take the smallest of.

    The upper half orders by ln a = ln c - r (t - beta) - r with t = floor(ln w / r
    + beta), the lower half tells different t apart. Elements of the same weight
    make the same offer in every document, and the smallest one is an element
    with probability proportional to its weight.
    """
    r, beta = _R[at], _BETA[at]
    t = np.floor(log_weight / r + beta)
    log_a = (_LOG_C[at] - r * (t - beta) - r).astype(np.float32)
    bits = log_a.view(np.uint32)
    ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
    step = mix(t.astype(np.int64).view(np.uint64)) >> np.uint64(32)
    return ordered << np.uint64(32) | step


_USUAL = _sample(np.full(1 << _TABLE_BITS, np.log(2.0)), np.arange(1 << _TABLE_BITS))


def _sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text index and shingle in one number, times) of the shingles of some texts."""
    hashes, owner = shingles(words, SHINGLE)
    keys = owner.astype(np.uint64) << np.uint64(_ID_BITS) | hashes >> np.uint64(64 - _ID_BITS)
    keys.sort()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    return keys[at], np.diff(np.append(at, len(keys)))


_ID_MASK = np.uint64((1 << _ID_BITS) - 1)


class Weights:
    """TF-IDF weights: times, by ``LEAST_IDF`` for a shingle of all documents up to 2.

    2 holds for shingles below ``floor`` documents. The others come with their
    numbers of documents.
    """

    def __init__(self, documents: int, floor: float, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = ids[order], counts[order]
        scale = np.log(documents / floor) if documents > floor else 0.0
        if scale > 0:
            rare = np.clip(np.log(documents / counts) / scale, 0, 1)
            self.idf = LEAST_IDF + (2 - LEAST_IDF) * rare
        else:
            self.idf = np.full(len(counts), 2.0)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.ids >> np.uint64(_ID_BITS - 20)).astype(np.int64)] = True

    def idfs(self, ids: np.ndarray) -> np.ndarray:
        found = np.full(len(ids), 2.0)
        if len(self.ids):
            likely = np.flatnonzero(self.maybe[(ids >> np.uint64(_ID_BITS - 20)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.ids, ids[likely]), len(self.ids) - 1)
            same = self.ids[at] == ids[likely]
            found[likely[same]] = self.idf[at[same]]
        return found


def _signatures(
    words: Words,
    weights: Weights,
    factors: np.ndarray = _FACTORS[:SAMPLES],
    sets: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(samples, whether there are any) of some texts, one sample per factor."""
    keys, times = _sets(words) if sets is None else sets
    owner = (keys >> np.uint64(_ID_BITS)).astype(np.int64)
    ids = keys & _ID_MASK
    idf = weights.idfs(ids)
    special = np.flatnonzero((times > 1) | (idf != 2.0))
    log_weight = np.log(times[special] * idf[special])
    counts = np.bincount(owner, minlength=len(words))
    filled = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[filled]
    low = ids & np.uint64(0xFFFFFFFF)
    found = np.zeros((len(words), len(factors)), np.uint32)
    shift = np.uint64(64 - _TABLE_BITS)
    for k in range(len(factors) if len(filled) else 0):
        at = (ids * factors[k] >> shift).astype(np.int64)
        offers = _USUAL[at]
        offers[special] = _sample(log_weight, at[special])
        offers ^= low
        found[filled, k] = np.minimum.reduceat(offers, starts).astype(np.uint32)
    return found, counts > 0


def _band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0xE7037ED1A0B428DB) + rows[:, :, r])
    return keys


def frequent_shingles(docs: DataFrame, text_col: str) -> Weights:
    """Document frequencies over all documents, exact for the frequent shingles.

    Tasks sort what they hold and send it as packed differences, one row per
    bucket of the hash space; a bucket's sums leave only shingles that make up
    ``floor`` documents, ``FREQUENT`` of all bytes at least. As a word and what
    follows it take two bytes, there can be no more than 1 / (2 ``FREQUENT``) of
    those (32 MB), so they may come together. The number of buckets follows the
    number of shuffle partitions.
    """
    spark = docs.sparkSession
    documents, size = docs.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))
    ).first()
    floor = max(2.0, FREQUENT * size)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = -(-(1 << _ID_BITS) // buckets)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            ids, counts = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(ids, np.arange(1, buckets, dtype=np.uint64) * np.uint64(width))
            rows = []
            for b, (i, c) in enumerate(zip(np.split(ids, edges), np.split(counts, edges), strict=True)):
                if len(i):
                    gaps = np.diff(i, prepend=np.uint64(b * width))
                    narrow = gaps.max() < _GAP
                    again = np.flatnonzero(c > 1)
                    rows.append(
                        {
                            "bucket": b,
                            "gaps": gaps.astype(np.uint32 if narrow else np.uint64).tobytes(),
                            "narrow": bool(narrow),
                            "again": again.astype(np.uint32).tobytes(),
                            "more": c[again].astype(np.uint32).tobytes(),
                        }
                    )
            return pa.RecordBatch.from_pylist(rows, gathered)

        for batch in batches:
            for _, _, words in chunks(batch.column(0)):
                held.append(_sets(words)[0] & _ID_MASK)
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    gathered = pa.schema(
        [("bucket", pa.int32()), ("gaps", pa.binary()), ("narrow", pa.bool_()), ("again", pa.binary()), ("more", pa.binary())]
    )
    found = docs.select(text_col).mapInArrow(
        gather, "bucket int, gaps binary, narrow boolean, again binary, more binary"
    )

    def count(table: pa.Table) -> pa.Table:
        ids, counts = [], []
        for row in table.to_pylist():
            gaps = np.frombuffer(row["gaps"], np.uint32 if row["narrow"] else np.uint64)
            ids.append(np.cumsum(gaps, dtype=np.uint64) + np.uint64(row["bucket"] * width))
            own = np.ones(len(gaps), np.int64)
            own[np.frombuffer(row["again"], np.uint32)] = np.frombuffer(row["more"], np.uint32)
            counts.append(own)
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        order = np.argsort(ids, kind="stable")
        ids, counts = ids[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        sums = np.add.reduceat(counts, at)
        kept = sums >= floor
        return pa.table({"ids": [ids[at][kept].tobytes()], "counts": [sums[kept].tobytes()]})

    frequent = (
        found.groupBy("bucket")
        .applyInArrow(count, "ids binary, counts binary")
        .filter(F.octet_length("ids") > 0)
        .collect()
    )
    ids = np.frombuffer(b"".join(r["ids"] for r in frequent), np.uint64)
    counts = np.frombuffer(b"".join(r["counts"] for r in frequent), np.int64)
    return Weights(documents, floor, ids, counts)


def _sign(rows: DataFrame, weights: Weights) -> DataFrame:
    """(id, v1, bands) of every row of (id, v1, text)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in chunks(batch.column(2)):
                samples, filled = _signatures(words, weights)
                keys = _band_keys(samples).view(np.int64)
                bands = [k if f else [] for k, f in zip(keys, filled, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["id", "v1", "bands"],
                )

    return rows.mapInArrow(sign, "id bigint, v1 bigint, bands array<bigint>")


def _sign_long(texts: DataFrame, weights: Weights) -> DataFrame:
    """(node, samples, shingles, times) of (node, text), packed.

    ``LONG_SAMPLES`` bytes of samples, and the shingles with the times they occur.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in chunks(batch.column(1)):
                keys, times = _sets(words)
                samples, _ = _signatures(words, weights, _FACTORS[SAMPLES:], (keys, times))
                edges = np.searchsorted(keys >> np.uint64(_ID_BITS), np.arange(1, len(words), dtype=np.uint64))
                columns = [
                    [s.tobytes() for s in samples.astype(np.uint8)],
                    [k.tobytes() for k in np.split(keys & _ID_MASK, edges)],
                    [t.astype("<u4").tobytes() for t in np.split(times, edges)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *(pa.array(c, pa.binary()) for c in columns)],
                    ["node", "samples", "shingles", "times"],
                )

    return texts.mapInArrow(sign, "node bigint, samples binary, shingles binary, times binary")


def _similar(pairs: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """(a, b) of those (a, b, text_a, text_b) whose weighted Jaccard similarity suffices."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PAIRS):
                part = batch.slice(begin, PAIRS)
                left, right = all_words(part.column(2)), all_words(part.column(3))
                kept = pa.array(_overlap(left, right, weights) >= similarity)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(kept), part.column(1).filter(kept)], ["a", "b"]
                )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint")


def _overlap(left: Words, right: Words, weights: Weights) -> np.ndarray:
    """Weighted Jaccard similarities of texts, one by one."""
    texts = len(left)
    (lk, lt), (rk, rt) = _sets(left), _sets(right)
    lw, rw = lt * weights.idfs(lk & _ID_MASK), rt * weights.idfs(rk & _ID_MASK)
    owner = lambda keys: (keys >> np.uint64(_ID_BITS)).astype(np.int64)
    common, i, j = np.intersect1d(lk, rk, assume_unique=True, return_indices=True)
    both = np.bincount(owner(common), np.minimum(lw[i], rw[j]), texts)
    all_ = np.bincount(owner(lk), lw, texts) + np.bincount(owner(rk), rw, texts) - both
    return np.where(all_ > 0, both / np.maximum(all_, 1e-300), 0.0)


def _verified(
    pairs: DataFrame, rows: DataFrame, nodes: DataFrame, weights: Weights, similarity: float, name: str
) -> DataFrame:
    """Those of the (stored) pairs (a, b) of nodes that are similar enough."""
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    texts = _texts(asked, rows, nodes, name)
    joined = pairs.join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    ).join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return stage(_similar(joined, weights, similarity), f"{name}-edges")


def _texts(asked: DataFrame, rows: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """(node, text) of the nodes in ``asked``, each from its first row."""
    asked = stage(asked.distinct().join(nodes.select("node", "first_id"), "node"), f"{name}-nodes")
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked.hint("shuffle_hash")
    found = rows.select(F.col("v1").alias("node"), _order_id().alias("first_id"), "text")
    found = found.join(asked, ["node", "first_id"], "left_semi").select("node", "text")
    return stage(found.dropDuplicates(["node"]), f"{name}-texts")


def _order_id():
    """The id, for choosing the smallest; NULL comes last."""
    return F.coalesce("id", F.lit((1 << 63) - 1))


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows, for jobs whose rows are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, held)


class _Bags:
    """The weighted shingles of some texts, for exact similarities of one to many."""

    def __init__(self, shingles: list[bytes], times: list[bytes], weights: Weights):
        sizes = np.array([len(b) // 8 for b in shingles], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.frombuffer(b"".join(shingles), np.uint64)
        self.weight = np.frombuffer(b"".join(times), "<u4") * weights.idfs(ids)
        names, self.place = np.unique(ids, return_inverse=True)
        self.row = np.zeros(len(names))
        sums = np.concatenate([[0.0], np.cumsum(self.weight)])
        self.total = sums[self.first[1:]] - sums[self.first[:-1]]

    def similarity(self, x: int, others: np.ndarray) -> np.ndarray:
        own = slice(self.first[x], self.first[x + 1])
        self.row[self.place[own]] = self.weight[own]
        sizes = self.first[others + 1] - self.first[others]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(self.first[others] - starts, sizes) + np.arange(sizes.sum())
        both = np.add.reduceat(np.minimum(self.row[self.place[at]], self.weight[at]), starts)
        self.row[self.place[own]] = 0.0
        return both / (self.total[x] + self.total[others] - both)


def _links(comps: np.ndarray, samples: np.ndarray, bags: _Bags, similarity: float) -> list[tuple[int, int]]:
    """Pairs that are similar enough, as many as connect what such pairs connect.

    Members of components not reached yet are compared with the next one, first by
    samples and the likely ones exactly. A pair more for each component
    that is reached is kept, so there are fewer pairs than members.
    """
    links: list[tuple[int, int]] = []
    left = np.arange(len(comps))
    while len(left) > 1:
        inside = comps[left] == comps[left[0]]
        queue, left, at = left[inside].tolist(), left[~inside], 0
        while at < len(queue) and len(left):
            x = queue[at]
            at += 1
            likely = left[(samples[left] == samples[x]).sum(axis=1) >= LIKELY]
            if not len(likely):
                continue
            reached = likely[bags.similarity(x, likely) >= similarity]
            if not len(reached):
                continue
            names, first = np.unique(comps[reached], return_index=True)
            links += [(x, int(y)) for y in reached[first]]
            gone = np.isin(comps[left], names)
            queue += left[gone].tolist()
            left = left[~gone]
    return links


def _block_links(members: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """Links (a, b) that connect components inside the buckets, verified in place.

    ``members`` (stored) is (h, node, comp, samples, shingles, times) of buckets with
    several components. Buckets are cut into blocks of about ``BLOCK`` members and
    ``BLOCK_BYTES``: large components into blocks of their own, the others together.
    Blocks of the same bucket meet, except two of one component, so a bucket that is
    nearly all one component costs no more than its size times the rest. Only
    links that connect components leave a task, never all pairs of a bucket.
    """
    volume = F.octet_length("shingles")
    sizes = members.groupBy("h", "comp").agg(F.count("*").alias("n"), F.sum(volume).alias("bytes"))
    blocks_of = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1))
    sizes = sizes.withColumn("pieces", blocks_of(F.col("n"), F.col("bytes")))
    rest = (
        sizes.filter("pieces = 1")
        .groupBy("h")
        .agg(blocks_of(F.sum("n"), F.sum("bytes")).alias("rest"))
    )
    sizes = stage(sizes.join(rest, "h", "left"), "bucket-sizes")
    large = F.col("pieces") > 1
    piece = F.when(large, F.pmod(F.xxhash64("node"), "pieces")).otherwise(F.pmod(F.xxhash64("comp", "h"), "rest"))
    placed = stage(
        members.join(sizes, ["h", "comp"]).select(
            "h", "node", "comp", "samples", "shingles", "times",
            F.when(large, F.col("comp")).alias("pure"),
            F.xxhash64(F.when(large, F.col("comp")), piece).alias("block"),
        ),
        "bucket-blocks",
    )
    blocks = stage(placed.select("h", "block", "pure").distinct(), "blocks")
    meets = (
        blocks.alias("x")
        .join(blocks.alias("y"), "h")
        .filter("x.block <= y.block and (x.pure is null or y.pure is null or x.pure <> y.pure)")
        .select("h", F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    )
    sides = meets.select("h", F.col("i").alias("block"), "i", "j").union(
        meets.filter("i <> j").select("h", F.col("j").alias("block"), "i", "j")
    )
    rows = placed.join(sides, ["h", "block"]).select("h", "i", "j", "node", "comp", "samples", "shingles", "times")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy() for c in ("h", "i", "j")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            found = [[], []]
            for begin, end in zip([0, *edges], [*edges, table.num_rows], strict=True):
                unit = table.slice(begin, end - begin)
                nodes, comps = unit.column("node").to_numpy(), unit.column("comp").to_numpy()
                if len(nodes) < 2 or (comps == comps[0]).all():
                    continue
                samples = np.frombuffer(b"".join(unit.column("samples").to_pylist()), np.uint8)
                bags = _Bags(unit.column("shingles").to_pylist(), unit.column("times").to_pylist(), weights)
                for x, y in _links(comps, samples.reshape(-1, LONG_SAMPLES), bags, similarity):
                    found[0].append(min(nodes[x], nodes[y]))
                    found[1].append(max(nodes[x], nodes[y]))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            # The last unit may go on in the next batch.
            keys = np.stack([table.column(c).to_numpy() for c in ("h", "i", "j")])
            others = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield links(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield links(held)

    dealt = rows.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, version, class_id, class_texts, stays), one row per input row.

    Texts are sets of runs of five words, weighted by times and inverse document
    frequency; two are near duplicates from a weighted Jaccard similarity of
    ``similarity``, and classes are what such links connect. ``class_id`` is the
    smallest id of the class, ``class_texts`` its number of different texts, and
    ``stays`` marks the row with that id. ``version`` is a 64-bit hash of the text,
    by which texts are known here.

    * All texts are signed where they lie, by ``SAMPLES`` improved consistent
      weighted samples; equal texts are one node from then on.
    * Bands of ``ROWS`` samples make buckets. A pair at the similarity limit
      shares none of ``BANDS`` bands once in about 13,000 cases.
    * In every bucket all members are compared with the smallest one, exactly.
      Of buckets whose others are still in several components after that, blocks of
      members meet, with their packed shingles. Members of different components are
      compared by longer signatures, and the likely ones exactly, until no more
      components can be connected. So each pair of a bucket is either in one
      component already or was compared. Buckets of the same members are one.

    A NULL text counts as empty. Texts without words only match equal ones, and
    texts of one to four words are one shingle. A NULL id has no part in the
    choice of the class id, unless the class has no other; then it is a hash.
    Repeated rows are in one class. An empty table gives no rows.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(whole).alias("v1"),
        whole.alias("text"),
    )
    weights = frequent_shingles(rows, "text")
    signed = stage(_sign(rows, weights), "signed")
    nodes = stage(
        signed.groupBy("v1")
        .agg(
            F.min(_order_id()).alias("first_id"),
            F.count("*").alias("n"),
            F.first("bands").alias("bands"),
        )
        .withColumnRenamed("v1", "node"),
        "nodes",
    )
    placed = nodes.select("node", F.explode("bands").alias("h"))
    buckets = placed.groupBy("h").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
    members = stage(
        placed.join(stage(buckets.filter("n > 1").drop("n"), "buckets"), "h"), "members"
    )
    stars = members.filter("node <> lead").select(
        F.col("lead").alias("a"), F.col("node").alias("b")
    )
    tested = stage(stars.distinct(), "stars")
    edges = _verified(tested, rows, nodes, weights, similarity, "star")
    labels = components(edges)
    # Every member was compared with the smallest one of its bucket, so only the
    # others can still need a link.
    labelled = stage(
        members.filter("node <> lead").select("h", "node")
        .join(labels, "node", "left")
        .select("h", "node", F.coalesce("label", "node").alias("comp")),
        "labelled",
    )
    several = (
        labelled.groupBy("h")
        .agg(
            F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("of"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("of2"),
        )
        .filter("x <> y")
        .groupBy("n", "of", "of2")
        .agg(F.min("h").alias("h"))
    )
    open_ = stage(labelled.join(several.select("h"), "h", "left_semi"), "open")
    texts = _texts(open_.select("node"), rows, nodes, "open")
    with _batches(docs.sparkSession, BATCH_ROWS):
        shown = stage(open_.join(stage(_sign_long(texts, weights), "signatures"), "node"), "open-members")
        more = stage(_block_links(shown, weights, similarity), "unlike-edges")
    if not more.isEmpty():
        labels = components(edges.union(more))
    labelled = stage(
        nodes.join(labels, "node", "left").select(
            F.col("node").alias("v1"), "first_id", "n", F.coalesce("label", "node").alias("label")
        ),
        "node-labels",
    )
    classes = labelled.groupBy("label").agg(
        F.min(F.struct("first_id", "v1")).alias("keeper"), F.count("*").alias("class_texts")
    )
    known = stage(labelled.join(classes, "label"), "classes")
    keeper = F.col("keeper.first_id")
    return spread_join(
        signed.select("id", "v1"),
        known.select("v1", "keeper", "class_texts"),
        ["v1"],
        counts=known.select("v1", "n"),
    ).select(
        F.col("id").alias(id_col),
        F.col("v1").alias("version"),
        F.when(keeper < (1 << 63) - 1, keeper).otherwise(F.col("keeper.v1")).alias("class_id"),
        "class_texts",
        ((_order_id() == keeper) & (F.col("v1") == F.col("keeper.v1"))).alias("stays"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row of ``docs`` of every class: the one with the smallest id.

    Rows that must go are listed by id and hash of the text.
    """
    key, mark = unused(docs, "_id", "_version")
    found = stage(near_duplicates(docs, id_col, text_col, **options), "near-duplicates")
    gone = stage(
        found.filter("not stays").select(F.col(id_col).alias(key), F.col("version").alias(mark)).distinct(),
        "gone",
    )
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone.hint("shuffle_hash")
    version = F.xxhash64(F.coalesce(text_col, F.lit("")))
    kept = docs.join(gone, F.col(id_col).eqNullSafe(F.col(key)) & (version == F.col(mark)), "left_anti")
    repeated = found.filter("stays").groupBy(id_col, "version").count().filter("count > 1")
    if repeated.isEmpty():
        return kept
    # By the hash, as a NULL and an empty text of one id are the same.
    return kept.withColumn(mark, version).dropDuplicates([id_col, mark]).drop(mark)
