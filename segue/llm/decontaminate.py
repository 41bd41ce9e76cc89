"""Benchmark passages in training documents, found with FM-indexes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.llm.fm_index import FmIndex
from segue.llm.names import unused
from segue.llm.words import chunks
from segue.operators.joins import fits_broadcast
from segue.sources.storage import scratch_path, stage

WINDOW = 13
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 17  # words of test items searched for together
BROADCAST_BYTES = 32 << 20  # of test items that are searched for in one round

_INDEX = (
    "shard bigint, doc_ids array<bigint>, versions array<bigint>, doc_words array<bigint>, "
    "size bigint, hashes binary, counts binary, planes array<binary>, marks binary, samples binary"
)
_INDEX_ARROW = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("versions", pa.list_(pa.int64())),
        ("doc_words", pa.list_(pa.int64())),
        ("size", pa.int64()),
        ("hashes", pa.binary()),
        ("counts", pa.binary()),
        ("planes", pa.list_(pa.binary())),
        ("marks", pa.binary()),
        ("samples", pa.binary()),
    ]
)
_FOUND = (
    "shard bigint, place bigint, id bigint, version bigint, n_words bigint, "
    "spans array<struct<first:bigint,past:bigint>>, items array<string>"
)
_FOUND_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("place", pa.int64()),
        ("id", pa.int64()),
        ("version", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def write_index(docs: DataFrame, path: str, id_col: str, text_col: str, shard_words: int) -> None:
    """One FM-index per shard of about ``shard_words`` words, where the rows lie.

    A shard holds whole documents, so a longer one makes a longer shard.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, versions, counts, hashes, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            doc_words = np.concatenate(counts)
            index = FmIndex.build(np.concatenate(hashes), doc_words)
            row = index.dump() | {"doc_ids": ids, "versions": versions, "doc_words": doc_words.tolist()}
            return pa.RecordBatch.from_pylist([row], _INDEX_ARROW)

        for batch in batches:
            for begin, end, words in chunks(batch.column(2)):
                ids += batch.column(0).slice(begin, end - begin).to_pylist()
                versions += batch.column(1).slice(begin, end - begin).to_pylist()
                counts.append(np.diff(words.first))
                hashes.append(words.hashes)
                held += len(words.hashes)
                if held >= shard_words:
                    yield close()
                    ids, versions, counts, hashes, held = [], [], [], [], 0
        if ids:
            yield close()

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text_col).alias("version"),
        F.col(text_col).alias("text"),
    )
    built = rows.mapInArrow(build, _INDEX.removeprefix("shard bigint, "))
    built.select(F.monotonically_increasing_id().alias("shard"), "*").write.option(
        "compression", "zstd"
    ).parquet(path)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(block, item ids, words per item, word hashes) of the test items, and bytes.

    Items without words are left out. Blocks hold about ``BLOCK_WORDS`` words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array([words.hashes[words.of(i)].tobytes() for i in range(len(words))], pa.binary()),
                    ],
                    ["item", "words"],
                )

    cut_items = stage(
        items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
        .mapInArrow(cut, "item string, words binary")
        .filter(F.octet_length("words") > 0)
        .distinct(),
        "items",
    )
    size = cut_items.agg(F.coalesce(F.sum(F.octet_length("words") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (8 * BLOCK_WORDS)))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int").alias("block")
    packed = cut_items.groupBy(block).agg(F.collect_list(F.struct("item", "words")).alias("block_items"))
    return stage(packed, "item-blocks"), size


class _Phrases:
    """The different windows of a block of items, and which items hold them."""

    def __init__(self, items: list[dict], window: int):
        words = [np.frombuffer(i["words"], np.uint64) for i in items]
        self.items = [i["item"] for i in items]
        self.hashes = np.concatenate([*words, np.zeros(1, np.uint64)])
        starts, lengths, owners, seen = [], [], [], {}
        at = 0
        pairs = set()
        for owner, w in enumerate(words):
            length = min(window, len(w))
            for begin in range(len(w) - length + 1):
                number = seen.setdefault(w[begin : begin + length].tobytes(), len(seen))
                if number == len(starts):
                    starts.append(at + begin)
                    lengths.append(length)
                if (number, owner) not in pairs:
                    pairs.add((number, owner))
                    owners.append((number, owner))
            at += len(w)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        owners.sort()
        self.owner = np.array([o for _, o in owners], np.int64)
        self.owner_from = np.searchsorted([n for n, _ in owners], np.arange(len(starts) + 1))


def _expand(first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and the range each comes from."""
    sizes = past - first
    which = np.repeat(np.arange(len(first)), sizes)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return first[which] + inside, which


def _search(row: dict, phrases: _Phrases) -> pa.RecordBatch:
    doc_words = np.array(row["doc_words"], np.int64)
    index = FmIndex.load(row, doc_words)
    phrase, low, high = index.search(
        index.codes(phrases.hashes), phrases.starts, phrases.lengths
    )
    rows, which = _expand(low, high)
    at, phrase = index.locate(rows), phrase[which]
    depth = np.zeros(index.size + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + phrases.lengths[phrase], -1)
    edges = np.diff(np.concatenate([[0], np.cumsum(depth) > 0]).astype(np.int8))
    first, past = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    docs = len(doc_words)
    span_doc = np.searchsorted(index.first, first, side="right") - 1
    spans: list[list] = [[] for _ in range(docs)]
    for d, a, b in zip(span_doc, first, past, strict=True):
        spans[d].append({"first": int(a - index.first[d]), "past": int(b - index.first[d])})
    doc = np.searchsorted(index.first, at, side="right") - 1
    n_phrases = max(1, len(phrases.starts))
    seen = np.unique(doc * n_phrases + phrase)
    owners, which = _expand(phrases.owner_from[seen % n_phrases], phrases.owner_from[seen % n_phrases + 1])
    n_items = max(1, len(phrases.items))
    pairs = np.unique(seen[which] // n_phrases * n_items + phrases.owner[owners])
    items: list[list] = [[] for _ in range(docs)]
    for pair in pairs:
        items[pair // n_items].append(phrases.items[pair % n_items])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row["shard"]] * docs, pa.int64()),
            pa.array(np.arange(docs)),
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(row["versions"], pa.int64()),
            pa.array(doc_words),
            pa.array(spans, _FOUND_ARROW.field("spans").type),
            pa.array(items, pa.list_(pa.string())),
        ],
        schema=_FOUND_ARROW,
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(id, version, n_words, n_hit, spans, items, contaminated), a row per input row.

    A window is ``window`` consecutive words of a test item, or all words of a
    shorter one. ``spans`` are the merged stretches of words of the document that
    lie inside occurrences of windows, ``n_hit`` their words, ``items`` the ids of
    the items whose windows occur, sorted as strings. A document is contaminated
    when at least one in ``share`` of its words is hit.

    Shards of documents are indexed where they lie and written; every block of
    items is then searched in every shard. The items come to the shards, by broadcasts
    of up to ``BROADCAST_BYTES``; more items take more rounds over the written indexes,
    whose rows never move. Words are compared by
    64-bit hashes, so a false hit needs a whole window of agreeing hashes.
    ``version`` (a hash of the text) tells rows with the same id apart.

    A NULL or empty text has no words and no hits. Repeated rows are judged
    alike. Items without words have no windows; one with a NULL id counts as hit
    but is not listed. An empty table gives no rows, and no items give no hits.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "fm-index")
    write_index(docs, path, id_col, text_col, shard_words)
    blocks, size = item_blocks(items, item_col, item_text_col)
    index = spark.read.schema(_INDEX).parquet(path)
    n_blocks = max(1, blocks.count())
    rounds = max(1, -(-size // BROADCAST_BYTES))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, _Phrases] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                [row] = batch.slice(i, 1).to_pylist()
                if row["block"] not in known:
                    known = {row["block"]: _Phrases(row["block_items"] or [], window)}
                yield _search(row, known[row["block"]])

    def searched(part: int) -> DataFrame:
        mine = blocks.filter(F.col("block") % rounds == part)
        # Without items, the shards still give their documents.
        listed = mine.agg(F.collect_list("block").alias("b")).scalar() if size else F.array(F.lit(0))
        placed = index.withColumn("block", F.explode(listed))
        return placed.join(F.broadcast(mine), "block", "left").mapInArrow(search, _FOUND)

    found = reduce(DataFrame.union, map(searched, range(rounds)))
    if n_blocks > 1:
        found = (
            found.groupBy("shard", "place", "id", "version", "n_words")
            .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        )
    merged = F.aggregate(
        F.array_sort("spans"),
        F.lit(None).cast("array<struct<first:bigint,past:bigint>>"),
        lambda done, x: F.when(done.isNull(), F.array(x))
        .when(
            F.element_at(done, -1)["past"] >= x["first"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first"].alias("first"),
                        F.greatest(F.element_at(done, -1)["past"], x["past"]).alias("past"),
                    )
                ),
            ),
        )
        .otherwise(F.concat(done, F.array(x))),
    )
    spans = F.coalesce(merged, F.array().cast("array<struct<first:bigint,past:bigint>>"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["past"] - x["first"])
    return (
        found.withColumn("spans", spans if n_blocks > 1 else F.col("spans"))
        .withColumn("n_hit", hit)
        .select(
            F.col("id").alias(id_col),
            "version",
            "n_words",
            "n_hit",
            "spans",
            F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull()))).alias("items"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean_rows(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    key, mark = unused(docs, "_id", "_version")
    found = contamination(docs, items, id_col, text_col, **options)
    bad = stage(
        found.filter("contaminated").select(F.col(id_col).alias(key), F.col("version").alias(mark)).distinct(),
        "contaminated",
    )
    bad = F.broadcast(bad) if fits_broadcast(bad) else bad.hint("shuffle_hash")
    return docs.join(
        bad,
        F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(mark)),
        "left_anti",
    )
