"""Ranked lexical search: one Aho-Corasick scan of the documents for all items."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from segue.operators.joins import fits_broadcast
from segue.sources.storage import stage

TOP = 50
BLOCK_BYTES = 2 << 20  # terms of items that are searched for in one scan
CHUNK_BYTES = 1 << 20  # text scanned in one go
CHUNK_DOCS = 4096
EXPANDED = 1 << 21  # scores of terms for items that are summed in one go
SPREAD = 64  # parts in which the best of all tasks are merged first
LAST = (1 << 63) - 1

# Bytes of terms, A-Z in lower case; all others become blanks.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_SCAN = "ids array<bigint>, n array<bigint>, docs binary, terms binary, tfs binary, n_docs bigint, n_terms bigint"
_SCAN_ARROW = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("n", pa.list_(pa.int64())),
        ("docs", pa.binary()),
        ("terms", pa.binary()),
        ("tfs", pa.binary()),
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
    ]
)
_BEST_ARROW = pa.schema([("item", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def guarded(text: str) -> bytes:
    """The terms of a text with blanks for all else, and a blank at either end."""
    return b" " + text.encode().translate(_TERM) + b" "


def _segments(data: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A guarded text in parts of bounded size, all guarded; a term is never divided."""
    begin = 0
    while begin < len(data) - 1:
        end = len(data) - 1
        if end - begin > size:
            end = data.index(b" ", begin + size)
        yield data[begin : end + 1]
        begin = end


class ItemTable:
    """The items of a block: their terms, and which items hold a term."""

    def __init__(self, rows: list):
        self.items = np.array([r["item"] for r in rows], np.int64)
        self.terms = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(self.terms)}
        pairs = sorted((number[t], i) for i, r in enumerate(rows) for t in r["terms"])
        self.holders = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(self.terms) + 1))

    def automaton(self) -> ahocorasick.Automaton:
        """Finds ``" term "``, so only whole terms match."""
        found = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            found.add_word(f" {term} ", i)
        found.make_automaton()
        return found


def search_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, bytes), stored: the different terms of each item.

    Equal rows are one item; ``item`` is a hash of the row. Items without terms are
    left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(guarded(t.as_py() or "").decode().split())) for t in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    kind = rows.schema["item_id"].dataType.simpleString()
    return stage(
        rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
        .mapInArrow(cut, f"item bigint, item_id {kind}, terms array<string>")
        .filter(F.size("terms") > 0)
        .withColumn("bytes", F.octet_length(F.array_join("terms", "  ")) + 2),
        "search-items",
    )


def scan(docs: DataFrame, table: ItemTable, id_col: str, text_col: str) -> DataFrame:
    """How often each term of the items occurs in each document, packed and stored.

    A row holds some documents: ``ids``, ``n`` (all their terms), the occurrences
    as (index of the document, term, times), and the sums of ``n > 0`` and ``n``.
    Documents stay where they lie and are read once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        finder, width = table.automaton(), max(1, len(table.terms))
        ids: list[int | None] = []
        lengths: list[int] = []
        waiting: list[tuple[int, bytes]] = []  # (index of the document, part of it)
        held, sums = 0, [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def find() -> None:
            """Reads what waits."""
            nonlocal held
            parts = [p.decode() for _, p in waiting]
            owner = np.array([i for i, _ in waiting], np.int64)
            begins = np.cumsum([0, *map(len, parts)])
            met = np.fromiter(finder.iter("".join(parts)), [("end", np.int64), ("term", np.int64)])
            doc = owner[np.searchsorted(begins, met["end"], side="right") - 1]
            sums.append(np.unique(doc * width + met["term"], return_counts=True))
            data = np.frombuffer(b"".join(p for _, p in waiting), np.uint8)
            # A term begins after a blank; every part begins with one.
            starts = np.zeros(len(data) + 1, np.int64)
            starts[2:] = np.cumsum((data[1:] != 32) & (data[:-1] == 32))
            edges = np.cumsum([0, *(len(p) for _, p in waiting)])
            for i, n in zip(owner.tolist(), (starts[edges[1:]] - starts[edges[:-1]]).tolist(), strict=True):
                lengths[i] += n
            waiting.clear()
            held = 0

        def close() -> pa.RecordBatch:
            find()
            keys, times = (np.concatenate(x) for x in zip(*sums, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            times = np.add.reduceat(times, at) if len(at) else times
            row = {
                "ids": ids,
                "n": lengths,
                "docs": (keys[at] // width).astype("<i4").tobytes(),
                "terms": (keys[at] % width).astype("<i4").tobytes(),
                "tfs": times.astype("<i8").tobytes(),
                "n_docs": sum(n > 0 for n in lengths),
                "n_terms": sum(lengths),
            }
            return pa.RecordBatch.from_pylist([row], _SCAN_ARROW)

        read = 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(key.as_py())
                lengths.append(0)
                for part in _segments(guarded(text.as_py() or "")):
                    waiting.append((len(ids) - 1, part))
                    held += len(part)
                    read += len(part)
                    if held >= CHUNK_BYTES:
                        find()
                if read >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    yield close()
                    ids, lengths, read = [], [], 0
                    sums = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stage(rows.mapInArrow(count, _SCAN), "search-scan")


def document_frequencies(scanned: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each of the ``terms`` terms of a block occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(terms, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                sums += np.bincount(np.frombuffer(packed.as_py(), "<i4"), minlength=terms)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(sums[met])], ["term", "n"])

    counted = scanned.select("terms").mapInArrow(count, "term bigint, n bigint")
    found = np.zeros(terms, np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        found[row["term"]] = row["n"]
    return found


class _Best:
    """The best documents of each item so far, ``k`` of them at most."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.bar = np.ones(items, np.int64)
        self.rows = np.zeros((4, 0), np.int64)  # item, score, whether the id is NULL, id

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([item, score, null, ids])], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(len(self.bar) + 1))
        place = np.arange(rows.shape[1]) - first[rows[0]]
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.bar[full] = rows[1][first[full] + self.k - 1]
        self.rows = rows[:, place < self.k]


def _rank(scanned: DataFrame, table: ItemTable, weights: np.ndarray, documents: int, words: int, k: int) -> DataFrame:
    """(item, id, score): of every task, the best documents of each item."""
    shared = scanned.sparkSession.sparkContext.broadcast((table, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = shared.value
        items = len(table.items)
        best = _Best(items, k)
        held = np.diff(table.first)
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                n = np.array(row["n"], np.int64)
                null = np.array([i is None for i in row["ids"]], np.int64)
                ids = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
                doc = np.frombuffer(row["docs"], "<i4").astype(np.int64)
                term = np.frombuffer(row["terms"], "<i4").astype(np.int64)
                tf = np.frombuffer(row["tfs"], "<i8")
                # fixed values: the score's constants
                m = 100 - 50 + (50 * n * documents) // words
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                step = max(1, EXPANDED // items)
                for begin in range(0, len(ids), step):
                    few = min(step, len(ids) - begin)
                    sums = np.zeros(few * items, np.int64)
                    low, high = np.searchsorted(doc, [begin, begin + few])
                    ends = np.cumsum(held[term[low:high]])
                    while low < high:
                        done = ends[0] - held[term[low]]
                        take = max(1, int(np.searchsorted(ends - done, EXPANDED, side="right")))
                        part, sizes = slice(low, low + take), held[term[low : low + take]]
                        which = np.repeat(np.arange(take), sizes)
                        inside = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                        holder = table.holders[table.first[term[part]][which] + inside]
                        np.add.at(sums, (doc[part][which] - begin) * items + holder, gain[part][which])
                        low, ends = low + take, ends[take:]
                    sums = sums.reshape(few, items)
                    where, item = np.nonzero(sums >= best.bar)
                    if len(where):
                        best.add(item, sums[where, item], null[begin + where], ids[begin + where])
        item, scores, null, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(table.items[item]), pa.array(ids, mask=null.astype(bool)), pa.array(scores)], schema=_BEST_ARROW
        )

    return scanned.select("ids", "n", "docs", "terms", "tfs").mapInArrow(score, "item bigint, id bigint, score bigint")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of every item.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in
    lower case. With N documents that have terms, L their terms, n the terms of a
    document, df the documents with a term and tf its times in the document, the
    score is the sum over the different terms of an item of w * ((10^9 tf) div (1000
    tf + 20 m)), with w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 50 + (50 n N)
    div L. Documents with a score above 0 are ranked by score, then id.

    An automaton of all terms of the items, each between blanks, reads every whole
    text once, where it lies; its outputs are the terms, and those are mapped to
    the items that hold them. What it counts is stored packed, so frequencies and
    scores need no second scan. Every task keeps the best documents of each item,
    and those are merged in two steps. Items whose terms take more than
    ``block_bytes`` in all are searched for in several scans, so what is broadcast
    is bounded (but for one item that is longer).

    A NULL or empty text has no terms and is no result. Documents with a NULL id
    come after others of the same score. Repeated documents are several results.
    Equal items give one list, different texts under one item id a list each, and
    items without terms none. A very long text is scanned in parts. Other
    columns play no part. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = search_items(items, item_col, item_text_col)
    size = asked.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // block_bytes)
    found, totals = None, None
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item", F.lit(1)), F.lit(blocks)) == block)
        table = ItemTable(mine.select("item", "terms").collect())
        if not len(table.items):
            continue
        scanned = scan(docs, table, id_col, text_col)
        if totals is None:
            totals = scanned.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        documents, words = totals
        if not documents:
            break
        df = document_frequencies(scanned, len(table.terms))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        best = _rank(scanned, table, weights, documents, words, k)
        found = best if found is None else found.union(best)
    item_id = asked.schema["item_id"]
    if found is None:
        kinds = [item_id, StructField("rank", LongType()), StructField(id_col, LongType()), StructField("score", LongType())]
        return spark.createDataFrame([], StructType(kinds)).withColumn("rank", F.col("rank").cast("int"))
    falling = [F.desc("score"), F.col("id").asc_nulls_last()]
    rank = lambda *keys: F.row_number().over(W.partitionBy(*keys).orderBy(*falling))
    near = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    near = near.withColumn("rank", rank("item", "part")).filter(F.col("rank") <= k)
    merged = near.withColumn("rank", rank("item")).filter(F.col("rank") <= k)
    names = asked.select("item", "item_id")
    names = F.broadcast(names) if fits_broadcast(names) else names
    return merged.join(names, "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
