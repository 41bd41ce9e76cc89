"""Text quality by regularised quadratic discriminant analysis."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.words import Words, chunks
from segue.sources.storage import stage

SHRINKAGE = 0.1
THRESHOLD = 0.7

STATISTICS = (
    "words", "word_length", "length_spread", "upper", "digits", "marks", "symbols",
    "calls", "blanks", "lines", "repeats", "new_words", "new_pairs", "packed",
)

# Bytes by kind; all other ASCII characters that are printed are symbols.
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "marks": b".,;:'\"-()",
    "calls": b"!?",
    "blanks": b" \t",
    "lines": b"\n\r",
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
}


def _kind(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(chars)] = 1
    return table


_TABLES = {name: _kind(chars) for name, chars in _KINDS.items()}


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[edges[1:]] - sums[edges[:-1]]


def _distinct(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Different values per text (equal ones only count within a text)."""
    marked = np.unique(values * np.uint64(texts) + owner.astype(np.uint64))
    return np.bincount((marked % np.uint64(texts)).astype(np.int64), minlength=texts)


def text_statistics(words: Words) -> np.ndarray:
    """Transformed statistics of some texts, one row of ``STATISTICS`` each."""
    texts = len(words)
    size = np.diff(words.offsets)
    count = np.diff(words.first)
    length = words.ends - words.starts
    total = _per_text(length, words.first)
    squares = _per_text(length * length, words.first)
    mean = total / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(count, 1) - mean**2, 0))
    owner = np.repeat(np.arange(texts), count)
    repeats, pairs, new_pairs = np.zeros(texts), np.maximum(count - 1, 0), np.zeros(texts)
    if len(owner) > 1:
        together = owner[1:] == owner[:-1]
        same = (words.hashes[1:] == words.hashes[:-1]) & together
        repeats = np.bincount(owner[1:], weights=same, minlength=texts)
        joint = (words.hashes[1:] * np.uint64(0xE7037ED1A0B428DB) + words.hashes[:-1]) >> np.uint64(20)
        new_pairs = _distinct(joint[together], owner[1:][together], texts)
    new_words = _distinct(words.hashes >> np.uint64(20), owner, texts)
    kinds = {n: _per_text(t[words.data], words.offsets) for n, t in _TABLES.items()}
    packed = [
        len(zlib.compress(words.data[a:b], 1))
        for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)
    ]

    def share(part, whole):
        # Log odds, steady near 0 and 1 for short texts.
        return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))

    columns = {
        "words": np.log1p(count),
        "word_length": np.log1p(mean),
        "length_spread": np.log1p(spread),
        "repeats": share(repeats, pairs),
        "new_words": share(new_words, count),
        "new_pairs": share(new_pairs, pairs),
        "packed": np.log((np.array(packed) + 1) / (size + 12)),
    } | {n: share(k, size) for n, k in kinds.items()}
    return np.stack([columns[n] for n in STATISTICS], axis=1)


def document_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, stats) of every whole text, where the rows lie."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, words in chunks(batch.column(1)):
                rows = text_statistics(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array(list(rows), pa.list_(pa.float64())),
                    ],
                    ["id", "stats"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(measure, "id bigint, stats array<double>").withColumnRenamed(
        "id", id_col
    )


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log weights of the two classes.

    None of them if a class had no rows: then every score is 0.5.
    """

    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    offsets: np.ndarray | None = None

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 by the difference of the log densities."""
        if self.means is None:
            return np.full(len(rows), 0.5)
        logs = [
            offset - 0.5 * (((rows - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(stats: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on all labelled rows: ``stats`` (id, stats), ``labels`` (id, label 0 or 1).

    Tasks reduce their rows to counts, sums and products per class, so what
    arrives here has the same size whatever the input. Class covariances are
    shrunk towards the variances of both classes together.
    """
    width = len(STATISTICS)
    key = labels.columns[0]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            label = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(-1, width)
            for c in (0, 1):
                own = rows[label == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        place = np.arange(sums.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums.ravel())], ["place", "v"])

    train = stats.join(labels, key).select(F.col(labels.columns[1]).cast("int").alias("label"), "stats")
    reduced = (
        train.mapInArrow(reduce, "place bigint, v double").groupBy("place").agg(F.sum("v").alias("v"))
    )
    sums = np.zeros(2 * (1 + width + width * width))
    for place, value in reduced.collect():
        sums[place] = value
    sums = sums.reshape(2, -1)
    counts = sums[:, 0]
    if counts.min() < 1:
        return Discriminant()
    means = sums[:, 1 : 1 + width] / counts[:, None]
    second = sums[:, 1 + width :].reshape(2, width, width) / counts[:, None, None]
    spread = second - means[:, :, None] * means[:, None, :]
    pooled = (spread * counts[:, None, None]).sum(axis=0) / counts.sum()
    target = np.diag(np.maximum(np.diag(pooled), 1e-6))
    factors, offsets = [], []
    for c in (0, 1):
        lower = np.linalg.cholesky((1 - shrinkage) * spread[c] + shrinkage * target)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(counts[c] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def held_out(id_col: str) -> Column:
    """A quarter of the ids, by a checksum of their digits. NULL is not in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(id, label) of the rows to learn from: labelled 0 or 1 and not held out."""
    return labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(id_col, label_col)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, held_out, score, predicted), one row per input row.

    Whole texts are turned into statistics once; the model is fitted on all rows
    labelled outside the held-out quarter, and scores follow from the statistics
    alone. A NULL text is scored as an empty one. Labels that are neither 0 nor 1
    and ids that occur on one side only are not learnt from; a document with
    several labels counts once for each. Without rows of both classes all scores
    are 0.5. An empty table gives no rows.
    """
    stats = stage(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, train_labels(labels, id_col, label_col))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(rows), pa.float64())], ["id", "score"]
            )

    scored = stats.select(F.col(id_col).alias("id"), "stats").mapInArrow(
        score, "id bigint, score double"
    )
    return scored.withColumnRenamed("id", id_col).select(
        id_col,
        held_out(id_col).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, where they lie."""
    stats = stage(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, train_labels(labels, id_col, label_col))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = [np.zeros(0)]
        for _, _, words in chunks(pa.Array.from_pandas(texts, type=pa.large_string())):
            found.append(model.score(text_statistics(words)))
        return pd.Series(np.concatenate(found))

    return docs.filter(score(F.col(text_col)) >= threshold)
