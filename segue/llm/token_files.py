"""Token ids in files of wavelet matrices."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.llm.prefix_tokens import _COMMON, LIBRARY_SPACE, _Cache, byte_symbols
from segue.llm.wavelet import WaveletMatrix
from segue.sources.storage import stage

SHARD_TOKENS = 1 << 19
CHUNK_CHARS = 1 << 22  # text encoded in one go
CACHED = 900_000  # pieces and words a worker keeps

_FILE = (
    "part int, shard int, n_tokens bigint, symbols binary, doc_ids array<bigint>, "
    "doc_tokens array<bigint>, planes array<binary>"
)
_ID = attrgetter("id")
_WORD = re.compile(f"[^{LIBRARY_SPACE}]+")
# The vocabulary's pattern, for lower-case text of Latin-1 letters and ASCII alone.
_LOWER = "a-zß-öø-ÿ"
_COMMON_PIECE = re.compile(
    f"[{_LOWER}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^{_LOWER}0-9\\t-\\r ]+"
)
# Lower-case text with only points and commas, all at ends of words.
_PLAIN = re.compile(f"(?:[{_LOWER} \\n]++|[.,](?![^ \\n]))*+")


def _spaced(lower: str) -> str:
    """A plain text with blanks between all its pieces."""
    return lower.replace(",", " ,").replace(".", " .")


class WordEncoder:
    """Ids of whole texts for a vocabulary that drops white space.

    White space ends all pieces, so ids of a text are those of its words in a
    row. What the library gives is kept in a cache of bounded size: for texts of
    Latin-1 letters and ASCII by pieces of the pattern, for others by words. Texts
    with special strings go to the library whole. ``encode_all`` looks up the
    different pieces of many plain texts once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # A piece comes here once, so the model's own cache only takes time.
        self.model = self.library.model
        self.model._resize_cache(0)
        self.levels = max(1, (self.library.get_vocab_size() - 1).bit_length())
        self.kind = np.uint16 if self.levels <= 16 else np.uint32
        self.code = "H" if self.levels <= 16 else "I"
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = special
        self.pieces = _Cache(self._piece)
        self.words = _Cache(self._encode)

    def _ids(self, ids: Iterable[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._ids(map(_ID, self.model.tokenize(byte_symbols(piece))))

    def _encode(self, text: str) -> bytes:
        return self._ids(self.library.encode(text, add_special_tokens=False).ids)

    def _trim(self) -> None:
        """Forgets the later half of a full cache; frequent pieces are met early."""
        for cache in (self.words, self.pieces):
            if len(cache) > CACHED:
                early = dict(islice(cache.items(), CACHED // 2))
                cache.clear()
                cache.update(early)

    def encode(self, text: str) -> bytes:
        self._trim()
        if any(s in text for s in self.special):
            return self._encode(text)
        if _COMMON.fullmatch(text):
            lower = text.lower()
            pieces = _spaced(lower).split() if _PLAIN.fullmatch(lower) else _COMMON_PIECE.findall(lower)
            return b"".join(map(self.pieces.__getitem__, pieces))
        return b"".join(map(self.words.__getitem__, _WORD.findall(text)))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list[np.ndarray] = [np.zeros(0, self.kind)] * len(texts)
        plain, spaced = [], []
        for i, text in enumerate(texts):
            lower = text.lower()
            # Special strings hold signs that plain texts do not.
            if _PLAIN.fullmatch(lower) and _COMMON.fullmatch(text):
                plain.append(i)
                spaced.append(_spaced(lower))
            else:
                found[i] = np.frombuffer(self.encode(text), self.kind)
        self._trim()
        if plain:
            for i, ids in zip(plain, self._take(spaced), strict=True):
                found[i] = ids
        return found

    def _take(self, spaced: list[str]) -> list[np.ndarray]:
        """The ids of texts whose pieces stand between blanks."""
        split = pc.ascii_split_whitespace(pa.array(spaced, pa.large_string()))
        met = split.flatten().dictionary_encode()
        names = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [self.pieces[p] if p else b"" for p in names]
        sizes = np.array([len(k) for k in known], np.int64) // self.kind().itemsize
        table = np.frombuffer(b"".join(known), self.kind)
        piece = met.indices.to_numpy()
        length = sizes[piece]
        ends = np.cumsum(length)
        at = np.repeat((np.cumsum(sizes) - sizes)[piece] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.asarray(split.offsets) - split.offsets[0].as_py()
        return np.split(table[at], np.concatenate([[0], ends])[offsets[1:-1]])


_encoders: dict[str, WordEncoder] = {}  # of this worker


def _text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of rows of (id, text), in lists of bounded size."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(doc.as_py())
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode all texts and write them to ``path`` in ascending order of ids.

    Texts are put in order by range partitions, and each task cuts its part into
    shards of about ``shard_tokens`` tokens (a longer document is one shard). A
    shard is one row of a compressed Parquet file: its documents with their
    numbers of tokens, the ids it holds by falling frequency, and the bit planes
    of a wavelet matrix over their places in that list. ``end_id`` follows every document.

    A NULL text is an empty one and has the end id alone. Rows with a NULL id
    come last; rows with the same id follow each other, ordered by a hash of the
    text. An empty table gives a file without rows.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer) or WordEncoder(tokenizer)
        _encoders[tokenizer] = encoder
        end = np.array([end_id], encoder.kind)
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        pieces: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            values = np.concatenate([x for p in pieces for x in (p, end)])
            # Frequent ids get small codes: few planes, and mostly zeros in the first.
            counts = np.bincount(values)
            symbols = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
            codes = np.zeros(len(counts), encoder.kind)
            codes[symbols] = np.arange(len(symbols))
            levels = max(1, (len(symbols) - 1).bit_length())
            planes = WaveletMatrix.build(codes[values], levels).dump()
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "shard": number,
                        "n_tokens": len(values),
                        "symbols": symbols.astype("<u4").tobytes(),
                        "doc_ids": ids,
                        "doc_tokens": [len(p) + 1 for p in pieces],
                        "planes": planes,
                    }
                ],
                schema,
            )

        for docs, texts in _text_chunks(batches):
            for doc, encoded in zip(docs, encoder.encode_all(texts), strict=True):
                ids.append(doc)
                pieces.append(encoded)
                held += len(encoded) + 1
                if held >= shard_tokens:
                    yield close()
                    ids, pieces, held, number = [], [], 0, number + 1
        if ids:
            yield close()

    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("shard", pa.int32()),
            ("n_tokens", pa.int64()),
            ("symbols", pa.binary()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_tokens", pa.list_(pa.int64())),
            ("planes", pa.list_(pa.binary())),
        ]
    )
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("version", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_last(), F.col("version")]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
        .mapInArrow(shards, _FILE)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files.

    ``start`` counts the ids of all documents before it. Shards are decoded where
    they lie; their starts follow from the token counts alone, per part and then
    over the parts.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                matrix = WaveletMatrix.load(one["planes"], one["n_tokens"])
                symbols = np.frombuffer(one["symbols"], "<u4")
                ids = symbols[matrix.decode(np.uint16 if len(symbols) <= 1 << 16 else np.uint32)]
                counts = one["doc_tokens"]
                ends = np.cumsum(counts)
                starts = ends - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"], pa.int64()),
                        pa.array([one["part"]] * len(counts), pa.int32()),
                        pa.array([one["shard"]] * len(counts), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(
                            [zlib.crc32(ids[a:b].data) for a, b in zip(starts, ends, strict=True)],
                            pa.int64(),
                        ),
                    ],
                    ["id", "part", "shard", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(_FILE).parquet(path)
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    sizes = files.select("part", "shard", "n_tokens")
    parts = (
        sizes.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select(
            "part",
            F.coalesce(F.sum("n").over(before(W.orderBy("part"))), F.lit(0)).alias("base"),
        )
    )
    starts = (
        sizes.select(
            "part",
            "shard",
            F.coalesce(
                F.sum("n_tokens").over(before(W.partitionBy("part").orderBy("shard"))),
                F.lit(0),
            ).alias("offset"),
        )
        .join(parts, "part")
        .select("part", "shard", (F.col("base") + F.col("offset")).alias("first"))
    )
    decoded = files.select(
        "part", "shard", "n_tokens", "symbols", "doc_ids", "doc_tokens", "planes"
    ).mapInArrow(
        documents,
        "id bigint, part int, shard int, inside bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return decoded.join(starts, ["part", "shard"]).select(
        F.col("id").alias(id_col),
        (F.col("first") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def _shard(row: dict) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """The matrix of a shard, its ids by code, and where its documents begin."""
    matrix = WaveletMatrix.load(row["planes"], row["n_tokens"])
    return matrix, np.frombuffer(row["symbols"], "<u4"), np.concatenate([[0], np.cumsum(row["doc_tokens"])])


def tokens_at(spark: SparkSession, path: str, asked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, pos, token): the tokens at some positions of documents, read by access.

    ``asked`` is (id, pos), positions from 0. Positions beyond a document's end, NULLs
    and unknown ids give no row; a repeated question gives a row each time, and an
    id that several documents have one for each. Only the shards asked for are
    opened, and nothing is decoded but the tokens themselves.
    """
    files = spark.read.schema(_FILE).parquet(path)
    listed = files.select("part", "shard", F.posexplode(F.arrays_zip("doc_ids", "doc_tokens")).alias("nth", "doc")).select(
        "part", "shard", "nth", F.col("doc.doc_ids").alias("id"), F.col("doc.doc_tokens").alias("size")
    )
    wanted = asked.select(F.col(id_col).cast("bigint").alias("id"), F.col("pos").cast("bigint").alias("pos"))
    placed = stage(
        listed.join(wanted, "id").filter((F.col("pos") >= 0) & (F.col("pos") < F.col("size"))).drop("size"), "asked-tokens"
    )

    def read(questions: pa.Table, shards: pa.Table) -> pa.Table:
        tokens = np.zeros(questions.num_rows, np.int64)
        for row in shards.to_pylist() if questions.num_rows else []:
            matrix, symbols, first = _shard(row)
            at = first[questions["nth"].to_numpy()] + questions["pos"].to_numpy()
            tokens = symbols[matrix.access(at)].astype(np.int64)
        return pa.table({"id": questions["id"], "pos": questions["pos"], "token": tokens})

    keys = ["part", "shard"]
    opened = files.join(placed.select(*keys).distinct(), keys, "left_semi").drop("doc_ids")
    found = placed.groupBy(*keys).cogroup(opened.groupBy(*keys)).applyInArrow(read, "id bigint, pos bigint, token bigint")
    return found.withColumnRenamed("id", id_col)


def token_counts(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """(token, n, shards): how often some tokens occur in all files, and in how many shards.

    Each shard counts by rank over its whole length. Tokens that occur nowhere are listed
    with 0.
    """
    wanted = np.unique(np.array(tokens, np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.load(row["planes"], row["n_tokens"])
                symbols = np.frombuffer(row["symbols"], "<u4")
                codes = np.flatnonzero(np.isin(symbols, wanted))
                n = matrix.rank(codes, np.full(len(codes), row["n_tokens"]))
                yield pa.RecordBatch.from_arrays([pa.array(symbols[codes].astype(np.int64)), pa.array(n)], ["token", "n"])

    files = spark.read.schema(_FILE).parquet(path).select("n_tokens", "symbols", "planes")
    zeros = spark.createDataFrame([(int(t), 0) for t in wanted], "token bigint, n bigint")
    counts = files.mapInArrow(count, "token bigint, n bigint").union(zeros)
    return counts.groupBy("token").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("shards"))


def token_positions(
    spark: SparkSession, path: str, tokens: Sequence[int], id_col: str = "doc_id"
) -> DataFrame:
    """(id, token, pos): where some tokens occur in the documents, read by select."""
    wanted = np.unique(np.array(tokens, np.int64))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                matrix, symbols, first = _shard(row)
                docs = pa.array(row["doc_ids"], pa.int64())
                for code in np.flatnonzero(np.isin(symbols, wanted)).tolist():
                    met = np.sort(matrix.occurrences(code))
                    doc = np.searchsorted(first, met, side="right") - 1
                    token = pa.array(np.full(len(met), symbols[code], np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [docs.take(pa.array(doc)), token, pa.array(met - first[doc])], ["id", "token", "pos"]
                    )

    files = spark.read.schema(_FILE).parquet(path)
    return files.mapInArrow(find, "id bigint, token bigint, pos bigint").withColumnRenamed("id", id_col)
