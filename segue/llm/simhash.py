"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.llm.components import components
from segue.operators.joins import fits_broadcast, spread_join
from segue.sources.storage import stage

BITS = 64
SHINGLE = 4
DISTANCE = 4  # bits in which linked fingerprints may differ
SEED = 42
PIECE_BYTES = 1 << 20  # text cut into words in one go
BLOCK = 4096  # members of a bucket compared in one go
SPARE_BITS = 4  # a segment may be this much shorter than the number of fingerprints

_SPACE = re.compile(rb"[ \t-\r]")


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists from consecutive pieces of bounded size."""
    begin = 0
    while begin < len(text):
        end = begin + PIECE_BYTES
        if end < len(text):
            # The cut falls on white space, so no word is divided.
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        yield text[begin:end].split()
        begin = end


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bits that over half of the hashes of the runs of ``size`` words have set.

    Words are what ASCII white space separates, with A-Z in lower case; a text of
    fewer words is one run, one without words has fingerprint 0.
    """
    ones, total, held = np.zeros(BITS, np.int64), 0, []

    def add(words: list[bytes]) -> None:
        nonlocal total
        line = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        runs = max(len(words) - size + 1, 1)
        last = ends[size - 1 :] if len(words) >= size else ends[-1:]
        hash_ = xxhash.xxh64_intdigest
        spans = zip((ends - lengths)[:runs].tolist(), last.tolist(), strict=True)
        hashes = np.array([hash_(line[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        total += runs

    for words in word_pieces(text.encode().lower()):
        held = held[len(held) - size + 1 :] if total else held
        held = held + words if held else words
        if len(held) >= size:
            add(held)
    if held and not total:
        add(held)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > total).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every row, as a signed 64-bit number."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py() or "", size) for t in batch.column(1)]
            found = np.array(marks, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(mark, "id bigint, fp bigint")


def segments(fingerprints: int, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of the segments for so many fingerprints.

    A segment has about as many bits as the number of fingerprints, so buckets
    stay small at any size. If two fingerprints differ in at most ``distance`` bits
    and there are m segments, with r = distance // m and a = distance % m, then one
    of the first a + 1 segments differs in at most r bits or one of the others in
    at most r - 1.
    """
    wanted = max(1, fingerprints.bit_length() - SPARE_BITS)
    count = max(1, min(distance + 1, BITS // wanted))
    radius, more = divmod(distance, count)
    edges = [BITS * i // count for i in range(count + 1)]
    found = [(a, b - a, radius - (i > more)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return [s for s in found if s[2] >= 0]


def _ball(bits: int, radius: int) -> list[int]:
    """All numbers of so many bits with at most ``radius`` of them set, 0 first."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def bucket_rows(marks: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """(segment, key, fp, own): where each fingerprint lies and where it looks.

    In every segment it lies under its own bits and looks under those of the ball
    around them. Of two fingerprints near each other in a segment, the one with the
    smaller bits looks for the other; the other way round would find the same pair.
    """
    entries = []
    for number, (first, bits, radius) in enumerate(parts):
        own = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(_signed((1 << bits) - 1)))
        key = own.bitwiseXOR(F.col("mask"))
        rows = marks.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("bigint") for m in _ball(bits, radius)])).alias("mask"))
        # As unsigned numbers, which matters only for a single segment of all bits.
        above = key.bitwiseXOR(F.lit(_signed(1 << 63))) > own.bitwiseXOR(F.lit(_signed(1 << 63)))
        entries.append(
            rows.filter((F.col("mask") == 0) | above).select(
                F.lit(number).alias("segment"), key.alias("key"), "fp", (F.col("mask") == 0).alias("own")
            )
        )
    found = entries[0]
    for more in entries[1:]:
        found = found.union(more)
    return found


def join_links(
    fps: np.ndarray, comps: np.ndarray, own: np.ndarray, distance: int
) -> list[tuple[int, int]]:
    """Links between members of a bucket that connect its components.

    Only members of components not reached yet are compared with the next one, and
    one link is kept for each component that is reached, so a dense bucket takes
    little more than its size, and no more links leave than it has components.
    Members that only look here are compared with those that lie here.
    """
    links: list[tuple[int, int]] = []
    left = np.arange(len(fps))
    while len(left) > 1:
        start = comps[left[0]]
        inside = comps[left] == start
        queue, left, at = left[inside].tolist(), left[~inside], 0
        while at < len(queue) and len(left):
            x = queue[at]
            at += 1
            near = np.bitwise_count(fps[left] ^ fps[x]) <= distance
            if not own[x]:
                near &= own[left]
            if near.any():
                reached = left[near]
                names, first = np.unique(comps[reached], return_index=True)
                links += [(x, int(y)) for y in reached[first]]
                gone = np.isin(comps[left], names)
                queue += left[gone].tolist()
                left = left[~gone]
    return links


_UNIT = ["segment", "key", "i", "j"]


def _linked(rows: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) inside every unit (segment, key, i, j) of (unit, fp, comp, own)."""

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def links(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy() for c in _UNIT])
            fps = table.column("fp").to_numpy().view(np.uint64)
            comps = table.column("comp").to_numpy()
            own = table.column("own").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            begins, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(fps)]])
            lying = np.add.reduceat(own.astype(np.int64), begins) if len(fps) else np.zeros(0)
            worth = (ends - begins > 1) & (lying > 0)
            found: list[tuple[int, int]] = []
            for a, b in zip(begins[worth].tolist(), ends[worth].tolist(), strict=True):
                for x, y in join_links(fps[a:b], comps[a:b], own[a:b], distance):
                    pair = (int(fps[a + x]), int(fps[a + y]))
                    pair = pair if pair[0] < pair[1] else pair[::-1]
                    if pair not in seen:
                        seen.add(pair)
                        found.append(pair)
            if len(seen) > 1_000_000:  # links that are met again are removed later
                seen.clear()
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            # The last unit may go on in the next batch.
            keys = np.stack([table.column(c).to_numpy() for c in _UNIT])
            others = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield links(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield links(held)

    dealt = rows.select(*_UNIT, "fp", "comp", "own").repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    return dealt.mapInArrow(connect, "a bigint, b bigint").distinct()


def _meetings(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Units of large buckets: pairs of blocks that hold different components.

    ``members`` (stored) is (segment, key, fp, comp, own) of the large buckets. A
    component of more than ``BLOCK`` members is cut into blocks of its own, which do
    not meet each other; the others share blocks.
    """
    bucket = ["segment", "key"]
    large = F.col("n") > BLOCK
    piece = F.when(large, F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / BLOCK))).otherwise(
        F.pmod(F.xxhash64("comp", "key"), F.ceil(F.col("rest") / BLOCK))
    )
    placed = stage(
        members.join(sizes, [*bucket, "comp"]).select(
            *bucket, "fp", "comp", "own",
            F.when(large, F.col("comp")).alias("pure"),
            F.xxhash64(F.when(large, F.col("comp")), piece).alias("block"),
        ),
        "fingerprint-blocks",
    )
    blocks = stage(placed.select(*bucket, "block", "pure").distinct(), "blocks")
    meets = (
        blocks.alias("x")
        .join(blocks.alias("y"), bucket)
        .filter("x.block <= y.block and (x.pure is null or y.pure is null or x.pure <> y.pure)")
        .select(*bucket, F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    )
    sides = meets.select(*bucket, F.col("i").alias("block"), "i", "j").union(
        meets.filter("i <> j").select(*bucket, F.col("j").alias("block"), "i", "j")
    )
    return placed.join(sides, [*bucket, "block"])


def fingerprint_links(marks: DataFrame, count: int, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect what fingerprints within ``distance`` connect.

    ``marks`` (stored) holds ``count`` different fingerprints. Buckets of up to
    ``BLOCK`` members are compared in one go; larger ones first in blocks, and then,
    between blocks, only members of components still apart.
    """
    bucket = ["segment", "key"]
    rows = bucket_rows(marks, segments(count, distance))
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("n"), F.max("own").alias("lies"))
    hot = stage(sizes.filter((F.col("n") > BLOCK) & F.col("lies")).drop("lies"), "large-buckets")
    none = hot.isEmpty()
    if none:
        split = rows.withColumn("i", F.lit(0).cast("bigint"))
    else:
        known = F.broadcast(hot) if fits_broadcast(hot) else hot
        split = rows.join(known, bucket, "left").withColumn(
            "i", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / BLOCK)))
        )
    links = stage(
        _linked(split.select(*bucket, "i", F.col("i").alias("j"), "fp", F.col("fp").alias("comp"), "own"), distance),
        "fingerprint-links",
    )
    if none:
        return links
    labels = components(links)
    members = stage(
        rows.join(known, bucket, "left_semi")
        .join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select(*bucket, "fp", F.coalesce("label", "fp").alias("comp"), "own"),
        "large-bucket-members",
    )
    comps = members.groupBy(*bucket, "comp").agg(F.count("*").alias("n"))
    comps = stage(comps, "bucket-components")
    open_ = comps.groupBy(*bucket).agg(
        F.count("*").alias("parts"), F.sum(F.when(F.col("n") <= BLOCK, F.col("n"))).alias("rest")
    )
    open_ = stage(open_.filter("parts > 1").drop("parts"), "open-buckets")
    apart = comps.join(open_, bucket)
    more = _linked(_meetings(members.join(open_.select(*bucket), bucket, "left_semi"), apart), distance)
    return links.union(stage(more, "further-links"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    size: int = SHINGLE,
) -> DataFrame:
    """(id, fp, component_id, component_fps), one row per input row.

    ``fp`` is the SimHash fingerprint of the runs of ``size`` words of the whole
    text. Fingerprints that differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest id of what links connect, ``component_fps`` its
    number of different fingerprints.

    Equal fingerprints are one node. Nodes are put into buckets by segments of
    their bits, and look into those of the small Hamming balls around them
    (``segments``); candidates are verified by their whole distance where they meet,
    and only links that connect components leave a task.

    A NULL text counts as empty; texts without words have fingerprint 0, which is
    linked like any other. A NULL id takes no part in the choice of the smallest;
    ``component_id`` is NULL if there is no other. A very long text is read in
    pieces of ``PIECE_BYTES``. Repeated rows stay and are judged alike, other
    columns of ``docs`` play no part, and an empty table gives no rows.
    """
    signed = stage(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = stage(
        signed.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "fingerprint-nodes"
    )
    labels = components(fingerprint_links(nodes.select("fp"), nodes.count(), distance))
    labelled = stage(
        nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", "n", F.coalesce("label", "fp").alias("label")
        ),
        "fingerprint-labels",
    )
    groups = labelled.groupBy("label").agg(
        F.min("first_id").alias("component_id"), F.count("*").alias("component_fps")
    )
    known = stage(labelled.join(groups, "label"), "fingerprint-groups")
    return spread_join(
        signed, known.select("fp", "component_id", "component_fps"), ["fp"], counts=known.select("fp", "n")
    ).select(F.col("id").alias(id_col), "fp", "component_id", "component_fps")


def hex_digits(mark: Column) -> Column:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(mark)), 16, "0")
