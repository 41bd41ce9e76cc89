"""URL rules looked up in cascades of Bloom filters."""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.sources.storage import stage

HASHES = 4
BITS_PER_KEY = 8
# Bits of one filter at most: 64 MB, what an executor gets of it.
MOST_BITS = 1 << 29


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")
    )


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit("")
    )


def _shape_key(labels: int, length: int) -> Column:
    """The last labels of the host and the first characters of the path.

    NULL where the host has fewer labels or the path fewer characters.
    """
    fits = (
        F.length(F.col("host")) - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
        >= labels - 1
    ) & (F.length("path") >= length)
    return F.when(
        fits,
        F.concat(
            F.substring_index(F.col("host"), ".", -labels),
            F.substring(F.col("path"), 1, length),
        ),
    )


def _bit(key: Column, level: int, n: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level * HASHES + n), key), F.lit(bits))


def filter_bits(count: int, others: int) -> int:
    """Bits of a filter that about ``count`` of ``others`` other keys pass.

    Then the next filter holds about as many keys as this one, however many keys the
    universe has: its size adds only bits per listed key.
    """
    share = min(max(count, 1) / max(others, 1), 0.5)
    each = max(BITS_PER_KEY, -HASHES / math.log1p(-(share ** (1 / HASHES))))
    return max(64, math.ceil(count * each / 64) * 64)


def _filter_words(keys: DataFrame, level: int, count: int, others: int) -> tuple[DataFrame, int]:
    """A Bloom filter of ``keys`` as one row: an array of 64-bit words."""
    bits = filter_bits(count, others)
    if bits > MOST_BITS:
        raise ValueError(f"a filter of {count} keys exceeds {MOST_BITS} bits")
    places = keys.select(
        F.explode(
            F.array(*[_bit(F.col("key"), level, n, bits) for n in range(HASHES)])
        ).alias("place")
    )
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
        ).alias("bits")
    )
    filled = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"))
    return (
        filled.join(words, "word", "left")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))),
                lambda x: x["bits"],
            ).alias("words")
        ),
        bits,
    )


class Cascade:
    """Exact membership of a list, for keys of a known universe.

    The first filter holds the listed keys, the next those unlisted keys of the
    universe that pass it, the next the listed keys that pass that one, and so on
    until none is left. A key's level is the first filter it fails; listed keys
    fail at even levels, the others at odd ones.
    """

    def __init__(self, universe: DataFrame, listed: DataFrame, name: str):
        known = stage(
            universe.join(listed.withColumn("_in", F.lit(True)), "key", "left").select(
                "key", F.coalesce("_in", F.lit(False)).alias("listed")
            ),
            name,
        )
        inside, outside = known.filter("listed"), known.filter("not listed")
        self.filters: list[tuple[DataFrame, int]] = []
        wanted, others = inside, outside
        left = outside.count()
        while count := wanted.count():
            level = len(self.filters)
            words, bits = _filter_words(wanted, level, count, left)
            self.filters.append((stage(words, f"{name}-{level}"), bits))
            passing = others.filter(self._passes(F.col("key"), level))
            wanted, others, left = stage(passing, f"{name}-passing"), wanted, count

    def _passes(self, key: Column, level: int) -> Column:
        words, bits = self.filters[level]
        held = words.select("words").scalar()
        test = F.lit(True)
        for n in range(HASHES):
            place = _bit(key, level, n, bits)
            word = F.get(held, F.shiftright(place, 6).cast("int"))
            mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
            test = test & (word.bitwiseAND(mask) != 0)
        return test

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed; NULL keys are not."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for level in reversed(range(len(self.filters))):
            answer = F.when(self._passes(key, level), answer).otherwise(level % 2 == 1)
        return F.coalesce(key.isNotNull() & answer, F.lit(False))


def url_filter(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict), one row per input row.

    The keys a URL could match follow from the shapes of the rules (labels of the
    host, characters of the path), so each URL has at most one key per shape. The
    distinct keys of the corpus are the universe of one cascade per verdict, and
    the rows are then judged where they lie, by filters of bounded size, without
    a join. The longest matching rule wins, of equal ones the longer host; a key listed
    under several verdicts has the last of them by name. A URL without a rule
    is in no list and gets ``default``. ``rules`` are a list in memory; filters
    grow with their number, not with that of the URLs (``filter_bits``), and more than
    about 50 million keys of one verdict are refused. A very long URL costs its
    length, and other columns of ``pages`` play no part.

    A NULL URL, or one without ``://``, has an empty host and path and matches
    nothing. Repeated rows are judged alike. An empty table gives no rows.
    """
    parsed = pages.select(
        F.col(id_col).alias("id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
    )
    shapes = sorted(
        {(r.host.count(".") + 1, len(r.path)) for r in rules},
        key=lambda s: (-s[0], -s[1]),
    )
    candidates = F.array(*[_shape_key(*s) for s in shapes])
    spark = pages.sparkSession
    universe = (
        parsed.select(F.explode(candidates).alias("key"))
        .filter("key is not null")
        .distinct()
    )
    universe = stage(universe, "url-keys")
    verdicts = sorted({r.verdict for r in rules})
    cascades = {
        v: Cascade(
            universe,
            spark.createDataFrame(
                sorted({(r.host + r.path,) for r in rules if r.verdict == v}),
                "key string",
            ),
            f"urls-{v}",
        )
        for v in verdicts
    }
    found = []
    for shape in shapes:
        key = _shape_key(*shape)
        listed = F.lit(None).cast("string")
        for v in verdicts:
            listed = F.when(cascades[v].contains(key), F.lit(v)).otherwise(listed)
        found.append(
            F.when(
                listed.isNotNull(),
                F.struct(
                    F.length(key).alias("n"),
                    F.lit(shape[0]).alias("labels"),
                    key.alias("rule"),
                    listed.alias("verdict"),
                ),
            )
        )
    best = F.array_max(F.array(*found))
    return parsed.select("id", "host", "path", best.alias("best")).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
