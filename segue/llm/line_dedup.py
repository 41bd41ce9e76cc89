"""Lines that many documents share, kept in one of them only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segue.operators.joins import spread_join
from segue.sources.storage import stage

# White space in ASCII: blank and \t to \r.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    bare = F.trim(line, F.lit(ASCII_SPACE))
    # Spark's lower() is much faster, and the same on ASCII; it would also fold
    # letters such as É, which are different here.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """(id, kept_text, n_lines, n_dropped), one row per input row.

    Lines are split at ``\\n``. A key (see ``line_key``) of at least ``min_chars``
    code points that at least ``min_docs`` documents hold loses all its lines
    except those in the smallest id holding it; the other lines stay, in order.

    Only hashes travel: 128 bits of every long enough key with its document and
    position are written once, distinct documents are counted per hash (combined
    before each shuffle), and the shared hashes are joined back with hot ones
    spread. What comes out is a list of positions per document, which meets the
    text in one join that does not sort it.

    A NULL or empty text is one empty line. A NULL id is a document of its own
    that sorts last; rows with the same id are one document and each keeps its
    row. An empty table gives no rows; other columns play no part.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        # The flag tells a NULL id from any number, and sorts it last.
        F.struct(
            F.col(id_col).isNull().alias("no_id"),
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("number"),
        ).alias("doc"),
        F.col(text_col).alias("text"),
        # Tells rows with the same id but different texts apart.
        F.xxhash64(text_col).alias("version"),
    )
    exploded = base.select(
        "doc", "version", F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    keys = stage(
        exploded.select("doc", "version", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            "doc",
            "version",
            "pos",
        ),
        "line-keys",
    )
    shared = stage(
        keys.select("h1", "h2", "doc")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("doc").alias("keeper"))
        .filter(F.col("n") >= min_docs),
        "shared-lines",
    )
    dropped = (
        spread_join(
            keys,
            shared.select("h1", "h2", "keeper"),
            ["h1", "h2"],
            counts=shared.select("h1", "h2", "n"),
        )
        .filter(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "version")
        .agg(F.collect_set("pos").alias("gone"))
    )
    joined = base.join(dropped.hint("shuffle_hash"), ["doc", "version"], "left")
    lines = _lines(F.col("text"))
    # array_except hashes its numbers, so long documents stay linear.
    left_over = F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")
    )
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(
            F.array_join(F.transform(left_over, lambda i: F.get(lines, i)), "\n")
        )
        .alias("kept_text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
