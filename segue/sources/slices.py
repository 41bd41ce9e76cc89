"""Nested JSON inputs: slice files and request files.

Documents that are broken are never lost in silence: the readers fail on them, unless
they are asked to set them aside (``read_checked``, ``write_quarantine``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segue.schema import REQUEST_FILE, SLICE
from segue.sources.storage import stage

_BROKEN = "_corrupt_record"
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")


@dataclass
class Checked:
    """Documents that fit their schema, and those that do not.

    ``rejected`` is (file, reason, record): the reason is ``malformed`` for what is
    not JSON of the schema, with its text in ``record``, and ``no playlists`` for
    documents that lack the list. Both are filters on one stored table.
    """

    good: DataFrame
    rejected: DataFrame


def _documents(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, mode: str
) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode}")
    read = spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode).json(path)
    if mode == "PERMISSIVE":
        return read
    if mode == "DROPMALFORMED":
        return read.filter(F.col("playlists").isNotNull())
    # A document without the list would vanish when the list is exploded.
    missing = F.raise_error(F.concat(F.lit("no playlists in a document of "), F.lit(path)))
    return read.withColumn("playlists", F.coalesce("playlists", missing.cast(schema["playlists"].dataType)))


def read_slices(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """Slice documents with the declared schema.

    ``multi_line`` reads one object per file, which is one task per file; use
    ``multi_line=False`` for inputs with one slice per line, which split. Broken
    documents, and those without playlists, end the job; with ``DROPMALFORMED``
    they are left out, with ``PERMISSIVE`` they give NULLs.
    """
    return _documents(spark, path, SLICE, multi_line, mode)


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType = SLICE, multi_line: bool = True
) -> Checked:
    """All documents below ``path``, the broken ones set aside with their file names.

    The files are parsed once, with all columns, and what was read is written to the
    shared folder: a scan of some columns only would not notice errors in others.
    """
    fields = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    read = (
        spark.read.schema(fields)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .json(path)
    )
    reason = F.when(F.col(_BROKEN).isNotNull(), "malformed").when(
        F.col("playlists").isNull(), "no playlists"
    )
    judged = stage(
        read.select("*", F.col("_metadata.file_path").alias("file"), reason.alias("reason")),
        "checked",
    )
    return Checked(
        judged.filter(F.col("reason").isNull()).select(*schema.names),
        judged.filter(F.col("reason").isNotNull()).select(
            "file", "reason", F.col(_BROKEN).alias("record")
        ),
    )


def write_quarantine(checked: Checked, path: str) -> None:
    """Adds the rejected documents to the quarantine at ``path``, a folder per reason."""
    checked.rejected.write.mode("append").partitionBy("reason").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, reason) of the rejected documents; none if all were good."""
    return spark.read.schema("file string, record string, reason string").parquet(path)


def read_requests(
    spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """Requests as ``(pid, name, num_samples, seeds array<string>)``.

    Broken files are treated as by ``read_slices``.
    """
    return request_rows(_documents(spark, path, REQUEST_FILE, multi_line, mode))


def request_rows(documents: DataFrame) -> DataFrame:
    """The requests of some request documents."""
    return documents.select(F.explode("playlists").alias("p")).select(
        "p.pid",
        "p.name",
        "p.num_samples",
        F.transform("p.tracks", lambda t: t["track_uri"]).alias("seeds"),
    )


def request_seeds(requests: DataFrame) -> DataFrame:
    """One row per seed of each request, in the given order and with repeats."""
    return requests.select("pid", F.posexplode("seeds").alias("pos", "track_uri"))
