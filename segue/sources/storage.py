"""Tables on shared storage: named Parquet tables, staged intermediates, models."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.ml.feature import Word2VecModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MANIFEST_VERSION = 1
_MANIFEST = "version int, kind string, params string, `table` string, columns string, rows bigint"


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``directory`` (a folder or a single file)."""
    return spark.read.parquet(f"{directory}/{name}")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make every table queryable from SQL under its name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


@contextmanager
def temporary_views(tables: dict[str, DataFrame]) -> Iterator[None]:
    """Tables under names that SQL inside the block can use; gone after it.

    A DataFrame made by ``spark.sql`` in the block stays valid. Views of the
    caller under one of the names are replaced, so choose other names.
    """
    register_views(tables)
    try:
        yield
    finally:
        for name, table in tables.items():
            table.sparkSession.catalog.dropTempView(name)


def literal_queries(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of hand-given rows, such as the users to recommend for."""
    return spark.createDataFrame(rows, schema)


def write_table(
    df: DataFrame,
    path: str,
    files: int | None = None,
    max_records_per_file: int | None = None,
    partition_by: Sequence[str] = (),
    target_bytes: int | None = None,
) -> None:
    """Overwrite a Parquet table.

    ``files`` asks for an exact number of files. It shuffles: narrowing the
    plan instead would run the whole upstream stage in that many tasks.
    ``max_records_per_file`` bounds file sizes without any shuffle.

    ``partition_by`` makes a folder per value, which later filters prune.
    ``target_bytes`` asks for files of about that size (before compression),
    in every folder: the rows are shuffled by the folder, and partitions are then
    split and joined by their measured sizes, so a hot folder is no single task.
    """
    spark = df.sparkSession
    if files is not None:
        df = df.repartition(files)
    elif target_bytes is not None:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    held = spark.conf.get(_PARTITION_BYTES, None)
    try:
        if target_bytes is not None:
            spark.conf.set(_PARTITION_BYTES, str(target_bytes))
        writer.parquet(path)
    finally:
        if target_bytes is not None:
            _restore(spark, _PARTITION_BYTES, held)


def _restore(spark: SparkSession, key: str, value: str | None) -> None:
    if value is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, value)


def write_buckets(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Overwrite the table ``name`` at ``path``, bucketed and sorted by ``keys``.

    Rows are dealt to the buckets once, before they are written, so every bucket is
    one file. Tables with the same number of buckets join and group by the
    keys without a further exchange.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name, format="parquet")
    return df.sparkSession.table(name)


def register_buckets(
    spark: SparkSession, name: str, path: str, schema: StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The bucketed table at ``path`` for a session that has not written it itself."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Lets Spark checkpoint below the shared folder, unless the caller chose another."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/segue-{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    Used where a result feeds several later jobs: it is computed once, its
    lineage ends at the files, and losing executors does not lose it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that wrote them, not when the driver collects garbage."""
    held = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        _restore(spark, _SHUFFLE_CLEANUP, held)


def _tables_of(model) -> dict[str, DataFrame]:
    """The tables a fitted model consists of."""
    if isinstance(model, ALSModel):
        return {"userFactors": model.userFactors, "itemFactors": model.itemFactors}
    if isinstance(model, Word2VecModel):
        return {"vectors": model.getVectors()}
    raise TypeError(f"no manifest for models of {type(model)}")


def manifest_of(model) -> DataFrame:
    """(version, kind, params, table, columns, rows): what a stored model must hold."""
    params = {p.name: v for p, v in model.extractParamMap().items()}
    lines = [
        (
            MANIFEST_VERSION,
            type(model).__name__,
            json.dumps(params, sort_keys=True, default=str),
            name,
            table.schema.simpleString(),
            table.count(),
        )
        for name, table in sorted(_tables_of(model).items())
    ]
    spark = SparkSession.active()
    return spark.createDataFrame(lines, _MANIFEST)


def save_model(model, path: str) -> None:
    """Store a model by MLlib's writer, and then its manifest beside it.

    The manifest comes last, so a model whose saving was cut short has none and
    does not load.
    """
    model.write().overwrite().save(path)
    manifest_of(model).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{path}/manifest")


def _load(kind, path: str):
    spark = SparkSession.active()
    try:
        stored = sorted(map(tuple, read_manifest(spark, path).collect()))
    except AnalysisException as error:
        raise ValueError(f"{path} has no manifest: its saving was not finished") from error
    if {line[0] for line in stored} != {MANIFEST_VERSION}:
        raise ValueError(f"manifest of {path} is not of version {MANIFEST_VERSION}")
    model = kind.load(path)
    found = sorted(map(tuple, manifest_of(model).collect()))
    if found != stored:
        raise ValueError(f"{path} holds {found}, its manifest says {stored}")
    return model


def load_als(path: str) -> ALSModel:
    """The model at ``path``, once its schema, parameters and row counts are checked."""
    return _load(ALSModel, path)


def load_word2vec(path: str) -> Word2VecModel:
    """The model at ``path``, once its schema, parameters and row counts are checked."""
    return _load(Word2VecModel, path)
