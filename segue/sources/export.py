"""Sinks for results: recommendation lines and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recommendation_lines(recs: DataFrame, n: int = 500) -> DataFrame:
    """(pid, line): ``pid, uri1, uri2, ...`` in order of rank, ``n`` items at most."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "track_uri")))
    uris = F.transform(ordered, lambda r: r["track_uri"])
    return (
        recs.filter(F.col("rank") <= n)
        .groupBy("pid")
        .agg(uris.alias("uris"))
        .select(
            "pid",
            F.concat_ws(
                ", ", F.concat(F.array(F.col("pid").cast("string")), F.col("uris"))
            ).alias("line"),
        )
    )


def export_recommendations(
    recs: DataFrame, path: str, n: int = 500, compression: str = "gzip"
) -> None:
    """Write one line per playlist as text files."""
    lines = recommendation_lines(recs, n).select(F.col("line").alias("value"))
    lines.write.mode("overwrite").option("compression", compression).text(path)


def read_recommendations(spark, path: str) -> DataFrame:
    """Exported lines as (pid, track_uri, rank)."""
    fields = F.split(F.col("value"), r",\s*")
    return (
        spark.read.text(path)
        .select(fields.alias("f"))
        .select(
            F.col("f")[0].cast("bigint").alias("pid"),
            F.posexplode(F.slice("f", 2, F.size("f") - 1)).alias("at", "track_uri"),
        )
        .select("pid", "track_uri", (F.col("at") + 1).cast("bigint").alias("rank"))
    )


def write_metrics(summary: DataFrame, path: str) -> None:
    """Metric table as Parquet and, from that, as CSV with a header."""
    summary.write.mode("overwrite").parquet(f"{path}/parquet")
    written = summary.sparkSession.read.schema(summary.schema).parquet(f"{path}/parquet")
    written.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
