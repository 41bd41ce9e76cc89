"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.sources.storage import stage

WORD = r"[^\x20\x09-\x0D]+"
_DRAW_BITS = 48


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone."""
    digits = F.substring(
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("-")))),
        1,
        _DRAW_BITS // 4,
    )
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(
        float(1 << _DRAW_BITS)
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: int = 2
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources take the ``weights`` in turn by code point, NULL last, and share
    ``share`` of all sizes by weight. A target stops at ``most`` times its source's
    size; what that leaves goes to the others by weight. Filling in the order in
    which sources reach their limit gives that in one pass. One row per source,
    so its windows are as small as the list of sources is.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sizes.select(
        "source",
        "source_size",
        F.element_at(
            F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int")
        )
        .cast("bigint")
        .alias("w"),
        (F.col("source_size") * most).alias("cap"),
    )
    filling = W.orderBy(
        (F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()
    )
    everything = W.partitionBy(F.lit(0))
    ordered = weighted.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("amount"),
        F.coalesce(
            F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("cap_before"),
        F.sum("w").over(filling.rowsBetween(0, W.unboundedFollowing)).alias("w_left"),
    )
    full = F.col("cap_before") * F.col("w") + F.col("cap") * F.col("w_left") <= (
        F.col("amount") * F.col("w")
    )
    marked = ordered.withColumn("full", full)
    open_w = F.coalesce(
        F.sum(F.when(~F.col("full"), F.col("w"))).over(everything), F.lit(0)
    )
    taken = F.coalesce(
        F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)
    )
    return marked.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(
            F.least(
                F.col("cap").cast("double"),
                (F.col("amount") - taken) * F.col("w") / open_w,
            )
        )
        .alias("target"),
    )


def mixing_plan(
    sized: DataFrame, weights: Sequence[int], share: float, bins: int = 1024
) -> DataFrame:
    """One row per source: its target and where its sample ends.

    ``sized`` is (doc, version, source, size, u) and stored; it is read three
    times. Every document of a source expects target / source_size copies. The
    whole part is certain. For the rest, documents are ranked by random odds over
    inclusion odds, and the sample is the head of that order whose words come
    nearest to what is left of the target.

    The end of the head is found without sorting a source: words are summed per
    source and bin of the rank variable, and only the bin where the sum crosses
    the goal is put in order.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        0.0
    )
    plan = stage(
        source_targets(totals, weights, share)
        .withColumn("copies", copies)
        .withColumn("whole", F.floor("copies"))
        .withColumn("part", F.col("copies") - F.col("whole"))
        .withColumn("goal", F.col("target") - F.col("whole") * F.col("source_size")),
        "targets",
    )
    ranked = (
        sized.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .filter("part > 0")
        .select("source", "goal", "doc", "version", "size", *_ranks(bins))
    )
    per_bin = ranked.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.first("goal").alias("goal")
    )
    run = W.partitionBy("source").orderBy("bin")
    ends = (
        per_bin.withColumn("upto", F.sum("words").over(run))
        .filter("upto >= goal and upto - words < goal")
        .groupBy("source")
        .agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("words")).alias("before")), "bin").alias("e"))
        .select(F.col("source").alias("_s"), "e.bin", "e.before")
        .withColumnRenamed("bin", "_bin")
    )
    order = W.partitionBy("source").orderBy("rank", "doc", "version")
    cuts = (
        ranked.join(
            ends, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_bin"))
        )
        .withColumn(
            "before",
            F.col("before")
            + F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        )
        .groupBy("source")
        .agg(
            F.max("bin").alias("end_bin"),
            F.max(
                F.when(
                    F.col("before") + F.col("size") / 2 <= F.col("goal"),
                    F.struct("rank", "doc", "version"),
                )
            ).alias("end"),
        )
        .withColumnRenamed("source", "_s")
    )
    return stage(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mixing-plan"
    )


def _ranks(bins: int) -> list[Column]:
    """Random odds over inclusion odds, and its bin: 1 / 2 is where they are even."""
    odds = F.col("u") / (1 - F.col("u"))
    rank = F.try_divide(odds, F.col("part") / (1 - F.col("part")))
    return [rank.alias("rank"), F.floor(rank / (1 + rank) * bins).alias("bin")]


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    return [
        F.col(id_col).alias("doc"),
        F.xxhash64(text_col).alias("version"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        draw(F.col(id_col), seed).alias("u"),
    ]


def _taken(rows: DataFrame, plan: DataFrame, bins: int) -> DataFrame:
    """``rows`` (with doc, version, source, u) with the plan and ``n_copies``."""
    joined = rows.join(
        plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    )
    ranked = joined.select("*", *_ranks(bins))
    here = F.struct("rank", "doc", "version")
    chosen = (F.col("part") > 0) & (
        (F.col("bin") < F.col("end_bin"))
        | ((F.col("bin") == F.col("end_bin")) & F.coalesce(here <= F.col("end"), F.lit(False)))
    )
    return ranked.withColumn(
        "n_copies",
        (F.col("whole") + F.coalesce(chosen, F.lit(False)).cast("int")).cast("int"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bins: int = 1024,
) -> DataFrame:
    """(id, size, source, source_size, target, n_copies, taken), a row per input row.

    See ``mixing_plan``. ``taken`` is copies times size: at most twice the size.
    The draw depends on id and seed alone, so reruns agree. A NULL text has size 0
    and takes no words; a NULL source is a source like any other. Rows with the
    same id draw the same number; rows that are equal throughout are
    interchangeable. An empty table gives no rows.
    """
    sized = stage(docs.select(*_sized(docs, id_col, text_col, source_col, seed)), "sizes")
    plan = mixing_plan(sized, weights, share, bins)
    return _taken(sized, plan, bins).select(
        F.col("doc").alias(id_col),
        "size",
        F.col("source").alias(source_col),
        "source_size",
        "target",
        "n_copies",
        (F.col("n_copies") * F.col("size")).alias("taken"),
    )


def mix_rows(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bins: int = 1024,
) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the mix takes it.

    The plan holds one row per source, so texts stay where they lie.
    """
    numbers = _sized(docs, id_col, text_col, source_col, seed)
    sized = stage(docs.select(*numbers), "sizes")
    plan = mixing_plan(sized, weights, share, bins)
    rows = docs.select(F.struct("*").alias("row"), *[c for i, c in enumerate(numbers) if i != 3])
    return (
        _taken(rows, plan, bins)
        .filter("n_copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("_copy"))
        .select("row.*")
    )
