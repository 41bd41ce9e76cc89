"""Scoring of all candidates for many partial collections.

Every model ranks by an inner product. With the popularity p_i of item i, its
ALS vector a_i and its unit word vector w_i, a query holds a weight, two
vectors and a constant, and

    score(q, i) = weight_q * p_i + als_q . a_i + word_q . w_i + shift_q

gives popularity (1, -, -, 0), ALS (0, profile, -, 0), Word2Vec (0, -, profile,
0) and the weighted hybrid, whose min-max scaling and (x + 1) / 2 turn into
factors of the vectors and a constant. So one kernel serves all models and
scenarios in the same pass.

Queries without any vector have the same order of items, up to their seeds;
they take the head of the popularity list instead of a product.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from segue.functions import tiles
from segue.functions.columns import WORD
from segue.functions.vectors import is_nonzero, l2_norm, normalize, scale
from segue.operators.joins import fits_broadcast, lookup_join, spread_join
from segue.operators.ranking import dense_index, top_per_group
from segue.sources.storage import stage

# The models and the weights of the hybrid.
MODELS = ["Popularity", "ALS", "Word2Vec", "Hybrid"]
WEIGHTS = {"popularity": 0.1, "als": 0.5, "word2vec": 0.4}

# Size of a tile: items, queries and result rows that a packed block has.
TILE_ITEMS = 8_192
TILE_QUERIES = 1_024
TILE_RESULTS = 500_000
# Query blocks that one copy of an item block meets in a task.
QUERY_BLOCKS = 4

# Longest table of vectors that is broadcast: 100 MB at 128 doubles.
VECTOR_ROWS = 100_000

# Executors need numpy and pyarrow only: the kernels travel with the plan.
cloudpickle.register_pickle_by_value(tiles)

# From this many item blocks on, a sample of the items is scored first.
FLOOR_BLOCKS = 128

# Longest head of the popularity list that one task sorts and that is broadcast.
HEAD_ROWS = 100_000
# Rows of popularity lists that one task unfolds.
LIST_ROWS = 1_000_000


# --- candidates and profiles -------------------------------------------------


def candidate_index(baseline: DataFrame) -> DataFrame:
    """Training items with their popularity scaled to [0, 1]."""
    most = baseline.agg(F.max("playlist_count")).scalar()
    return baseline.select(
        "track_uri",
        "playlist_count",
        (F.col("playlist_count").cast("double") / most).alias("popularity"),
    )


def align_factors(candidates: DataFrame, als: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with both vectors; NULL stands for a zero vector.

    The word vector is kept as it is, with its norm: profiles average the plain
    vectors, scores use the unit ones.
    """
    als_side = als.select("track_uri", F.col("features").alias("als"))
    word_side = words.select(
        "track_uri",
        F.col("features").alias("word"),
        l2_norm(F.col("features")).alias("word_norm"),
    )
    return candidates.join(als_side, "track_uri", "left").join(
        word_side, "track_uri", "left"
    )


def factor_coverage(aligned: DataFrame) -> DataFrame:
    """How many candidates have a vector of either kind."""
    return aligned.agg(
        F.count("*").alias("candidates"),
        F.count("als").alias("als_covered"),
        F.count("word").alias("word_covered"),
    )


def profile_vectors(
    seeds: DataFrame, factors: DataFrame, keys: list[str], unit: bool = False
) -> DataFrame:
    """(keys, profile): the mean of the seed vectors that are not zero.

    A repeated seed weighs as often as it occurs: repeats are folded into a
    weight first, once seeds without a vector are gone. The mean is a partial aggregate, so a query with very many
    seeds is averaged across tasks. ``unit`` scales the mean to length 1.
    """
    usable = factors.filter(is_nonzero(F.col("features"))).select(
        "track_uri", "features"
    )
    known = usable.select("track_uri")
    if fits_broadcast(known):
        seeds = seeds.join(F.broadcast(known), "track_uri", "left_semi")
    folded = seeds.groupBy(*keys, "track_uri").agg(F.count("*").alias("_w"))
    mean = Summarizer.mean(array_to_vector(F.col("features")), F.col("_w"))
    profiles = (
        lookup_join(folded, usable, "track_uri", limit=VECTOR_ROWS)
        .groupBy(*keys)
        .agg(vector_to_array(mean).alias("profile"))
    )
    if unit:
        profiles = profiles.withColumn("profile", normalize(F.col("profile")))
    return profiles


# --- queries -----------------------------------------------------------------

_NO_VECTOR = "array<double>"


def popularity_queries(queries: DataFrame) -> DataFrame:
    none = F.lit(None).cast(_NO_VECTOR)
    return queries.select(
        "*",
        F.lit(1.0).alias("weight"),
        none.alias("als_q"),
        none.alias("word_q"),
        F.lit(0.0).alias("shift"),
    )


def vector_queries(
    queries: DataFrame, profiles: DataFrame, keys: list[str], side: str
) -> DataFrame:
    """Queries by one kind of vector (``als`` or ``word``), else by popularity."""
    none = F.lit(None).cast(_NO_VECTOR)
    vector = F.col("profile")
    return queries.join(profiles, keys, "left").select(
        *queries.columns,
        F.when(vector.isNull(), 1.0).otherwise(0.0).alias("weight"),
        (vector if side == "als" else none).alias("als_q"),
        (vector if side == "word" else none).alias("word_q"),
        F.lit(0.0).alias("shift"),
    )


def hybrid_queries(
    queries: DataFrame,
    als_profiles: DataFrame,
    als_spans: DataFrame,
    word_profiles: DataFrame,
    keys: list[str],
    weights: dict[str, float] = WEIGHTS,
) -> DataFrame:
    """Queries by the weighted sum of popularity, scaled ALS score and cosine.

    ``als_spans`` (keys, low, high) is the range of the ALS scores over all
    candidates. Scores without a range are not scaled; a missing profile leaves
    its part out.
    """
    wide = F.col("high") > F.col("low")
    spread = F.when(wide, F.col("high") - F.col("low")).otherwise(F.lit(1.0))
    factor = F.lit(weights["als"]) / spread
    half = weights["word2vec"] / 2
    als = als_profiles.withColumnRenamed("profile", "_als")
    word = word_profiles.withColumnRenamed("profile", "_word")
    return (
        queries.join(als.join(als_spans, keys), keys, "left")
        .join(word, keys, "left")
        .select(
            *queries.columns,
            F.lit(weights["popularity"]).alias("weight"),
            scale(F.col("_als"), factor).alias("als_q"),
            scale(F.col("_word"), F.lit(half)).alias("word_q"),
            (
                F.when(F.col("_als").isNotNull() & wide, -F.col("low") * factor).otherwise(
                    F.lit(0.0)
                )
                + F.when(F.col("_word").isNotNull(), F.lit(half)).otherwise(F.lit(0.0))
            ).alias("shift"),
        )
    )


# --- tiles -------------------------------------------------------------------


def _shape(candidates: DataFrame, queries: DataFrame, keep_rows: bool) -> tuple[int, int, int, int]:
    """Blocks of items and of queries, groups of query blocks, and parts of the item blocks.

    The groups are the tasks. While there are fewer than workers, the items are parted, too.
    """
    n_items = candidates.count()
    kept = F.least("keep", F.lit(n_items)) if keep_rows else F.lit(1)
    n_queries, n_kept = queries.agg(F.count("*"), F.sum(kept)).first()
    workers = candidates.sparkSession.sparkContext.defaultParallelism
    item_blocks = max(-(-n_items // TILE_ITEMS), min(workers, -(-n_items // 1_024)), 1)
    query_blocks = max(-(-n_queries // TILE_QUERIES), -(-(n_kept or 0) // TILE_RESULTS), 1)
    groups = -(-query_blocks // QUERY_BLOCKS)
    return item_blocks, query_blocks, groups, min(item_blocks, -(-workers // groups))


def _tiles(
    candidates: DataFrame,
    queries: DataFrame,
    keys: list[str],
    state,
    results: list[tuple[str, T.DataType]],
    shape: tuple[int, int, int, int],
    bare: DataFrame | None = None,
) -> DataFrame:
    """Run every item block past every query block, for which a ``state`` keeps the result.

    Blocks are formed by hash and packed: all rows of a block are one binary value.
    A task has a group of ``QUERY_BLOCKS`` query blocks, and the item blocks (one part of them,
    if there are few groups) pass it one by one, so its memory follows the queries of a
    group whatever the number of items, and nothing is broadcast or fetched. What leaves is
    one result for each query and part. ``bare`` are items without vectors, which the
    first part has as well.
    """
    item_blocks, query_blocks, groups, parts = shape
    item_block = F.pmod(F.xxhash64("track_uri"), F.lit(item_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(*keys), F.lit(query_blocks)).cast("int")
    # Vectors that no query asks for stay where they are.
    uses = queries.agg(F.count("als_q"), F.count("word_q")).first()
    sides = [
        F.col(c) if used else F.lit(None).cast(candidates.schema[c].dataType).alias(c)
        for c, used in zip(["als", "word"], uses, strict=True)
    ]

    def pack(items: DataFrame, block: Column) -> DataFrame:
        shown = items.select(block.alias("_i"), "track_uri", "popularity", *sides, "word_norm")
        return shown.groupBy("_i").applyInArrow(tiles.pack_kernel("_i", "track_uri"), "_i int, block binary")

    def rows(packed: DataFrame, kind: int, cell: Column) -> DataFrame:
        return packed.select(cell.cast("int").alias("cell"), F.lit(kind).alias("kind"), "block")

    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    blocks = pack(candidates, item_block).withColumn("_g", each_group)
    moved = rows(blocks, tiles.ITEMS, F.col("_g") * parts + F.pmod("_i", F.lit(parts)))
    if bare is not None:
        blocks = pack(bare, F.lit(0)).withColumn("_g", each_group)
        moved = moved.unionByName(rows(blocks, tiles.BARE, F.col("_g") * parts))
    packed = queries.withColumn("_q", query_block).groupBy("_q").applyInArrow(tiles.pack_kernel("_q"), "_q int, block binary")
    packed = packed.select("block", F.pmod("_q", F.lit(groups)).alias("_g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_p"))
    moved = moved.unionByName(rows(packed, tiles.QUERIES, F.col("_g") * parts + F.col("_p")))
    schema = T.StructType(
        [queries.schema[k] for k in keys]
        + [T.StructField(name, kind) for name, kind in results]
    )
    fields = to_arrow_schema(schema)
    tasks = min(groups * parts, 20_000)
    dealt = moved.repartitionById(tasks, F.pmod("cell", F.lit(tasks))).sortWithinPartitions("cell", "kind")
    return dealt.mapInArrow(tiles.meeting(lambda: state(keys, fields)), schema)


def als_spans(candidates: DataFrame, profiles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, low, high): range of the ALS scores of each profile.

    All candidates count, seeds and items without a vector (score 0) included; only
    those with one are multiplied.
    """
    bare = F.col("als").isNull()
    queries = profiles.select(
        *keys,
        F.lit(0.0).alias("weight"),
        F.col("profile").alias("als_q"),
        F.lit(None).cast(_NO_VECTOR).alias("word_q"),
        F.lit(0.0).alias("shift"),
    )
    results = [("low", T.DoubleType()), ("high", T.DoubleType())]
    placed = candidates.filter(~bare)
    shape = _shape(placed, queries, keep_rows=False)
    parts = _tiles(placed, queries, keys, tiles.Spans, results, shape)
    if not candidates.filter(bare).isEmpty():
        parts = parts.unionByName(profiles.select(*keys, F.lit(0.0).alias("low"), F.lit(0.0).alias("high")))
    return parts.groupBy(*keys).agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    )


def _top_of_tiles(
    candidates: DataFrame, queries: DataFrame, keys: list[str],
    bare: DataFrame | None = None, shape: tuple[int, int, int, int] | None = None,
) -> DataFrame:
    """(keys, track_uri, score, rank in its part) of the best ``keep`` items of every query."""
    results = [("track_uri", T.StringType()), ("score", T.DoubleType()), ("rank", T.LongType())]
    if "gone" not in queries.columns:
        queries = queries.withColumn("gone", F.lit(None).cast("array<string>"))
    shape = shape or _shape(candidates, queries, keep_rows=True)
    return _tiles(candidates, queries, keys, tiles.Best, results, shape, bare)


def _with_floors(
    candidates: DataFrame, queries: DataFrame, keys: list[str], n: int
) -> DataFrame:
    """Queries with a score that their ``keep`` best candidates surely reach.

    The keep-th best score among some of the candidates is a lower bound of the
    keep-th best among all, so items below it need not leave their tile. With b
    item blocks, a sample of 1 / sqrt(b) of the items cuts the rows that leave
    the tiles from b * keep to about 2 * sqrt(b) * keep per query. The result
    does not depend on the sample. The bound is lowered a little because the
    same product may differ in its last bits between two passes.

    Queries with very many seeds keep so many rows that a bound would not help.
    """
    unbounded = F.lit(float("-inf"))
    blocks = candidates.count() / TILE_ITEMS
    if blocks < FLOOR_BLOCKS:
        return queries.withColumn("floor", unbounded)
    limit = math.ceil(blocks**-0.5 * WORD)
    drawn = F.pmod(F.xxhash64("track_uri"), F.lit(WORD)) < F.lit(limit)
    few = queries.filter(F.col("keep") <= 10 * n).withColumn("floor", unbounded)
    first = _top_of_tiles(candidates.filter(drawn), few, keys)
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score")))
    floors = (
        first.withColumn("_place", place)
        .join(few.select(*keys, "keep"), keys)
        .filter(F.col("_place") == F.col("keep"))
        .select(
            *keys,
            (
                F.col("score") - F.greatest(F.lit(1.0), F.abs("score")) * F.lit(1e-9)
            ).alias("_floor"),
        )
    )
    floors = stage(floors, "floors")
    return (
        queries.join(floors, keys, "left")
        .withColumn("floor", F.coalesce("_floor", unbounded))
        .drop("_floor")
    )


# --- recommendation lists ----------------------------------------------------


def _grouped(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The items of each key as one list, which is in no case longer than what is asked for them."""
    return rows.groupBy(*keys).agg(F.collect_set("track_uri").alias(name))


def _exclusion_counts(excluded: DataFrame, keys: list[str]) -> DataFrame:
    return excluded.groupBy(*keys).agg(F.count("*").alias("_excluded"))


def _popular_lists(
    candidates: DataFrame,
    queries: DataFrame,
    excluded: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """First ``need`` items that are not excluded, per query: by popularity, or ``order``.

    With ``wanted``, only the rows of these lists that are in it, as in recommend.

    Leaving out s items, the wanted ones are among the first need + s of the
    order. Only that head of the list is joined, by position.
    """
    order = order or [F.desc("playlist_count"), F.asc("track_uri")]
    reach = queries.join(_exclusion_counts(excluded, keys), keys, "left").withColumn(
        "_reach",
        (F.col("need") + F.coalesce(F.col("_excluded"), F.lit(0))).cast("bigint"),
    )
    reach = stage(reach.drop("_excluded"), "reach")
    furthest, most, needed = reach.agg(F.max("_reach"), F.max("need"), F.sum("need")).first()
    longest = min(furthest or 0, candidates.count())
    listed = candidates.select("track_uri", "playlist_count", "popularity")
    if longest <= HEAD_ROWS:
        head = top_per_group(
            listed.orderBy(*order).limit(longest).withColumn("_all", F.lit(0)),
            ["_all"],
            order,
            longest,
            name="_at",
        ).drop("_all")
        tasks = min(-(-(needed or 0) // LIST_ROWS) or 1, 20_000)
        return _head_lists(stage(head, "head"), reach, excluded, keys, longest, tasks, wanted)
    numbered = dense_index(listed, order, "_at").withColumn("_at", F.col("_at") + 1)
    head = numbered.filter(F.col("_at") <= longest)
    # Long lists are laid out in pieces that are spread before they unfold.
    last_piece = F.floor((F.least("_reach", F.lit(longest)) - 1) / HEAD_ROWS)
    pieces = reach.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), last_piece))
    ).repartition(*keys, "_piece")
    start = F.col("_piece") * HEAD_ROWS
    places = pieces.withColumn(
        "_at",
        F.explode(
            F.sequence(start + 1, F.least(start + HEAD_ROWS, "_reach", F.lit(longest)))
        ),
    ).drop("_piece")
    scored = spread_join(places, head, "_at").select(
        *keys,
        "need",
        "track_uri",
        (F.col("weight") * F.col("popularity") + F.col("shift")).alias("score"),
        "_at",
    )
    left_over = scored.join(excluded, keys + ["track_uri"], "left_anti")
    lists = top_per_group(left_over, keys, [F.col("_at")], most or 0).filter(F.col("rank") <= F.col("need"))
    return _only(lists.select(*keys, "track_uri", "score", "rank"), wanted, keys)


def _head_lists(
    head: DataFrame, reach: DataFrame, excluded: DataFrame, keys: list[str], longest: int, tasks: int,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Lists of _popular_lists from a short head (_at, track_uri, popularity).

    A query is one row until its list is final: the positions of its excluded items
    are taken out of 1..reach, and what is left unfolds in ``tasks`` tasks, with
    neither a join of the unfolded rows by shuffle nor a sort. Queries of the same
    keys share one list, in which every item comes once for each of them.
    """
    asked = reach.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("need", "weight", "shift"))).alias("_asks"),
        F.max("_reach").alias("_reach"),
    )
    gone = (
        excluded.join(F.broadcast(head.select("track_uri", "_at")), "track_uri")
        .groupBy(*keys)
        .agg(F.collect_set("_at").alias("_gone"))
    )
    copies = F.size("_asks")
    free = F.array_except(
        F.sequence(F.lit(1).cast("bigint"), F.least("_reach", F.lit(longest).cast("bigint"))),
        F.coalesce("_gone", F.array().cast("array<bigint>")),
    )
    length = F.ceil(F.array_max(F.transform("_asks", lambda a: a["need"])) / copies).cast("int")
    lists = asked.join(gone, keys, "left").withColumn("_list", F.slice(free, F.lit(1), length))
    if wanted is None:
        unfolded = lists.repartition(tasks, *keys).select(*keys, "_asks", F.posexplode("_list").alias("_nth", "_at"))
    else:
        of_wanted = [k for k in keys if k in wanted.columns]
        places = wanted.join(F.broadcast(head.select("track_uri", "_at")), "track_uri")
        places = places.groupBy(*of_wanted).agg(F.collect_set("_at").alias("_want"))
        found = F.array_position("_list", F.col("_at")).cast("int") - 1
        unfolded = lists.join(places, of_wanted).select(*keys, "_asks", "_list", F.explode("_want").alias("_at"))
        unfolded = unfolded.select(*keys, "_asks", found.alias("_nth"), "_at").filter("_nth >= 0")
    return (
        unfolded.select(*keys, "_nth", "_at", copies.alias("_copies"), F.posexplode("_asks").alias("_copy", "_ask"))
        .join(F.broadcast(head), "_at")
        .withColumn("rank", (F.col("_nth") * F.col("_copies") + F.col("_copy") + 1).cast("bigint"))
        .filter(F.col("rank") <= F.col("_ask.need"))
        .select(
            *keys,
            "track_uri",
            (F.col("_ask.weight") * F.col("popularity") + F.col("_ask.shift")).alias("score"),
            "rank",
        )
    )


def _bare_order(sign: int) -> list[Column]:
    """Order of items without any vector for queries whose weight has this sign.

    Their score is weight * popularity + shift: popular items first, or last, or by URI alone.
    """
    by = {1: [F.desc("popularity")], 0: [], -1: [F.asc("popularity")]}[sign]
    # Inside a tile, an item without a URI comes last of equals, too.
    return [*by, F.asc_nulls_last("track_uri")]


def _signs(dense: DataFrame) -> list[int]:
    return [r[0] for r in dense.select(F.signum("weight").cast("int")).distinct().collect()]


def _bare_heads(bare: DataFrame, dense: DataFrame, n: int) -> DataFrame | None:
    """The items without any vector that can be in a list of ``n``; None if they are too many.

    The first n that are not excluded are among the first n + s of the order, s being the largest
    number of excluded items of a query.
    """
    reach = n + (dense.agg(F.max("_excluded")).first()[0] or 0)
    if reach > HEAD_ROWS:
        return None
    heads = [bare.orderBy(*_bare_order(sign)).limit(reach) for sign in _signs(dense)]
    return stage(reduce(DataFrame.unionByName, heads).dropDuplicates(["track_uri"]) if len(heads) > 1 else heads[0], "bare-heads")


def _bare_lists(
    bare: DataFrame, dense: DataFrame, excluded: DataFrame, keys: list[str], n: int
) -> list[DataFrame]:
    """The best ``n`` items without any vector for every query, by the sign of its weight."""
    lists = []
    for sign in _signs(dense):
        of_sign = dense.filter(F.signum("weight") == sign).select(
            *keys, "weight", "shift", F.lit(n).cast("bigint").alias("need")
        )
        lists.append(_popular_lists(bare, of_sign, excluded, keys, _bare_order(sign)))
    return lists


def _unique(rows: DataFrame, keys: list[str]) -> bool:
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def _only(lists: DataFrame, wanted: DataFrame | None, keys: list[str]) -> DataFrame:
    if wanted is None:
        return lists
    return lists.join(wanted, [k for k in keys if k in wanted.columns] + ["track_uri"], "left_semi")


def recommend(
    candidates: DataFrame, queries: DataFrame, seeds: DataFrame, keys: list[str], n: int,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """(keys, track_uri, score, rank): best ``n`` candidates of every query.

    ``candidates`` comes from align_factors and is read several times: pass a
    written table. ``queries`` are rows of the *_queries functions, ``seeds``
    (some or all of the keys, track_uri) are never recommended. Equal scores
    are ordered by track_uri.

    A task ranks the whole list of a query, its seeds left out, so no list is merged by a
    shuffle unless there are few queries, or several of the same keys. Large candidate sets are
    cut by score floors first. Candidates without any vector follow from the
    popularity list, whose head is one more block.

    With ``wanted`` (some or all of the keys, track_uri; a stored table), lists are
    ranked as without it, and then only their rows that are in it leave the task, with
    their ranks: what a semi join of the lists would leave.
    """
    queries = stage(queries, "queries")
    shared = [k for k in keys if k in seeds.columns]
    excluded = stage(seeds.select(*shared, "track_uri").distinct(), "seeds")
    counts, gone = _exclusion_counts(excluded, shared), _grouped(excluded, shared, "gone")
    has_vector = F.col("als_q").isNotNull() | F.col("word_q").isNotNull()
    plain = queries.filter(~has_vector).withColumn("need", F.lit(n).cast("bigint"))
    dense = queries.filter(has_vector).join(counts, shared, "left").withColumn("keep", F.lit(n).cast("bigint"))
    if shared != keys and not plain.isEmpty():
        of_plain = lookup_join(excluded, plain.select(*keys).distinct(), shared)
    else:
        of_plain = excluded
    if dense.isEmpty():
        return _popular_lists(candidates, plain, of_plain, keys, wanted=wanted)
    bare = F.col("als").isNull() & F.col("word").isNull()
    placed, others = candidates.filter(~bare), candidates.filter(bare)
    some_bare = not others.isEmpty()
    heads = _bare_heads(others, dense, n) if some_bare else None
    apart = some_bare and heads is None
    asked = _with_floors(placed, dense, keys, n).join(gone, shared, "left")
    shape = _shape(placed, asked, keep_rows=True)
    final = shape[-1] == 1 and not apart and _unique(dense, keys)
    if final and wanted is not None:
        of_wanted = [k for k in keys if k in wanted.columns]
        asked = asked.join(_grouped(wanted, of_wanted, "want"), of_wanted, "left")
    lists = _top_of_tiles(placed, asked.drop("_excluded"), keys, heads, shape)
    if not final:
        best = lists.drop("rank")
        if apart:
            of_dense = excluded if shared == keys else lookup_join(excluded, dense.select(*keys).distinct(), shared)
            for more in _bare_lists(others, dense, of_dense, keys, n):
                best = best.unionByName(more.drop("rank"))
        order = [F.desc("score"), F.asc("track_uri")]
        lists = _only(top_per_group(best, keys, order, n), wanted, keys)
    lists = lists.select(*keys, "track_uri", "score", "rank")
    if plain.isEmpty():
        return lists
    return lists.unionByName(_popular_lists(candidates, plain, of_plain, keys, wanted=wanted))


def pad_with_popularity(
    recs: DataFrame,
    requests: DataFrame,
    seeds: DataFrame,
    candidates: DataFrame,
    keys: list[str],
    n: int,
) -> DataFrame:
    """Lists shorter than ``n`` filled up with popular items.

    Added items follow the ranked ones; neither seeds nor items already listed
    are added. Requests without any list get one made of popular items only.
    """
    held = recs.groupBy(*keys).agg(F.count("*").alias("_held"))
    short = (
        requests.select(*keys)
        .join(held, keys, "left")
        .withColumn("_held", F.coalesce(F.col("_held"), F.lit(0)))
        .filter(F.col("_held") < n)
        .select(
            *keys,
            "_held",
            (F.lit(n) - F.col("_held")).alias("need"),
            F.lit(1.0).alias("weight"),
            F.lit(0.0).alias("shift"),
        )
    )
    short = stage(short, "short")
    if short.isEmpty():
        return recs
    taken = (
        seeds.select(*keys, "track_uri")
        .unionByName(recs.select(*keys, "track_uri"))
        .distinct()
        .join(short.select(*keys), keys, "left_semi")
    )
    filler = _popular_lists(candidates, short.drop("_held"), stage(taken, "taken"), keys)
    offsets = short.select(*keys, "_held")
    padded = filler.join(offsets, keys).select(
        *keys, "track_uri", "score", (F.col("rank") + F.col("_held")).alias("rank")
    )
    return recs.select(*keys, "track_uri", "score", "rank").unionByName(padded)
