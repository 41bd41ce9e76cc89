"""SQL for the registered queries, on the source tables alone.

Written against the star schema with plain windows, joins and lists, so that it
shares nothing with the Spark side but the question.
"""

from __future__ import annotations

from segue.plans.queries import (
    ALS_SMALL,
    FILES,
    FRACTION,
    LITERAL_USERS,
    LONG,
    MIN_PAIRS,
    MIN_PAIRS_SAMPLED,
    N,
    NATION_FRACTION,
    SCENARIOS,
    SIMILAR_TO,
    SLICE_PIDS,
    TOP_ITEMS,
    TOP_PRODUCTS,
    VOCABULARIES,
    WIDE,
    WORD2VEC_SMALL,
)


def _drawn(key: str, seed: int) -> str:
    """The 32-bit number that decides whether a key is sampled."""
    word = f"(xor({key}, {key} >> 32) & 4294967295)"
    for shift, multiplier, added in [(16, 569420461, seed), (15, 1935289751, 0)]:
        word = f"(((xor({word}, {word} >> {shift}) * {multiplier}) & 4294967295) + {added}) & 4294967295"
        word = f"({word})"
    return f"xor({word}, {word} >> 15)"


# Each fragment is one CTE; NEEDS lists the ones it reads.
PARTS = {
    "pt": """
        SELECT o_custkey AS pid, 'item:' || CAST(l_partkey AS VARCHAR) AS track_uri,
               row_number() OVER (
                   PARTITION BY o_custkey
                   ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey,
                            l_suppkey, l_extendedprice) - 1 AS pos
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "tracks": """
        SELECT 'item:' || CAST(p_partkey AS VARCHAR) AS track_uri,
               p_name AS track_name, p_brand AS artist_uri, p_brand AS artist_name,
               p_type AS album_uri, p_type AS album_name,
               p_size * 1000 AS duration_ms
        FROM part""",
    "lengths": "SELECT pid, count(*) AS num_tracks FROM pt GROUP BY pid",
    "heads": """
        SELECT pid, num_tracks, ' ' || c_mktsegment || ' ' AS name,
               CASE WHEN c_acctbal >= 5000 THEN c_name END AS description,
               c_nationkey % 2 = 0 AS collaborative,
               1 + c_custkey % 97 AS num_followers
        FROM lengths JOIN customer ON pid = c_custkey""",
    "edits": """
        SELECT o_custkey AS pid, count(*) AS num_edits,
               CAST(epoch(max(o_orderdate)) AS BIGINT) AS modified_at
        FROM orders GROUP BY 1""",
    "details": """
        SELECT pid, count(DISTINCT album_uri) AS num_albums,
               count(DISTINCT artist_uri) AS num_artists,
               CAST(sum(duration_ms) AS BIGINT) AS duration_ms
        FROM pt JOIN tracks USING (track_uri) GROUP BY pid""",
    "counts": "SELECT track_uri, count(*) AS playlist_count FROM pt GROUP BY 1",
    "popularity": """
        SELECT track_uri, playlist_count,
               rank() OVER (ORDER BY playlist_count DESC) AS popularity_rank
        FROM counts""",
    "kept": f"""
        SELECT pid, track_uri FROM pt JOIN popularity USING (track_uri)
        WHERE popularity_rank <= {TOP_ITEMS}""",
    "cooc": f"""
        SELECT a.track_uri AS track_uri_1, b.track_uri AS track_uri_2,
               count(*) AS co_count
        FROM kept a JOIN kept b ON a.pid = b.pid AND a.track_uri < b.track_uri
        GROUP BY 1, 2 HAVING count(*) >= {MIN_PAIRS}""",
    "reserved": f"""
        SELECT pid, name FROM (
            SELECT pid, name, num_tracks, {_drawn("pid", 0)} AS draw FROM heads)
        WHERE num_tracks >= {LONG} AND draw < {FRACTION} * 4294967296
        """,
    "validation": "SELECT pt.* FROM pt WHERE pid IN (SELECT pid FROM reserved)",
    "train": "SELECT pt.* FROM pt WHERE pid NOT IN (SELECT pid FROM reserved)",
    "baseline": """
        SELECT track_uri, playlist_count,
               rank() OVER (ORDER BY playlist_count DESC) AS pop_rank
        FROM (SELECT track_uri, count(*) AS playlist_count FROM train GROUP BY 1)""",
    "ids": """
        SELECT track_uri, row_number() OVER (ORDER BY track_uri) - 1 AS track_id
        FROM (SELECT DISTINCT track_uri FROM train)""",
    "known": """
        SELECT pid, track_uri, pos,
               row_number() OVER (PARTITION BY pid ORDER BY pos) AS nth
        FROM validation WHERE track_uri IN (SELECT track_uri FROM baseline)""",
    "scenarios": "SELECT * FROM (VALUES "
    + ", ".join(f"('{name}', {k})" for name, k in SCENARIOS.items())
    + ") AS v(scenario, k)",
    "seeds": """
        SELECT scenario, pid, track_uri, pos FROM known, scenarios WHERE nth <= k""",
    "holdout": """
        SELECT DISTINCT scenario, pid, track_uri
        FROM known, scenarios WHERE nth > k""",
    "candidates": """
        SELECT track_uri, playlist_count,
               playlist_count / (SELECT CAST(max(playlist_count) AS DOUBLE)
                                 FROM baseline) AS popularity
        FROM baseline""",
    "factors": """
        SELECT 'item:' || CAST(vec_id AS VARCHAR) AS track_uri,
               CAST(embedding AS DOUBLE[]) AS v
        FROM embeddings""",
    "normed": """
        SELECT track_uri, v, sqrt(list_dot_product(v, v)) AS norm FROM factors""",
    # Queries of all scenarios; title_only has no seeds at all.
    "asked": "SELECT DISTINCT scenario, pid FROM holdout",
    "means": """
        SELECT scenario, pid, dim, avg(x) AS m FROM (
            SELECT scenario, pid, unnest(v) AS x, unnest(range(len(v))) AS dim
            FROM seeds JOIN normed USING (track_uri) WHERE norm > 0)
        GROUP BY ALL""",
    "profiles": """
        SELECT scenario, pid, list(m ORDER BY dim) AS p,
               sqrt(sum(m * m)) AS p_norm
        FROM means GROUP BY scenario, pid""",
    "raw": """
        SELECT scenario, pid, track_uri, popularity,
               p IS NOT NULL AS has_profile,
               CASE WHEN p IS NULL THEN NULL WHEN v IS NULL THEN 0.0
                    ELSE list_dot_product(v, p) END AS als,
               CASE WHEN p IS NULL THEN NULL WHEN v IS NULL OR norm = 0 THEN 0.0
                    ELSE list_dot_product(v, p) / norm
                         / CASE WHEN p_norm > 0 THEN p_norm ELSE 1 END END AS cosine
        FROM asked LEFT JOIN profiles USING (scenario, pid)
        CROSS JOIN candidates LEFT JOIN normed USING (track_uri)""",
    "ranges": """
        SELECT scenario, pid, min(als) AS low, max(als) AS high
        FROM raw GROUP BY scenario, pid""",
    "scored": """
        SELECT scenario, pid, track_uri, model,
               CASE model
                   WHEN 'Popularity' THEN popularity
                   WHEN 'ALS' THEN CASE WHEN has_profile THEN als ELSE popularity END
                   WHEN 'Word2Vec'
                       THEN CASE WHEN has_profile THEN cosine ELSE popularity END
                   ELSE 0.1 * popularity + CASE WHEN has_profile THEN
                       0.5 * CASE WHEN high > low THEN (als - low) / (high - low)
                                  ELSE als END + 0.4 * (cosine + 1) / 2
                       ELSE 0 END
               END AS score
        FROM raw JOIN ranges USING (scenario, pid),
             (VALUES ('Popularity'), ('ALS'), ('Word2Vec'), ('Hybrid')) AS m(model)""",
    "recs": f"""
        SELECT * FROM (
            SELECT scenario, model, pid, track_uri, score,
                   row_number() OVER (PARTITION BY scenario, model, pid
                                      ORDER BY score DESC, track_uri) AS rank
            FROM scored ANTI JOIN seeds USING (scenario, pid, track_uri))
        WHERE rank <= {N}""",
    "sizes": "SELECT scenario, pid, count(*) AS held FROM holdout GROUP BY 1, 2",
    "hits": """
        SELECT scenario, model, pid,
               count(*) FILTER (WHERE rank <= held) AS early,
               sum(1 / log2(rank + 1)) AS dcg, min(rank) AS first_hit
        FROM recs JOIN holdout USING (scenario, pid, track_uri)
        JOIN sizes USING (scenario, pid) GROUP BY ALL""",
    "ideals": f"""
        SELECT held, sum(1 / log2(i + 1)) AS ideal FROM (
            SELECT held, unnest(range(1, least(held, {N}) + 1)) AS i
            FROM (SELECT DISTINCT held FROM sizes)) GROUP BY held""",
    "metrics": f"""
        SELECT scenario, model, pid, coalesce(early, 0) / held AS r_precision,
               coalesce(dcg, 0) / ideal AS ndcg,
               CAST(coalesce((first_hit - 1) // 10, {N} // 10 + 1) AS BIGINT) AS clicks
        FROM sizes JOIN ideals USING (held)
        CROSS JOIN (VALUES ('Popularity'), ('ALS'), ('Word2Vec'), ('Hybrid'))
            AS m(model)
        LEFT JOIN hits USING (scenario, model, pid)""",
    "summary": """
        SELECT scenario, model, avg(r_precision) AS r_precision, avg(ndcg) AS ndcg,
               avg(clicks) AS clicks, count(*) AS evaluated
        FROM metrics GROUP BY ALL""",
    "requests": """
        SELECT pid, CASE WHEN pid % 3 <> 0 THEN name END AS name,
               CASE pid % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 25 END
                   AS num_samples
        FROM reserved""",
}

NEEDS = {
    "lengths": ["pt"],
    "heads": ["lengths"],
    "details": ["pt", "tracks"],
    "counts": ["pt"],
    "popularity": ["counts"],
    "kept": ["pt", "popularity"],
    "cooc": ["kept"],
    "reserved": ["heads"],
    "validation": ["pt", "reserved"],
    "train": ["pt", "reserved"],
    "baseline": ["train"],
    "ids": ["train"],
    "known": ["validation", "baseline"],
    "seeds": ["known", "scenarios"],
    "holdout": ["known", "scenarios"],
    "candidates": ["baseline"],
    "normed": ["factors"],
    "asked": ["holdout"],
    "means": ["seeds", "normed"],
    "profiles": ["means"],
    "raw": ["asked", "profiles", "candidates", "normed"],
    "ranges": ["raw"],
    "scored": ["raw", "ranges"],
    "recs": ["scored", "seeds"],
    "sizes": ["holdout"],
    "hits": ["recs", "holdout", "sizes"],
    "ideals": ["sizes"],
    "metrics": ["sizes", "ideals", "hits"],
    "summary": ["metrics"],
    "requests": ["reserved"],
}


def _with(parts: list[str], select: str, replaced: dict[str, str] | None = None) -> str:
    """``select`` preceded by the CTEs it needs, ``replaced`` ones changed."""
    bodies = {**PARTS, **(replaced or {})}
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        add(part)
    ctes = ",\n".join(f"{name} AS ({bodies[name]})" for name in ordered)
    return f"WITH {ctes}\n{select}"


# Scoring queries ask for every reserved playlist with its first ten items.
_FIRST_10 = {
    "scenarios": "SELECT 'first_10' AS scenario, 10 AS k",
    "asked": "SELECT 'first_10' AS scenario, pid FROM reserved",
}


def _bucketed(value: str, source: str, parts: list[str], cases: str, names) -> str:
    bucket, count, pct = names
    return _with(
        parts,
        f"""
        SELECT bucket AS {bucket}, n AS {count},
               round(n * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 2) AS {pct}
        FROM (SELECT CASE {cases} END AS bucket, count(*) AS n
              FROM (SELECT {value} AS x FROM {source}) GROUP BY 1)""",
    )


def _model_lists(model: str) -> str:
    return _with(
        ["recs"],
        f"""SELECT pid, track_uri, round(score, 6) AS score, rank
            FROM recs WHERE model = '{model}'""",
        _FIRST_10,
    )


# The request lists: seeds come from the raw rows of each playlist, known to the
# training data or not.
_REQUESTED = {
    "scenarios": "SELECT 'request' AS scenario, 0 AS k",
    "asked": "SELECT 'request' AS scenario, pid FROM requests",
    "seeds": """
        SELECT 'request' AS scenario, pid, track_uri, pos
        FROM validation JOIN requests USING (pid) WHERE pos < num_samples""",
}


def _requested(select: str) -> str:
    return _with(["requests", "recs"], select, _REQUESTED)


def oracle_sql() -> dict[str, str]:
    sql = {}
    sql["playlists_flat"] = _with(
        ["heads", "edits", "details"],
        """
        SELECT pid, name, description, collaborative,
               CAST(modified_at AS INTEGER) AS modified_at,
               CAST(num_tracks AS INTEGER) AS num_tracks,
               CAST(num_albums AS INTEGER) AS num_albums,
               CAST(num_artists AS INTEGER) AS num_artists,
               CAST(num_followers AS INTEGER) AS num_followers,
               CAST(num_edits AS INTEGER) AS num_edits, duration_ms
        FROM heads JOIN edits USING (pid) JOIN details USING (pid)""",
    )
    sql["interactions_flat"] = _with(
        ["pt"], "SELECT pid, track_uri, CAST(pos AS INTEGER) AS pos FROM pt"
    )
    sql["tracks_dedup"] = _with(
        ["pt", "tracks"],
        """
        SELECT track_uri, track_name, artist_uri, artist_name, album_uri,
               album_name, CAST(duration_ms AS INTEGER) AS duration_ms
        FROM (SELECT tracks.*, row_number() OVER (PARTITION BY track_uri
                                                  ORDER BY pid, pos) AS nth
              FROM pt JOIN tracks USING (track_uri)) WHERE nth = 1""",
    )
    sql["read_slices_roundtrip"] = _with(
        ["pt", "heads", "tracks"],
        """
        SELECT pid, name, collaborative, CAST(pos AS INTEGER) AS pos, track_uri,
               album_name
        FROM pt JOIN heads USING (pid) JOIN tracks USING (track_uri)""",
    )
    sql["validate_counts"] = _with(
        ["pt", "tracks"],
        """
        SELECT name, CAST(n AS DOUBLE) AS actual, CAST(n AS DOUBLE) AS expected,
               TRUE AS ok
        FROM (SELECT 'playlists' AS name, count(DISTINCT pid) AS n FROM pt
              UNION ALL SELECT 'total_tracks', count(*) FROM pt
              UNION ALL SELECT 'unique_tracks', count(DISTINCT track_uri) FROM pt
              UNION ALL SELECT 'unique_artists', count(DISTINCT artist_uri)
                        FROM pt JOIN tracks USING (track_uri)
              UNION ALL SELECT 'unique_albums', count(DISTINCT album_uri)
                        FROM pt JOIN tracks USING (track_uri)
              UNION ALL SELECT 'avg_playlist_length',
                        count(*) / CAST(count(DISTINCT pid) AS DOUBLE) FROM pt)""",
    )
    sql["length_stats"] = _with(
        ["lengths"],
        """
        SELECT min(num_tracks) AS min_length, max(num_tracks) AS max_length,
               avg(num_tracks) AS avg_length,
               quantile_cont(num_tracks, 0.25) AS p25,
               quantile_cont(num_tracks, 0.5) AS median,
               quantile_cont(num_tracks, 0.75) AS p75,
               quantile_cont(num_tracks, 0.95) AS p95
        FROM lengths""",
    )
    sql["length_histogram"] = _bucketed(
        "num_tracks",
        "lengths",
        ["lengths"],
        """WHEN x <= 10 THEN '5-10' WHEN x <= 25 THEN '11-25'
           WHEN x <= 50 THEN '26-50' WHEN x <= 100 THEN '51-100'
           WHEN x <= 150 THEN '101-150' ELSE '151-250'""",
        ("length_bucket", "num_playlists", "pct"),
    )
    sql["follower_histogram"] = _bucketed(
        "num_followers",
        "heads",
        ["heads"],
        """WHEN x = 1 THEN '1' WHEN x = 2 THEN '2' WHEN x <= 5 THEN '3-5'
           WHEN x <= 10 THEN '6-10' WHEN x <= 50 THEN '11-50' ELSE '50+'""",
        ("follower_bucket", "num_playlists", "pct"),
    )
    sql["frequency_histogram"] = _bucketed(
        "playlist_count",
        "counts",
        ["counts"],
        """WHEN x = 1 THEN '1 (appears once)' WHEN x <= 5 THEN '2-5'
           WHEN x <= 20 THEN '6-20' WHEN x <= 100 THEN '21-100'
           WHEN x <= 1000 THEN '101-1000' WHEN x <= 10000 THEN '1001-10000'
           ELSE '10000+'""",
        ("frequency_bucket", "num_tracks", "pct_of_tracks"),
    )
    sql["title_counts"] = _with(
        ["heads"],
        """
        SELECT lower(trim(name)) AS title_normalized, count(*) AS count FROM heads
        GROUP BY 1 ORDER BY count DESC, title_normalized LIMIT 20""",
    )
    sql["description_share"] = _with(
        ["heads"],
        """
        SELECT count(description) AS with_description,
               round(count(description) * 100.0 / CAST(count(*) AS DOUBLE), 2) AS pct
        FROM heads""",
    )
    sql["collaborative_counts"] = _with(
        ["heads"],
        "SELECT collaborative, count(*) AS num_playlists FROM heads GROUP BY 1",
    )
    sql["top_tracks"] = _with(
        ["pt", "tracks"],
        """
        SELECT track_name, artist_name, count(*) AS playlist_count
        FROM pt JOIN tracks USING (track_uri) GROUP BY 1, 2
        ORDER BY playlist_count DESC, track_name, artist_name LIMIT 20""",
    )
    sql["top_artists"] = sql["top_artists_sql"] = _with(
        ["pt", "tracks"],
        """
        SELECT artist_name, count(*) AS track_appearances
        FROM pt JOIN tracks USING (track_uri) GROUP BY 1
        ORDER BY track_appearances DESC, artist_name LIMIT 20""",
    )
    sql["item_counts"] = _with(["counts"], "SELECT * FROM counts")
    sql["track_popularity"] = _with(["popularity"], "SELECT * FROM popularity")
    sql["artist_popularity"] = _with(
        ["pt", "tracks"],
        """
        SELECT artist_uri, artist_name, count(*) AS total_appearances,
               count(DISTINCT track_uri) AS unique_tracks,
               count(DISTINCT pid) AS unique_playlists,
               rank() OVER (ORDER BY count(*) DESC) AS popularity_rank
        FROM pt JOIN tracks USING (track_uri) GROUP BY 1, 2""",
    )
    sql["cooccurrence"] = _with(["cooc"], "SELECT * FROM cooc")
    sql["cooccurrence_sampled"] = _with(
        ["pt"],
        f"""
        SELECT a.track_uri AS track_uri_1, b.track_uri AS track_uri_2,
               count(*) AS co_count
        FROM pt a JOIN pt b ON a.pid = b.pid AND a.track_uri < b.track_uri
        WHERE {_drawn("a.pid", 42)} < {FRACTION} * 4294967296
        GROUP BY 1, 2 HAVING count(*) >= {MIN_PAIRS_SAMPLED}""",
    )
    sql["top_pairs"] = _with(
        ["cooc", "tracks"],
        """
        SELECT track_uri_1, track_uri_2, a.track_name AS track_1,
               a.artist_name AS artist_1, b.track_name AS track_2,
               b.artist_name AS artist_2, co_count
        FROM cooc JOIN tracks a ON a.track_uri = track_uri_1
        JOIN tracks b ON b.track_uri = track_uri_2
        ORDER BY co_count DESC, track_uri_1, track_uri_2 LIMIT 20""",
    )
    sql["validation_playlists"] = _with(["reserved"], "SELECT pid, name FROM reserved")
    sql["validation_split"] = _with(["validation"], "SELECT * FROM validation")
    sql["train_split"] = _with(["train"], "SELECT * FROM train")
    sql["split_counts"] = _with(
        ["validation", "train"],
        """
        SELECT (SELECT count(*) FROM reserved) AS validation_playlists,
               (SELECT count(*) FROM train) AS train_rows,
               (SELECT count(*) FROM validation) AS removed_rows""",
    )
    sql["pop_baseline"] = _with(["baseline"], "SELECT * FROM baseline")
    sql["popularity_topn_labeled"] = _with(
        ["baseline", "tracks"],
        """
        SELECT pop_rank, track_uri, track_name, artist_name, playlist_count
        FROM baseline JOIN tracks USING (track_uri)
        ORDER BY pop_rank, track_uri LIMIT 10""",
    )
    sql["dense_index"] = _with(["ids"], "SELECT * FROM ids")
    sql["sequences"] = _with(
        ["pt"],
        """
        SELECT pid, pos // 1000 AS part, whole AS num_tracks,
               count(*) AS part_tracks,
               string_agg(track_uri, ' ' ORDER BY pos) AS track_sequence
        FROM (SELECT *, count(*) OVER (PARTITION BY pid) AS whole FROM pt)
        WHERE whole >= 5 GROUP BY pid, pos // 1000, whole""",
    )
    sql["seed_items"] = _with(["seeds"], "SELECT * FROM seeds")
    sql["seed_holdout"] = _with(["holdout"], "SELECT * FROM holdout")
    sql["candidate_index"] = _with(
        ["candidates"],
        """SELECT track_uri, playlist_count, round(popularity, 6) AS popularity
           FROM candidates""",
    )
    sql["aligned_factors"] = _with(
        ["candidates", "normed"],
        """
        SELECT track_uri, round(norm, 6) AS als_norm,
               CASE WHEN norm > 0 THEN 1.0::DOUBLE WHEN norm = 0 THEN 0.0::DOUBLE END
                   AS word_unit_norm
        FROM candidates LEFT JOIN normed USING (track_uri)""",
    )
    sql["factor_coverage"] = _with(
        ["candidates", "normed"],
        """
        SELECT count(*) AS candidates, count(v) AS als_covered,
               count(v) AS word_covered
        FROM candidates LEFT JOIN normed USING (track_uri)""",
    )
    sql["profile_vectors"] = _with(
        ["means", "profiles"],
        """
        SELECT pid, dim, round(m, 6) AS mean,
               round(m / CASE WHEN p_norm > 0 THEN p_norm ELSE 1 END, 6) AS unit_mean
        FROM means JOIN profiles USING (scenario, pid)""",
        _FIRST_10,
    )
    sql["similar_items"] = _with(
        ["normed", "tracks"],
        f"""
        SELECT track_uri, track_name, artist_name, round(cosine, 6) AS similarity
        FROM (SELECT n.track_uri,
                     list_dot_product(n.v, q.v) / (n.norm * q.norm) AS cosine
              FROM normed n, normed q
              WHERE q.track_uri = '{SIMILAR_TO}' AND n.track_uri <> q.track_uri
                    AND n.norm > 0
              ORDER BY cosine DESC, n.track_uri LIMIT 10)
        JOIN tracks USING (track_uri)""",
    )
    sql["score_popularity"] = _model_lists("Popularity")
    sql["score_als"] = _model_lists("ALS")
    sql["score_w2v"] = _model_lists("Word2Vec")
    sql["score_hybrid"] = _model_lists("Hybrid")
    sql["pad_with_popularity"] = _with(
        ["recs"],
        f"""
        , kept_recs AS (
            SELECT pid, track_uri, rank FROM recs WHERE model = 'ALS' AND rank <= 10),
        filler AS (
            SELECT pid, track_uri,
                   10 + row_number() OVER (PARTITION BY pid
                       ORDER BY playlist_count DESC, track_uri) AS rank
            FROM (SELECT pid FROM reserved) CROSS JOIN candidates
            ANTI JOIN (SELECT pid, track_uri FROM seeds
                       UNION SELECT pid, track_uri FROM kept_recs) AS taken
            USING (pid, track_uri))
        SELECT * FROM kept_recs
        UNION ALL SELECT * FROM filler WHERE rank <= {N}""",
        _FIRST_10,
    )
    sql["eval_metrics"] = _with(
        ["metrics"],
        """
        SELECT scenario, pid, model, round(r_precision, 6) AS r_precision,
               round(ndcg, 6) AS ndcg, clicks FROM metrics""",
    )
    sql["eval_summary"] = sql["metrics_roundtrip"] = _with(
        ["summary"],
        """
        SELECT scenario, model, round(r_precision, 6) AS r_precision,
               round(ndcg, 6) AS ndcg, round(clicks, 6) AS clicks, evaluated
        FROM summary""",
    )
    place = "CASE model WHEN 'Popularity' THEN 1 WHEN 'ALS' THEN 2 "
    place += "WHEN 'Word2Vec' THEN 3 ELSE 4 END"
    sql["best_model"] = _with(
        ["summary"],
        f"""
        SELECT scenario, model, round(r_precision, 6) AS r_precision,
               round(ndcg, 6) AS ndcg
        FROM (SELECT *, row_number() OVER (PARTITION BY scenario
                  ORDER BY round(r_precision, 12) DESC, {place}) AS nth FROM summary)
        WHERE nth = 1""",
    )
    sql["improvement"] = _with(
        ["summary"],
        """
        SELECT s.scenario, s.model,
               CASE WHEN b.r_precision > 0 THEN
                   round((s.r_precision - b.r_precision) / b.r_precision * 100, 4) + 0.0
               END AS gain_pct
        FROM summary s JOIN summary b USING (scenario)
        WHERE b.model = 'Popularity' AND s.model <> 'Popularity'""",
    )
    sql["request_scenarios"] = _with(
        ["requests"],
        """
        SELECT CAST(num_samples AS BIGINT) AS num_samples,
               name IS NOT NULL AS has_title, count(*) AS requests
        FROM requests GROUP BY 1, 2""",
    )
    sql["recommend_requests"] = sql["export_roundtrip"] = _requested(
        "SELECT pid, track_uri, rank FROM recs WHERE model = 'Hybrid'"
    )
    sql["export_recommendations"] = _requested(
        """
        SELECT pid, CAST(pid AS VARCHAR) || ', '
                    || string_agg(track_uri, ', ' ORDER BY rank) AS line
        FROM recs WHERE model = 'Hybrid' GROUP BY pid"""
    )
    sql["verify_recommendations"] = _with(
        ["requests", "validation", "candidates"],
        f"""
        , head AS (SELECT track_uri FROM candidates
                   ORDER BY playlist_count DESC, track_uri LIMIT {N}),
        given AS (SELECT DISTINCT pid, track_uri
                  FROM validation JOIN requests USING (pid) WHERE pos < num_samples)
        SELECT pid, 'wrong_count' AS violation, (SELECT count(*) FROM head) AS detail
        FROM requests
        UNION ALL SELECT pid, 'duplicates', (SELECT count(*) FROM head) FROM requests
        UNION ALL SELECT pid, 'seed_overlap', count(*)
                  FROM given JOIN head USING (track_uri) GROUP BY pid""",
    )
    sql["als_ratings"] = _with(
        ["train", "ids"],
        """
        SELECT CAST(pid AS INTEGER) AS user_id, CAST(track_id AS INTEGER) AS item_id,
               CAST(count(*) AS DOUBLE) AS rating
        FROM train JOIN ids USING (track_uri) GROUP BY 1, 2""",
    )
    sql["slice_quarantine"] = _with(
        ["pt"],
        f"""
        , files AS (SELECT pid // {SLICE_PIDS} AS slice, count(DISTINCT pid) AS playlists, count(*) AS tracks
                    FROM pt GROUP BY 1),
        judged AS (SELECT *, CASE WHEN slice % 7 = 3 THEN 'malformed' WHEN slice % 5 = 4 THEN 'no playlists'
                                  ELSE 'read' END AS status FROM files)
        SELECT status, count(*) AS files,
               CAST(sum(CASE WHEN status = 'read' THEN playlists ELSE 0 END) AS BIGINT) AS playlists,
               CAST(sum(CASE WHEN status = 'read' THEN tracks ELSE 0 END) AS BIGINT) AS tracks
        FROM judged GROUP BY status""",
    )
    sql["literal_queries"] = _with(
        ["pt"],
        f"""SELECT pid, count(*) AS num_tracks FROM pt
            WHERE pid IN ({", ".join(map(str, LITERAL_USERS))}) GROUP BY pid""",
    )
    sql["file_count"] = _with(
        ["pt"], f"SELECT CAST({FILES} AS BIGINT) AS files, count(*) AS num_rows FROM pt"
    )
    sql["table_layout"] = _with(
        ["heads"],
        """SELECT collaborative, count(*) AS playlists, CAST(sum(num_tracks) AS BIGINT) AS tracks
           FROM heads WHERE collaborative GROUP BY collaborative""",
    )
    sql["eval_first_100"] = _with(
        ["summary"],
        """SELECT scenario, model, round(r_precision, 6) AS r_precision, round(ndcg, 6) AS ndcg,
                  round(clicks, 6) AS clicks, evaluated FROM summary""",
        {
            "pt": """
                SELECT CAST(c_nationkey AS BIGINT) AS pid,
                       'item:' || CAST(l_partkey AS VARCHAR) AS track_uri,
                       row_number() OVER (
                           PARTITION BY c_nationkey
                           ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey,
                                    l_suppkey, l_extendedprice) - 1 AS pos
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON c_custkey = o_custkey""",
            "heads": "SELECT pid, num_tracks, 'nation' AS name FROM lengths",
            "reserved": f"""
                SELECT pid, name FROM (
                    SELECT pid, name, num_tracks, {_drawn("pid", 0)} AS draw FROM heads)
                WHERE num_tracks >= 100 AND draw < {NATION_FRACTION} * 4294967296""",
        },
    )
    sql["als_wide_ids"] = _with(
        ["train"],
        f"""SELECT pid + {WIDE} AS pid, row_number() OVER (ORDER BY pid) - 1 AS user_id, n AS ratings
            FROM (SELECT pid, count(*) AS n FROM train GROUP BY pid)""",
    )
    sql["als_residuals"] = _with(
        ["train"], "SELECT pid, count(*) AS ratings, true AS solved FROM train GROUP BY pid"
    )
    sql["model_roundtrip"] = _with(
        ["ids"],
        f"SELECT track_uri, CAST({ALS_SMALL['rank']} AS BIGINT) AS dim, true AS same FROM ids",
    )
    sql["top_items_by_product"] = _with(
        ["pt", "normed"],
        f"""
        , means AS (SELECT pid, dim, avg(x) AS m FROM (
                SELECT pid, unnest(v) AS x, unnest(range(len(v))) AS dim
                FROM pt JOIN normed USING (track_uri) WHERE norm > 0) GROUP BY ALL),
        people AS (SELECT pid, list(m ORDER BY dim) AS p FROM means GROUP BY pid),
        scored AS (SELECT pid, track_uri, list_dot_product(p, v) AS score FROM people, factors)
        SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY score DESC, track_uri) AS rank,
               track_uri, round(score, 6) AS score
        FROM scored QUALIFY rank <= {TOP_PRODUCTS}""",
    )
    sql["als_item_dims"] = _with(
        ["ids"], f"SELECT track_uri, CAST({ALS_SMALL['rank']} AS BIGINT) AS dim FROM ids"
    )
    sql["word_vocabulary"] = _with(
        ["train"],
        f"""
        SELECT track_uri, CAST({WORD2VEC_SMALL['vectorSize']} AS BIGINT) AS dim
        FROM (SELECT *, count(*) OVER (PARTITION BY pid) AS whole FROM train)
        WHERE whole >= 5 GROUP BY track_uri HAVING count(*) >= 5""",
    )
    sql["word_min_count"] = _with(
        ["train"],
        f"""
        , words AS (
            SELECT track_uri, count(*) AS n
            FROM (SELECT *, count(*) OVER (PARTITION BY pid) AS whole FROM train)
            WHERE whole >= 5 GROUP BY track_uri),
        tried AS (SELECT 5 AS c UNION SELECT n + 1 FROM words WHERE n >= 5),
        left_over AS (SELECT c, (SELECT count(*) FROM words WHERE n >= c) AS vocabulary FROM tried)
        SELECT most, c AS min_count, vocabulary
        FROM left_over, (SELECT unnest([{", ".join(map(str, VOCABULARIES))}]::BIGINT[]) AS most)
        WHERE vocabulary <= most
        QUALIFY row_number() OVER (PARTITION BY most ORDER BY c) = 1""",
    )
    return sql
