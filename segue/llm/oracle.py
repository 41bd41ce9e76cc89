"""SQL (DuckDB) for those text queries that SQL can express."""

from __future__ import annotations

import re

from segue.llm.licenses import NOTICES, STRETCH, TEXTS

_LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(
               trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
           ) AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT k.*, s.key IS NOT NULL AND s.keeper <> k.doc_id AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id
"""

_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5('7:' || doc_id), 1, 12) AS BIGINT) + 0.5::DOUBLE)
               / 281474976710656::DOUBLE AS u
    FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)] AS w
    FROM totals
), ordered AS (
    SELECT *, 2 * source_size AS cap,
           CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS amount,
           coalesce(sum(2 * source_size) OVER (
               ORDER BY 2 * source_size / CAST(w AS DOUBLE), source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
           sum(w) OVER (
               ORDER BY 2 * source_size / CAST(w AS DOUBLE), source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
    FROM weighted
), marked AS (
    SELECT *, CAST(cap_before * w + cap * w_left AS DOUBLE) <= amount * w AS "full" FROM ordered
), targets AS (
    SELECT source, source_size,
           CASE WHEN "full" THEN CAST(cap AS DOUBLE)
                ELSE least(CAST(cap AS DOUBLE),
                     (amount - CAST(coalesce(sum(cap) FILTER ("full") OVER (), 0) AS DOUBLE)) * w
                     / CAST(sum(w) FILTER (NOT "full") OVER () AS DOUBLE)) END AS target
    FROM marked
), planned AS (
    SELECT *, target / source_size AS copies FROM targets
), ranked AS (
    SELECT d.doc_id, d.size, p.source, p.source_size, p.target, floor(p.copies) AS whole,
           p.target - floor(p.copies) * p.source_size AS goal,
           p.copies - floor(p.copies) AS part,
           (d.u / (1 - d.u)) / ((p.copies - floor(p.copies)) / (1 - (p.copies - floor(p.copies)))) AS rank
    FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
), summed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN part > 0 AND before + size / 2.0 <= goal THEN 1 ELSE 0 END) * size
            AS BIGINT) AS taken
FROM summed
"""

_URL_FILTER = r"""
WITH rules(rule, host, path, verdict) AS (VALUES
    ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), parsed AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), matched AS (
    SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
           row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS n
    FROM parsed p LEFT JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM matched WHERE n = 1
"""

_TOPK = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256::DOUBLE * x::DOUBLE) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_DECONTAMINATION = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n,
           list_slice(w, i, i + least(13, len(w)) - 1) AS phrase
    FROM item_words, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT n FROM windows
), runs AS (
    SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS phrase
    FROM doc_words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
    WHERE len(w) >= n
), hits AS (
    SELECT r.doc_id, r.i, r.n, w.item_id FROM runs r JOIN windows w ON r.n = w.n AND r.phrase = w.phrase
), per_doc AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
), per_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN per_items i USING (doc_id)
"""

_LICENSES = r"""
WITH templates(id, whole, name, body) AS (VALUES
__TEMPLATES__
), files AS (
    SELECT doc_id, text, length(text) AS chars,
           concat_ws('/', source, lang,
               CASE WHEN n_chars >= 1000 THEN CAST(doc_id // 1000 AS VARCHAR) END) AS folder
    FROM documents
), total AS (
    SELECT count(*) AS n FROM files
), template_words AS (
    SELECT id, whole, name, w, count(*) AS n
    FROM templates, unnest(regexp_extract_all(lower(body), '[\p{L}\p{N}]+')) AS t(w) GROUP BY ALL
), df AS (
    SELECT w, count(*) AS df
    FROM files, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS t(w) GROUP BY w
), idf AS (
    SELECT w, ln((1 + total.n) / CAST(1 + coalesce(df.df, 0) AS DOUBLE)) + 1 AS idf
    FROM (SELECT w FROM template_words UNION SELECT w FROM df) LEFT JOIN df USING (w), total
), vectors AS (
    SELECT id, whole, name, w, n * idf / sqrt(sum(n * n * idf * idf) OVER (PARTITION BY id)) AS x
    FROM template_words JOIN idf USING (w)
), passages AS (
    SELECT doc_id, part, passage, len(regexp_extract_all(lower(passage), '[\p{L}\p{N}]+')) AS n
    FROM (SELECT doc_id, unnest(string_split_regex(text, '\n\s*\n')) AS passage,
                 generate_subscripts(string_split_regex(text, '\n\s*\n'), 1) AS part FROM files)
), placed AS (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY part
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM passages WHERE n > 0
), lines AS (
    SELECT doc_id, part, unnest(string_split(passage, chr(10))) AS unit,
           generate_subscripts(string_split(passage, chr(10)), 1) AS pos
    FROM passages
), stretches AS (
    SELECT a.doc_id, a.part, b.part AS last FROM placed a JOIN placed b
      ON a.doc_id = b.doc_id AND b.part > a.part AND b.start + b.n - a.start <= __MOST__
), units AS (
    SELECT doc_id, part, pos, unit FROM lines
    UNION ALL SELECT doc_id, part, -1, passage FROM passages WHERE contains(passage, chr(10))
    UNION ALL SELECT s.doc_id, s.part, -1 - s.last, string_agg(p.passage, chr(10) || chr(10) ORDER BY p.part)
              FROM stretches s JOIN placed p ON s.doc_id = p.doc_id AND p.part BETWEEN s.part AND s.last
              GROUP BY s.doc_id, s.part, s.last
), unit_words AS (
    SELECT doc_id, part, pos, w, count(*) AS n
    FROM units, unnest(regexp_extract_all(lower(unit), '[\p{L}\p{N}]+')) AS t(w) GROUP BY ALL
), weighed AS (
    SELECT doc_id, part, pos, w, n * idf AS x FROM unit_words JOIN idf USING (w)
), norms AS (
    SELECT doc_id, part, pos, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL
), cosines AS (
    SELECT g.doc_id, g.part, g.pos, v.name, round(sum(g.x * v.x) / any_value(n.norm), 6) AS cosine
    FROM weighed g JOIN vectors v USING (w)
    JOIN norms n ON g.doc_id = n.doc_id AND g.part = n.part AND g.pos = n.pos
    WHERE v.whole OR g.pos >= -1
    GROUP BY g.doc_id, g.part, g.pos, v.id, v.name HAVING cosine >= 0.8
), unit_best AS (
    SELECT c.doc_id, c.part, c.pos, max(c.cosine) AS cosine, first(c.name ORDER BY c.cosine DESC, c.name) AS name,
           any_value(length(u.unit)) AS size
    FROM cosines c JOIN units u ON c.doc_id = u.doc_id AND c.part = u.part AND c.pos = u.pos
    GROUP BY c.doc_id, c.part, c.pos
), part_best AS (
    SELECT doc_id, part, greatest(coalesce(sum(size) FILTER (pos >= 0), 0),
                                  coalesce(sum(size) FILTER (pos = -1), 0)) AS size,
           coalesce(max(size) FILTER (pos < -1), 0) AS longest
    FROM unit_best GROUP BY doc_id, part
), own AS (
    SELECT doc_id, folder, any_value(chars) AS chars, greatest(sum(p.size), max(p.longest)) AS size,
           any_value(b.own_license) AS own_license, any_value(b.cosine) AS cosine
    FROM part_best p JOIN files USING (doc_id) JOIN (
        SELECT doc_id, max(cosine) AS cosine, first(name ORDER BY cosine DESC, name) AS own_license
        FROM unit_best GROUP BY doc_id) b USING (doc_id)
    GROUP BY doc_id, folder
), folders AS (
    SELECT folder, own_license AS name FROM own WHERE size >= chars * 0.1::DOUBLE GROUP BY folder, own_license
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY count(*) DESC, own_license) = 1
), inherited AS (
    SELECT f.folder, g.folder AS inherited_from, g.name AS inherited_license
    FROM (SELECT DISTINCT folder FROM files) f JOIN folders g
      ON f.folder = g.folder OR starts_with(f.folder, g.folder || '/')
    QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(g.folder) DESC) = 1
)
SELECT f.doc_id, o.own_license, o.cosine,
       CASE WHEN o.doc_id IS NULL THEN i.inherited_license END AS inherited_license,
       CASE WHEN o.doc_id IS NULL THEN i.inherited_from END AS inherited_from,
       coalesce(o.own_license, i.inherited_license) AS license
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN inherited i ON f.folder = i.folder
"""

# crc32 by its definition: a shift for each bit of each digit.
_PERIODIC_RUNS = r"""
WITH given AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(4294967295, list_reduce(
               list_concat([4294967295::BIGINT], list_transform(
                   string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda crc, byte: list_reduce(
                   list_concat([xor(crc, byte)], [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
                   lambda c, bit: xor(c >> 1, 3988292384 * (c & 1))))) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted,
           (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS times
    FROM given
), words AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // times) ELSE i END] AS word
    FROM numbers, unnest(range(n)) AS t(i)
), equal AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word
    WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n
), streaks AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS streak FROM equal)
    GROUP BY doc_id, q, streak HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM streaks GROUP BY doc_id, start, length
), lists AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs r WHERE NOT EXISTS (
        SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (
            o.length * r.period > r.length * o.period OR o.length * r.period = r.length * o.period
            AND (o.start < r.start OR o.start = r.start AND o.period < r.period)))
), gone AS (
    SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) AS t(i)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT g.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period,
       1000 * b.length // b.period AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(coalesce(k.words, '')) AS collapsed_sha256
FROM given g LEFT JOIN lists l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_LEXICAL_SEARCH = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (
    SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms)
    GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, docs
), gains AS (
    SELECT c.doc_id, c.term,
           w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS gain
    FROM counts c JOIN weights USING (term) JOIN sizes USING (doc_id), totals
), scores AS (
    SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score
    FROM item_terms JOIN gains USING (term) GROUP BY item_id, doc_id HAVING sum(gain) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores QUALIFY rank <= 50
"""


def _licenses() -> str:
    rows = [(i >= len(NOTICES), *t) for i, t in enumerate([*NOTICES, *TEXTS])]
    values = [f"    ({i}, {whole}, '{name}', '{text}')" for i, (whole, name, text) in enumerate(rows)]
    most = STRETCH * max(len(re.findall(r"[^\W_]+", text)) for _, text in TEXTS)
    return _LICENSES.replace("__TEMPLATES__", ",\n".join(values)).replace("__MOST__", str(most))


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": _LINE_DEDUP,
        "op3_mixing": _MIXING,
        "op5_licenses": _licenses(),
        "op6_url_filter": _URL_FILTER,
        "op7_topk": _TOPK,
        "op9_decontamination": _DECONTAMINATION,
        "op12_periodic_runs": _PERIODIC_RUNS,
        "op13_lexical_search": _LEXICAL_SEARCH,
    }
