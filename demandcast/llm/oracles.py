"""DuckDB equivalents of the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op7_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS cap FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3.0::DOUBLE, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sources
), levels AS (
    SELECT *, cap / weight AS ratio,
           ((SELECT 1.5 * sum(source_size) FROM sources)
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, least(cap, weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source LIMIT 1)) AS target
    FROM levels
), ordered AS (
    SELECT s.*, source_size, target,
           CASE WHEN target >= source_size THEN target - source_size ELSE target END AS budget,
           CASE WHEN target >= source_size THEN 1 ELSE 0 END AS once,
           sum(size) OVER (PARTITION BY s.source ORDER BY hash) AS through,
           sum(size) OVER (PARTITION BY s.source ORDER BY hash) - sum(size) OVER (PARTITION BY s.source, hash) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (once + CASE WHEN through <= budget OR (before <= budget AND budget - before > through - budget)
                                THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

ORACLES["op12_shingle_join"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[n : n + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS n FROM worded WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 80 * (min(x.size) + min(y.size) - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.size, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""


def _nearest(name: str, books: str) -> str:
    """Parts with their nearest entry in ``books``, the lower of equal ones."""
    return f"""{name} AS MATERIALIZED (
    SELECT vec_id, p, k, d FROM (
        SELECT v.vec_id, v.p, e.k, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - e.x[i]) * (v.x[i] - e.x[i]))) AS d,
               row_number() OVER (PARTITION BY v.vec_id, v.p ORDER BY d, e.k) AS place
        FROM parts v JOIN {books} e ON v.p = e.p
    ) WHERE place = 1
)"""


def _updated(name: str, books: str, nearest: str) -> str:
    """Entries at the floor of their parts' mean, unused ones as they were."""
    return f"""{name} AS MATERIALIZED (
    SELECT e.p, e.k, coalesce(m.x, e.x) AS x FROM {books} e LEFT JOIN (
        SELECT p, k, list(mean ORDER BY i) AS x FROM (
            SELECT p, k, i, CAST((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
            FROM (SELECT n.p, n.k, unnest(range(1, len(v.x) + 1)) AS i, unnest(v.x) AS c
                  FROM {nearest} n JOIN parts v ON n.vec_id = v.vec_id AND n.p = v.p)
            GROUP BY p, k, i
        ) GROUP BY p, k
    ) m ON e.p = m.p AND e.k = m.k
)"""


ORACLES["op13_vector_codes"] = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, label, p, v[CAST(p * (len(v) // 16) + 1 AS BIGINT) : CAST((p + 1) * (len(v) // 16) AS BIGINT)] AS x
    FROM (SELECT vec_id, label, v, unnest(range(16)) AS p FROM kept)
), books0 AS MATERIALIZED (
    SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS k, x
    FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
),
{_nearest("near0", "books0")},
{_updated("books1", "books0", "near0")},
{_nearest("near1", "books1")},
{_updated("books2", "books1", "near1")},
{_nearest("near2", "books2")},
coded AS (
    SELECT vec_id, string_agg(printf('%02x', CAST(k AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near2 GROUP BY vec_id
)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, k)) FROM books2) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id)
"""
