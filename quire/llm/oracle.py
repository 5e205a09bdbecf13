"""DuckDB statements that compute what the queries return, straight from the tables."""

# rows without an unusable component, as doubles
_VECTORS = """
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

TOPK_SEARCH = f"""
WITH d AS (SELECT vec_id, list_transform(v, lambda x: floor(64 * x)) AS q FROM ({_VECTORS})),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM d a JOIN d b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE u AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM ({_VECTORS})),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.v, b.v) >= 0.9 * a.n * b.n),
c AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y),
k AS (SELECT x, min(y) AS component_id FROM c GROUP BY x)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.x = e.vec_id) AS n_links, k.component_id,
    k.component_id = e.vec_id AS kept
FROM embeddings e JOIN k ON k.x = e.vec_id"""

# base 32 of a SHA-1: each 5 hexadecimal digits make 4 letters
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31), 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)

WARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS last FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM r"""

JACCARD_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, words[i:i + 3] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
c AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y),
k AS (SELECT x, min(y) AS component_id FROM c GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, k.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN k ON k.x = d.doc_id"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, text,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM t),
l AS (SELECT *, 2 * total AS most, row_number() OVER o AS place,
    (CAST(1.5 AS DOUBLE) * CAST(sum(total) OVER () AS DOUBLE) - CAST(coalesce(sum(2 * total) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM w WINDOW o AS (ORDER BY 2 * total / CAST(weight AS DOUBLE), source NULLS LAST)),
c AS (SELECT *, (SELECT arg_min(level, place) FROM l WHERE level <= most / CAST(weight AS DOUBLE)) AS cut FROM l),
q AS (SELECT d.doc_id, d.size, c.total AS source_size, c.weight, c.cut,
    least(CAST(c.most AS DOUBLE), c.weight * c.cut) AS target,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS queued
    FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN queued / CAST(weight AS DOUBLE) <= cut THEN size ELSE 0 END
       + CASE WHEN (queued + source_size) / CAST(weight AS DOUBLE) <= cut THEN size ELSE 0 END AS BIGINT) AS taken
FROM q"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

MASK_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
l AS (SELECT doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
c AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM l),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (SELECT item_id, term, count(*) AS reps FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT i.item_id, i.term, i.reps * CAST(floor(1000 * ln((2 * all_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM i JOIN f USING (term), c),
s AS (SELECT item_id, p.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM w JOIN p USING (term) JOIN l ON l.doc_id = p.doc_id, c GROUP BY item_id, p.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""

PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, m, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM s, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, g, m, count(*) AS f FROM t GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM t WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, g, m, f, unnest(range(1, m)) AS k FROM f WHERE m > 1),
x AS (SELECT c.*, u.f AS l, v.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.f) // (u.f + v.f) AS BIGINT) AS score
    FROM c JOIN f u ON u.lang = c.lang AND u.g = c.g[1:k] JOIN f v ON v.lang = c.lang AND v.g = c.g[k + 1:c.m]),
b AS (SELECT lang, g, f, l, r, score FROM x QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT lang, g[i:i + z - 1] AS g, max(f) AS longer FROM (SELECT lang, g, f, m, z, unnest(range(1, m - z + 2)) AS i
    FROM f, (SELECT unnest([2, 3]) AS z) WHERE z < m) GROUP BY ALL),
y AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.f AS a, l, r, n, score FROM b JOIN n USING (lang)
    LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR 100 * o.longer < 80 * b.f),
z AS (SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INT) AS rank, phrase, a, l, r, n, score FROM y)
SELECT * FROM z WHERE rank <= 2000"""
