r"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its query from the raw driver tables with plain
SQL, independently of the Spark code, over the whole tables.  The shared
common table expressions below restate the adapters and the stage rules:

* regexes are given to RE2 as raw text (``\p{L}``, ``\n`` inside a class);
* ``row_number`` is cast to INTEGER (Spark's width), sums to BIGINT;
* doubles are rounded in the final projection only, with ``+ 0.0`` where a
  rounded value could be a negative zero.
"""

from __future__ import annotations

from quire.operators.similar import lsh_directions
from quire.plans.queries import CLOSER_THRESHOLD, LSH_BUCKET, LSH_TABLES, SIMILAR_THRESHOLD

# --- shared CTEs ------------------------------------------------------------

NEWS = r"""
news AS (
  SELECT doc_id AS m_id, text AS context, lang AS platform,
         CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS our_tags,
         CAST(NULL AS VARCHAR) AS descr, source,
         CASE ((doc_id % 4) + 4) % 4
              WHEN 0 THEN NULL WHEN 1 THEN 'unknow' WHEN 2 THEN '[]'
              ELSE '["' || source || '", "' || lang || '"]' END AS source_tags,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((doc_id % 64800) * 7919 % 64800 AS BIGINT)) AS time
  FROM documents
)"""


def _clean(col: str) -> str:
    return (
        f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'unknow' "
        f"ELSE replace(replace({col}, chr(10), ''), chr(13), '') END"
    )


def articles_from(source: str) -> str:
    return f"""
SELECT m_id AS article_id, platform AS channel_name,
       {_clean('descr')} AS article_describe,
       our_tags AS channel_tags, title,
       {_clean('context')} AS content, source, source_tags,
       concat_ws(',', source_tags, platform, title, {_clean('context')}) AS sentence,
       time AS article_time
FROM {source}"""


ART = f"art AS ({articles_from('news')})"

AS_OF = "as_of AS (SELECT max(time) AS t FROM news)"

KEEP = (
    "CASE WHEN regexp_full_match(word, '[A-Za-z]+') THEN length(word) >= 3 "
    "ELSE length(word) >= 2 END"
)


def tokens_of(source: str) -> str:
    return rf"""
SELECT article_id, CAST(pos AS INTEGER) AS pos, word FROM (
  SELECT article_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT article_id,
               regexp_extract_all(regexp_replace(sentence, '<[^>\n]*>', '', 'g'), '\p{{L}}+') AS w
        FROM {source}))
WHERE {KEEP}"""


TOK = f"tok AS ({tokens_of('art')})"


def tf_of(source: str) -> str:
    return f"SELECT article_id, word, count(*) AS tf FROM {source} GROUP BY article_id, word"


TF = f"tf AS ({tf_of('tok')})"


def vocab_of(tf: str, docs: str) -> str:
    return f"""
SELECT keyword, "count", df, idf, index FROM (
  SELECT s.word AS keyword, s."count", s.df,
         ln((d.m + 1.0) / (s.df + 1.0)) AS idf,
         row_number() OVER (ORDER BY s."count" DESC, s.word ASC) - 1 AS index
  FROM (SELECT word, CAST(sum(tf) AS BIGINT) AS "count", count(*) AS df
        FROM {tf} GROUP BY word) s,
       (SELECT count(*) AS m FROM {docs}) d
  WHERE s.df >= 1)"""


VOCAB = f"vocab AS ({vocab_of('tf', 'art')})"


def scored_of(tf: str, vocab: str) -> str:
    return f"""
SELECT t.article_id, v.keyword, v.index, t.tf, v.idf, t.tf * v.idf AS tfidf
FROM {tf} t JOIN {vocab} v ON t.word = v.keyword"""


def keywords_of(scored: str, arts: str) -> str:
    return f"""
SELECT r.article_id, a.channel_name, r.keyword, round(r.tfidf, 4) AS tfidf,
       a.article_time, r.rank
FROM (SELECT article_id, keyword, index, tfidf,
             CAST(row_number() OVER (PARTITION BY article_id
                                     ORDER BY tfidf DESC, index ASC) AS INTEGER) AS rank
      FROM {scored}) r
JOIN {arts} a ON r.article_id = a.article_id
WHERE r.rank <= 20"""


KW = f"scored AS ({scored_of('tf', 'vocab')}), kw AS ({keywords_of('scored', 'art')})"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [NEWS, ART]
KEYWORDS = [NEWS, ART, TOK, TF, VOCAB, KW]

# --- statements --------------------------------------------------------------

ORACLE: dict[str, str] = {}

ORACLE["article_prepare"] = with_ctes(*BASE) + "SELECT * FROM art"

ORACLE["article_dedup"] = with_ctes(*BASE) + "SELECT DISTINCT * FROM art"

ORACLE["html_words"] = f"""
SELECT article_id AS page_id, pos, word
FROM ({tokens_of('(SELECT page_id AS article_id, html AS sentence FROM pages)')})"""

ORACLE["article_window"] = with_ctes(NEWS, AS_OF) + articles_from(
    """(SELECT n.* FROM news n, as_of
       WHERE n.time >= date_trunc('hour', as_of.t) + INTERVAL 30 MINUTE - INTERVAL 2 HOUR
         AND n.time <  date_trunc('hour', as_of.t) + INTERVAL 30 MINUTE)"""
)

ORACLE["article_window_daily"] = with_ctes(NEWS, AS_OF) + articles_from(
    """(SELECT n.* FROM news n, as_of
       WHERE n.time >= date_trunc('day', as_of.t) - INTERVAL 1 DAY
         AND n.time <  date_trunc('day', as_of.t))"""
)

ORACLE["article_tokens"] = with_ctes(*BASE, TOK) + "SELECT article_id, pos, word FROM tok"

# the lattice of every letter run from its end to its start: each step keeps the
# best weights of the places a word can reach; then the path from the start
ORACLE["article_segments"] = (
    with_ctes(
        *BASE,
        TOK,
        TF,
        VOCAB,
        'total AS (SELECT CAST(sum("count") AS DOUBLE) AS t FROM vocab)',
        r"""lex AS (SELECT keyword AS word, length(keyword) AS len, CAST(floor(1000 * ln("count" / t)) AS BIGINT) AS w,
              CASE WHEN index < 50 THEN 'u' WHEN lower(keyword[1:1]) <> keyword[1:1] THEN 'x' ELSE 'n' END AS flag
            FROM vocab, total WHERE "count" >= t / 200000)""",
        r"""runs AS (SELECT article_id, run, length(run) AS n, row_number() OVER () AS r, place FROM (
              SELECT article_id, unnest(w) AS run, generate_subscripts(w, 1) AS place FROM (
                SELECT article_id, regexp_extract_all(regexp_replace(replace(sentence, ' ', ''), '<[^>\n]*>', '', 'g'), '\p{L}+') AS w
                FROM art)))""",
        """spots AS (SELECT r, i, run[i:i + len - 1] AS piece, len FROM (SELECT r, run, n, unnest(range(1, n + 1)) AS i FROM runs),
              (SELECT DISTINCT len FROM lex UNION SELECT 1) WHERE i + len - 1 <= n)""",
        """edges AS (SELECT r, i, list({'w': coalesce(lex.w, CAST(floor(1000 * ln(1 / t)) AS BIGINT)), 'len': CAST(spots.len AS BIGINT)}) AS e
            FROM spots LEFT JOIN lex ON lex.word = piece, total WHERE lex.w IS NOT NULL OR spots.len = 1 GROUP BY r, i)""",
        # places from the last to the first: weights ahead, length of the word that starts there
        """folded AS (SELECT r, list_reduce(list(e ORDER BY i DESC), lambda a, x: {
                'e': CAST([] AS STRUCT(w BIGINT, len BIGINT)[]),
                'ahead': list_prepend(list_sort(list_transform(x.e, lambda y: {'w': y.w + a.ahead[y.len], 'len': y.len}), 'DESC')[1].w, a.ahead[1:200]),
                'steps': list_prepend(list_sort(list_transform(x.e, lambda y: {'w': y.w + a.ahead[y.len], 'len': y.len}), 'DESC')[1].len, a.steps)},
              {'e': CAST([] AS STRUCT(w BIGINT, len BIGINT)[]), 'ahead': [CAST(0 AS BIGINT)], 'steps': CAST([] AS BIGINT[])}).steps AS steps
            FROM (SELECT r, i, {'e': e, 'ahead': CAST([] AS BIGINT[]), 'steps': CAST([] AS BIGINT[])} AS e FROM edges) GROUP BY r)""",
        # from the first place on: where a word starts, the next starts its length later
        """path AS (SELECT r, unnest(list_reduce(list_transform(steps, lambda x, i: {'s': x, 'i': i, 'next': CAST(1 AS BIGINT), 'marks': CAST([] AS BIGINT[])}),
              lambda a, x: {'s': x.s, 'i': x.i, 'next': CASE WHEN x.i = a.next THEN x.i + x.s ELSE a.next END,
                            'marks': CASE WHEN x.i = a.next THEN list_append(a.marks, x.i) ELSE a.marks END},
              {'s': CAST(0 AS BIGINT), 'i': CAST(0 AS BIGINT), 'next': CAST(1 AS BIGINT), 'marks': CAST([] AS BIGINT[])}).marks) AS i, steps
            FROM folded)""",
        """cut AS (SELECT article_id, run[i:i + steps[i] - 1] AS word,
              CAST(row_number() OVER (PARTITION BY article_id ORDER BY place, i) - 1 AS INTEGER) AS pos
            FROM path JOIN runs USING (r))""",
    )
    + """
SELECT article_id, pos, cut.word, flag FROM cut JOIN lex ON lex.word = cut.word
WHERE flag IN ('n', 'x') AND length(cut.word) >= 2"""
)

ORACLE["tokens_filtered"] = with_ctes(*BASE, TOK, TF, VOCAB) + """
SELECT t.word, t.article_id, t.pos FROM tok t
WHERE t.word NOT IN (SELECT keyword FROM vocab WHERE index < 50)"""

ORACLE["term_frequency"] = with_ctes(*BASE, TOK, TF, VOCAB) + f"""
SELECT article_id, keyword, index, tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf
FROM ({scored_of('tf', 'vocab')})"""

ORACLE["keyword_vocabulary"] = with_ctes(*BASE, TOK, TF, VOCAB) + """
SELECT keyword, "count", df, round(idf, 6) AS idf, index FROM vocab"""

ORACLE["article_keywords_top20"] = with_ctes(*KEYWORDS) + "SELECT * FROM kw"

ORACLE["keyword_count"] = with_ctes(*KEYWORDS) + """
SELECT count(*) AS n_keywords, count(DISTINCT article_id) AS n_articles FROM kw"""

ORACLE["article_keywords_incremental"] = with_ctes(
    NEWS,
    ART,
    AS_OF,
    """hist AS (SELECT a.* FROM art a, as_of
                WHERE a.article_time < date_trunc('day', as_of.t) - INTERVAL 1 DAY)""",
    """new AS (SELECT a.* FROM art a, as_of
               WHERE a.article_time >= date_trunc('day', as_of.t) - INTERVAL 1 DAY
                 AND a.article_time <  date_trunc('day', as_of.t))""",
    f"htok AS ({tokens_of('hist')})",
    f"htf AS ({tf_of('htok')})",
    f"hvocab AS ({vocab_of('htf', 'hist')})",
    f"ntok AS ({tokens_of('new')})",
    f"ntf AS ({tf_of('ntok')})",
    f"nscored AS ({scored_of('ntf', 'hvocab')})",
) + keywords_of("nscored", "new")

# --- profile -----------------------------------------------------------------

TOPICS = """
topics AS (
  SELECT k.article_id, k.pos, k.topic FROM (
    SELECT kw.article_id, kw.rank - 1 AS pos, kw.keyword AS topic
    FROM kw JOIN art a ON kw.article_id = a.article_id
    WHERE a.source_tags IS NULL OR a.source_tags = 'unknow' OR length(a.source_tags) <= 3) k
  UNION ALL
  SELECT article_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS topic
  FROM (SELECT a.article_id,
               string_split(translate(a.source_tags, '[]" ', ''), ',') AS t
        FROM art a
        WHERE a.article_id IN (SELECT article_id FROM kw)
          AND NOT (a.source_tags IS NULL OR a.source_tags = 'unknow' OR length(a.source_tags) <= 3))
)"""

ORACLE["article_topics"] = with_ctes(*KEYWORDS, TOPICS) + """
SELECT article_id, CAST(pos AS INTEGER) AS pos, topic FROM topics"""

ORACLE["article_profile"] = with_ctes(*KEYWORDS, TOPICS) + """
SELECT k.article_id, k.channel_name, k.n_keywords, k.keywords, t.topics, k.article_time
FROM (SELECT article_id, min(channel_name) AS channel_name, CAST(count(*) AS INTEGER) AS n_keywords,
             string_agg(keyword, ',' ORDER BY keyword) AS keywords, min(article_time) AS article_time
      FROM kw GROUP BY article_id) k
JOIN (SELECT article_id, string_agg(topic, ',' ORDER BY pos) AS topics
      FROM topics GROUP BY article_id) t ON k.article_id = t.article_id"""

ORACLE["keyword_index_table"] = with_ctes(*KEYWORDS) + """
SELECT k.article_id, k.channel_name, v.index, k.tfidf FROM kw k JOIN vocab v ON v.keyword = k.keyword"""

ORACLE["profile_explode"] = with_ctes(*KEYWORDS) + """
SELECT article_id, channel_name, keyword, tfidf AS weight, article_time FROM kw"""

# --- vectors -----------------------------------------------------------------

ORACLE["article_vector"] = with_ctes(
    *KEYWORDS,
    """wv AS (SELECT v.keyword AS word, CAST(e.embedding AS DOUBLE[]) AS vector
              FROM vocab v JOIN embeddings e ON v.index % (SELECT count(*) FROM embeddings) = e.vec_id)""",
    """wvec AS (SELECT DISTINCT k.article_id, list_transform(wv.vector, lambda x: x * k.tfidf) AS wvec
                FROM kw k JOIN wv ON k.keyword = wv.word)""",
    """attrs AS (SELECT k.article_id, min(k.channel_name) AS channel_name,
                        min(k.article_time) AS article_time
                 FROM kw k JOIN wv ON k.keyword = wv.word GROUP BY k.article_id)""",
) + """
SELECT c.article_id, a.channel_name, a.article_time, CAST(c.i - 1 AS INTEGER) AS pos,
       round(avg(c.x), 4) + 0.0 AS x
FROM (SELECT article_id, unnest(wvec) AS x, generate_subscripts(wvec, 1) AS i FROM wvec) c
JOIN attrs a ON c.article_id = a.article_id
GROUP BY c.article_id, a.channel_name, a.article_time, c.i"""

ORACLE["article_vector_refresh"] = ORACLE["article_vector"].replace(
    "GROUP BY c.article_id, a.channel_name, a.article_time, c.i",
    """WHERE a.article_time >= (SELECT date_trunc('day', max(time)) - INTERVAL 2 DAY FROM news)
  AND a.article_time < (SELECT date_trunc('day', max(time)) FROM news)
GROUP BY c.article_id, a.channel_name, a.article_time, c.i""",
)

# words of an article in order, pairs up to 5 places apart, positive pointwise
# mutual information, summed with the sign bits of the context word's MD5
ORACLE["word_vectors"] = with_ctes(
    *BASE,
    TOK,
    "seq AS (SELECT article_id, word, row_number() OVER (PARTITION BY article_id ORDER BY pos) AS i FROM tok)",
    "kept AS (SELECT word FROM tok GROUP BY word HAVING count(*) >= 3)",
    """near AS (SELECT x.word AS a, y.word AS b FROM seq x JOIN seq y
               ON x.article_id = y.article_id AND y.i - x.i BETWEEN 1 AND 5)""",
    """pairs AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM near UNION ALL SELECT b, a FROM near)
               WHERE a IN (SELECT word FROM kept) AND b IN (SELECT word FROM kept) GROUP BY a, b)""",
    "margin AS (SELECT a, CAST(sum(n) AS DOUBLE) AS total FROM pairs GROUP BY a)",
    """ppmi AS (SELECT p.a, p.b, ln(p.n * (SELECT sum(total) FROM margin) / (x.total * y.total)) AS pmi
              FROM pairs p JOIN margin x ON x.a = p.a JOIN margin y ON y.a = p.b)""",
    "dims AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS pos)",
) + """
SELECT a AS word, pos, round(sum(pmi * (1 - 2 *
    ((CAST('0x' || substr(md5(b || '#' || (pos // 128)), 8 * (pos % 128 // 32) + 1, 8) AS BIGINT) >> (pos % 32)) & 1))), 3) + 0.0 AS x
FROM ppmi, dims WHERE pmi > 0 GROUP BY a, pos"""

ARTICLE_VECTORS = """
av AS (SELECT vec_id AS article_id, CAST(embedding AS DOUBLE[]) AS v,
              TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(
                CASE WHEN vec_id % 10 = 0 THEN 64799 - (vec_id % 64800) * 7 % 90
                     ELSE (vec_id % 64800) * 7919 % 64800 END AS BIGINT)) AS t
       FROM embeddings),
av_as_of AS (SELECT max(t) AS t FROM av),
new_av AS (SELECT av.* FROM av, av_as_of WHERE av.t >= date_trunc('hour', av_as_of.t) - INTERVAL 2 HOUR),
hist_av AS (SELECT av.* FROM av, av_as_of WHERE av.t >= date_trunc('hour', av_as_of.t) - INTERVAL 30 DAY)"""

def _lsh_pairs() -> str:
    tables = " UNION ALL ".join(
        f"SELECT {t} AS k, {u}::DOUBLE[] AS u" for t, u in enumerate(lsh_directions(64, LSH_TABLES))
    )
    return f"""
dirs AS ({tables}),
nb AS (SELECT article_id, v, k, floor(list_dot_product(v, u) / {LSH_BUCKET}) AS b FROM new_av, dirs),
hb AS (SELECT article_id AS similar_id, v AS w, k, floor(list_dot_product(v, u) / {LSH_BUCKET}) AS b FROM hist_av, dirs),
lsh AS (SELECT DISTINCT article_id, similar_id, round(d, 4) + 0.0 AS distance FROM (
  SELECT article_id, similar_id,
         sqrt(list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM nb JOIN hb USING (k, b))
  WHERE d < {SIMILAR_THRESHOLD} AND article_id <> similar_id AND d <> 0)"""


LSH_PAIRS = _lsh_pairs()

ORACLE["similar_articles_lsh"] = with_ctes(ARTICLE_VECTORS, LSH_PAIRS) + "SELECT * FROM lsh"

ORACLE["similar_store_upsert"] = with_ctes(
    ARTICLE_VECTORS,
    LSH_PAIRS,
    "even AS (SELECT DISTINCT article_id AS t FROM lsh WHERE article_id % 20 = 0)",
    """sides AS (SELECT article_id, similar_id, distance FROM lsh
              UNION SELECT similar_id AS article_id, article_id AS similar_id, distance FROM lsh)""",
    "runs AS (SELECT *, article_id IN (FROM even) OR similar_id IN (FROM even) AS again FROM sides)",
) + f"""
SELECT article_id, similar_id, distance,
       CASE WHEN again THEN TIMESTAMP '2024-02-16' ELSE TIMESTAMP '2024-02-15' END AS computed_at
FROM runs WHERE NOT again OR distance < {CLOSER_THRESHOLD}"""

ORACLE["similar_articles_exact"] = with_ctes(ARTICLE_VECTORS) + """
SELECT article_id, similar_id, round(d, 4) + 0.0 AS distance FROM (
  SELECT n.article_id, h.article_id AS similar_id,
         sqrt(list_sum(list_transform(list_zip(n.v, h.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM new_av n, hist_av h)
WHERE d < 1.2 AND article_id <> similar_id AND d <> 0"""

# --- recall ------------------------------------------------------------------

CLICKS = """
beh AS (SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN user_id % 3 = 0 THEN '"' || json_extract_string(props, '$.k') || '"'
                    ELSE json_extract_string(props, '$.k') END AS articles,
               CAST(event_type = 'click' AS INTEGER) AS click_art, strftime(ts, '%Y-%m-%d') AS dt
        FROM events),
ev_as_of AS (SELECT max(ts) AS t FROM events),
clicks AS (SELECT b.user_id, replace(b.articles, '"', '') AS article_id, max(b.click_art) AS clicked
           FROM beh b, ev_as_of
           WHERE b.dt > strftime(date_trunc('hour', ev_as_of.t + INTERVAL 45 DAY) - INTERVAL 60 DAY, '%Y-%m-%d')
           GROUP BY b.user_id, replace(b.articles, '"', ''))"""

ORACLE["user_item_clicks"] = with_ctes(CLICKS) + "SELECT user_id, article_id, clicked FROM clicks"

# batches and repeated deliveries change no row of the table
ORACLE["behaviour_store_clicks"] = ORACLE["user_item_clicks"]

ORACLE["als_index"] = with_ctes(CLICKS) + """
SELECT 'user' AS kind, user_id AS key,
       CAST(row_number() OVER (ORDER BY n DESC, user_id ASC) - 1 AS INTEGER) AS als_id
FROM (SELECT user_id, count(*) AS n FROM clicks GROUP BY user_id)
UNION ALL
SELECT 'article' AS kind, article_id AS key,
       CAST(row_number() OVER (ORDER BY n DESC, article_id ASC) - 1 AS INTEGER) AS als_id
FROM (SELECT article_id, count(*) AS n FROM clicks GROUP BY article_id)"""

ORACLE["als_recall_coverage"] = with_ctes(CLICKS) + """
SELECT user_id, CAST(least(50, (SELECT count(DISTINCT article_id) FROM clicks)) AS INTEGER) AS n_items,
       least(50, (SELECT count(DISTINCT article_id) FROM clicks)) AS n_known
FROM clicks GROUP BY user_id"""

ORACLE["factor_recall"] = with_ctes(
    CLICKS,
    "e AS (SELECT CAST(vec_id AS VARCHAR) AS article_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
    "pop AS (SELECT article_id, count(*) AS n FROM clicks WHERE clicked = 1 GROUP BY article_id)",
    """uf AS (SELECT user_id, list(x ORDER BY pos) AS u FROM (
             SELECT user_id, pos, sum(v[pos]) AS x
             FROM clicks JOIN e USING (article_id), range(1, 65) AS r(pos) WHERE clicked = 1 GROUP BY user_id, pos)
           GROUP BY user_id)""",
    """scored AS (SELECT user_id, article_id, list_dot_product(u, v) * (1 + coalesce(n, 0)) AS s
               FROM uf, e LEFT JOIN pop USING (article_id))""",
) + """
SELECT user_id, rank, article_id, round(s, 6) + 0.0 AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY s DESC, article_id) AS INTEGER) AS rank FROM scored)
WHERE rank <= 50"""

ORACLE["recall_table"] = with_ctes(
    CLICKS,
    """u AS (SELECT user_id, row_number() OVER (ORDER BY n DESC, user_id) - 1 AS i
           FROM (SELECT user_id, count(*) AS n FROM clicks GROUP BY user_id))""",
    """a AS (SELECT article_id, row_number() OVER (ORDER BY n DESC, article_id) - 1 AS i
           FROM (SELECT article_id, count(*) AS n FROM clicks GROUP BY article_id))""",
) + """
SELECT t.user_id, CAST(count(*) AS INTEGER) AS n_items,
       '[' || string_agg('"' || c.article_id || '"', ', ' ORDER BY c.clicked DESC, a.i) || ']' AS als_ids
FROM clicks c JOIN u ON u.user_id = c.user_id JOIN a ON a.article_id = c.article_id JOIN u t ON t.i = u.i + 1
GROUP BY t.user_id"""

ORACLE["article_store_upsert"] = with_ctes(*BASE) + """
SELECT article_id, channel_name, CASE WHEN article_id % 3 = 0 THEN 'edited' ELSE title END AS title,
       CASE WHEN article_id % 3 = 0 THEN article_time + INTERVAL 1 DAY ELSE article_time END AS article_time
FROM art WHERE article_id % 7 <> 0 OR article_id % 3 = 0 OR article_id % 5 = 0"""

ORACLE["snapshot_reads"] = with_ctes(*BASE) + """
SELECT 'between' AS moment, article_id, title, length(content) AS n_chars, article_time FROM art
UNION ALL
SELECT 'after' AS moment, article_id, CASE WHEN article_id % 5 = 0 THEN 'edit 2' ELSE title END AS title,
       length(content) + CASE WHEN article_id % 5 = 0 THEN 2 ELSE 0 END AS n_chars,
       CASE WHEN article_id % 5 = 0 THEN article_time + INTERVAL 2 DAY ELSE article_time END AS article_time
FROM art"""

ORACLE["store_views"] = with_ctes(*KEYWORDS) + """
SELECT a.article_id, a.title, a.article_time, count(k.keyword) AS n_keywords,
       coalesce(string_agg(k.keyword, ',' ORDER BY k.keyword), '') AS keywords
FROM (SELECT article_id, CASE WHEN article_id % 3 = 0 THEN 'edited' ELSE title END AS title,
             CASE WHEN article_id % 3 = 0 THEN article_time + INTERVAL 1 DAY ELSE article_time END AS article_time
      FROM art WHERE article_id % 7 <> 0 OR article_id % 3 = 0) a
LEFT JOIN kw k ON k.article_id = a.article_id AND k.rank <= CASE WHEN a.article_id % 3 = 0 THEN 2 ELSE 5 END
GROUP BY a.article_id, a.title, a.article_time"""

ORACLE["delivery_windows"] = with_ctes(
    NEWS,
    """own AS (SELECT m_id, platform, coalesce(length(context), 0) AS n_chars, time,
              least(CAST(floor(date_diff('minute', TIMESTAMP '2024-01-01', time) * 4 / 64800) AS INTEGER)
                + CASE WHEN m_id % 7 = 2 THEN 2 WHEN m_id % 11 = 4 THEN 1 ELSE 0 END, 3) AS d FROM news)""",
    "feed AS (SELECT * FROM own UNION ALL SELECT m_id, platform, n_chars, time, least(d + 1, 3) FROM own WHERE m_id % 10 = 3)",
    """marks AS (SELECT x.d, (SELECT max(time) - INTERVAL 2 DAY FROM feed WHERE feed.d < x.d) AS mark
            FROM (SELECT DISTINCT d FROM feed) x)""",
    """kept AS (SELECT DISTINCT m_id, platform, n_chars, time FROM feed JOIN marks USING (d) WHERE mark IS NULL OR time > mark)""",
) + """
SELECT date_trunc('day', time)::TIMESTAMP AS window_start, platform AS channel_name, count(*) AS n_articles,
       CAST(sum(n_chars) AS BIGINT) AS n_chars, max(time) AS newest
FROM kept WHERE date_trunc('day', time) + INTERVAL 1 DAY <= (SELECT max(time) - INTERVAL 2 DAY FROM feed) GROUP BY 1, 2"""
