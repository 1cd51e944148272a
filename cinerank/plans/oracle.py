"""Independent DuckDB SQL for every SQL-expressible registered query.

Each statement inlines the stand-in views as CTEs over the raw test tables
(``lineitem orders part events embeddings``) and computes the answer by brute
force -- e.g. content similarity over all movie pairs sharing a term, dense
similarity over all vector pairs -- so it checks the Spark operators'
algorithms (blocking, signatures, partial top-k) rather than repeating them.
"""

from __future__ import annotations

from cinerank import config
from cinerank.plans import catalog as C

VIEWS = {
    "ratings": """ratings AS (
  SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid,
         ceil(l_quantity / 5) / 2 AS score, CAST(epoch(l_shipdate) AS INT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "movies": """movies AS (
  SELECT CAST(p_partkey AS INT) AS mid, p_name AS name,
         concat(p_name, ' by ', p_brand) AS descri, concat(p_size, ' minutes') AS timelong,
         concat('January 1, ', 1960 + p_partkey % 60) AS shoot,
         CAST(1960 + p_partkey % 60 AS VARCHAR) AS issue, 'English' AS language,
         concat(replace(p_name, ' ', '|'), '|', p_type) AS genres,
         p_brand AS director, concat('Actor ', p_partkey % 37) AS actors
  FROM part)""",
    "tags": """tags AS (
  SELECT CAST(user_id AS INT) AS uid, CAST(json_extract_string(props, '$.k') AS INT) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS INT) AS "timestamp"
  FROM events)""",
    "rating_events": """rating_events AS (
  SELECT event_id, ts, CAST(user_id AS INT) AS uid,
         CAST(json_extract_string(props, '$.k') AS INT) AS mid,
         ((event_id % 10) + 1) / 2.0 AS score, CAST(floor(epoch(ts)) AS INT) AS "timestamp"
  FROM events)""",
    "log_lines": """log_lines AS (
  SELECT event_id, CASE
    WHEN event_id % 50 = 1 THEN 'INFO app MOVIE_RATING_PREFIX:'
    WHEN event_id % 50 = 2 THEN concat('INFO app MOVIE_RATING_PREFIX:', uid, '|', mid, '|bad|', "timestamp")
    WHEN event_id % 3 = 0  THEN concat('INFO app heartbeat ', event_id)
    ELSE concat('INFO app MOVIE_RATING_PREFIX:', uid, '|', mid, '|', score, '|', "timestamp", ' ')
  END AS value
  FROM rating_events)""",
    "item_vectors": """item_vectors AS (
  SELECT CAST(vec_id AS INT) AS mid, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)""",
}
DEPENDS = {"log_lines": ["rating_events"]}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []
    for n in names:
        for dep in DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    return "WITH " + ",\n".join(VIEWS[n] for n in order) + ",\n" + body


def _dense(metric: str, threshold: float) -> str:
    den = "a.n2 * b.n2" if metric == "cosine" else "a.n1 * b.n2"
    return f"""
norms AS (
  SELECT mid, features, sqrt(list_dot_product(features, features)) AS n2,
         list_sum(list_transform(features, lambda x: abs(x))) AS n1
  FROM item_vectors),
pairs AS (
  SELECT a.mid AS mid, b.mid AS rec_mid,
         CAST(CASE WHEN {den} > 0 THEN list_dot_product(a.features, b.features) / ({den}) ELSE 0 END AS DECIMAL(30,12)) AS raw
  FROM norms a JOIN norms b ON a.mid <> b.mid),
kept AS (SELECT mid, rec_mid, raw, CAST(round(raw, 6) AS DOUBLE) AS score FROM pairs WHERE raw > {threshold})"""


def _dense_ranked(metric: str, threshold: float) -> str:
    return with_views(["item_vectors"], _dense(metric, threshold).lstrip() + """
SELECT mid, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid) AS INTEGER) AS rank, rec_mid, score
FROM kept""")


PARSE_RATING = """
  CASE WHEN len(string_split(value, '{sep}')) < 4 THEN 'too_few_fields'
       WHEN TRY_CAST(string_split(value, '{sep}')[1] AS INT) IS NULL THEN 'bad_uid'
       WHEN TRY_CAST(string_split(value, '{sep}')[2] AS INT) IS NULL THEN 'bad_mid'
       WHEN TRY_CAST(string_split(value, '{sep}')[3] AS DOUBLE) IS NULL THEN 'bad_score'
       WHEN TRY_CAST(string_split(value, '{sep}')[4] AS INT) IS NULL THEN 'bad_timestamp'
       ELSE 'ok' END"""

LOG_MESSAGES = """messages AS (
  SELECT event_id,
         regexp_replace(split_part(value, 'MOVIE_RATING_PREFIX:', 2), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS message
  FROM log_lines WHERE contains(value, 'MOVIE_RATING_PREFIX:'))"""

REALTIME = """
trig AS (
  SELECT uid, mid FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM rating_events)
  WHERE rn = 1),
recent AS (
  SELECT uid, mid, score FROM (
    SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn
    FROM rating_events)
  WHERE rn <= 20),
cand AS (
  SELECT uid, rank, mid, sim FROM (
    SELECT t.uid, k.rec_mid AS mid, k.score AS sim,
           CAST(row_number() OVER (PARTITION BY t.uid ORDER BY k.score DESC, k.rec_mid) AS INTEGER) AS rank
    FROM trig t JOIN kept k ON k.mid = t.mid
    WHERE NOT EXISTS (SELECT 1 FROM rating_events h WHERE h.uid = t.uid AND h.mid = k.rec_mid))
  WHERE rank <= 20),
scored AS (
  SELECT c.uid, c.mid,
         CAST(round(CAST(avg(k.score * r.score) + log10(greatest(count_if(r.score > 3), 1))
               - log10(greatest(count_if(r.score <= 3), 1)) AS DECIMAL(30,12)), 6) AS DOUBLE) AS score
  FROM cand c JOIN recent r ON r.uid = c.uid JOIN kept k ON k.mid = c.mid AND k.rec_mid = r.mid
  WHERE k.raw > {score_threshold}
  GROUP BY c.uid, c.mid)"""

TFIDF = """
words AS (
  SELECT mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) AS term FROM movies),
tf AS (SELECT mid, term, count(*) AS tf FROM words WHERE term <> '' GROUP BY mid, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS n FROM movies),
tfidf AS (
  SELECT tf.mid, tf.term, tf.tf, dfq.df, ln((m.n + 1.0) / (dfq.df + 1.0)) AS idf,
         tf.tf * ln((m.n + 1.0) / (dfq.df + 1.0)) AS tfidf
  FROM tf JOIN dfq USING (term) CROSS JOIN m)"""


def _genre_top10() -> str:
    kws = ", ".join(f"('{g}')" for g in C.FIXTURE_GENRES)
    return with_views(["movies", "ratings"], f"""
kw(genre) AS (VALUES {kws}),
avgs AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid),
matched AS (
  SELECT kw.genre AS genres, m.mid, CAST(round(CAST(a.avg AS DECIMAL(30,12)), 6) AS DOUBLE) AS score
  FROM movies m JOIN avgs a ON a.mid = m.mid JOIN kw ON contains(lower(m.genres), lower(kw.genre)))
SELECT genres, rank, mid, score FROM (
  SELECT genres, mid, score, CAST(row_number() OVER (PARTITION BY genres ORDER BY score DESC, mid) AS INTEGER) AS rank FROM matched)
WHERE rank <= 10""")


def _ingest_rejects() -> str:
    return with_views(["rating_events"], """
lines AS (
  SELECT CASE event_id % 11
    WHEN 1 THEN concat('u', uid, ',', mid, ',', score, ',', "timestamp")
    WHEN 2 THEN concat(uid, ',', mid, ',', score)
    WHEN 3 THEN concat(uid, ',', mid, ',bad,', "timestamp")
    WHEN 4 THEN concat(uid, ',', mid, ',', score, ',')
    WHEN 5 THEN concat(uid, ',', mid, ',', score, ',', "timestamp", ',extra')
    WHEN 6 THEN concat(uid, ',,', score, ',', "timestamp")
    ELSE concat(uid, ',', mid, ',', score, ',', "timestamp") END AS value
  FROM rating_events)
SELECT reason, count(*) AS n FROM (SELECT """ + PARSE_RATING.format(sep=",") + """ AS reason FROM lines)
GROUP BY reason""")


def _parsed_stream() -> str:
    return with_views(["log_lines"], LOG_MESSAGES + """,
parsed AS (SELECT event_id, message AS value FROM messages WHERE message <> ''),
typed AS (SELECT event_id, value, """ + PARSE_RATING.format(sep="|") + """ AS reason FROM parsed)
SELECT event_id, CAST(string_split(value, '|')[1] AS INT) AS uid, CAST(string_split(value, '|')[2] AS INT) AS mid,
       CAST(string_split(value, '|')[3] AS DOUBLE) AS score, CAST(string_split(value, '|')[4] AS INT) AS "timestamp"
FROM typed WHERE reason = 'ok'""")


def _stream_progress() -> str:
    return with_views(["log_lines", "rating_events"], LOG_MESSAGES + """,
parsed AS (SELECT event_id, message AS value FROM messages WHERE message <> ''),
typed AS (SELECT event_id, value, """ + PARSE_RATING.format(sep="|") + """ AS reason FROM parsed)
SELECT count(*) AS n_messages, count(*) FILTER (reason <> 'ok') AS n_rejected,
       CAST(min(epoch(ts)) AS BIGINT) AS first_second, CAST(max(epoch(ts)) AS BIGINT) AS last_second,
       count(DISTINCT uid) FILTER (reason = 'ok') AS n_users
FROM typed JOIN rating_events USING (event_id)""")


def _realtime(select: str) -> str:
    body = _dense("cosine", C.REALTIME_MATRIX_THRESHOLD).lstrip() + "," + REALTIME.format(
        score_threshold=C.REALTIME_SCORE_THRESHOLD) + "\n" + select
    return with_views(["item_vectors", "rating_events"], body)


RANKED_SCORES = """SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank, mid, score
FROM scored"""


def _content_similarity() -> str:
    return with_views(["movies"], TFIDF.lstrip() + """,
norms AS (SELECT mid, sqrt(sum(tfidf * tfidf)) AS n FROM tfidf GROUP BY mid),
dots AS (
  SELECT a.mid AS mid, b.mid AS rec_mid, sum(a.tfidf * b.tfidf) AS dot
  FROM tfidf a JOIN tfidf b ON a.term = b.term AND a.mid <> b.mid GROUP BY a.mid, b.mid),
scored AS (
  SELECT d.mid, d.rec_mid, CAST(CASE WHEN na.n * nb.n > 0 THEN d.dot / (na.n * nb.n) ELSE 0 END AS DECIMAL(30,12)) AS raw, CAST(round(raw, 6) AS DOUBLE) AS score
  FROM dots d JOIN norms na ON na.mid = d.mid JOIN norms nb ON nb.mid = d.rec_mid)
SELECT mid, rank, rec_mid, score FROM (
  SELECT mid, rec_mid, score, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid) AS INTEGER) AS rank
  FROM scored WHERE raw > 0)
WHERE rank <= 10""")


def _content_similarity_with_zeros() -> str:
    return with_views(["movies"], TFIDF.lstrip() + """,
norms AS (SELECT mid, sqrt(sum(tfidf * tfidf)) AS n FROM tfidf GROUP BY mid),
dots AS (
  SELECT a.mid AS mid, b.mid AS rec_mid, sum(a.tfidf * b.tfidf) AS dot
  FROM tfidf a JOIN tfidf b ON a.term = b.term AND a.mid <> b.mid GROUP BY a.mid, b.mid),
allpairs AS (SELECT a.mid AS mid, b.mid AS rec_mid FROM movies a JOIN movies b ON a.mid <> b.mid),
scored AS (
  SELECT p.mid, p.rec_mid,
         CAST(round(CAST(CASE WHEN na.n * nb.n > 0 THEN coalesce(d.dot, 0) / (na.n * nb.n) ELSE 0 END
                         AS DECIMAL(30,12)), 6) AS DOUBLE) AS score
  FROM allpairs p LEFT JOIN dots d ON d.mid = p.mid AND d.rec_mid = p.rec_mid
       LEFT JOIN norms na ON na.mid = p.mid LEFT JOIN norms nb ON nb.mid = p.rec_mid)
SELECT mid, rank, rec_mid, score FROM (
  SELECT mid, rec_mid, score,
         CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid) AS INTEGER) AS rank
  FROM scored)
WHERE rank <= 10""")


def statements() -> dict[str, str]:
    movie_cols = "mid, name, descri, timelong, shoot, issue, language, genres, director, actors"
    month = "CAST(strftime(to_timestamp(\"timestamp\") AT TIME ZONE 'UTC', '%Y%m') AS INT)"
    out = {
        "load_movies": with_views(["movies"], "x AS (SELECT 1)\nSELECT * FROM movies"),
        "load_ratings": with_views(["ratings"], "x AS (SELECT 1)\nSELECT * FROM ratings"),
        "load_tags": with_views(["tags"], "x AS (SELECT 1)\nSELECT * FROM tags"),
        "ingest_rejects": _ingest_rejects(),
        "movie_search_docs": with_views(["movies", "tags"], f"""
agg AS (SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid)
SELECT {movie_cols}, agg.tags FROM movies LEFT JOIN agg USING (mid)"""),
        "most_rated": with_views(["ratings"], """x AS (SELECT 1)
SELECT mid, count(mid) AS count FROM ratings GROUP BY mid ORDER BY count DESC, mid"""),
        "most_rated_by_month": with_views(["ratings"], f"""m AS (SELECT mid, {month} AS yyyymm FROM ratings)
SELECT yyyymm, mid, count(mid) AS count FROM m GROUP BY yyyymm, mid ORDER BY yyyymm DESC, count DESC, mid"""),
        "recent_popular_as_written": with_views(["ratings"], f"""m AS (SELECT mid, {month} AS yyyymm FROM ratings)
SELECT mid, count(mid) AS count FROM m GROUP BY yyyymm, mid"""),
        "avg_score": with_views(["ratings"], """x AS (SELECT 1)
SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid ORDER BY avg DESC, mid"""),
        "genre_top10": _genre_top10(),
        "distinct_users": with_views(["ratings"], "x AS (SELECT 1)\nSELECT DISTINCT uid FROM ratings"),
        "distinct_items": with_views(["ratings"], "x AS (SELECT 1)\nSELECT DISTINCT mid FROM ratings"),
        "user_item_grid_count": with_views(["ratings"], """x AS (SELECT 1)
SELECT uid, count(DISTINCT mid) AS n_rated,
       (SELECT count(DISTINCT mid) FROM ratings) - count(DISTINCT mid) AS n_unrated
FROM ratings GROUP BY uid"""),
        "item_similarity_dense": _dense_ranked("cosine", C.DENSE_LIST_THRESHOLD),
        "item_similarity_l1l2": _dense_ranked("l1l2", C.L1L2_THRESHOLD),
        "tfidf_terms": with_views(["movies"], TFIDF.lstrip() + """
SELECT mid, term, tf, df, CAST(round(CAST(idf AS DECIMAL(30,12)), 6) AS DOUBLE) AS idf, CAST(round(CAST(tfidf AS DECIMAL(30,12)), 6) AS DOUBLE) AS tfidf FROM tfidf"""),
        "content_similarity": _content_similarity(),
        "content_similarity_with_zeros": _content_similarity_with_zeros(),
        "recent_ratings": with_views(["rating_events"], """x AS (SELECT 1)
SELECT uid, rank, mid, score FROM (
  SELECT uid, mid, score, CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank
  FROM rating_events)
WHERE rank <= 20"""),
        "candidate_items": _realtime("SELECT uid, rank, mid, sim FROM cand"),
        "realtime_scores": _realtime(RANKED_SCORES),
        "log_filter": with_views(["log_lines"], LOG_MESSAGES + """
SELECT event_id, message FROM messages WHERE message <> ''"""),
        "rating_stream_parse": _parsed_stream(),
        "stream_recs": _realtime(RANKED_SCORES),
        "recent_ratings_stream": with_views(["rating_events"], """x AS (SELECT 1)
SELECT uid, rank, mid, score FROM (
  SELECT uid, mid, score, CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank
  FROM rating_events)
WHERE rank <= 20"""),
        "table_roundtrip": _genre_top10(),
        "rating_republish": with_views(["log_lines"], LOG_MESSAGES + """
SELECT 'logProcessor' AS key, message AS value FROM messages WHERE message <> ''"""),
        "rated_layout": with_views(["ratings"], """x AS (SELECT 1)
SELECT uid, count(*) AS n_ratings, CAST(round(CAST(avg(score) AS DECIMAL(30,12)), 6) AS DOUBLE) AS avg_score FROM ratings GROUP BY uid"""),
    }
    out["keyed_reads"] = with_views(["movies", "ratings", "tags"], """x AS (SELECT 1)
""" + " UNION ALL ".join(f"SELECT '{p}' AS path, {k} AS key, count(*) AS n FROM {t} WHERE {k} IN (SELECT DISTINCT {k} FROM {t} ORDER BY 1 LIMIT 20) GROUP BY {k}"
                         for p, t, k in (("MovieByMid", "movies", "mid"), ("RatingByUser", "ratings", "uid"), ("RatingByMid", "ratings", "mid"),
                                         ("TagByUser", "tags", "uid"), ("TagByMid", "tags", "mid"))))
    out["stream_progress"] = _stream_progress()
    out["hashed_tfidf_checks"] = with_views(["movies"], f"""x AS (SELECT 1)
SELECT mid, len(string_split(lower(replace(genres, '|', ' ')), ' ')) AS n_tokens, {config.TF_BUCKETS} AS n_buckets, true AS ok FROM movies""")
    # written or rendered forms give the rows of the plain query
    out["search_docs_table"] = out["movie_search_docs"]
    out["content_recs_table"] = out["content_similarity"]
    out["content_recs_map"] = f"SELECT mid, rec_mid, score FROM ({out['content_similarity']})"
    out["recent_lists_import"] = out["recent_ratings"]
    out["log_filter_bytes"] = out["log_filter"]
    out["average_and_tags_tables"] = with_views(["ratings", "tags"], """
n AS (SELECT mid, count(*) AS n_tags FROM tags GROUP BY mid)
SELECT mid, CAST(round(CAST(avg AS DECIMAL(30,12)), 6) AS DOUBLE) AS avg, coalesce(n_tags, 0) AS n_tags
FROM (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) LEFT JOIN n USING (mid)""")
    # ALS: what must hold of any correct model, for the users and items of the ratings
    out["als_normal_equations"] = with_views(["ratings"], "x AS (SELECT 1)\nSELECT DISTINCT uid, true AS ok FROM ratings")
    out["als_user_recs_checks"] = with_views(["ratings"], """x AS (SELECT 1)
SELECT DISTINCT uid, least(20, (SELECT count(DISTINCT mid) FROM ratings)) AS n, true AS ok FROM ratings""")
    out["als_user_recs_by_length"] = out["als_user_recs_checks"]
    out["als_predict_checks"] = with_views(["ratings"], "x AS (SELECT 1)\nSELECT uid, count(*) AS n, true AS ok FROM ratings GROUP BY uid")
    out["als_item_lists_checks"] = with_views(["ratings"], "x AS (SELECT 1)\nSELECT DISTINCT mid, true AS ok FROM ratings")
    return out
