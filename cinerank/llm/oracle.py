"""DuckDB SQL for the queries SQL can express over whole tables.

Written from the contracts, not from the Spark plans: secrets by list functions over
the pieces between matches, pairs by an equi-join on shingles with counted overlaps and
components by a recursive walk, top-k by all inner products."""

from __future__ import annotations

ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
          "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")


def _spans(kind: int, pattern: str, group: int, least: int) -> str:
    return f"""
      SELECT k, {kind} AS kind, s + 0 AS s, s + length(m) AS e, v FROM (
        SELECT k, m, v, gaps + coalesce(sum(length(m)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM (
          SELECT k, i, ms[i] AS m, vs[i] AS v, sum(length(gs[i])) OVER (PARTITION BY k ORDER BY i) AS gaps FROM (
            SELECT k, ms, vs, gs, unnest(range(1, len(ms) + 1)) AS i FROM (
              SELECT k, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
                     string_split_regex(t, '{pattern}') AS gs FROM texts WHERE regexp_matches(t, '{pattern}')))))
      WHERE length(v) >= {least}"""


OP1 = f"""
WITH texts AS (SELECT sha256(t) AS k, t FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents)),
found AS ({_spans(0, ASSIGN, 2, 12)}
  UNION ALL {_spans(1, 'AKIA[A-Z0-9]+', 0, 18)}
  UNION ALL {_spans(2, '[0-9a-f]+', 0, 16)}
  UNION ALL SELECT * FROM ({_spans(3, '[A-Za-z0-9+/_=-]+', 0, 20)})
    WHERE regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]')),
owners AS (SELECT v, count(DISTINCT owner) AS n, count(DISTINCT owner || chr(1) || repo) AS repos FROM found JOIN (
    SELECT sha256(coalesce(text, '')) AS k, coalesce('s' || source, 'n') AS owner, coalesce('l' || lang, 'n') AS repo FROM documents) USING (k) GROUP BY v),
judged AS (SELECT found.*, n <= 2 AND repos <= 4 AS live FROM found JOIN owners USING (v)),
word(kind, w) AS (VALUES (0, 'assign'), (1, 'access'), (2, 'hex'), (3, 'owned')),
per AS (SELECT k,
    count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(w || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
    string_agg(w || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, kind) FILTER (kind < 3 OR live) AS spans,
    count(DISTINCT v) FILTER (live) AS n_live, count(DISTINCT v) FILTER (NOT live) AS n_copied
  FROM judged JOIN word USING (kind) GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS k FROM documents) LEFT JOIN per USING (k)
"""

OP4 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT *, '(</?|\\[/?)(\\\\*)(s>|INST\\])' AS control FROM turns),
e AS (SELECT *, '[INST]' || regexp_replace(role, control, '\\1\\2\\\\\\3', 'g') || '[/INST]' ||
  regexp_replace(text, control, '\\1\\2\\\\\\3', 'g') || '</s>' AS shown FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(length(shown)))::BIGINT AS formatted_chars, true AS identical
FROM e GROUP BY conv_id
"""

OP5 = """
WITH parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
  coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
r(v, h, q) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT host, path, arg_max(h || q, length(h || q)) AS rule, arg_max(v, length(h || q)) AS v
  FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
"""

OP8 = """
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
one AS (SELECT s, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
items AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM one),
overlap AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
link AS (SELECT a, b FROM overlap WHERE 100 * c >= 80 * (na + nb - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
walk AS (SELECT rep AS node, rep AS seen FROM one UNION SELECT node, b FROM walk JOIN both_ways ON seen = a),
comp AS (SELECT node, min(seen) AS component FROM walk GROUP BY node)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, sets.doc_id) AS component_id,
  coalesce(component, sets.doc_id) = sets.doc_id AS kept
FROM sets LEFT JOIN one ON list_sort(sets.s) = one.s LEFT JOIN comp ON comp.node = one.rep
"""

OP9 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s) WHERE rank <= 5
"""

LEVELS = 8      # levels of runs that the manifest's SQL spells out: 16^8 documents a source
CRC32 = ("xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length({0}) + 1), lambda i: "
         "list_transform(range(8), lambda j: (ord({0}[i]) >> j) & 1))), "
         "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)")


def _levels(name: str, first: str) -> str:
    """Levels of runs over ``first`` (tree, pos, d): a run's text and digest, until one node is left."""
    out = [f"{name}0 AS (SELECT tree, pos, d, count(*) OVER (PARTITION BY tree) AS n FROM ({first}))"]
    for i in range(LEVELS):
        out.append(f"""{name}{i + 1} AS (
  SELECT tree, pos, text, CASE WHEN alone THEN text ELSE sha256(text) END AS d, alone, count(*) OVER (PARTITION BY tree) AS n FROM (
    SELECT tree, pos // 16 AS pos, string_agg(d, '' ORDER BY pos) AS text, bool_and(n = 1) AS alone FROM {name}{i} GROUP BY 1, 2))""")
    return ",\n".join(out)


def _climb(name: str, i: int, rows: str) -> str:
    """``rows`` (k, tree, pos, proof, own, n) one level up: siblings joined to the proof, own digest folded."""
    at = f"(r.pos // {16 ** i}) % 16 * 64"
    return f"""SELECT r.k, r.tree, r.pos, r.proof || CASE WHEN alone THEN '' ELSE substr(text, 1, {at}) || substr(text, {at} + 65) END AS proof,
    CASE WHEN alone THEN r.own ELSE sha256(substr(text, 1, {at}) || r.own || substr(text, {at} + 65)) END AS own
  FROM ({rows}) r JOIN {name}{i + 1} l ON l.tree = r.tree AND l.pos = r.pos // {16 ** (i + 1)}"""


def _climbs(name: str, rows: str, step: str) -> str:
    out = []
    for i in range(LEVELS):
        out.append(f"{step}{i + 1} AS ({_climb(name, i, rows)})")
        rows = f"SELECT * FROM {step}{i + 1}"
    return ",\n".join(out)


def _stated(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


OP11 = f"""
WITH leaves AS (
  SELECT *, row_number() OVER () AS k, coalesce('=' || source, '-') AS tree, sha256(head || {_stated('text')}) AS leaf,
    CASE WHEN text IS NOT NULL AND {CRC32.format('(doc_id::VARCHAR)')} % 5 = 0
      THEN sha256(head || {_stated("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS changed
  FROM (SELECT *, {' || '.join(_stated(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} AS head FROM documents)),
placed AS (SELECT k, doc_id, tree, leaf, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{_levels('s', 'SELECT tree, pos, leaf AS d FROM placed')},
tops AS (SELECT tree AS name, '*' AS tree, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM s{LEVELS}),
{_levels('t', 'SELECT tree, pos, d FROM tops')},
{_climbs('s', "SELECT k, tree, pos, '' AS proof, coalesce(changed, leaf) AS own FROM placed", 'a')},
{_climbs('t', f"SELECT k, tops.tree, tops.pos, proof, own FROM a{LEVELS} a JOIN tops ON a.tree = tops.name", 'b')}
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = t.d AS verified
FROM placed JOIN b{LEVELS} b USING (k) JOIN s{LEVELS} s ON s.tree = placed.tree, t{LEVELS} t
"""

ORACLE = {"op1_secret_scan": OP1, "op4_chat_format": OP4, "op5_url_filter": OP5, "op8_near_dedup": OP8,
          "op9_exact_dedup": OP9, "op10_top_k": OP10, "op11_merkle_manifest": OP11}
