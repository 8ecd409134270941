"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP4 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

OP8 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, row_number() OVER w AS place,
         lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes,
         length(regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|SEP\])', '\1\2\\\3', 'g')) AS body,
         length(regexp_replace(role, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|SEP\])', '\1\2\\\3', 'g')) AS name
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + CASE WHEN opens THEN 9 + name ELSE 5 END + CASE WHEN closes THEN 4 ELSE 0 END) AS BIGINT)
         AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP2 = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line
  FROM documents
), worded AS (
  SELECT doc_id, line, raw, list_filter(regexp_split_to_array(raw, '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS w FROM split
), placed AS (
  SELECT doc_id, line, w, array_to_string(w, ' ') AS s FROM worded WHERE len(w) >= 1
), firsts AS (
  SELECT s, any_value(w) AS w, min((doc_id, line)) AS first FROM placed GROUP BY s
), variants AS (
  SELECT s, first, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') AS v
  FROM (SELECT s, w, first, unnest(range(1, len(w) + 1)) AS i FROM firsts WHERE len(w) >= 8)
), near AS (
  SELECT s FROM (SELECT s, first, min(first) OVER (PARTITION BY v, i) AS keeper FROM variants) WHERE keeper < first
  UNION
  SELECT v.s FROM variants v JOIN firsts f ON v.v = f.s WHERE len(f.w) >= 8 AND f.first < v.first
  UNION
  SELECT f.s FROM variants v JOIN firsts f ON v.v = f.s WHERE len(f.w) >= 8 AND v.first < f.first
), gone AS (
  SELECT p.doc_id, p.line FROM placed p JOIN firsts f ON p.s = f.s
  WHERE (p.doc_id, p.line) <> f.first OR p.s IN (SELECT s FROM near)
)
SELECT d.doc_id, count(*) AS lines, count(g.line) AS dropped_lines,
       sha256(coalesce(string_agg(d.raw, chr(10) ORDER BY d.line) FILTER (g.line IS NULL), '')) AS text_sha256
FROM split d LEFT JOIN gone g ON d.doc_id = g.doc_id AND d.line = g.line GROUP BY d.doc_id
"""

#: CTEs for crc32 of decimal ids: ``checks`` (doc_id, h), its table of 256 entries made by the rule.
CHECKS = r"""
table_256 AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), checks AS (
  SELECT doc_id, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), table_256
)
"""

OP12 = f"""
WITH RECURSIVE {CHECKS}, rows_ AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, text, h,
         list_aggregate(list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
           lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '') AS front
  FROM documents LEFT JOIN checks USING (doc_id)
), leaves AS (
  SELECT row_number() OVER () AS r, doc_id, tree, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN h % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered, front
  FROM rows_
), placed AS (
  SELECT r, doc_id, tree, leaf, sha256(front || coalesce(strlen(altered) || ':' || altered, '-')) AS given,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), lower_ AS (
  SELECT 0 AS level, tree, nth, leaf AS digest, n FROM placed
  UNION ALL
  SELECT level + 1, tree, nth // 3, sha256(string_agg(digest, '' ORDER BY nth)), (n + 2) // 3
  FROM lower_ WHERE n > 1 GROUP BY level, tree, nth // 3, n
), subroots AS (
  SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS nth, count(*) OVER () AS n FROM lower_ WHERE n = 1
), upper_ AS (
  SELECT 0 AS level, nth, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, nth // 3, sha256(string_agg(digest, '' ORDER BY nth)), (n + 2) // 3 FROM upper_ WHERE n > 1 GROUP BY level, nth // 3, n
), steps AS (
  SELECT p.r, l.level, l.nth < p.nth // CAST(pow(3, l.level) AS BIGINT) AS before, l.nth, l.digest
  FROM placed p JOIN lower_ l
    ON l.tree = p.tree AND l.n > 1 AND l.nth // 3 = p.nth // CAST(pow(3, l.level + 1) AS BIGINT) AND l.nth <> p.nth // CAST(pow(3, l.level) AS BIGINT)
  UNION ALL
  SELECT p.r, s.level + u.level, u.nth < s.nth // CAST(pow(3, u.level) AS BIGINT), u.nth, u.digest
  FROM placed p JOIN subroots s USING (tree) JOIN upper_ u
    ON u.n > 1 AND u.nth // 3 = s.nth // CAST(pow(3, u.level + 1) AS BIGINT) AND u.nth <> s.nth // CAST(pow(3, u.level) AS BIGINT)
), sides AS (
  SELECT r, level, coalesce(string_agg(digest, '' ORDER BY nth) FILTER (before), '') AS b,
         coalesce(string_agg(digest, '' ORDER BY nth) FILTER (NOT before), '') AS a
  FROM steps GROUP BY r, level
), heights AS (
  SELECT p.r, s.level + (SELECT max(level) FROM upper_) AS height, s.digest AS subroot FROM placed p JOIN subroots s USING (tree)
), climbed AS (
  SELECT r, 0 AS level, given AS digest FROM placed
  UNION ALL
  SELECT c.r, c.level + 1, sha256(coalesce(s.b, '') || c.digest || coalesce(s.a, ''))
  FROM climbed c JOIN heights h ON c.r = h.r AND c.level < h.height LEFT JOIN sides s ON s.r = c.r AND s.level = c.level
), proofs AS (
  SELECT r, sha256(string_agg(b || a, '' ORDER BY level)) AS proof FROM sides GROUP BY r
)
SELECT p.doc_id, p.leaf, h.subroot, t.digest AS root, coalesce(f.proof, sha256('')) AS proof_sha256, c.digest AS folded_root,
       c.digest = t.digest AS verified
FROM placed p JOIN heights h USING (r) JOIN climbed c ON c.r = p.r AND c.level = h.height LEFT JOIN proofs f ON f.r = p.r
CROSS JOIN (SELECT digest FROM upper_ WHERE n = 1) t
"""

# Three words that agree with the three p words on begin every run, so pairs are joined on trigrams.
OP13 = f"""
WITH {CHECKS}, raw AS (
  SELECT row_number() OVER () AS r, doc_id, h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS w
  FROM documents LEFT JOIN checks USING (doc_id)
), measured AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM raw
), planted AS (
  SELECT r, doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)),
           lambda i: CASE WHEN i >= a THEN w[a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) + 1] ELSE w[i + 1] END) END AS w
  FROM measured
), words AS (
  SELECT r, unnest(range(len(w))) AS i, unnest(w) AS x FROM planted
), grams AS (
  SELECT r, i, x || ' ' || lead(x, 1) OVER k || ' ' || lead(x, 2) OVER k AS x, count(*) OVER (PARTITION BY r) AS n
  FROM words WINDOW k AS (PARTITION BY r ORDER BY i)
), pairs AS (
  SELECT a.r, a.i, b.i - a.i AS p FROM grams a JOIN grams b ON a.r = b.r AND a.x = b.x AND a.i < b.i
  WHERE 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT r, p, min(i) AS start, count(*) + 2 + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM pairs) GROUP BY r, p, island
), found AS (
  SELECT r, start, length, min(p) AS p FROM stretches WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length
), kept AS (
  SELECT w.r, string_agg(w.x, ' ' ORDER BY w.i) AS s FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.r = w.r AND w.i >= f.start + f.p AND w.i < f.start + f.length) GROUP BY w.r
), best AS (
  SELECT r, start, length, p FROM found QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, p) = 1
), listed AS (
  SELECT r, count(*) AS n, string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS s FROM found GROUP BY r
)
SELECT d.doc_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length,
       CAST(b.p AS BIGINT) AS period, CAST(1000 * b.length // b.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.s, '')) AS runs_sha256, sha256(coalesce(k.s, '')) AS collapsed_sha256
FROM planted d LEFT JOIN listed l USING (r) LEFT JOIN best b USING (r) LEFT JOIN kept k USING (r)
"""

ORACLES = {"op2_line_dedup": OP2, "op4_topk": OP4, "op8_chat": OP8, "op12_merkle": OP12, "op13_runs": OP13}
