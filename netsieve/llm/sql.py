"""SQL twins of the queries that SQL can state, for DuckDB."""

_WORDS4 = r"regexp_extract_all({low}, '[^ \t\n\x0B\f\r]+')"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".replace("{low}", _LOW)

OP3 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
), m AS (SELECT d, n, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d, n)
SELECT page_id, p.n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN top IS NULL OR top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d AND p.n = m.n
"""

OP4 = """
WITH l AS (
  SELECT doc_id, i - 1 AS line, parts[i] AS said, len(parts) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL) t,
    unnest(range(1, len(parts) + 1)) AS u(i)
), w AS (
  SELECT a.doc_id, a.line, row_number() OVER (PARTITION BY a.said, b.said, c.said ORDER BY a.doc_id, a.line) AS k
  FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.line = a.line + 1 JOIN l c ON c.doc_id = a.doc_id AND c.line = a.line + 2
), gone AS (
  SELECT DISTINCT doc_id, line + j AS line FROM w, unnest([0, 1, 2]) AS u(j) WHERE k > 1
), kept AS (
  SELECT l.doc_id, string_agg(CASE WHEN gone.line IS NULL THEN said END, chr(10) ORDER BY l.line) AS text,
    max(l.n) AS n_lines, count(gone.line) AS n_removed
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.line = l.line GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

# characters of a text or role behind backslashes: one for each backslash and each control string, overlapping ones too
_WRITTEN = """length({x}) * 2 - length(replace({x}, chr(92), '')) + (length({x}) - length(replace({x}, '</turn>', ''))) // 7
  + coalesce(list_sum(list_transform(regexp_extract_all({x}, '#{3,}'), lambda r: length(r) - 2)), 0)"""

OP6 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before, lead(k0) OVER w IS NULL AS last
  FROM (SELECT *, 1 AS k0 FROM t) WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), e AS (
  SELECT *, """ + _WRITTEN.replace("{x}", "text") + """ + 9 + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
    ELSE 7 + length(role) - length(replace(role, ':', '')) + """ + _WRITTEN.replace("{x}", "role") + """ END AS written,
    CASE WHEN k = 1 THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
      WHEN before = 'user' THEN role = 'assistant' ELSE false END AND (NOT last OR role = 'assistant') AS fits
  FROM o
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(written)::BIGINT AS formatted_chars, bool_and(fits) AS valid
FROM e GROUP BY conv_id
"""

OP7 = """
WITH RECURSIVE t AS (SELECT doc_id, """ + _WORDS4.replace("{low}", _LOW) + """ AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 3], 'string_agg', ' ') AS shingle
  FROM t, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS u(i)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP8 = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r(rhost, rpath, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), f AS (
  SELECT page_id, host, path, rhost || rpath AS rule, v,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS k
  FROM h LEFT JOIN r ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f WHERE k = 1
"""

OP9 = """
WITH d AS (SELECT doc_id, """ + _WORDS + """ AS w FROM documents),
b AS (SELECT item_id, """ + _WORDS + """ AS w FROM benchmark),
x AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i : i + 9], 'string_agg', ' ') AS window_words
  FROM b, unnest(range(1, greatest(len(w) - 8, least(len(w), 1) + 1))) AS u(i)
), o AS (
  SELECT doc_id, i, z.n, list_aggregate(w[i : i + z.n - 1], 'string_agg', ' ') AS window_words
  FROM d, (SELECT DISTINCT n FROM x) z, unnest(range(1, len(w) - z.n + 2)) AS u(i)
), f AS (SELECT doc_id, i, o.n, item_id FROM o JOIN x ON x.n = o.n AND x.window_words = o.window_words),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM f, unnest(range(0, n)) AS u(j) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM f) q GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""

OP10 = """
WITH s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: CAST(q.embedding[i] AS DOUBLE) * CAST(c.embedding[i] AS DOUBLE))) AS score
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""

# CRC-32 of a decimal id, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda s, d: list_reduce(list_concat([xor(s, d)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, z: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""

OP12 = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
h AS (SELECT c, c - c % 5 AS b, """ + _CRC + """ % 9 AS h FROM n),
r AS (
  SELECT h.c, pos, role, text FROM h JOIN t ON t.c = h.b AND pos < h.h
  UNION ALL
  SELECT h.c, pos - h.h + least(h.h, coalesce(b.n, 0)), role, text FROM h JOIN t ON t.c = h.c AND pos >= h.h LEFT JOIN n b ON b.c = h.b
), p AS (
  SELECT c, 0 AS d, '' AS key, 0 AS bytes FROM h
  UNION ALL
  SELECT c, pos + 1, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY pos)),
    octet_length(encode(text)) FROM r
), node AS (SELECT key, min(c) AS c, min(d) AS d, count(*) AS n, min(bytes) AS bytes FROM p GROUP BY key),
own AS (SELECT node.*, p.key AS above FROM node LEFT JOIN p ON p.c = node.c AND p.d = node.d - 1),
kids AS (SELECT above AS key, count(*) AS k FROM own WHERE above IS NOT NULL GROUP BY above),
sums AS (
  SELECT p.key, sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS leaves, sum((node.n - 1) * node.bytes) AS saved
  FROM node LEFT JOIN kids ON kids.key = node.key JOIN p ON p.c = node.c AND p.d <= node.d GROUP BY p.key
), ends AS (
  SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e
  FROM (SELECT c, key, row_number() OVER (PARTITION BY c ORDER BY d DESC) AS k FROM p) WHERE k = 1 GROUP BY key
)
SELECT own.c AS conv_id, own.d AS depth, up.c AS parent_conv_id, own.n AS n_convs, coalesce(k, 0) AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
FROM own LEFT JOIN node up ON up.key = own.above LEFT JOIN kids ON kids.key = own.key JOIN sums ON sums.key = own.key
  LEFT JOIN ends ON ends.key = own.key
"""
