"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), o AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS owner FROM h
)
SELECT
  page_id,
  payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, CAST(5 * (j // 4) + 1 AS INTEGER), 5) AS BIGINT)
      >> (15 - 5 * (j % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM o
"""

LINE_DEDUP = """
WITH l AS (
  SELECT doc_id, place, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), k AS (
  SELECT key, min(doc_id) AS owner FROM l WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT l.doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE owner < l.doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
    FILTER (WHERE owner IS NULL OR owner = l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN k ON l.key = k.key
GROUP BY l.doc_id
"""

QUOTES = r"""
WITH RECURSIVE originals AS (
  SELECT conv_id, turn, max(text) AS said FROM conversations GROUP BY conv_id, turn
), quoting AS (
  SELECT c.conv_id, c.turn, c.role,
    CASE WHEN c.turn % 4 = 3 AND far.said IS NOT NULL THEN
      concat('> > ', replace(far.said, chr(10), concat(chr(10), '> > ')), chr(10)) ELSE '' END ||
    CASE WHEN c.turn % 2 = 1 AND near.said IS NOT NULL THEN
      concat('> ', replace(near.said, chr(10), concat(chr(10), '> ')), chr(10)) ELSE '' END ||
    coalesce(c.text, '') AS text
  FROM conversations c
  LEFT JOIN originals near ON near.conv_id = c.conv_id AND near.turn = c.turn - 1 - c.turn % 3
  LEFT JOIN originals far ON far.conv_id = c.conv_id AND far.turn = c.turn - 2
), l AS (
  SELECT conv_id, turn, place, whole,
    length(regexp_replace(regexp_extract(whole, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g')) AS level,
    regexp_replace(whole, '^[ \t]*(?:>[ \t]*)+', '') AS line
  FROM (SELECT conv_id, turn, unnest(parts) AS whole, unnest(range(len(parts))) AS place
        FROM (SELECT conv_id, turn, string_split(coalesce(text, ''), chr(10)) AS parts
              FROM quoting))
), r AS (
  SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY place) AS run
  FROM (SELECT *, CASE WHEN level <> lag(level) OVER (PARTITION BY conv_id, turn ORDER BY place)
          THEN 1 ELSE 0 END AS new FROM l)
), u AS (
  SELECT conv_id, turn, level, trim(regexp_replace(lower(unit), '\s+', ' ', 'g')) AS key, weight
  FROM (SELECT conv_id, turn, level, string_agg(line, ' ' ORDER BY place) AS unit,
          count(*) + 1 AS weight FROM r GROUP BY conv_id, turn, level, run
        UNION ALL SELECT conv_id, turn, level, line, 1 FROM r)
), o AS (
  SELECT conv_id, key, min(turn) AS first FROM u WHERE level = 0 AND key <> ''
  GROUP BY conv_id, key
), v AS (
  SELECT u.conv_id, u.turn, level, first, sum(weight) AS weight
  FROM u JOIN o ON u.conv_id = o.conv_id AND u.key = o.key AND first < u.turn
  WHERE level > 0 GROUP BY u.conv_id, u.turn, level, first
), p AS (
  SELECT conv_id, turn, first AS reply_to FROM v
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn
    ORDER BY level, weight DESC, first DESC) = 1
), t AS (
  SELECT c.conv_id, c.turn, c.turn AS thread
  FROM quoting c LEFT JOIN p ON p.conv_id = c.conv_id AND p.turn = c.turn
  WHERE p.turn IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, t.thread
  FROM p JOIN t ON t.conv_id = p.conv_id AND t.turn = p.reply_to
), k AS (
  SELECT conv_id, turn, bool_or(level > 0) AS quotes,
    trim(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE level = 0), ''),
      chr(10)) AS own
  FROM l GROUP BY conv_id, turn
)
SELECT c.conv_id,
  row_number() OVER (PARTITION BY c.conv_id ORDER BY thread, c.turn) - 1 AS position,
  c.turn, c.role, CASE WHEN quotes THEN own ELSE coalesce(c.text, '') END AS content,
  reply_to, thread
FROM quoting c
JOIN t ON t.conv_id = c.conv_id AND t.turn = c.turn
JOIN k ON k.conv_id = c.conv_id AND k.turn = c.turn
LEFT JOIN p ON p.conv_id = c.conv_id AND p.turn = c.turn
"""

PREFIX_TRIE = r"""
WITH t AS (
  SELECT conv_id,
    list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), c AS (
  SELECT conv_id, turns, CAST(xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])),
      lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS INTEGER) AS h
  FROM t
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM c LEFT JOIN t AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), p AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM r
), n AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY ALL
), k AS (
  SELECT n.*, count(b.path) AS n_children FROM n
  LEFT JOIN n AS b ON b.depth = n.depth + 1 AND b.path[1:n.depth] = n.path
  GROUP BY ALL
), s AS (
  SELECT conv_id, depth, unnest(range(depth + 1)) AS above, path, n_children,
    (n_convs - 1) * CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM k
), u AS (
  SELECT path[1:above] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM s GROUP BY path[1:above]
)
SELECT k.conv_id, k.depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, u.n_leaves,
  u.saved_tokens, k.ends_sha256
FROM k JOIN u ON u.path = k.path
LEFT JOIN k AS up ON up.depth = k.depth - 1 AND up.path = k.path[1:k.depth - 1]
"""

LEXICAL = r"""
WITH dt AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), it AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), q AS (
  SELECT item_id, term, count(*) AS qtf FROM it GROUP BY ALL
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY ALL
), d AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), a AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), a
), x AS (
  SELECT q.item_id, tf.doc_id, CAST(sum(qtf * w * ((1000000000 * tf) //
    (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id), a
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM x WHERE score > 0
) WHERE rank <= 10
"""

ORACLES = {
    "op6_line_dedup": LINE_DEDUP,
    "op7_chat_quotes": QUOTES,
    "op9_warc": WARC,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_lexical_search": LEXICAL,
}
