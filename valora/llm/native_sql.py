"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Unsigned CRC-32 by bytes: ``crc`` has the table of 256 entries as one list.
CRC = """steps AS (
  SELECT i, i AS v, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)"""


def crc32(text: str, table: str = "crc.t") -> str:
    """CRC-32 of the UTF-8 bytes of ``text``, with ``crc`` joined."""
    return f"""xor(4294967295, list_reduce(list_transform(
      range(1, 2 * octet_length(encode({text})) + 1, 2), lambda p: ('0x' || substr(hex(encode({text})), p, 2))::BIGINT),
      lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1]), 4294967295::BIGINT))"""


SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC},
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, c, {crc32("(doc_id::VARCHAR || ':' || run)")} AS h FROM runs, crc),
results AS (
  SELECT CASE WHEN h % 199 = 0
         THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c
  FROM hashed),
words AS (
  SELECT word, sum(c)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (
  SELECT word, n, p, substr(word, 1, p::INT) || substr(word, p::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut AS a JOIN cut AS b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut AS a JOIN words AS b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other COLLATE C) AS best, max(other_n) AS best_n
  FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
         CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words AS w LEFT JOIN near USING (word)),
chains AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chains AS c JOIN forms AS f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms AS f JOIN (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word) AS c USING (word)
"""

#: A trie node is the list of its turns; subtree sums go from each node, and
#: from each leaf, to all its prefixes.
PREFIX_TRIE = f"""
WITH RECURSIVE {CRC},
turns AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, own, ({crc32("conv_id::VARCHAR")} % 6)::INT AS h FROM turns, crc),
paths AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS path
  FROM hashed AS a LEFT JOIN turns AS b ON b.conv_id = a.conv_id - a.conv_id % 100),
places AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN len(path) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ids
  FROM places GROUP BY ALL),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
weighed AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[depth].t) END AS saved
  FROM nodes AS n LEFT JOIN children AS c ON c.node = n.node),
sums AS (
  SELECT node[1:d] AS node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT node, leaf, saved, unnest(range(depth + 1)) AS d FROM weighed) GROUP BY ALL)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(w.ids, '')) AS ends_sha256
FROM weighed AS w JOIN sums AS s ON s.node = w.node
LEFT JOIN nodes AS p ON w.depth > 0 AND p.node = w.node[1:w.depth - 1]
"""
