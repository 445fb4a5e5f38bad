"""DuckDB SQL of the queries on conversations and embeddings, written from their
contracts: dynamic programming over whole audits, and all products."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"

#: CRC-32 of an ASCII text, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({x}) + 1), lambda i: ascii({x}[i])::BIGINT)),
 lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
 lambda d, i: xor(d >> 1, CASE WHEN d & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

CONVERSATION_REPAIR = f"""
WITH RECURSIVE given AS (
 SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
dealt AS (SELECT *, {_CRC.format(x='k')} % 20 AS d FROM given),
damaged AS (
 SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE d WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM dealt WHERE d <> 0),
placed AS (
 SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM damaged),
faulty AS (
 SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?]{SPACE}*$') THEN 'truncated' END AS fault,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
inserted(p, m, k) AS (VALUES (0,0,0),(0,2,1),(0,3,2),(1,1,0),(1,2,1),(1,3,2),(2,2,0),(2,3,1),(2,2,2),(3,3,0),(3,2,1),(3,3,2)),
allowed(m, initial, q) AS (VALUES (0,'s',1),(0,'u',2),(1,'u',2),(2,'a',3),(3,'u',2)),
edits AS (
 SELECT c.conv_id, c.i, e.p, e.q, e.cost, e.edit, e.lines FROM faulty c, LATERAL (
  SELECT p, m AS q, 2 * k + 3 AS cost, repeat('I', k) || 'D' AS edit,
   CASE WHEN k = 0 THEN []::VARCHAR[] ELSE list_transform(range(k), lambda j: CASE WHEN (j % 2 = 0) = (p <> 2) THEN 'user:' ELSE 'assistant:' END) END AS lines
   FROM inserted
  UNION ALL
  SELECT n.p, CASE WHEN n.m = 2 THEN 3 ELSE 2 END, 2 * n.k + 2 + CASE WHEN c.fault = 'truncated' THEN 1 ELSE 0 END, repeat('I', n.k) || 'R',
   list_transform(range(n.k), lambda j: CASE WHEN (j % 2 = 0) = (n.p <> 2) THEN 'user:' ELSE 'assistant:' END)
    || [CASE WHEN n.m = 2 THEN 'assistant:' ELSE 'user:' END || c.text]
   FROM inserted n WHERE coalesce(c.fault, '') NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT n.p, a.q, 2 * n.k + CASE WHEN c.fault = 'truncated' THEN 1 ELSE 0 END, repeat('I', n.k) || 'K',
   list_transform(range(n.k), lambda j: CASE WHEN (j % 2 = 0) = (n.p <> 2) THEN 'user:' ELSE 'assistant:' END) || [c.role || ':' || c.text]
   FROM inserted n JOIN allowed a ON a.m = n.m AND a.initial = c.role[1] WHERE coalesce(c.fault, '') NOT IN ('blank', 'duplicate')) e),
ways AS (
 SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} AS best FROM placed
 UNION ALL
 SELECT w.conv_id, w.i + 1, e.q, min({{'c': w.best.c + e.cost, 'a': w.best.a || e.edit, 'l': w.best.l || e.lines}})
 FROM ways w JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.p = w.s
 GROUP BY w.conv_id, w.i, e.q),
sizes AS (
 SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
 FROM faulty GROUP BY conv_id),
ends AS (
 SELECT w.conv_id, min({{'c': w.best.c + 2 * len(t.tail), 'a': w.best.a || t.tail, 'l': w.best.l || t.lines}}) AS best
 FROM ways w JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = z.n
 JOIN (VALUES (0, '', []::VARCHAR[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', []::VARCHAR[]))
  t(s, tail, lines) ON t.s = w.s GROUP BY w.conv_id)
SELECT g.conv_id, CAST(coalesce(z.gaps, 0) AS BIGINT) AS gaps, coalesce(z.blank, 0) AS blank, coalesce(z.duplicate, 0) AS duplicate,
 coalesce(z.truncated, 0) AS truncated, coalesce(z.illegal, 0) AS illegal, CAST(coalesce(e.best.c, 0) AS BIGINT) AS cost,
 coalesce(e.best.a, '') AS audit, sha256(coalesce(array_to_string(e.best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM g.conv_id"""

HARD_NEGATIVES = """
WITH valid AS (
 SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
 SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
  CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
 FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS r
  FROM pairs WHERE same) WHERE r <= 5),
ranked AS (
 SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS r
 FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 5"""
