"""SQL twins of the manifest and of conversation repair."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII string, bit by bit."""
    step = "lambda x, k: xor(x >> 1, 3988292384 * (x & 1))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    byte = f"lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


#: Levels by recursion over whole trees; each leaf then climbs to the root.
MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT doc_id, source, coalesce('s' || source, 'null') AS tree, {_leaf("text")} AS leaf,
          CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
               THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS shown
        FROM documents)),
s AS (
  SELECT tree, source, 0 AS level, i, n, leaf AS h FROM d
  UNION ALL
  SELECT tree, source, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM s WHERE n > 1 GROUP BY tree, source, level, i // 16, n),
t AS (
  SELECT tree AS leaf_tree, 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h FROM s WHERE n = 1
  UNION ALL
  SELECT NULL, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY level, i // 16, n),
r AS (
  SELECT tree, level, i // 16 AS p, list(h ORDER BY i) AS hs
  FROM (SELECT tree, level, i, n, h FROM s UNION ALL SELECT 'top', level, i, n, h FROM t) WHERE n > 1 GROUP BY ALL),
w AS (
  SELECT doc_id, leaf, tree, tree AS here, 0 AS level, i, n, coalesce(shown, leaf) AS fold, '' AS proof FROM d
  UNION ALL
  SELECT doc_id, leaf, w.tree, CASE WHEN w.n > 1 THEN here ELSE 'top' END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.i // 16 ELSE t.i END, CASE WHEN w.n > 1 THEN (w.n + 15) // 16 ELSE t.n END,
         CASE WHEN w.n > 1 THEN sha256(coalesce(array_to_string(hs[1:w.i % 16], ''), '') || fold || coalesce(array_to_string(hs[w.i % 16 + 2:], ''), '')) ELSE fold END,
         CASE WHEN w.n > 1 THEN proof || coalesce(array_to_string(hs[1:w.i % 16], ''), '') || coalesce(array_to_string(hs[w.i % 16 + 2:], ''), '') ELSE proof END
  FROM w LEFT JOIN r ON w.n > 1 AND r.tree = here AND r.level = w.level AND r.p = w.i // 16
         LEFT JOIN t ON w.n = 1 AND t.leaf_tree = here
  WHERE w.n > 1 OR here <> 'top')
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.h AS verified
FROM w JOIN s ON s.tree = w.tree AND s.n = 1 JOIN t ON t.n = 1 WHERE w.here = 'top' AND w.n = 1
"""


_CONV_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
#: Least (cost, audit) by state, row by row: the cost is padded, so the least string is the least pair.
REPAIR = f"""
WITH RECURSIVE f AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_CONV_KEY)} % 20 AS k FROM conversations),
g AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS time
  FROM f WHERE k <> 0),
o AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), 'null') AS c,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM g),
p AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
             row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS prior FROM o),
q AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM p),
moves(q1, q2, op, ini, cost) AS (VALUES
  (0, 0, 'D', '', 4), (1, 1, 'D', '', 4), (2, 2, 'D', '', 4), (3, 3, 'D', '', 4), (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0),
  (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0), (0, 2, 'R', '', 3), (1, 2, 'R', '', 3), (3, 2, 'R', '', 3), (2, 3, 'R', '', 3)),
gaps(q2, q3, ins) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (2, 3, 'I'), (3, 2, 'I'), (0, 3, 'II'), (1, 3, 'II')),
dp AS (
  SELECT c, 0::BIGINT AS i, q3 AS q, lpad(CAST(3 * length(ins) AS VARCHAR), 9, '0') || ins AS v FROM (SELECT DISTINCT c FROM q), gaps WHERE q2 = 0
  UNION ALL
  SELECT dp.c, q.i, q3, min(lpad(CAST(CAST(substr(v, 1, 9) AS BIGINT) + cost + 3 * length(ins)
                                      + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS VARCHAR), 9, '0') || substr(v, 10) || op || ins)
  FROM dp JOIN q ON q.c = dp.c AND q.i = dp.i + 1 JOIN moves ON q1 = dp.q JOIN gaps ON gaps.q2 = moves.q2
  WHERE op = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (op = 'R' OR ini = left(role, 1)))
  GROUP BY dp.c, q.i, q3),
e AS (
  SELECT c, CAST(substr(min(v), 1, 9) AS BIGINT) AS cost, substr(min(v), 10) AS audit
  FROM dp WHERE dp.q IN (0, 3) AND dp.i = (SELECT max(i) FROM q WHERE q.c = dp.c) GROUP BY c),
u AS (SELECT c, unnest(string_split(audit, '')) AS op, unnest(range(1, length(audit) + 1)) AS k FROM e WHERE audit <> ''),
x AS (SELECT *, sum(CASE WHEN op = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY k) AS i, row_number() OVER (PARTITION BY c, op = 'D' ORDER BY k) AS place FROM u),
y AS (
  SELECT x.c, k, place, op, CASE WHEN op = 'I' THEN '' ELSE text END AS text, role,
         max(CASE WHEN place = 1 AND op = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.c) AS head
  FROM x LEFT JOIN q ON q.c = x.c AND q.i = x.i WHERE op <> 'D'),
z AS (
  SELECT c, sha256(string_agg(CASE WHEN op = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS h
  FROM y GROUP BY c),
n AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM q GROUP BY c)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'null') AS c FROM conversations) a
LEFT JOIN n USING (c) LEFT JOIN e USING (c) LEFT JOIN z USING (c)
"""
