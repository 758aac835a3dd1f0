"""DuckDB SQL of the operators that SQL can express (same columns as the queries)."""

from __future__ import annotations

OP1 = r"""
WITH items AS (
  SELECT item_id, w, least(len(w), 5) AS k
  FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
        FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s FROM items),
sizes AS (SELECT item_id, count(*) AS n FROM wanted GROUP BY item_id),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL),
held AS (  -- windows of the items' sizes: five words, or an item's own number
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s
  FROM docs, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM held JOIN wanted USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, n_shared, n_shared / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= ceil(0.8 * n - 1e-9)
"""


OP6 = r"""
WITH t AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS c, conv_id,
         '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS shown,
         concat_ws(chr(31), coalesce('=' || role, '-'), coalesce('=' || text, '-')) || chr(30) AS code,
         row_number() OVER (PARTITION BY coalesce(conv_id::VARCHAR, '') ORDER BY turn NULLS LAST, role NULLS FIRST) AS pos
  FROM conversations),
p AS (
  SELECT c, conv_id, pos, count(*) OVER (PARTITION BY c) AS n,
         string_agg(code, '') OVER (PARTITION BY c ORDER BY pos) AS prefix,
         string_agg(shown, '') OVER (PARTITION BY c ORDER BY pos) AS text
  FROM t),
whole AS (
  SELECT min(conv_id) AS conv_id, pos AS n_turns, count(*) AS n_equal, any_value(text) AS text, prefix
  FROM p WHERE pos = n GROUP BY pos, prefix)
SELECT conv_id, n_turns, n_equal, text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = whole.n_turns AND p.prefix = whole.prefix)
"""

OP13 = r"""
WITH RECURSIVE coded AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS front,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
         list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
             lambda k: [ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, tree, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(front || coalesce(strlen(small) || ':' || small, '-'))
              ELSE sha256(front || coalesce(strlen(text) || ':' || text, '-')) END AS shown
  FROM coded),
leaves AS (
  SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, pos AS i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8, n),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, rank AS i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM tops WHERE n > 1 GROUP BY level, i // 8, n),
every AS (
  SELECT tree, level, i, h, n FROM nodes
  UNION ALL SELECT NULL, level, i, h, n FROM tops),
runs AS (
  SELECT tree, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM every WHERE n > 1 GROUP BY tree, level, i // 8),
steps AS (  -- siblings of every node
  SELECT e.tree, e.level, e.i, array_to_string(hs[1:(e.i % 8)], '') AS lft, array_to_string(hs[(e.i % 8) + 2:], '') AS rgt
  FROM every e JOIN runs r ON e.tree IS NOT DISTINCT FROM r.tree AND e.level = r.level AND e.i // 8 = r.run WHERE e.n > 1),
height AS (SELECT tree, max(level) AS levels FROM nodes GROUP BY tree),
walk AS (  -- up the language's tree, then up the top tree
  SELECT rid, 0 AS step, leaves.tree, 0 AS level, pos AS i, shown AS h, '' AS proof, rank, levels, leaves.tree AS name
  FROM leaves JOIN subroots USING (tree) JOIN height USING (tree)
  UNION ALL
  SELECT rid, step + 1, CASE WHEN crosses THEN NULL ELSE tree END, CASE WHEN crosses THEN 0 ELSE level + 1 END,
         CASE WHEN crosses THEN rank ELSE i // 8 END, CASE WHEN crosses THEN h ELSE sha256(lft || h || rgt) END,
         CASE WHEN crosses THEN proof ELSE proof || lft || rgt END, rank, levels, name
  FROM (SELECT w.*, s.lft, s.rgt, w.tree IS NOT NULL AND w.level = w.levels AS crosses, s.i IS NOT NULL AS climbs
        FROM walk w LEFT JOIN steps s ON w.tree IS NOT DISTINCT FROM s.tree AND w.level = s.level AND w.i = s.i)
  WHERE crosses OR climbs),
ends AS (SELECT rid, max_by(h, step) AS folded_root, max_by(proof, step) AS proof FROM walk GROUP BY rid),
top AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (rid) CROSS JOIN top
"""


def statements() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op6_chat": OP6, "op13_merkle": OP13}
