"""DuckDB SQL of the training-data queries that SQL can express, written from their contracts."""

ORACLES: dict[str, str] = {}


ORACLES["op5_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 34), ' ') AS s
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p FROM w WHERE len(ws) >= 35)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 34)) AS p FROM win SEMI JOIN rep USING (s)),
g AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN g.n IS NULL THEN ws ELSE
              list_filter(ws, lambda x, i: NOT list_contains(g.ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""

ORACLES["op6_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, array_to_string(list_slice(ws, p, p + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS p FROM w WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN comp ON comp.a = doc_id
"""

ORACLES["op8_decontamination"] = r"""
WITH low AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM low),
item AS (SELECT id, least(len(ws), 10) AS k, array_to_string(list_slice(ws, p, p + least(len(ws), 10) - 1), ' ') AS s
         FROM (SELECT id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS p FROM w WHERE side = 'b' AND len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM item),
win AS (SELECT id, k, p, array_to_string(list_slice(ws, p, p + k - 1), ' ') AS s
        FROM (SELECT id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS p FROM w, ks WHERE side = 'd' AND len(ws) >= k)),
m AS (SELECT DISTINCT win.id, win.p, win.k, item.id AS item_id FROM win JOIN item ON win.k = item.k AND win.s = item.s),
hit AS (SELECT id, count(*) AS n FROM (SELECT DISTINCT id, unnest(generate_series(p, p + k - 1)) AS q FROM m) GROUP BY id),
its AS (SELECT id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY id)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.id = w.id LEFT JOIN its ON its.id = w.id WHERE side = 'd'
"""

ORACLES["op10_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(deg.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN deg ON deg.a = vec_id JOIN comp ON comp.a = vec_id
"""

ORACLES["op9_chat_format"] = r"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t1 AS (SELECT *, len(regexp_extract_all(text, '[0-9A-Za-z_]+|[^0-9A-Za-z_\x20\x09-\x0D]')) + 8 AS cost,
              15 + length(role) + length(regexp_replace(text, '(\\*(?:###|</turn>))', '\\\1', 'g')) AS chars,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM t0),
t2 AS (SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY n) AS stop FROM t1),
t3 AS (SELECT *, stop - cost AS start, CAST(stop - cost AS BIGINT) // 512 AS cell FROM t2),
t4 AS (SELECT *, stop > (cell + 1) * 512 AND sum(cost) OVER (PARTITION BY conv_id, cell ORDER BY n) > 512 AS alone FROM t3),
span AS (SELECT conv_id, min(n) AS lead, sum(chars) AS chars FROM t4 GROUP BY conv_id, cell, alone),
head AS (SELECT conv_id, role = 'system' AS is_system, chars FROM t3 WHERE n = 1),
again AS (SELECT span.conv_id, span.lead, sum(p.chars) AS chars FROM span JOIN t3 l ON l.conv_id = span.conv_id AND l.n = span.lead
          JOIN head ON head.conv_id = span.conv_id JOIN t3 p ON p.conv_id = span.conv_id AND p.n BETWEEN span.lead - 4 AND span.lead - 1
          WHERE l.start - p.start <= 128 AND NOT (p.start = 0 AND head.is_system) GROUP BY ALL),
made AS (SELECT span.conv_id, CAST(sum(span.chars + coalesce(again.chars, 0) + CASE WHEN head.is_system AND span.lead > 1 THEN head.chars ELSE 0 END)
              AS BIGINT) AS formatted_chars
         FROM span JOIN head USING (conv_id) LEFT JOIN again USING (conv_id, lead) GROUP BY span.conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM t3 JOIN made USING (conv_id) GROUP BY conv_id
"""

ORACLES["op12_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM d GROUP BY source),
-- a target is cut if it is above its bound when all sources of smaller bound per weight are cut
lvl AS (SELECT a.source, a.source_size, a.w,
               (SELECT 1.5 * sum(b.source_size) FROM src b) -
               (SELECT coalesce(sum(2.0 * b.source_size), 0) FROM src b WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w) AS rest,
               (SELECT sum(b.w) FROM src b WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w) AS ws FROM src a),
cut AS (SELECT *, rest * w / ws > 2.0 * source_size AS above FROM lvl),
fin AS (SELECT (SELECT 1.5 * sum(source_size) FROM cut) - coalesce(sum(CASE WHEN above THEN 2.0 * source_size END), 0) AS rest,
               sum(CASE WHEN NOT above THEN w END) AS ws FROM cut),
t AS (SELECT source, source_size, CASE WHEN above THEN 2.0 * source_size ELSE fin.rest * w / fin.ws END AS target FROM cut, fin),
p AS (SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS q,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (q // source_size) * size + greatest(0, least(pos + size, q % source_size) - pos) END AS taken
FROM p
"""

ORACLES["op11_lexical_search"] = r"""
WITH low AS (
  SELECT 'd' AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM low WHERE t IS NOT NULL),
every AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM w WHERE side = 'd' AND len(ws) > 0),
tf AS (SELECT id, n, term, count(*) AS tf FROM (SELECT id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM w WHERE side = 'd') GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * every.n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, every),
q AS (SELECT id AS item_id, term, count(*) AS q FROM (SELECT id, unnest(ws) AS term FROM w WHERE side = 'b') GROUP BY ALL),
s AS (SELECT item_id, tf.id AS doc_id,
             CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * tf.n * every.n) // every.l)))) AS BIGINT) AS score
      FROM q JOIN wt USING (term) JOIN tf USING (term), every GROUP BY item_id, tf.id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
